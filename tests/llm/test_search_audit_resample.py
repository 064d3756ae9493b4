"""Exact top-k search, filter audit and importance resampling against brute force, with edge rows."""

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import pytest

from menulake.llm.common import table
from menulake.llm.filter_audit import FILTERS, filter_audit, stream_changes, take
from menulake.llm.importance_resample import importance_resample, nth_key, weighted_median, words
from menulake.llm.top_scores import top_scores

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- top-k search

def _best(rows, top=5, every=50, scale=256):
    v = [(i, [max(-2 ** 62, min(2 ** 62, math.floor(scale * x))) for x in x]) for i, x in rows
         if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for n, (i, q) in enumerate(v):
        if i is not None and i % every == 0:
            scored = [(sum(a * b for a, b in zip(q, x)), j) for m, (j, x) in enumerate(v) if m != n]
            scored.sort(key=lambda t: (-t[0], t[1] is None, t[1] or 0))
            out += [(i, r + 1, j, s) for r, (s, j) in enumerate(scored[:top])]
    return sorted(out, key=repr)


def _vectors(n=400, dims=9):
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = [(i - 20, [c + r.gauss(0, 0.2) for c in r.choice(centres)]) for i in range(n)]
    rows += [(50, list(rows[120][1])), (50, list(rows[120][1])), (1000, [0.0] * dims), (1001, [0.0] * dims), (None, rows[70][1])]
    rows += [(2000 + i, list(rows[70][1])) for i in range(300)]  # one very common vector
    rows += [(1100, None), (1150, [0.1, None] + [0.0] * (dims - 2)), (1200, [float("nan")] * dims), (1250, [float("inf")] * dims)]
    return rows + [(1300, []), (1350, [0.5, -0.25])]


@pytest.mark.parametrize("lists,depth,block", [(1, 5, 4096), (2, 32, 64), (3, 6, 100)])
def test_top_scores_are_all_pairs(spark, lists, depth, block):
    rows = _vectors()
    df = spark.createDataFrame([(i, x, 0, 0, "z") for i, x in rows], "vec_id long, embedding array<double>, row int, score int, list string")
    got = top_scores(df.repartition(3), lists=lists, depth=depth, block=block)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == _best(rows)


def test_top_scores_of_large_components_and_few_rows(spark):
    rows = [(0, [2.0 ** 20, -1.0]), (50, [2.0 ** 21, 3.0]), (7, [-(2.0 ** 21) + 0.5, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_scores(df).collect()), key=repr) == _best(rows)
    huge = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in sorted(top_scores(huge).collect(), key=lambda r: r.rank)] == [1, 2]
    assert top_scores(df.limit(0)).collect() == []
    assert top_scores(df.where("vec_id = 0")).collect() == []


# ---------------------------------------------------------------- filter audit

def _fails(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, x in (("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)), ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)),
                           ("D", bool(re.search(r"[#$%&*|]", text)))) if x}


def _report(docs, labels):
    docs = [(i, t or "", p or "") for i, t, p in docs]
    rows = []
    for i, t, p in docs:
        own = _fails(t)
        if i is not None and any(j is not None and j < i and u == t for j, u, _ in docs):
            own.add("E")
        rows.append((p, own, any(j == i and q == 1 for j, q, _ in labels if j is not None), any(j == i and x == 1 for j, _, x in labels if j is not None)))
    out = {}
    for part in {p for p, *_ in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in itertools.permutations(FILTERS):
            left = mine
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def _documents():
    r = random.Random(5)
    long = " ".join(f"w{r.randrange(900)}" for _ in range(80))
    texts = [long, "kurz", None, "", "A B " * 60, long + " # x", "ÄÖ é " * 30, "\x1f ä\x0b" * 40, "50% off", "x " * 20_000 + "END", long.upper()]
    docs = [(100 - i, texts[i % len(texts)], ["s1", "s2", None, ""][i % 4], "m", i) for i in range(90)]
    docs += [(7, "same", "s1", "m", 0), (7, "same", "s2", "m", 0), (3, "same", "s3", "m", 0), (9, "same", "s1", "m", 0), (None, "same", "s1", "m", 0), (None, long, "s2", "m", 0)]
    return docs


LABELS = [(100, 1, 0), (99, 0, 1), (50, 1, 1), (50, None, None), (7, 1, 0), (3, 0, 1), (None, 1, 1), (12, 1, None)]


def _got(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_filter_audit_against_all_orders(spark, scratch):
    docs = _documents()
    path = os.path.join(scratch, "docs")
    # greater ids come first: later batches retract what earlier ones counted
    for k in range(0, len(docs), 24):
        spark.createDataFrame(docs[k:k + 24], "doc_id long, text string, source string, mask string, bucket long").coalesce(1).write.mode("append").parquet(path)
    labels = spark.createDataFrame([(*x, "e") for x in LABELS], "doc_id long, quality int, toxic int, part string")
    got = filter_audit(spark, path, labels, bucket=8, batches=4)
    assert dict(got.dtypes)["step"] == "int" and dict(got.dtypes)["shapley"] == "bigint"
    assert _got(got) == _report([d[:3] for d in docs], LABELS)


def test_later_files_retract_what_was_counted(spark, scratch):
    src, target, checkpoint = (os.path.join(scratch, x) for x in ("src", "changes", "checkpoint"))
    schema = "doc_id long, text string, source string"
    spark.createDataFrame([(5, "a", "p"), (6, "a", "q")], schema).coalesce(1).write.mode("append").parquet(src)
    assert stream_changes(spark, src, target, checkpoint) == 1
    assert stream_changes(spark, src, target, checkpoint) == 0
    spark.createDataFrame([(2, "a", "r")], schema).coalesce(1).write.mode("append").parquet(src)
    assert stream_changes(spark, src, target, checkpoint) == 1
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{target}/batch=1").drop("batch").collect())
    short = 1  # fails A
    assert rows == [(2, "r", short, 1), (5, "p", short, -1), (5, "p", short | 16, 1)]


def test_changes_are_the_same_in_any_order():
    rows = [(i, "p" if i % 2 else "q", m) for i, m in ((4, 0), (2, 1), (2, 1), (9, 3), (1, 2))]
    want = Counter({(i, p, m | (16 if i > 1 else 0)): n for (i, p, m), n in Counter(rows).items()})
    for order in itertools.permutations(rows):
        entries, total = {}, Counter()
        for i, p, m in order:
            for *row, delta in take(entries, b"k", i, p, m):
                total[tuple(row)] += delta
        assert +total == want and min(total.values()) >= 0


def test_filter_audit_of_an_empty_table(spark, scratch):
    path = os.path.join(scratch, "none")
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(path)
    assert filter_audit(spark, path, table(spark, SF, "labels")).collect() == []


# ---------------------------------------------------------------- resampling

def _resampled(docs, target, share=5):
    def grams(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[k:k + n]).encode()) % 10_000 for n in (1, 2, 3) for k in range(len(w) - n + 1)]
    own = [(i, *grams(t)) for i, t in docs]
    s, t = Counter(b for *_, g in own for b in g), Counter(b for x in target for b in grams(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n_words, g in own:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        rows.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words >= 20))
    able = sorted((k for k, r in enumerate(rows) if r[4]), key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0))
    rank = {k: n + 1 for n, k in enumerate(able[:share * len(able) // 100])}
    return sorted(((*r[:4], rank.get(k)) for k, r in enumerate(rows)), key=repr)


def test_resample_is_brute_force(spark):
    docs = table(spark, SF, "documents")
    bench = table(spark, SF, "benchmark")
    want = _resampled([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    for last in (1, 4_096):  # to the last key by medians, and with the rest read at once
        got = importance_resample(docs.repartition(5), bench, last=last)
        assert [t for _, t in got.dtypes] == ["bigint"] * 5
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_resample_edge_rows(spark):
    text = " ".join(f"Wort{k % 37} Über-{k} \x00x" for k in range(60))
    docs = [(k, text) for k in range(30)] + [(5, text)] * 20 + [(None, text), (None, text), (-4, None), (91, ""), (92, "x " * 50_000), (93, "a\x7fb\x80c")]
    frame = spark.createDataFrame([(*d, 1, "s", 2.0) for d in docs], "doc_id long, text string, weight int, row string, rank double")
    bench = spark.createDataFrame([("Wort1 über 3",), (None,)], "text string")
    for share in (5, 50, 100):
        got = sorted(map(tuple, importance_resample(frame.repartition(4), bench, share=share, last=1).collect()), key=repr)
        assert got == _resampled(docs, ["Wort1 über 3", None], share)
    assert importance_resample(frame.limit(0), bench).collect() == []
    assert all(r.rank is None for r in importance_resample(frame.limit(3), bench.limit(0)).collect())
    assert words("A1b é\tZ_z\x00q") == ["a1b".encode(), "é".encode(), b"z", b"z", b"q"]


def test_nth_key_by_weighted_medians(spark):
    r = random.Random(1)
    keys = [(r.randrange(20), k) for k in range(3_000)]
    df = spark.createDataFrame(keys, "a long, b long").repartition(6).cache()
    for nth in (1, 2, 1_500, 2_999, 3_000):
        assert nth_key(df, nth, last=1) == sorted(keys)[nth - 1]
    assert nth_key(df, 3_001) is None and nth_key(df, 0) is None
    assert weighted_median([(3,), (1,), (2,)], [1, 1, 5]) == (2,)
    df.unpersist()
