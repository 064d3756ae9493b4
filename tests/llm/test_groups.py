"""Near copies, near vectors and components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from menulake.llm import near_vectors as nv
from menulake.llm.common import Tables, table
from menulake.llm.components import components
from menulake.llm.near_copies import compare, near_copies, signatures, windows, without_near_copies
from menulake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def bag(text):
    import re
    w = re.findall(r"\w+", text.lower())
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def expected_classes(rows):
    bags, u = {i: bag(t or "") for i, t in rows}, Union()
    by = {}
    for i, b in bags.items():
        u.find(i)
        for k in b:
            by.setdefault(k, []).append(i)
    for i in bags:
        for j in {j for k in bags[i] for j in by[k] if j < i}:
            if jaccard(bags[i], bags[j]) >= 0.8 - 1e-12:
                u.join(i, j)
    return {i: u.find(i) for i in bags}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2001 + i) for i in range(300)]
    edges = [e for e in edges if e[0] != e[1]]
    u = Union()
    for a, b in edges:
        u.join(a, b)
    got = {r.node: r.root for r in components(Tables(spark, "test"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: u.find(n) for n in u}
    assert components(Tables(spark, "test"), spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_estimate_the_weighted_jaccard():
    rng = np.random.default_rng(0)
    h = np.sort(rng.integers(0, 2 ** 63, 300).astype(np.uint64))
    a = rng.integers(1, 40, 300)
    b = np.maximum(1, a + rng.integers(-6, 7, 300))
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    s = signatures(np.repeat([0, 1], 300), np.concatenate([h, h]), np.concatenate([a, b]), 2, 8000)
    assert abs((s[0] == s[1]).mean() - want) < 0.02


def test_windows_are_those_of_each_text():
    texts = ["A b, c d e f a b c d e.", "", "x y", "a b c d e", "!!"]
    doc, _, count = windows(texts)
    for i, t in enumerate(texts):
        assert sorted(count[doc == i]) == sorted(bag(t).values())


def test_compare_finds_what_a_partner_must_share():
    rng = random.Random(4)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
    def edited(words, n):
        w = list(words)
        for _ in range(n):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        return w
    hub = " ".join(base)
    for _ in range(60):
        x = edited(base, rng.randrange(2, 9))
        y = edited(x, rng.randrange(0, 3))
        x, y = " ".join(x), " ".join(y)
        assert compare(x, hub)[0] == (jaccard(bag(x), bag(hub)) >= 0.8)
        if jaccard(bag(x), bag(y)) >= 0.8 and jaccard(bag(x), bag(hub)) < 0.8:
            assert set(compare(x, hub)[1].tolist()) & set(compare(y, hub)[1].tolist())


def test_families_of_copies(spark):
    rng = random.Random(9)
    rows, n = [], 0
    for _ in range(4):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(40, 160))]
        for _ in range(45):
            w = list(base)
            for _ in range(rng.randrange(0, 7)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            if rng.random() < 0.3:
                base = w  # the family drifts, so that chains hold it together
            rows.append((n, " ".join(w)))
            n += 1
    want = expected_classes(rows)
    got = {r.doc_id: r.class_id for r in near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and 4 < len(set(want.values())) < 160


def test_copies_edge_rows(spark):
    d = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "x y", 1), (4, "X, y!", 1), (4, "X, y!", 1), (5, "!!", 1), (None, "x y", 1), (6, "a b c d e f g", 1), (6, "z b c d e f g", 1), (7, "w " * 50_000, 1), (8, "w " * 49_000, 1)], "doc_id long, text string, size int")
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in near_copies(d).collect()), key=str)
    assert got == sorted([(None, 3, False), (1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False), (4, 3, False), (5, 5, True), (6, 6, True), (6, 6, True), (7, 7, True), (8, 7, False)], key=str)
    assert sorted(r.doc_id for r in without_near_copies(d).collect()) == [1, 2, 3, 5, 6, 6, 7]
    assert without_near_copies(d).columns == d.columns
    assert near_copies(d.limit(0)).count() == 0


def test_copies_whole_table(spark):
    want = expected_classes([(d.doc_id, d.text) for d in table(spark, SF, "documents").collect()])
    got = QUERIES["op5_near_copies"](spark, SF).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def brute(ids, x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    u = Union()
    for i in ids:
        u.find(i)
    for i, j in zip(*np.nonzero(near)):
        u.join(ids[i], ids[j])
    return {i: (int(near[k].sum()), u.find(i)) for k, i in enumerate(ids)}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_vectors_whole_table(spark):
    e = table(spark, SF, "embeddings").toPandas()
    got = QUERIES["op4_near_vectors"](spark, SF)
    assert result(got) == brute(e.vec_id.tolist(), np.stack(e.embedding).astype(float))
    assert all(r.kept == (r.vec_id == r.component_id) and r.audit_recall >= 0.99 for r in got.collect())


@pytest.mark.parametrize("step", [0.02, 0.12])
def test_chains_and_balls_in_several_shards(spark, monkeypatch, step):
    monkeypatch.setattr(nv, "SHARD", 120)
    rng = np.random.default_rng(3)
    points = []
    for b in rng.normal(size=(40, 16)):
        v = b.copy()
        for _ in range(12):
            v = v + rng.normal(size=16) * step * np.linalg.norm(v) / 4 * rng.integers(0, 4)
            points.append(v.copy())
    x, ids = np.array(points), list(range(100, 100 + len(points)))
    rows = [(i, v.tolist(), 1) for i, v in zip(ids, x)]
    odd = [(1, None, 0), (2, [0.0] * 16, 0), (3, [float("nan")] * 16, 0), (4, [None] * 16, 0), (5, [], 0), (6, [1.0, 2.0], 0), (None, [1.0] * 16, 0), (100, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, leader int")
    got = nv.near_vectors(df).collect()
    assert len(got) == len(rows) + len(odd)
    want = brute(ids, x) | {i: (0, i) for i in range(1, 7)} | {None: (0, None)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_empty_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert result(nv.near_vectors(df)) == {1: (0, 1), 2: (0, 2)}
    assert nv.near_vectors(df.limit(0)).count() == 0


def test_large_groups_end_in_few_rounds(spark, monkeypatch):
    """Texts chained by a common licence: the rounds end, and the classes are those of all pairs."""
    import random
    from menulake.llm import near_copies as module
    monkeypatch.setattr(module, "GROUP", 8)
    r = random.Random(11)
    licence = [f"lic{k}" for k in range(90)]
    texts = []
    for k in range(40):
        own = [f"w{r.randrange(10 ** 6)}" for _ in range(60 + k % 7)]
        texts.append(own + licence)
        if k % 3 == 0:
            texts.append([*own[:-2], "x", *licence])
    for k in range(30):  # near copies of one text
        copy = list(texts[0])
        copy[r.randrange(len(copy))] = f"edit{k}"
        texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    seen = []
    monkeypatch.setattr(module.Tables, "cut", lambda self, df, label, cut=module.Tables.cut: (seen.append(label), cut(self, df, label))[1])
    got = {x.doc_id: x.class_id for x in near_copies(spark.createDataFrame(rows, "doc_id long, text string"), bands=40, rows=2).collect()}
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and jaccard(bags[i], bags[j]) >= 0.8:
                a, b = max(root[i], root[j]), min(root[i], root[j])
                root = [b if x == a else x for x in root]
    assert [got[i] for i in range(len(rows))] == root
    assert 1 <= seen.count("compared") <= 8


def test_helper_columns_never_clash(spark):
    from menulake.llm.mix import mixed_documents
    docs = spark.createDataFrame([(1, "a b c d e f", "s", 7, 8, 9), (2, "a b c d e f", "s", 7, 8, 9)],
                                 "doc_id long, text string, source string, _key int, key int, _id int")
    assert [tuple(r) for r in without_near_copies(docs).collect()] == [(1, "a b c d e f", "s", 7, 8, 9)]
    wide = docs.selectExpr("*", "1 AS mix_id", "2 AS MIX_SIZE", "3 AS mix_whole", "4 AS _size", "5 AS mix_part", "6 AS mix_copy")
    assert mixed_documents(wide).columns == wide.columns and mixed_documents(wide).count() > 0


def test_a_group_is_resolved_as_by_all_pairs():
    import random
    from menulake.llm.near_copies import resolve
    r = random.Random(2)
    for _ in range(40):
        base = [[f"w{r.randrange(12)}" for _ in range(r.randrange(0, 40))] for _ in range(4)]
        texts = []
        for _ in range(25):
            t = list(r.choice(base)) * r.choice((1, 1, 2))
            for _ in range(r.randrange(3)):
                if t:
                    t[r.randrange(len(t))] = f"w{r.randrange(12)}"
            texts.append(" ".join(t))
        bags = [bag(t) for t in texts]
        want, got = list(range(len(texts))), list(range(len(texts)))
        for root, links in ((want, [(i, j) for i in range(len(texts)) for j in range(i) if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= 0.8]), (got, resolve(texts))):
            for i, j in links:
                a, b = root[i], root[j]
                root[:] = [min(a, b) if x in (a, b) else x for x in root]
        assert got == want
    assert resolve([]) == [] and resolve(["", "a"]) == []


def test_a_window_of_a_pair_has_enough_left_on_both_sides():
    from menulake.llm.near_copies import beyond, counted
    r = random.Random(5)
    met = 0
    for _ in range(600):
        base = [f"w{r.randrange(50)}" for _ in range(r.randrange(12, 60))]

        def edited(words, changes):
            t = list(words)
            for _ in range(changes):
                t[r.randrange(len(t))] = f"w{r.randrange(80)}"
            return t[:len(t) - r.randrange(3)]
        x = edited(base, r.randrange(3))
        y, h = edited(x, r.randrange(3)), edited(base, r.randrange(4))
        x, y, h = sorted((counted(" ".join(t)) for t in (x, y, h)), key=lambda c: c[1].sum(), reverse=True)
        (lx, wx, left_x, need_x), (ly, wy, left_y, need_y) = beyond(x, h), beyond(y, h)
        if beyond(x, y)[0] and not (lx and ly):
            # the group's wanted number is that of its unlinked texts, at most
            wanted = min(n for n, near in ((need_x, lx), (need_y, ly)) if not near)
            assert set(wx[left_x >= wanted].tolist()) & set(wy[left_y >= wanted].tolist())
            met += 1
    assert met > 20


def test_nodes_with_many_common_neighbours_leave_few_edges(spark, monkeypatch):
    from menulake.llm import components as module
    from menulake.llm.common import Tables
    left, rounds = [], module._rounds

    def counted(t, edges):
        left.append(edges.distinct().count())
        return rounds(t, edges)

    monkeypatch.setattr(module, "_rounds", counted)
    # 500 texts, each with 28 of 40 firsts, and a chain beside them
    edges = [(1000 + x, (x + 3 * b) % 40) for x in range(500) for b in range(28)] + [(k, k + 1) for k in range(5000, 5060)] + [(9000, 9000)]
    got = {r.node: r.root for r in module.components(Tables(spark, "test"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 if n < 2000 else 5000 if n < 9000 else n for e in edges for n in e}
    assert left[0] < 1_000


def test_only_texts_that_may_be_wanted_are_shuffled(spark):
    from menulake.llm.near_copies import _likely
    d = spark.range(5_000).selectExpr("IF(id = 3, NULL, id) AS doc_id", "concat('t', id) AS text")
    wanted = d.where("doc_id % 10 = 0 OR doc_id IS NULL").select("doc_id")
    got = {r.doc_id for r in _likely(d, wanted).collect()}
    assert {r.doc_id for r in wanted.collect()} <= got and len(got) < 600
    assert _likely(d, wanted).columns == d.columns and not _likely(d, wanted.limit(0)).count()
