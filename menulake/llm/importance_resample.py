"""Resampling documents towards a target distribution by importance weights (operator 13).

*Weights.* Features are the runs of one to three consecutive words; a feature's
bucket is its crc32 modulo ``BUCKETS``. Two passes go over the texts: the first
counts the buckets, one array a task, the second sums the buckets' gains (a
fixed array of ``BUCKETS`` numbers) over each document's features and adds the
seeded Gumbel noise that turns the highest scores into a draw without replacement.

*Selection.* The draw's last key is found by weighted medians of medians. Every
task takes the lower median of each batch of its remaining keys and from these
the one that halves their sizes; the driver does the same with the tasks'
medians, a key a task. The keys up to such a pivot are counted while the next
medians of either side are taken, so a round is one job. At each level at least
half of the sizes lie in groups whose median is no greater (no smaller) than the
pivot, and half of such a group with it, so a round discards an eighth of the
remaining keys or more. Once ``LAST`` keys or fewer remain, they are read and the
cutoff is taken from them. Keys are distinct (a row's number ends them), so the
draw has its exact size. Only the winners are sorted, by ranges, and numbered
from the ranges' sizes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from menulake.llm.common import Tables, text_of

BUCKETS, GRAMS = 10_000, 3
SHARE, LEAST_WORDS, SEED = 5, 20, 42
#: So many remaining keys at most are read at once to end the selection.
LAST = 4_096

#: Bytes of words: digits, small letters and all of UTF-8's longer characters; capitals become small ones.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lowered: runs of [0-9a-z] and non-ASCII characters, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def buckets(w: list[bytes], n_buckets: int = BUCKETS, grams: int = GRAMS) -> np.ndarray:
    """The bucket of each run of 1 to ``grams`` words: a longer run's checksum goes on from the shorter one's."""
    spaced, sums, out = [b" " + x for x in w], list(map(crc32, w)), []
    for k in range(grams):
        if k:
            sums = list(map(crc32, spaced[k:], sums))
        out.append(np.fromiter(sums, np.uint32, len(sums)))
    return np.concatenate(out) % np.uint32(n_buckets)


def _count(n_buckets: int, grams: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            for text in b.column(0):
                total += np.bincount(buckets(words(text.as_py()), n_buckets, grams), minlength=n_buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, n_buckets: int = BUCKETS, grams: int = GRAMS) -> np.ndarray:
    """How many features of all ``texts`` (one column) fall into each bucket; the tasks' arrays are summed by Spark."""
    rows = texts.mapInArrow(_count(n_buckets, grams), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(n_buckets, np.int64)
    for r in rows.collect():  # n_buckets rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of target to corpus share) for each bucket."""
    n, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + n) / ((s + 1) * (all_t + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Seeded Gumbel noise in thousandths; a null id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gain: np.ndarray, grams: int, least_words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = words(text.as_py())
                at = buckets(w, len(gain), grams)
                weight = int(gain[at].sum())
                rows.append((i, len(at), weight, weight + noise(i, seed), len(w) >= least_words))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(),) * 4 + (pa.bool_(),), strict=True)] if rows else [pa.array([], t) for t in (pa.int64(),) * 4 + (pa.bool_(),)], ["doc_id", "n_features", "weight", "score", "eligible"])
    return run


Key = tuple[int, ...]


def weighted_median(keys: Sequence[Key], sizes: Sequence[int]) -> Key:
    """The least key such that the keys up to it hold half of all sizes."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    half, upto = sum(sizes) / 2, 0
    for i in order:
        upto += sizes[i]
        if upto >= half:
            return keys[i]
    raise ValueError("no keys")


def _medians(pivot: Key | None, n_cols: int):
    """For the keys up to the pivot and for those above it: how many a task has, and the median of its batches' medians."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bool, tuple[list[Key], list[int]]] = {False: ([], []), True: ([], [])}
        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(n_cols)]
            order = np.lexsort(cols[::-1])
            keys = [c[order] for c in cols]
            low = 0
            if pivot is not None:
                # rows are in order: count those up to the pivot
                upto, same = np.zeros(len(order), bool), np.ones(len(order), bool)
                for c, p in zip(keys, pivot, strict=True):
                    upto |= same & (c < p)
                    same &= c == p
                low = int((upto | same).sum())
            for above, first, n in ((False, 0, low), (True, low, len(order) - low)):
                if n:
                    found[above][0].append(tuple(int(c[first + (n - 1) // 2]) for c in keys))
                    found[above][1].append(n)
        for above, (medians, sizes) in found.items():
            if sizes:
                m = weighted_median(medians, sizes)
                yield pa.RecordBatch.from_arrays([pa.array([above]), pa.array([sum(sizes)], pa.int64()), *(pa.array([x], pa.int64()) for x in m)], ["above", "n", *(f"m{k}" for k in range(n_cols))])
    return run


def _compare(cols: Sequence[str], key: Key, above: bool) -> Column:
    """Whether the row's key is above the given one, or up to it."""
    tests, same = [], F.lit(True)
    for c, v in zip(cols, key, strict=True):
        tests.append(same & (F.col(c) > v))
        same = same & (F.col(c) == v)
    is_above = reduce(lambda a, b: a | b, tests)
    return is_above if above else ~is_above


def nth_key(keys: DataFrame, nth: int, last: int = LAST) -> Key | None:
    """The ``nth`` smallest (from 1) of the distinct keys that the long columns of ``keys`` form; None where there are fewer.

    ``keys`` is read once a round, so it should be a written table.
    """
    cols, low, high, pivot, need = keys.columns, None, None, None, nth
    schema = "above boolean, n long, " + ", ".join(f"m{k} long" for k in range(len(cols)))
    while need > 0:
        rest = keys
        if low is not None:
            rest = rest.where(_compare(cols, low, True))
        if high is not None:
            rest = rest.where(_compare(cols, high, False))
        sides: dict[bool, list] = {False: [], True: []}
        for r in rest.mapInArrow(_medians(pivot, len(cols)), schema).collect():  # two rows a task
            sides[r["above"]].append((tuple(r)[2:], r["n"]))
        n_low = sum(n for _, n in sides[False])
        if pivot is not None and n_low == need:
            return pivot
        if pivot is not None and n_low > need:
            high, side = pivot, sides[False]
        else:
            low, need, side = pivot if pivot is not None else low, need - n_low, sides[True]
        left = sum(n for _, n in side)
        if left < need:
            return None
        if left <= last:
            rest = keys if low is None else keys.where(_compare(cols, low, True))
            rest = rest if high is None else rest.where(_compare(cols, high, False))
            return sorted(tuple(r) for r in rest.collect())[need - 1]
        pivot = weighted_median([m for m, _ in side], [n for _, n in side])
    return None


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", share: int = SHARE, least_words: int = LEAST_WORDS, n_buckets: int = BUCKETS, grams: int = GRAMS, seed: int = SEED, last: int = LAST) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for each row of ``docs``, all long.

    Of the N rows with at least ``least_words`` words, floor(share N / 100) with the
    highest scores are drawn and ranked from 1, ties to smaller doc_id (null
    last); the others' rank is null. A null text has no words; repeated rows
    are rows of their own and rank one after the other; an empty table gives no
    rows, an empty ``target`` gains that only follow the corpus. Other columns are
    ignored. The same rows give the same scores in whatever order they come.
    """
    spark = docs.sparkSession
    t = Tables(spark, "resample")
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs[text_col]).alias("text"))
    wanted = target.select(text_of(target[target_col]).alias("text"))
    gain = gains(bucket_counts(d.select("text"), n_buckets, grams), bucket_counts(wanted, n_buckets, grams))
    scored = d.mapInArrow(_score(gain, grams, least_words, seed), "doc_id long, n_features long, weight long, score long, eligible boolean")
    scored = t.cut(scored.withColumn("row", F.monotonically_increasing_id()), "scored")

    drawn = scored.where("eligible").count() * share // 100
    keys = scored.where("eligible").select((-F.col("score")).alias("by_score"), F.col("doc_id").isNull().cast("long").alias("no_id"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), "row")
    cutoff = nth_key(keys, drawn, last)
    if cutoff is None:
        return scored.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    winners = keys.where(_compare(keys.columns, cutoff, False)).orderBy(*keys.columns)
    winners = t.cut(winners.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "winners")
    # a row a range: the ranges before it
    sizes = winners.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ranks = winners.join(offsets, "part").select("row", (F.col("before") + within + 1).cast("long").alias("rank"))
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
