"""How filters of a corpus interact, by a stream with retractions (operator 12).

The files of a documents table are processed once as a stream of available-now
micro-batches. Each text becomes a mask of the filters A to D that it fails. A
document also fails E if any smaller doc_id has the same text, which later files
can still bring: the state keeps, for each text (by a 16-byte digest), the
least doc_id so far and the rows that bear it. A row with a greater id
is counted as failing E at once. A smaller id takes the text over: the
rows counted before are retracted and counted again as failing E. The changes
(+1, -1) are written batch by batch, each batch in a folder of its own that a
replayed batch overwrites; their sums are the counters.

The state is kept in buckets of texts, whose number grows with the table, so a
bucket stays small and a micro-batch makes one call a bucket. Before the
shuffle, rows whose text a smaller id has in the same Arrow batch are settled and
dealt out by their own ids, so a text that holds a third of all rows sends one
row a batch to its bucket.

The counters of a part (32 masks by label) give the number of rows that pass each
set of filters; everything in the report of all orders follows from those 32
numbers.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import pickle
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from menulake.llm.common import Tables

FILTERS = "ABCDE"
SAME = 1 << FILTERS.index("E")
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
#: Texts to a bucket of state, and micro-batches in which all files are processed.
BUCKET, BATCHES = 1_024, 4
_CAPITALS = bytes(range(65, 91))
_SIGNS = re.compile(rb"[#$%&*|]")

Entry = tuple[int, list[tuple[str, int]]]


def mask(text: bytes) -> int:
    """The filters A to D that a UTF-8 text fails, as bits. ``bytes.split`` parts at space, tab, LF, VT, FF and CR alone."""
    words = text.split()
    points = len(text) - len(text.translate(None, bytes(range(0x80)) + bytes(range(0xC0, 0x100))))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    fails = (len(words) < LEAST_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words),
             100 * capitals > CAPITAL_PERCENT * points, _SIGNS.search(text) is not None)
    return sum(1 << k for k, x in enumerate(fails) if x)


def _facts(n_buckets: int):
    """doc_id, part, mask, key, bucket; a row that is settled within its batch has no key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            masks, keys, least = [], [], {}
            for i, text in zip(ids, b.column(1).cast(pa.binary()), strict=True):
                text = text.as_py() or b""
                key = hashlib.blake2b(text, digest_size=16).digest()
                masks.append(mask(text))
                keys.append(key)
                if i is not None:
                    least[key] = min(i, least.get(key, i))
            for k, i in enumerate(ids):
                if i is None or i > least[keys[k]]:
                    masks[k] |= 0 if i is None else SAME
                    keys[k] = None
            dealt = [int.from_bytes(key[:8], "big") % n_buckets if key else hash((i, k)) % n_buckets for k, (key, i) in enumerate(zip(keys, ids, strict=True))]
            parts = ["" if p is None else p for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.string()), pa.array(masks, pa.int32()), pa.array(keys, pa.binary()), pa.array(dealt, pa.int64())], ["doc_id", "part", "mask", "key", "bucket"])
    return run


def take(entries: dict[bytes, Entry], key: bytes, doc_id: int, part: str, fails: int) -> Iterator[tuple[int, str, int, int]]:
    """Brings one row to the state; the changes of the counters, as (doc_id, part, mask, delta)."""
    least, holders = entries.get(key, (None, []))
    if least is not None and doc_id > least:
        yield doc_id, part, fails | SAME, 1
        return
    if least is not None and doc_id < least:
        for p, m in holders:
            yield least, p, m, -1
            yield least, p, m | SAME, 1
        holders = []
    entries[key] = (doc_id, [*holders, (part, fails)])
    yield doc_id, part, fails, 1


CHANGES = "doc_id long, part string, mask int, delta int"


def _keyed(_: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    entries: dict[bytes, Entry] = pickle.loads(state.get[0]) if state.exists else {}
    for f in frames:
        out = []
        for i, part, m, key in zip(f["doc_id"], f["part"], f["mask"], f["key"], strict=True):
            if key is None:
                out.append((None if pd.isna(i) else int(i), part, m, 1))
            else:
                out.extend(take(entries, bytes(key), int(i), part, m))
        changed = pd.DataFrame(out, columns=["doc_id", "part", "mask", "delta"])
        yield changed.astype({"doc_id": "Int64", "mask": "int32", "delta": "int32"})
    state.update((pickle.dumps(entries, 5),))


def _status(spark: SparkSession, path: str):
    """Hadoop's status of a path; None where there is nothing, or the path is a pattern."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(p) if fs.exists(p) else None


def stream_changes(spark: SparkSession, path: str, target: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", bucket: int = BUCKET, batches: int = BATCHES) -> int:
    """Processes the files of ``path`` that ``checkpoint`` doesn't list yet; the changes go to ``target/batch=<n>``.

    A stream that was broken off goes on from its checkpoint; a replayed batch
    overwrites its own folder. Files that are added later are processed by the
    next call: they may retract what was counted before. The number of
    buckets is fixed by the first call. Returns the micro-batches run.
    """
    table = spark.read.parquet(path)
    kept = f"{target}/buckets"
    if _status(spark, kept) is None:
        spark.range(1).select(F.lit(max(1, math.ceil(table.count() / bucket))).cast("long").alias("n")).write.parquet(kept)
    n_buckets = spark.read.parquet(kept).first()["n"]
    files = max(1, math.ceil(len(table.inputFiles()) / batches))
    # a stream reads folders or patterns: a table that is one file is named by a pattern that only fits it
    source = f"{path[:-1]}[{path[-1]}]" if (found := _status(spark, path)) is not None and found.isFile() else path
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(source)
    facts = stream.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(part_col).cast("string").alias("part"))
    facts = facts.mapInArrow(_facts(n_buckets), "doc_id long, part string, mask int, key binary, bucket long")
    changes = facts.groupBy("bucket").applyInPandasWithState(_keyed, CHANGES, "entries binary", "append", GroupStateTimeout.NoTimeout)
    ran = []

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={n}")
        ran.append(n)

    changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(ran)


def counters(changes: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: the rows that fail exactly a mask's filters, and those labelled so; sums of all changes."""
    own = changes.groupBy("doc_id", "part", "mask").agg(F.sum("delta").alias("n")).where("n != 0")
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    n = F.col("n")
    return own.join(flags, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum(n).alias("n"), F.sum(n * F.coalesce("is_good", F.lit(0))).alias("good"), F.sum(n * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))


def orders(counted: DataFrame) -> DataFrame:
    """The report of all filter orders from ``counters``: 600 rows a part, zeros included."""
    # rows that pass all filters of a set; the empty set has all rows
    sets = counted.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))).alias("set")).where(F.col("mask").bitwiseAND(F.col("set")) == 0)
    passing = sets.groupBy("part", "set").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    only = counted.select("part", "mask", "n").groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", "n"))).alias("only"))
    # 32 sets and masks a part at most
    part = passing.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("set", F.struct("n", "good", "toxic")))).alias("passing")).join(only, "part")

    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for k, f in enumerate(order):
            steps.append({"filter_order": "".join(FILTERS[x] for x in order), "step": k + 1, "bit": 1 << f, "before": before})
            before |= 1 << f
    grid = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, before int>>")

    def passes(of, what: str):
        return F.coalesce(F.try_element_at("passing", of)[what], F.lit(0)).cast("long")

    # shapley: a filter removes what passes a set S but not S with it, in |S|! (4 - |S|)! of all orders
    added = F.lit(0).cast("long")
    size, bit = len(FILTERS), F.col("bit")
    for s in range(1 << size):
        times = math.factorial(s.bit_count()) * math.factorial(size - 1 - s.bit_count()) if s.bit_count() < size else 0
        if times:
            without = passes(F.lit(s), "n") - passes(F.lit(s).bitwiseOR(bit), "n")
            added = added + F.when(F.lit(s).bitwiseAND(bit) == 0, without * times).otherwise(F.lit(0))
    each = part.select("part", "passing", "only", F.explode(F.array(*(F.lit(1 << k) for k in range(size)))).alias("bit")).select("*", added.alias("shapley"))
    each = each.select("*", F.explode(F.filter(grid, lambda g: g["bit"] == F.col("bit"))).alias("g"))
    before, after = F.col("g.before"), F.col("g.before").bitwiseOR(bit)
    removed = passes(before, "n") - passes(after, "n")
    return each.select(
        "part", F.col("g.filter_order").alias("filter_order"), F.col("g.step").alias("step"), passes(after, "n").alias("kept"), removed.alias("removed"),
        (passes(F.lit(0), "n") - passes(bit, "n") - removed).alias("redundant"), F.coalesce(F.try_element_at("only", bit), F.lit(0)).cast("long").alias("unique_fails"),
        (passes(before, "good") - passes(after, "good")).alias("good_lost"), (passes(before, "toxic") - passes(after, "toxic")).alias("toxic_lost"), "shapley")


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", **options) -> DataFrame:
    """The report of all orders of the five filters over the whole table at ``path``: a row a part, order and step.

    A null text is empty; a null source counts as the empty part; rows that
    repeat the least id of a text don't fail E; a null id is neither smaller
    nor greater than another, so it never fails E and has no label; a label that
    stands twice counts if any of its rows says 1. An empty table has no part and
    gives no rows. Other columns are ignored.
    """
    t = Tables(spark, "filter-audit")
    target = t.path("changes")
    stream_changes(spark, path, target, t.path("stream"), id_col, text_col, part_col, **options)
    changes = spark.read.schema(CHANGES).parquet(f"{target}/batch=*")
    return orders(counters(changes, labels))
