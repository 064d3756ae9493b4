"""Commits of a lake, and keyed tables in buckets (storage of S-03, S-04, U-01, T-01, T-02).

*Commits.* A run writes its tables first and then one small JSON file,
``root/_commits/<run_ts>.json``, that names the folders or files of all of them.
The file appears by an atomic rename, and readers follow the newest one that
names their table. So a run's tables become visible together, and a folder that
was cut short is never read. A run that is written again is withdrawn first.

*Keyed tables.* A row lies in the bucket ``pmod(hash(key), n)``; a commit names the
files of each bucket. ``merge`` reads, joins and writes only the buckets that hold
a fresh key; the others' files are named again. ``append`` writes the fresh rows
alone, as a layer over their buckets: what is written grows with the fresh rows,
not with the table. Readers lay a bucket's layers over each other by key. Once the
layers of a bucket hold half as many rows as its first one, the bucket is
rewritten as one layer, so every appended row is rewritten about twice at most.

The number of buckets follows the rows when a table begins (one for ``ROWS``), and
is set anew, by a rewrite, once a bucket would hold four times as many.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any
from urllib.parse import quote, unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from menulake.operators.upsert import last_per_key, upsert

COMMITS = "_commits"
ROWS, LEAST_BUCKETS = 400_000, 8
#: Fresh rows are counted by so many cells of their keys; of a cell with more rows than the
#: larger of these, a number and a share of all rows, a task ships one row a key.
CELLS, HOT, HOT_SHARE = 65_536, 10_000, 0.001
#: A merge takes its buckets in so many turns at most, each of as many buckets as the session has cores at least:
#: the shuffled rows on the executors' disks at once are those of a turn.
TURNS = 8
#: A bucket is rewritten once its layers hold this share of its first layer's rows, or are so many.
REWRITE, MOST_LAYERS = 0.5, 32
#: Ids are hex digits, which snappy leaves as they are.
COMPRESSION = "zstd"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Entry = dict[str, Any]


# ---------------------------------------------------------------- commits

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _commit_path(root: str, run_ts: str) -> str:
    return f"{root}/{COMMITS}/{quote(run_ts, safe='')}.json"


def runs(spark: SparkSession, root: str) -> list[str]:
    """The committed runs of a lake, oldest first; names sort as text. Only a missing folder means "none"."""
    fs, p = _fs(spark, f"{root}/{COMMITS}")
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(unquote(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def read_commit(spark: SparkSession, root: str, run_ts: str) -> dict[str, Entry]:
    """The tables that a run committed; none if it didn't."""
    fs, p = _fs(spark, _commit_path(root, run_ts))
    if not fs.exists(p):
        return {}
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["tables"]
    finally:
        stream.close()


def _put(spark: SparkSession, root: str, run_ts: str, tables: dict[str, Entry]) -> None:
    """Writes a commit beside its place and moves it there in one step."""
    jvm = spark._jvm
    fs, p = _fs(spark, _commit_path(root, run_ts))
    _, beside = _fs(spark, f"{root}/{COMMITS}/.{uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps({"run_ts": run_ts, "tables": tables}).encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(beside), fs.makeQualified(p), over)


def commit(spark: SparkSession, root: str, run_ts: str, tables: dict[str, Entry]) -> None:
    """Makes the tables of a run visible at once; tables that the run committed before stay."""
    _put(spark, root, run_ts, read_commit(spark, root, run_ts) | tables)


def withdraw(spark: SparkSession, root: str, run_ts: str, names: Iterable[str]) -> None:
    """Takes tables out of a run's commit, before their folder is written again."""
    tables = read_commit(spark, root, run_ts)
    if tables.keys() & set(names):
        _put(spark, root, run_ts, {k: v for k, v in tables.items() if k not in set(names)})


def newest(spark: SparkSession, root: str, name: str, before: str | None = None) -> Entry | None:
    """What the newest run (older than ``before``) committed for a table; None where no run names it."""
    for run_ts in reversed(runs(spark, root)):
        if before is None or run_ts < before:
            entry = read_commit(spark, root, run_ts).get(name)
            if entry is not None:
                return entry
    return None


def run_folder(root: str, name: str, run_ts: str) -> str:
    return f"{root}/{name}/run_ts={quote(run_ts, safe='')}"


def _folder_to_write(spark: SparkSession, root: str, name: str, run_ts: str) -> str:
    """The run's folder, to be overwritten; where later runs may name files of it, a new folder inside."""
    withdraw(spark, root, run_ts, [name])
    folder = run_folder(root, name, run_ts)
    return f"{folder}/{uuid4().hex}" if any(r > run_ts for r in runs(spark, root)) else folder


@contextmanager
def _own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write are removed as it ends: its rows are read from its files then.

    Else they stay until the driver happens to collect its garbage, and the runs of a
    job pile up on the executors' disks.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def write_files(df: DataFrame, folder: str, fmt: str = "parquet") -> None:
    """Writes a folder anew."""
    writer = df.write.mode("overwrite")
    with _own_shuffles(df.sparkSession):
        getattr(writer.option("compression", COMPRESSION) if fmt == "parquet" else writer, fmt)(folder)


def write_table(df: DataFrame, root: str, name: str, run_ts: str, fmt: str = "parquet") -> Entry:
    """Writes a whole table to the folder of its run; it is visible once its entry is committed."""
    folder = _folder_to_write(df.sparkSession, root, name, run_ts)
    write_files(df, folder, fmt)
    return {"run_ts": run_ts, "format": fmt, "folder": folder.removeprefix(f"{root}/"), "schema": json.loads(df.schema.json())}


def without(entry: Entry, columns: Iterable[str]) -> Entry:
    """An entry whose table is read without some columns of its files."""
    schema = T.StructType.fromJson(entry["schema"])
    return entry | {"schema": json.loads(T.StructType([f for f in schema.fields if f.name not in set(columns)]).json())}


def read_table(spark: SparkSession, root: str, entry: Entry, only: Iterable[int] | None = None) -> DataFrame:
    """The rows of a committed table, with the columns it was committed with; of a keyed one, of some buckets."""
    schema = T.StructType.fromJson(entry["schema"])
    if "files" not in entry:
        return spark.read.schema(schema).format(entry["format"]).load(f"{root}/{entry['folder']}")
    return _read_layers(spark, root, entry, schema, None if only is None else set(only))


# ---------------------------------------------------------------- keyed tables

def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def _read_files(spark: SparkSession, root: str, schema: T.StructType, files: Sequence[list]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f[2]}" for f in files])


def _read_layers(spark: SparkSession, root: str, entry: Entry, schema: T.StructType, only: set[int] | None) -> DataFrame:
    by_bucket = defaultdict(list)
    for f in entry["files"]:  # bucket, layer, path, rows
        if only is None or f[0] in only:
            by_bucket[f[0]].append(f)
    plain, laid = [], []
    for files in by_bucket.values():
        (plain if len({f[1] for f in files}) == 1 else laid).extend(files)
    whole = _read_files(spark, root, schema, plain)
    if not laid:
        return whole
    key, layers = entry["key"], {int(k): v for k, v in entry["layers"].items()}
    parts = [_read_files(spark, root, schema, [f for f in laid if f[1] == n]).withColumn("_layer", F.lit(n)) for n in sorted({f[1] for f in laid})]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    # columns that the same layers bear are taken together, from the last of these layers
    alike = defaultdict(list)
    for c in schema.names:
        if c != key:
            alike[tuple(n for n, cols in layers.items() if c in cols)].append(c)
    groups = list(alike.items())
    # a null key matches nothing
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    found = rows.groupBy(key, alone.alias("_alone")).agg(*(
        F.max_by(F.struct(*cols), F.when(F.col("_layer").isin(list(ns)), F.col("_layer"))).alias(f"_g{i}") for i, (ns, cols) in enumerate(groups)), F.count(F.lit(1)).alias("_n"))
    of = {c: i for i, (_, cols) in enumerate(groups) for c in cols}
    over = found.select(*(F.col(c) if c == key else F.col(f"_g{of[c]}")[c].alias(c) for c in schema.names))
    return whole.unionByName(over)


def _placed(spark: SparkSession, folder: str, root: str, key: str, buckets: int, layer: int) -> list[list]:
    """The files of a folder: bucket, layer, path, rows. Reads the key column alone."""
    rows = spark.read.parquet(folder).select(bucket_of(key, buckets).alias("b"), F.col("_metadata.file_name").alias("f"))
    found = rows.groupBy("b", "f").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a file
    if len({r["f"] for r in found}) < len(found):
        raise ValueError(f"a file of {folder} holds several buckets")
    return [[r["b"], layer, f"{folder.removeprefix(f'{root}/')}/{r['f']}", r["n"]] for r in found]


def _dealt(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """A partition a bucket. By its number: a shuffle by the key itself could be merged with one before it, and its partitions then coalesced."""
    return df.repartitionById(buckets, bucket_of(key, buckets))


def _by_key(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """A partition a bucket, by the key: partition i of such a shuffle holds the keys of bucket i, and groups and joins by key need no other."""
    return df.repartition(buckets, key)


def _thinned(fresh: DataFrame, key: str, order: str | Sequence[str]) -> DataFrame:
    """``fresh`` with the rows of hot keys brought down to the last one; the other rows pass as they are."""
    cell = bucket_of(key, CELLS)
    rows = fresh.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n"))
    most = F.greatest(F.lit(HOT), F.sum("n").over(Window.partitionBy()) * HOT_SHARE)
    hot = [r["c"] for r in rows.withColumn("most", most).where("n > most").select("c").collect()]  # 1,000 cells at most, by the share
    if not hot:
        return fresh
    last = last_per_key(fresh.where(cell.isin(hot)), key, order)
    return fresh.where(~cell.isin(hot)).unionByName(last)


def _write_buckets(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Writes rows that are dealt by bucket, a file a bucket."""
    with _own_shuffles(df.sparkSession):
        df.write.mode(mode).option("maxRecordsPerFile", 0).option("compression", COMPRESSION).parquet(folder)


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, math.ceil(rows / ROWS))


def _begin(base: DataFrame, root: str, name: str, key: str, run_ts: str, folder: str, buckets: int | None) -> Entry:
    """A keyed table of one layer, from rows with one row a key."""
    buckets = buckets or buckets_for(base.count())
    _write_buckets(_dealt(base, key, buckets), folder)
    return {"run_ts": run_ts, "key": key, "buckets": buckets, "schema": json.loads(base.schema.json()), "layers": {"0": base.columns},
            "files": _placed(base.sparkSession, folder, root, key, buckets, 0)}


def _grown(spark: SparkSession, root: str, entry: Entry) -> int:
    """The number of buckets to go on with: its own, or the one for its rows if these are too many for it."""
    rows = sum(f[3] for f in entry["files"])
    return buckets_for(rows) if rows > 4 * ROWS * entry["buckets"] else entry["buckets"]


def merge(fresh: DataFrame, root: str, name: str, run_ts: str, key: str, order: str | Sequence[str],
          keep_order: bool = True, buckets: int | None = None) -> tuple[Entry, dict[str, int]]:
    """U-01 onto the newest table before ``run_ts``: its entry (not yet committed) and the counts.

    Only the buckets that hold a fresh key are read, joined and written. Both sides are
    shuffled once, by key into their buckets: the last row of a key is taken, the join
    made and the bucket written there. The counts are observed while they are written,
    behind these shuffles, where no task's rows are counted twice. A large merge goes by
    turns, some of the buckets in each, and a turn's shuffle files are removed as it ends;
    the fresh rows are scanned once a turn then, a bucket of the base is read in its own.
    """
    spark = fresh.sparkSession
    folder = _folder_to_write(spark, root, name, run_ts)
    entry = newest(spark, root, name, before=run_ts)
    with _own_shuffles(spark):
        if entry is None:
            n = buckets or buckets_for(fresh.count())
            one = last_per_key(fresh, key, order)
            entry = {"key": key, "buckets": n, "layers": {}, "files": [], "schema": json.loads(one.drop(*([] if keep_order else _names(order))).schema.json())}
        n = _grown(spark, root, entry)
        regrown = n != entry["buckets"]
        touched = None if regrown or not entry["files"] else {r["b"] for r in fresh.select(bucket_of(key, n).alias("b")).distinct().collect()}  # n rows at most
        thin = _thinned(fresh, key, order)
    turns = _turns(spark, range(n) if touched is None else touched)
    counts = {"inserted": 0, "matched": 0, "modified": 0, "errors": 0}
    for i, turn in enumerate(turns):
        old, new = read_table(spark, root, entry, None if regrown else turn), thin
        if len(turns) > 1:
            mine = bucket_of(key, n).isin(turn)
            old, new = old.where(mine) if regrown else old, new.where(mine)
        merged = upsert(_by_key(old, key, n), _by_key(new, key, n), key, order, keep_order).flagged
        seen = Observation()
        counted = merged.observe(seen, F.count_if("_ins").alias("inserted"), F.count_if("_match").alias("matched"), F.count_if("_mod").alias("modified"))
        table = counted.drop("_ins", "_match", "_mod")
        if i == 0:
            _write_buckets(table, folder)
        else:
            _write_buckets(table, folder, "append")
        counts |= {k: counts[k] + int(v) for k, v in seen.get.items()}
    kept = [f for f in entry["files"] if touched is not None and f[0] not in touched]
    layer = max(map(int, entry["layers"]), default=-1) + 1
    files = kept + _placed(spark, folder, root, key, n, layer)
    layers = {k: v for k, v in entry["layers"].items() if any(f[1] == int(k) for f in kept)} | {str(layer): table.columns}
    return {"run_ts": run_ts, "key": key, "buckets": n, "schema": json.loads(table.schema.json()), "layers": layers, "files": files}, counts


def _turns(spark: SparkSession, buckets: Iterable[int]) -> list[list[int]]:
    """The buckets of each turn of a merge; one turn, of none, where there are none."""
    each = sorted(buckets)
    n = max(1, min(TURNS, len(each) // max(1, spark.sparkContext.defaultParallelism)))
    return [each[i::n] for i in range(n)]


def _names(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def append(fresh: DataFrame, root: str, name: str, run_ts: str, key: str, order: str | Sequence[str] | None = None, keep_order: bool = True,
           base: DataFrame | None = None, whole_rows: bool = False, buckets: int | None = None) -> Entry:
    """Lays fresh rows over the newest table before ``run_ts``; its entry (not yet committed).

    Writes the fresh rows (the last of a key by ``order``), and the buckets that
    are due to be rewritten. A fresh row's columns replace those of its key's row;
    with ``whole_rows`` the columns it lacks become null. ``base`` (one row a key)
    begins a table that no run has committed.
    """
    spark = fresh.sparkSession
    folder = _folder_to_write(spark, root, name, run_ts)
    entry = newest(spark, root, name, before=run_ts)
    if order is not None:
        fresh = last_per_key(fresh, key, order)
        fresh = fresh if keep_order else fresh.drop(*_names(order))
    if entry is None:
        entry = _begin(fresh.limit(0) if base is None else base, root, name, key, run_ts, f"{folder}/first", buckets)
    n, layer = entry["buckets"], max(map(int, entry["layers"]), default=-1) + 1
    _write_buckets(_dealt(fresh, key, n), f"{folder}/fresh")
    old = T.StructType.fromJson(entry["schema"])
    schema = T.StructType([*old.fields, *(f for f in fresh.schema.fields if f.name not in old.names)])
    entry = {"run_ts": run_ts, "key": key, "buckets": n, "schema": json.loads(schema.json()),
             "layers": entry["layers"] | {str(layer): schema.names if whole_rows else fresh.columns},
             "files": entry["files"] + _placed(spark, f"{folder}/fresh", root, key, n, layer)}
    return _rewritten(spark, root, entry, f"{folder}/rewritten")


def _due(entry: Entry) -> set[int]:
    """The buckets whose layers have grown large against their first one, or are very many."""
    rows: dict[int, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    for b, layer, _, n in entry["files"]:
        rows[b][layer] += n
    return {b for b, by in rows.items() if len(by) > MOST_LAYERS or sum(by.values()) - by[min(by)] >= REWRITE * max(1, by[min(by)])}


def _rewritten(spark: SparkSession, root: str, entry: Entry, folder: str) -> Entry:
    due, n = _due(entry), _grown(spark, root, entry)
    if n != entry["buckets"]:
        due = {f[0] for f in entry["files"]}
    if not due:
        return entry
    key, layer = entry["key"], max(map(int, entry["layers"])) + 1
    _write_buckets(_dealt(read_table(spark, root, entry, due), key, n), folder)
    files = [f for f in entry["files"] if f[0] not in due] + _placed(spark, folder, root, key, n, layer)
    names = T.StructType.fromJson(entry["schema"]).names
    layers = {k: v for k, v in (entry["layers"] | {str(layer): names}).items() if any(f[1] == int(k) for f in files)}
    return entry | {"buckets": n, "layers": layers, "files": files}
