"""Resumable ingest (T-01) and streaming upsert (T-02) with Structured Streaming.

Progress lives in the query's ``checkpointLocation`` (on shared storage): a
restarted stream processes only files it has not committed. ``foreachBatch``
writes each micro-batch under a folder named by its batch id, so replaying a
batch after a failure rewrites the same folder instead of adding rows twice.
Batches of keyed tables are layers over the table before them
(``sources.lake``): what a batch writes grows with the batch, not with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from menulake.operators.extract import parse_pages
from menulake.operators.upsert import last_per_key
from menulake.sources import lake
from menulake.sources.io import COLLECTIONS, latest_snapshot


def stream_keyed_documents(spark: SparkSession, src: str, root: str, checkpoint: str, run_ts: str,
                           max_files: int | None = None) -> int:
    """T-01 over saved keyed brand documents (the resume files of an ingest).

    Each new JSON file under ``src`` is read once; every micro-batch is
    normalized (N-01..N-04) and laid over the raw tables before it: a fresh
    row replaces the saved one with its id (J-05; of repeated fresh ids the last).
    The three tables are committed together as the run ``<run_ts>-<batch>``, which
    sorts behind the run ``run_ts`` and before any later run. A restarted stream
    skips files it has committed; a replayed batch rewrites its own layer.
    """
    from menulake.operators.normalize import normalize
    from menulake.plans.jobs import ORDER
    from menulake.sources.io import keyed_texts_to_flat
    reader = spark.readStream.option("wholetext", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = (reader.text(src)
              .select("value", F.col("_metadata.file_path").alias("_file")))
    runs = []

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"{run_ts}-{batch_stamp(batch_id)}"
        rb, ri, rs = keyed_texts_to_flat(batch)
        n = normalize(rb, ri, rs, run_ts)
        fresh = {"brands": n.brands, "menu_items": n.menu_items.drop("brand_name"), "variations": n.variations}
        raw, layers = f"{root}/raw", {}
        for c in COLLECTIONS:
            saved = lake.newest(spark, raw, c, before=name)
            # a run's plain snapshot begins the keyed table, with one row an id
            base = None if saved is None or "files" in saved else last_per_key(lake.read_table(spark, raw, saved), "_id", ORDER[c])
            layers[c] = lake.append(fresh[c], raw, c, name, "_id", ORDER[c], base=base, whole_rows=True)
        lake.commit(spark, raw, name, layers)
        runs.append(batch_id)

    q = (stream.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(runs)


PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


def batch_stamp(batch_id: int) -> str:
    """Sortable snapshot name of a micro-batch."""
    return f"b{batch_id:012d}"


def stream_ingest(spark: SparkSession, src: str, target: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  schema: T.StructType = PAGES_SCHEMA, max_files: int | None = None,
                  glob: str | None = None) -> int:
    """T-01: process the stored files of ``src`` not seen before; returns batches run.

    Default work: parse pages (the extraction pass) and append the parsed
    rows under ``target/batch=<stamp>``. Runs until the source is drained
    (``availableNow``), then stops.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(src)
    fn = transform or parse_pages
    seen = []

    def write(batch: DataFrame, batch_id: int) -> None:
        out = fn(batch)
        out.write.mode("overwrite").parquet(f"{target}/batch={batch_stamp(batch_id)}")
        seen.append(batch_id)

    q = (stream.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(seen)


def stream_upsert(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str,
                  key: str, order: str | Sequence[str], base: DataFrame | None = None,
                  prepare: Callable[[DataFrame], DataFrame] | None = None, keep_order: bool = True) -> int:
    """T-02: upsert each micro-batch onto the table before it.

    Of a batch's rows with one key the last by ``order`` counts.

    Batch ``n`` lays its rows over the table of the last batch before ``n`` (or over
    ``base``, with one row a key, for the first) and commits the run ``<stamp n>``.
    A replayed batch reads the same input and rewrites the same layer, so the
    result is the same as a single run.
    """
    root, coll = target.rstrip("/").rsplit("/", 1)
    runs = []

    def write(batch: DataFrame, batch_id: int) -> None:
        stamp = batch_stamp(batch_id)
        fresh = prepare(batch) if prepare else batch
        lake.commit(spark, root, stamp, {coll: lake.append(fresh, root, coll, stamp, key, order, keep_order, base)})
        runs.append(batch_id)

    q = (stream.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(runs)


def latest_stream_snapshot(spark: SparkSession, target: str) -> DataFrame:
    """The table as the newest batch of a streaming upsert left it."""
    root, coll = target.rstrip("/").rsplit("/", 1)
    return latest_snapshot(spark, root, coll).drop("run_ts")
