"""Helpers that several corpus operators share: intermediate tables and input columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session (a test) gets a folder of its own; on a
    cluster that is an error, as executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local.setdefault(sc.applicationId, "file://" + tempfile.mkdtemp(prefix="corpus-"))


class Tables:
    """Intermediate tables of one run, below the shared folder.

    ``cut`` writes a frame and reads it back: the lineage ends in files that
    survive a lost executor. ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, label: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{label}"

    def cut(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.table_path = path
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for f in frames:
            path = getattr(f, "table_path", None)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named input columns, renamed: extra columns, also ones whose names clash, are left behind."""
    return df.select(*(df[c].alias(as_) for as_, c in wanted.items()))


def free(df: DataFrame, name: str) -> str:
    """A name for a helper column that no column of ``df`` has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name
