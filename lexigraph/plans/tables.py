"""Tables written in the shared folder: where a plan's lineage ends."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: With this setting Spark removes a query's shuffle files when the query ends; a written table needs them no more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes of a batch that goes to a Python worker: batches by rows alone would grow with the texts.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; set here only where it is unset and the session is local (tests)."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not conf:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="lexigraph-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df in the shared folder and read it back; a lost executor then costs no recomputation of what led to df."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexigraph-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """A written table, to be broadcast in joins if it has so many rows at most: whole tables are then not dealt anew for it."""
    return F.broadcast(df) if df.count() <= rows else df


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold about BATCH_BYTES at most (or one row), unless it has a lower bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name, None)
    if not own or not own.isdigit() or int(own) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def drop_cut(df: DataFrame) -> None:
    """Remove the files of a table that cut() wrote, once nothing reads them."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        if "/lexigraph-" in f:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
