"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.tables import BATCH_BYTES, bounded_batches  # noqa: F401
from ..plans.tables import cut as materialize  # noqa: F401


_COLLECTED = [0.0]


def release() -> None:
    """Gives freed memory of a Python worker back: workers are reused, and what one task held would stay with the next.

    Cycles are looked for every two seconds at most, as that takes longer than the rest.
    """
    if time.monotonic() - _COLLECTED[0] > 2:
        gc.collect()
        _COLLECTED[0] = time.monotonic()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def tidy(run: Callable) -> Callable:
    """run, a function of Arrow batches or of tables of groups, with release() when it has ended."""

    @wraps(run)
    def batches(some):
        try:
            yield from run(some)
        finally:
            release()

    @wraps(run)
    def table(t):
        try:
            return run(t)
        finally:
            release()

    @wraps(run)
    def tables(left, right):
        try:
            return run(left, right)
        finally:
            release()

    if "RecordBatch" in str(run.__annotations__.get("return")):
        return batches
    return table if run.__code__.co_argcount == 1 else tables


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply fn, columns in and columns out, to every Arrow batch of df."""
    kinds = arrow_schema(df.sparkSession, schema)
    bounded_batches(df.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in kinds], schema=kinds)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), null texts as empty; other columns stay behind, so that their names can't clash."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
