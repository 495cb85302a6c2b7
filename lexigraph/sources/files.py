"""Triples as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..types import TRIPLE


def write_triples(triples: DataFrame, path: str) -> None:
    """One JSON object a line, nulls included."""
    triples.write.option("ignoreNullFields", False).json(path)


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """Strict: a line that is no triple fails the read; blank lines are skipped. Column seq stays as written."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    got = lines.select(F.from_json("value", TRIPLE, {"mode": "FAILFAST"}).alias("t")).select("t.*")
    ok = (F.trim("subject.name") != "") & (F.trim("object.name") != "") & (F.trim("predicate") != "") & F.col("confidence").between(0, 1) & (F.length("source_doc_id") > 0)
    return got.withColumn("predicate", F.when(ok, F.col("predicate")).otherwise(F.raise_error(F.concat(F.lit("not a triple: "), F.to_json(F.struct(*got.columns))))))
