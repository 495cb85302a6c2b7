"""Change detection between two snapshots of a corpus: state(doc_id, checksum, modified_at)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff(before: DataFrame, now: DataFrame) -> DataFrame:
    """Events: upsert for new or changed checksums (a new time alone is none), delete for documents that went."""
    b = before.select("doc_id", F.col("checksum").alias("old"), F.col("modified_at").alias("old_at"))
    n = now.select("doc_id", F.col("checksum").alias("new"), F.col("modified_at").alias("new_at"), F.lit(True).alias("here"))
    got = n.join(b, "doc_id", "full_outer")
    kind = F.when(F.col("here").isNull(), "delete").when(~F.col("new").eqNullSafe(F.col("old")), "upsert")
    return got.withColumn("kind", kind).filter("kind is not null").select("doc_id", "kind", F.col("doc_id").alias("path"), F.coalesce("new", "old").alias("checksum"), F.coalesce("new_at", "old_at").alias("modified_at"))


def summary(events: DataFrame) -> DataFrame:
    return events.agg(F.count_if(F.col("kind") == "upsert").alias("upserts"), F.count_if(F.col("kind") == "delete").alias("deletes"))


def upserts(events: DataFrame) -> DataFrame:
    return events.filter("kind = 'upsert'")
