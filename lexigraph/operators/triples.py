"""Triples: identity, filters, deduplication, statistics. Column seq is the input order, which several results depend on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_key, same_key
from ..plans.tables import cut


#: Numbers that a broadcast may hold.
FEW = 2_000_000


def keyed(triples: DataFrame, fold: str = "casefold") -> DataFrame:
    """With s_key, p_key and o_key: a triple's identity."""
    return triples.withColumns({"s_key": norm_key("subject.name", fold), "p_key": norm_key("predicate", fold), "o_key": norm_key("object.name", fold)})


def dedupe(triples: DataFrame, fold: str = "casefold") -> DataFrame:
    """One triple for each identity: the most confident, of equals the earliest; column first is where the identity first appeared, which is the output order."""
    names = triples.columns
    best = F.max_by(F.struct(*names), F.struct("confidence", -F.col("seq")))
    got = keyed(triples, fold).groupBy("s_key", "p_key", "o_key").agg(best.alias("t"), F.min("seq").alias("first"))
    return got.select("t.*", "first")


def confidence_floor(triples: DataFrame, least: float) -> DataFrame:
    return triples.filter(F.col("confidence") >= least)


def confidence_stats(triples: DataFrame, review: float = 0.6) -> DataFrame:
    return triples.agg(F.count("*").alias("count"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("mean"), F.count_if(F.col("confidence") < review).alias("low_confidence_count"))


def mentions(triples: DataFrame) -> DataFrame:
    """Every endpoint in order: subject before object."""
    ends = F.posexplode(F.array(F.col("subject"), F.col("object"))).alias("end", "entity")
    got = triples.select("seq", "source_doc_id", ends)
    return got.select((F.col("seq") * 2 + F.col("end")).alias("mention"), F.col("entity.name").alias("name"), F.col("entity.entity_type").alias("entity_type"), "source_doc_id")


def duplicate_rate(triples: DataFrame, fold: str = "casefold") -> DataFrame:
    """1 - distinct / total over mentions; 0 without any."""
    key = norm_key("name", fold)
    return mentions(triples).agg(F.coalesce(1 - F.count_distinct(key) / F.count("*"), F.lit(0.0)).alias("duplicate_rate"))


def _winners(triples: DataFrame, seqs: DataFrame) -> DataFrame:
    """The triples at the places seqs, and those without a place."""
    own = cut(seqs.filter("seq is not null").distinct(), "places")
    held = triples.join(F.broadcast(own) if own.count() <= FEW else own, "seq", "left_semi")
    return held.select(triples.columns).unionByName(triples.filter("seq is null"))


def node_rows(triples: DataFrame) -> DataFrame:
    """One row for each exact name, as its first mention has it.

    First places alone are compared over all mentions: they are numbers, which Spark hashes, where rows with texts are sorted.
    """
    places = mentions(triples).groupBy("name").agg(F.min("mention").alias("mention")).select(F.shiftright("mention", 1).alias("seq"))
    first = F.min_by(F.struct("entity_type", "source_doc_id"), "mention").alias("f")
    return mentions(_winners(triples, places)).groupBy("name").agg(first).select("name", F.col("f.entity_type").alias("entity_type"), F.col("f.source_doc_id").alias("last_seen_doc"))


def edge_rows(triples: DataFrame, fold: str = "casefold") -> DataFrame:
    """One row for each (subject, predicate, object), as the last triple has it; self-loops, by identity, have none.

    Where keys are few (by an estimate, which decides nothing but the plan), last places are compared first, as in node_rows().
    """
    key = [F.col("subject.name").alias("subject"), F.col("predicate"), F.col("object.name").alias("object")]
    if triples.agg(F.approx_count_distinct(F.xxhash64("subject.name", "predicate", "object.name"))).first()[0] <= FEW:
        triples = _winners(triples, triples.groupBy(key).agg(F.max("seq").alias("seq")).select("seq"))
    last = F.max_by(F.struct("confidence", "source_doc_id", "inferred"), "seq").alias("l")
    rows = triples.groupBy(key).agg(last).filter(~same_key("subject", "object", fold))
    return rows.select("subject", "predicate", "object", "l.*")


def entity_types(triples: DataFrame, fold: str = "casefold") -> DataFrame:
    """(name, entity_type) by identity: the last mention's type. Exact names and types come first: their last places are numbers, and few rows are left to fold."""
    last = mentions(triples).groupBy("name", "entity_type").agg(F.max("mention").alias("mention"))
    return last.groupBy(norm_key("name", fold).alias("name")).agg(F.max_by("entity_type", "mention").alias("entity_type"))


def fixed_batches(rows: DataFrame, size: int, order: str | list[str] = "seq") -> DataFrame:
    """batch: floor((place - 1) / size) over a total order. Places come from counts by range partition, not from one task.

    The rows are range-partitioned and numbered inside each partition; the partitions' counts, as many as there are partitions, give
    each its start. The partitions are written first: planned twice, their sampled bounds could differ.
    """
    spark, by = rows.sparkSession, [order] if isinstance(order, str) else order
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(rows.repartitionByRange(parts, *by).withColumn("__part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    starts = F.broadcast(counts.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start")))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*by)) + F.col("__start")
    return ranged.join(starts, "__part").withColumn("batch", F.floor((place - 1) / size)).drop("__part", "__start")
