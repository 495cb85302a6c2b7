"""Alias table and review queue as tables: alias(alias, canonical), pending(seq, item_id, canonical, alias, similarity, context), decided(item_id, approved)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import norm_key
from ..plans.tables import cut, drop_cut
from .triples import fixed_batches

ALIAS = "alias string, canonical string"


def add(table: DataFrame, pairs: DataFrame, fold: str = "casefold") -> DataFrame:
    """table with (canonical, alias) pairs, both normalised; later seq wins for one alias, and a name is no alias of itself."""
    new = pairs.select(norm_key("alias", fold).alias("alias"), norm_key("canonical", fold).alias("canonical"), "seq").filter("alias <> canonical")
    last = new.groupBy("alias").agg(F.max_by("canonical", "seq").alias("canonical"))
    return table.join(last.select("alias"), "alias", "left_anti").select("alias", "canonical").unionByName(last)


def lookup(names: DataFrame, table: DataFrame, fold: str = "casefold", name: str = "name") -> DataFrame:
    """names with canonical: one step in the table, else the name's own identity."""
    key = norm_key(name, fold)
    return names.withColumn("__key", key).join(table.select(F.col("alias").alias("__alias"), "canonical"), F.col("__key") == F.col("__alias"), "left").withColumn("canonical", F.coalesce("canonical", "__key")).drop("__key", "__alias")


def aliases_of(table: DataFrame) -> DataFrame:
    return table.groupBy("canonical").agg(F.array_sort(F.collect_list("alias")).alias("aliases"))


def merge(table: DataFrame, keep: str, drop: str) -> DataFrame:
    """Aliases of drop become keep's, and drop an alias itself."""
    spark = table.sparkSession
    moved = table.filter(F.col("alias") != drop).withColumn("canonical", F.when(F.col("canonical") == drop, keep).otherwise(F.col("canonical")))
    return moved.unionByName(spark.createDataFrame([(drop, keep)], "alias string, canonical string"))


def stats(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("aliases"), F.count_distinct("canonical").alias("canonicals"))


def candidates(names: DataFrame, table: DataFrame, least: int = 4, fold: str = "casefold") -> DataFrame:
    """(name, canonical): canonical names that share a word of so many letters with a name."""
    words = lambda c: F.explode(F.array_distinct(F.filter(F.split(c, " "), lambda w: F.length(w) >= least)))
    own = names.select("name", words(norm_key("name", fold)).alias("word"))
    known = table.select(F.explode(F.array("alias", "canonical")).alias("t"), "canonical").select(words(F.col("t")).alias("word"), "canonical").distinct()
    return own.join(known, "word").select("name", "canonical").distinct()


def load(spark: SparkSession, path: str) -> DataFrame:
    """The table of a folder that save() wrote; empty where nothing is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(ALIAS).json(path) if there else spark.createDataFrame([], ALIAS)


def save(table: DataFrame, path: str) -> None:
    """Written as JSON lines in the order of alias, over whatever was there; the table may have been read from path."""
    held = cut(table.select("alias", "canonical"), "aliases")
    exported(held).write.mode("overwrite").json(path)
    drop_cut(held)


def exported(table: DataFrame) -> DataFrame:
    """The table in the order of alias."""
    return table.select("alias", "canonical").orderBy("alias")


def queue(borderline: DataFrame) -> DataFrame:
    """Pending items review-0000, review-0001, ... in the order of (canonical, alias)."""
    got = fixed_batches(borderline, 1, ["canonical", "alias"]).withColumnRenamed("batch", "seq")
    return got.select("seq", F.format_string("review-%04d", "seq").alias("item_id"), "canonical", "alias", "similarity", F.lit("").alias("context"))


def submit(pending: DataFrame, decided: DataFrame, items: DataFrame) -> DataFrame:
    """pending with those items whose id is neither pending nor decided."""
    known = pending.select("item_id").unionByName(decided.select("item_id"))
    return pending.unionByName(items.join(known, "item_id", "left_anti").select(pending.columns))


def decide(pending: DataFrame, decided: DataFrame, item_id: str, approved: bool) -> tuple[DataFrame, DataFrame]:
    """(pending, decided) with the decision. The item stays known to apply(); an unknown id is a KeyError."""
    if pending.filter(F.col("item_id") == item_id).join(decided, "item_id", "left_anti").isEmpty():
        raise KeyError(item_id)
    return pending, decided.unionByName(decided.sparkSession.createDataFrame([(item_id, approved)], "item_id string, approved boolean"))


def undecided(pending: DataFrame, decided: DataFrame) -> DataFrame:
    return pending.join(decided, "item_id", "left_anti")


def apply(pending: DataFrame, decided: DataFrame, table: DataFrame, fold: str = "casefold") -> DataFrame:
    """table with all approved items."""
    return add(table, pending.join(decided.filter("approved"), "item_id", "left_semi").select("canonical", "alias", "seq"), fold)
