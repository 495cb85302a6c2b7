"""Inferred edges between the components of a triple graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_key
from ..plans.tables import cut
from ..types import CONCEPT, INFERRED_DOC, SPAN, BridgeConfig
from .components import connected
from .triples import entity_types, keyed, mentions


def entity_components(triples: DataFrame, fold: str = "casefold") -> DataFrame:
    """(name, component) by identity; a name with only self-loops is its own component."""
    exact = triples.select(F.col("subject.name").alias("s"), F.col("object.name").alias("o")).distinct()  # before folding, as facts repeat
    k = cut(exact.select(norm_key("s", fold).alias("a"), norm_key("o", fold).alias("b")).distinct(), "links")
    comps = connected(k)
    names = k.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    return names.join(comps, names["name"] == comps["node"], "left").select("name", F.coalesce("component", "name").alias("component"))


def component_report(triples: DataFrame, fold: str = "casefold") -> DataFrame:
    sizes = entity_components(triples, fold).groupBy("component").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("components"), F.coalesce(F.sum("n"), F.lit(0)).alias("entities"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))


def score(source: Column, target: Column, source_type: Column, target_type: Column, cap: float = 0.95) -> tuple[Column, Column]:
    """(score, predicate). The additions keep their order: 0.4 + 0.15 must reach 0.55 in doubles."""
    long_words = lambda c: F.filter(F.split(c, " "), lambda w: F.length(w) >= 4)
    same = source_type == target_type
    joins = (source_type == "PERSON") & (target_type == "ORG")
    firms = (source_type == "ORG") & (target_type == "ORG")
    s = F.lit(0.4)
    for case, more in ((same, 0.15), (joins, 0.2), (firms, 0.1), (F.arrays_overlap(long_words(source), long_words(target)), 0.1)):
        s = s + F.when(case, F.lit(more)).otherwise(F.lit(0.0))
    return F.least(s, F.lit(cap)), F.when(firms, "related to").when(joins, "affiliated with").when(same, "associated with").otherwise("relates to")


def bridges(triples: DataFrame, how: BridgeConfig = BridgeConfig(), fold: str = "casefold") -> DataFrame:
    """The best candidates for each pair of components, at most candidate_limit: (source, target, predicate, score).

    Components are in the order of their first mention, and the earlier one holds the source. Without two components, or
    with more than max_components, there are none. A score only depends on the two types and on a shared long word, so
    for each pair of components candidates come from joins on types and on words, and of each type only the first
    candidate_limit names of a component can be among its best by name order: what meets is bounded by the number of types
    and of pairs of components, not by the product of component sizes.
    """
    spark = triples.sparkSession
    none = spark.createDataFrame([], "source string, target string, predicate string, score double")
    comps = cut(entity_components(triples, fold), "components")
    n = comps.select("component").distinct().limit(how.max_components + 1).count()
    if n < 2 or n > how.max_components:
        return none
    first = mentions(triples).groupBy("name").agg(F.min("mention").alias("mention")).groupBy(norm_key("name", fold).alias("name")).agg(F.min("mention").alias("mention"))
    place = comps.join(first, "name").groupBy("component").agg(F.min("mention").alias("place"))
    nodes = comps.join(entity_types(triples, fold), "name").join(F.broadcast(place), "component").select("name", "place", F.coalesce("entity_type", F.lit(CONCEPT)).alias("type"))
    nodes = cut(nodes, "bridge-nodes")
    ends = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])

    def best(pairs: DataFrame) -> DataFrame:
        s, p = score(F.col("l_name"), F.col("r_name"), F.col("l_type"), F.col("r_type"), how.cap)
        got = pairs.withColumn("score", s).withColumn("predicate", p).filter(F.col("score") >= how.floor)
        order = Window.partitionBy("l_place", "r_place").orderBy(F.desc("score"), "l_name", "r_name")
        return got.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= how.candidate_limit)

    # by types alone: the first names of each type of a component, at most candidate_limit
    by_name = Window.partitionBy("place", "type").orderBy("name")
    few = nodes.withColumn("rank", F.row_number().over(by_name)).filter(F.col("rank") <= how.candidate_limit).drop("rank")
    kinds = few.select("type").distinct()
    wanted = kinds.select(F.col("type").alias("l_type"), F.col("type").alias("r_type")).unionByName(spark.createDataFrame([("PERSON", "ORG")], "l_type string, r_type string"))
    by_type = ends(few, "l").join(F.broadcast(wanted), "l_type").join(ends(few, "r"), "r_type").filter("l_place < r_place")
    # by a shared long word
    words = nodes.withColumn("word", F.explode(F.array_distinct(F.filter(F.split("name", " "), lambda w: F.length(w) >= 4))))
    by_type_word = Window.partitionBy("place", "type", "word").orderBy("name")
    words = words.withColumn("rank", F.row_number().over(by_type_word)).filter(F.col("rank") <= how.candidate_limit).drop("rank")
    by_word = ends(words, "l").join(ends(words, "r"), F.col("l_word") == F.col("r_word")).filter("l_place < r_place")
    columns = ["l_name", "l_place", "l_type", "r_name", "r_place", "r_type"]
    got = best(best(by_type.select(columns)).select(columns).unionByName(best(by_word.select(columns).distinct()).select(columns)).distinct())
    return got.select(F.col("l_name").alias("source"), F.col("r_name").alias("target"), "predicate", "score")


def materialized(found: DataFrame, first_seq: int = 1 << 60) -> DataFrame:
    """Bridges as inferred triples; both types are CONCEPT, whatever the ends' types."""
    entity = lambda c: F.struct(F.col(c).alias("name"), F.lit(CONCEPT).alias("entity_type"))
    seq = F.lit(first_seq) + F.pmod(F.xxhash64("source", "target"), F.lit(1 << 59))
    return found.select(seq.alias("seq"), entity("source").alias("subject"), "predicate", entity("target").alias("object"), F.round("score", 4).alias("confidence"), F.lit(INFERRED_DOC).alias("source_doc_id"), F.lit(None).cast(SPAN).alias("source_span"), F.lit(True).alias("inferred"))


def merge_inferred(stated: DataFrame, inferred: DataFrame, fold: str = "casefold") -> DataFrame:
    """stated and those inferred triples whose identity it lacks, the first of each identity."""
    keys = ["s_key", "p_key", "o_key"]
    new = keyed(inferred, fold).join(keyed(stated, fold).select(keys).distinct(), keys, "left_anti")
    first = new.groupBy(keys).agg(F.min_by(F.struct(*inferred.columns), "seq").alias("t")).select("t.*")
    return stated.unionByName(first)


def report_lines(found: DataFrame) -> DataFrame:
    return found.select(F.format_string("BRIDGE %s -[%s]-> %s (%.2f)", "source", "predicate", "target", "score").alias("line"))
