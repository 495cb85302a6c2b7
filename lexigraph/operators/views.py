"""What a graph viewer does with edges(source, target, predicate, confidence, ...) and nodes(id, label, type). Column seq is their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.tables import cut, small
from ..types import CONCEPT


def substring_filter(nodes: DataFrame, query: str) -> DataFrame:
    """Nodes whose label or type holds query, whatever the case; a blank query keeps all."""
    q = query.strip().lower()
    return nodes.filter(F.contains(F.lower("label"), F.lit(q)) | F.contains(F.lower("type"), F.lit(q))) if q else nodes


def regex_filter(nodes: DataFrame, pattern: str) -> DataFrame:
    """Nodes whose label or type the pattern finds, whatever the case; a blank or broken pattern keeps all."""
    jvm = nodes.sparkSession._jvm
    try:
        if not pattern.strip():
            return nodes
        jvm.java.util.regex.Pattern.compile(pattern)
    except Exception:  # what Java's matcher can't compile
        return nodes
    return nodes.filter(F.col("label").rlike(f"(?i){pattern}") | F.col("type").rlike(f"(?i){pattern}"))


def type_filter(nodes: DataFrame, hidden: list[str]) -> DataFrame:
    return nodes.filter(~F.col("type").isin(hidden)) if hidden else nodes


def induced(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with both ends among nodes."""
    own = nodes.select(F.col("id").alias("__id"))
    return edges.join(own, F.col("source") == F.col("__id"), "left_semi").join(own, F.col("target") == F.col("__id"), "left_semi")


def dangling(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that is no node."""
    own = nodes.select(F.col("id").alias("__id"))
    lost = edges.join(own, F.col("source") == F.col("__id"), "left_anti")
    return lost.unionByName(edges.join(own, F.col("source") == F.col("__id"), "left_semi").join(own, F.col("target") == F.col("__id"), "left_anti"))


def self_loops(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loops, others)."""
    return edges.filter("source = target"), edges.filter("source <> target")


def collapse_parallel(edges: DataFrame) -> DataFrame:
    """One edge for each (source, target): predicates joined in order, all else as the first has it."""
    kinds = edges.groupBy("source", "target", "predicate").agg(F.count("*").alias("n"), F.min("seq").alias("seq"), F.min_by("confidence", "seq").alias("confidence"))
    pairs = cut(kinds.groupBy("source", "target").agg(F.count("*").alias("kinds"), F.first("predicate").alias("p"), F.sum("n").cast("int").alias("n"), F.min_by("confidence", "seq").alias("confidence")), "pairs")
    # with one predicate, as most have, all that a list of edges would give is its number; the others' edges are put in order
    mixed = small(cut(pairs.filter("kinds > 1").select(F.col("source").alias("__s"), F.col("target").alias("__t"), "confidence"), "mixed"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "predicate"))), lambda x: x["predicate"]), ", ")
    some = edges.select("source", "target", "seq", "predicate").join(mixed, F.col("source").eqNullSafe(F.col("__s")) & F.col("target").eqNullSafe(F.col("__t")))
    some = some.groupBy("source", "target").agg(joined.alias("predicate"), F.first("confidence").alias("confidence"))
    alike = pairs.filter("kinds = 1").select("source", "target", F.array_join(F.array_repeat("p", F.col("n")), ", ").alias("predicate"), "confidence")
    return alike.unionByName(some).select(F.concat("source", F.lit("-->"), "target").alias("id"), "source", "target", "predicate", "confidence")


def distinct_predicates(edges: DataFrame) -> DataFrame:
    """One label for each (source, target): distinct predicates in order."""
    first = edges.groupBy("source", "target", "predicate").agg(F.min("seq").alias("seq"))
    return first.groupBy("source", "target").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "predicate"))), lambda x: x["predicate"]), ", ").alias("label"))


def parallel_index(edges: DataFrame) -> DataFrame:
    pair = Window.partitionBy("source", "target")
    return edges.withColumns({"parallel_index": F.row_number().over(pair.orderBy("seq")) - 1, "parallel_count": F.count("*").over(pair)})


def legend(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("type").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "type")


def related_types(nodes: DataFrame, edges: DataFrame, focus: str) -> DataFrame:
    """Types at the other ends of focus's edges, the most frequent first; a loop counts once."""
    other = F.when(F.col("source") == focus, F.col("target")).otherwise(F.col("source"))
    own = edges.filter((F.col("source") == focus) | (F.col("target") == focus)).select(other.alias("id"))
    return own.join(nodes.select("id", "type"), "id", "left").groupBy(F.coalesce("type", F.lit(CONCEPT)).alias("type")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "type")


def directions(edges: DataFrame, focus: str) -> DataFrame:
    own = edges.filter((F.col("source") == focus) | (F.col("target") == focus))
    return own.withColumn("direction", F.when(F.col("source") == focus, "out").otherwise("in"))


def by_confidence(edges: DataFrame) -> DataFrame:
    return edges.orderBy(F.desc_nulls_last("confidence"), "seq")


def type_ahead(nodes: DataFrame, query: str, k: int = 6) -> DataFrame:
    q = query.strip().lower()
    return (nodes.filter(F.contains(F.lower("label"), F.lit(q))) if q else nodes.limit(0)).orderBy("label", "id").limit(k)


def edge_keys(edges: DataFrame) -> DataFrame:
    return edges.select(F.concat_ws("|", "source", "predicate", "target").alias("key")).distinct()


def cluster_buckets(clusters: DataFrame, size: Column | None = None) -> DataFrame:
    n = F.size("variants") if size is None else size
    return clusters.agg(F.count_if(n <= 2).alias("small"), F.count_if((n > 2) & (n <= 4)).alias("medium"), F.count_if(n > 4).alias("large"))


def edge_label(with_confidence: bool = False) -> Column:
    return F.when(F.col("confidence").isNotNull(), F.concat("predicate", F.format_string(" (%.2f)", "confidence"))).otherwise(F.col("predicate")) if with_confidence else F.col("predicate")


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.when(F.col("source") == F.col("target"), F.array("source")).otherwise(F.array("source", "target"))).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("degree"))


def edge_tooltip() -> Column:
    """Ends and predicate, the confidence if there is one, and whether the edge is inferred."""
    parts = F.concat("source", F.lit(" —"), "predicate", F.lit("→ "), "target"), F.format_string("confidence %.2f", "confidence"), F.when(F.col("inferred"), "inferred")
    return F.concat_ws(" · ", parts[0], F.when(F.col("confidence").isNotNull(), parts[1]), parts[2])


def node_tooltip() -> Column:
    return F.concat_ws(" · ", "label", "type")


def node_sizes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes with degree (0 without edges) and size, which grows with the degree from 18 to 42 at 20 edges."""
    got = nodes.join(degrees(edges), "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    return got.withColumn("size", 18 + F.least("degree", F.lit(20)) / 20 * 24)


def recent(queries: list[str], most: int = 5) -> list[str]:
    """The latest queries first, each once."""
    out: list[str] = []
    for q in reversed([q.strip() for q in queries]):
        if q and q not in out:
            out.append(q)
    return out[:most]
