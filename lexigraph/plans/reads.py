"""Read queries on a graph of nodes(name, entity_type, ...) and edges(subject, predicate, object, confidence, source_doc_id, inferred).

Every limit has a total order under it, so results don't depend on how rows were dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..types import CONCEPT, INFERRED_DOC
from .tables import cut, drop_cut, small


def _ends(edges: DataFrame) -> DataFrame:
    """(name, other, predicate, ...) in both directions; a self-loop once."""
    out = edges.select(F.col("subject").alias("name"), F.col("object").alias("other"), "*")
    back = edges.filter("subject <> object").select(F.col("object").alias("name"), F.col("subject").alias("other"), "*")
    return out.unionByName(back)


def hubs(edges: DataFrame, k: int = 10) -> DataFrame:
    """The k nodes with the most edges, in either direction."""
    return _ends(edges).groupBy("name").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "name").limit(k)


def labels(nodes: DataFrame) -> DataFrame:
    """Nodes by type; those without a type are a group of their own, shown as CONCEPT."""
    got = nodes.groupBy(F.col("entity_type").alias("t")).agg(F.count("*").alias("count"))
    return got.select(F.coalesce("t", F.lit(CONCEPT)).alias("label"), "count").orderBy(F.desc("count"), "label")


def node_stats(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.count("*").alias("total"), F.array_sort(F.collect_set("entity_type")).alias("types"))


def edge_stats(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count("*").alias("total"), F.count_distinct("predicate").alias("predicates"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def duplicate_clusters(nodes: DataFrame, limit: int = 100) -> DataFrame:
    """Names that differ in case alone."""
    got = nodes.groupBy(F.lower("name").alias("folded")).agg(F.array_sort(F.collect_list("name")).alias("variants"))
    return got.filter(F.size("variants") > 1).orderBy("folded").limit(limit)


def dedup_metrics(nodes: DataFrame, edges: DataFrame, limit: int = 100, examples: int = 10) -> DataFrame:
    """One row: totals, types, predicates, mean confidence, duplicate clusters (limit at most) and examples of them."""
    found = duplicate_clusters(nodes, limit)
    some = found.agg(F.count("*").alias("clusters"), F.slice(F.array_sort(F.collect_list("folded")), 1, examples).alias("examples"))
    n = node_stats(nodes).select(F.col("total").alias("nodes"), "types")
    e = edge_stats(edges).select(F.col("total").alias("edges"), "predicates", "mean_confidence")
    return n.join(e).join(some)  # three tables of one row


def graph(nodes: DataFrame, edges: DataFrame, limit: int = 500) -> DataFrame:
    """Rows (source, source_type, predicate, target, target_type, confidence, inferred) of nodes with their outgoing edges; a node without any has one row. Limit counts rows."""
    m = nodes.select(F.col("name").alias("target"), F.coalesce("entity_type", F.lit(CONCEPT)).alias("target_type"))
    rows = nodes.select(F.col("name").alias("source"), F.coalesce("entity_type", F.lit(CONCEPT)).alias("source_type")).join(edges.withColumnsRenamed({"subject": "source", "object": "target"}), "source", "left")
    rows = rows.join(m, "target", "left").select("source", "source_type", "predicate", "target", "target_type", "confidence", F.when(F.col("predicate").isNotNull(), F.coalesce("inferred", F.lit(False))).alias("inferred"))
    return rows.orderBy("source", F.asc_nulls_first("predicate"), F.asc_nulls_first("target")).limit(limit)


def view_nodes(rows: DataFrame) -> DataFrame:
    """The nodes of graph() as (id, label, type)."""
    ends = rows.select(F.col("source").alias("id"), F.col("source_type").alias("type")).unionByName(rows.filter("target is not null").select(F.col("target").alias("id"), F.col("target_type").alias("type")))
    return ends.groupBy("id").agg(F.max("type").alias("type")).select("id", F.col("id").alias("label"), "type")


def view_edges(rows: DataFrame) -> DataFrame:
    """The edges of graph() as (id, source, target, predicate, confidence, inferred)."""
    own = rows.filter("predicate is not null")
    if own.filter("source is null or target is null").limit(1).count():
        raise ValueError("an edge is missing an endpoint")
    return own.select(F.concat_ws("|", "source", "predicate", "target").alias("id"), "source", "target", "predicate", "confidence", F.coalesce("inferred", F.lit(False)).alias("inferred")).dropDuplicates(["source", "predicate", "target"])


def neighborhood(nodes: DataFrame, edges: DataFrame, name: str, limit: int = 200) -> DataFrame:
    """Edges at name in their true direction, with the other end's type; an isolated node has one row with nulls, an unknown one has none."""
    own = _ends(edges.filter((F.col("subject") == name) | (F.col("object") == name))).filter(F.col("name") == name)
    types = nodes.select(F.col("name").alias("other"), F.coalesce("entity_type", F.lit(CONCEPT)).alias("other_type"))
    me = nodes.filter(F.col("name") == name).select("name")
    got = me.join(own, "name", "left").join(types, "other", "left")
    direction = F.when(F.col("subject") == F.col("name"), "out").when(F.col("object") == F.col("name"), "in")
    return got.select("name", direction.alias("direction"), "predicate", "other", "other_type", "confidence").orderBy(F.desc_nulls_last("confidence"), "predicate", "other", "direction").limit(limit)


def anchors(edges: DataFrame, names: list[str], k: int = 25, hint: str | None = None, max_degree: int | None = None) -> DataFrame:
    """One hop from each anchor in either direction, the most confident first, k for each anchor.

    hint: only this predicate. max_degree: anchors with more edges than that give none without a hint.
    """
    got = _ends(edges.filter(F.col("subject").isin(names) | F.col("object").isin(names))).filter(F.col("name").isin(names))
    if hint is not None:
        got = got.filter(F.col("predicate") == hint)
    elif max_degree is not None:
        few = got.groupBy("name").count().filter(F.col("count") <= max_degree).select("name")
        got = got.join(few, "name", "left_semi")
    order = Window.partitionBy("name").orderBy(F.desc_nulls_last("confidence"), "predicate", "other", "subject")
    return got.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("name", "rank", "subject", "predicate", "object", "confidence", "source_doc_id", "inferred")


def top_hops(edges: DataFrame, k: int = 3) -> DataFrame:
    """anchors() for all nodes at once."""
    order = Window.partitionBy("name").orderBy(F.desc_nulls_last("confidence"), "predicate", "other", "subject")
    return _ends(edges).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("name", "rank", "predicate", "other", "confidence")


def shortest_paths(edges: DataFrame, source: str, target: str, hops: int = 3, limit: int = 3) -> DataFrame:
    """The shortest undirected paths of at most so many edges, as (hops, path, all_inferred), in the order of path."""
    return shortest_paths_of(edges, [(source, target)], hops, limit).select("hops", "path", "all_inferred")


def shortest_paths_of(edges: DataFrame, pairs: list[tuple[str, str]], hops: int = 3, limit: int = 3) -> DataFrame:
    """shortest_paths() of all pairs (source, target) in one search, as (source, target, hops, path, all_inferred): a step reads the edges once.

    The search goes from both ends, so no frontier is wider than half the hops make it. A frontier holds nodes that no
    earlier one held and, for each, the `limit` least paths to it: those of one length only compete at their own end, so
    the least whole paths are among their combinations. A pair whose paths were found takes no further step.
    """
    if hops < 1:
        raise ValueError("hops must be positive")
    spark, schema = edges.sparkSession, "source string, target string, hops int, path array<string>, all_inferred boolean"
    same = sorted({a for a, b in pairs if a == b})
    known = {r[0] for r in _ends(edges.filter(F.col("subject").isin(same) | F.col("object").isin(same))).filter(F.col("name").isin(same)).select("name").distinct().collect()} if same else set()
    found = [(i, 0, [a], False) for i, (a, b) in enumerate(pairs) if a == b and a in known]
    open_ = [i for i, (a, b) in enumerate(pairs) if a != b]
    ends = _ends(edges.select("subject", "object", F.coalesce("inferred", F.lit(False)).alias("inferred")).filter("subject <> object")).select("name", "other", "inferred")
    front = lambda k: spark.createDataFrame([(i, pairs[i][k], [pairs[i][k]], True) for i in open_], "pair int, end string, path array<string>, all boolean")
    sides = [F.broadcast(front(0)), F.broadcast(front(1))]
    seen = [side.select("pair", "end") for side in sides]
    used: list[DataFrame] = []

    def grow(k: int) -> None:
        step = ends.join(sides[k].filter(F.col("pair").isin(open_)), F.col("end") == F.col("name")).groupBy("pair", "end", "path", "all", "other").agg(F.min("inferred").alias("inferred"))
        new = step.select("pair", F.col("other").alias("end"), (F.array_append("path", F.col("other")) if not k else F.array_prepend("path", F.col("other"))).alias("path"), (F.col("all") & F.col("inferred")).alias("all"))
        best = Window.partitionBy("pair", "end").orderBy(F.array_join("path", "\x01"))
        new = new.join(seen[k], ["pair", "end"], "left_anti").withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= limit).drop("nth")
        held = cut(new, "front")
        used.append(held)
        sides[k] = small(held)
        seen[k] = seen[k].unionByName(held.select("pair", "end"))

    for n in range(1, hops + 1):
        if not open_:
            break
        grow((n + 1) % 2)
        left, right = sides[0], sides[1].select("pair", "end", F.col("path").alias("tail"), F.col("all").alias("tail_all"))
        met = left.filter(F.col("pair").isin(open_)).join(right, ["pair", "end"]).select("pair", F.lit(n).alias("hops"), F.concat(F.slice("path", 1, F.size("path") - 1), "tail").alias("path"), (F.col("all") & F.col("tail_all")).alias("all_inferred"))
        order = F.array_join("path", "\x01")
        least = met.withColumn("nth", F.row_number().over(Window.partitionBy("pair").orderBy(order))).filter(F.col("nth") <= limit)
        rows = [tuple(r) for r in least.orderBy("pair", "nth").drop("nth").collect()]  # limit rows a pair
        found += rows
        open_ = [i for i in open_ if i not in {r[0] for r in rows}]
    for t in used:
        drop_cut(t)
    return spark.createDataFrame([(*pairs[i], *rest) for i, *rest in sorted(found, key=lambda r: r[0])], schema)


def answers(paths: DataFrame) -> DataFrame:
    """Paths that may answer a question: one of inferred edges alone is no answer."""
    return paths.filter(~F.col("all_inferred"))


def by_document(edges: DataFrame, doc_id: str, prefix: bool = False) -> DataFrame:
    """Edges that rest on a document, or on those whose id begins so."""
    return edges.filter(F.startswith("source_doc_id", F.lit(doc_id)) if prefix else F.col("source_doc_id") == doc_id)


def inferred_only(edges: DataFrame, limit: int = 50) -> DataFrame:
    """Inferred edges in the order of their keys."""
    return edges.filter("inferred").orderBy("subject", "predicate", "object").limit(limit)


def grounding(edges: DataFrame, documents: DataFrame) -> DataFrame:
    """(subject, predicate, object, doc_id): the documents that an edge rests on. An inferred edge rests on its ends' documents."""
    stated = edges.filter(F.col("source_doc_id") != INFERRED_DOC)
    near = stated.select(F.col("subject").alias("name"), "source_doc_id").unionByName(stated.select(F.col("object").alias("name"), "source_doc_id")).distinct()
    guess = edges.filter(F.col("source_doc_id") == INFERRED_DOC).select("subject", "predicate", "object", F.explode(F.array("subject", "object")).alias("name"))
    rows = stated.select("subject", "predicate", "object", "source_doc_id").unionByName(guess.join(near, "name").select("subject", "predicate", "object", "source_doc_id"))
    return rows.distinct().join(documents.select(F.col("doc_id").cast("string").alias("doc_id")).distinct(), F.col("source_doc_id") == F.col("doc_id"), "left_semi").withColumnRenamed("source_doc_id", "doc_id")


def link_entities(nodes: DataFrame, aliases: DataFrame, names: list[str], most: int = 3) -> DataFrame:
    """Anchors for names: an exact node name, else the alias table's canonical one; no fuzzy match."""
    spark = nodes.sparkSession
    asked = spark.createDataFrame(list(enumerate(names)), "place int, query string")
    exact = asked.join(nodes.select(F.col("name")), F.col("query") == F.col("name"), "left")
    via = exact.join(aliases, F.lower(F.trim("query")) == F.col("alias"), "left")
    return via.select("place", "query", F.coalesce("name", "canonical").alias("anchor")).filter("anchor is not null").orderBy("place", "anchor").limit(most)
