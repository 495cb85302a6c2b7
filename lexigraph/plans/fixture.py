"""A graph out of the benchmark's relational tables: facts about places, firms, people and products."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..types import INFERRED_DOC, SPAN
from .store import GraphStore
from .tables import cut, shared_dir


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _facts(df: DataFrame, first: int, place: Column, s: tuple[Column | str, str], predicate: str, o: tuple[Column | str, str], confidence: Column, doc: Column, inferred: bool = False) -> DataFrame:
    entity = lambda e: F.struct((F.col(e[0]) if isinstance(e[0], str) else e[0]).alias("name"), F.lit(e[1]).alias("entity_type"))
    return df.select((F.lit(first) + place.cast("bigint")).alias("seq"), entity(s).alias("subject"), F.lit(predicate).alias("predicate"), entity(o).alias("object"), confidence.cast("double").alias("confidence"), doc.alias("source_doc_id"), F.lit(None).cast(SPAN).alias("source_span"), F.lit(inferred).alias("inferred"))


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq is unique and in the order of source tables and keys; rows of lineitem, whose keys repeat, by all their columns.

    Every row of lineitem gives two facts. Regions border themselves (self-loops), nations have a second spelling (loops by
    identity alone), and a nation is guessed to trade with the next one (inferred).
    """
    read = lambda n: _read(spark, sf_dir, n)
    nation, region, supplier, customer, part, orders, line = map(read, ("nation", "region", "supplier", "customer", "part", "orders", "lineitem"))
    doc = lambda kind, key: F.concat(F.lit(f"{kind}/"), F.col(key).cast("string"))
    key = ["l_orderkey", "l_linenumber"]
    among = F.row_number().over(Window.partitionBy(key).orderBy([c for c in line.columns if c not in key]))
    at = F.col("among") + 1_000_000 * (F.col("l_orderkey") * 1000 + F.col("l_linenumber"))
    # one pass over lineitem, dealt by orders once: all names of a key stand in one row, so that keys which repeat give their facts on their own side alone
    names = lambda df, key, name, to: df.groupBy(key).agg(F.collect_list(F.struct(F.col(name).alias("name"))).alias(to))
    owners = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name").repartition("o_orderkey")
    lines = line.repartition("l_orderkey").withColumn("among", among).join(names(owners, "o_orderkey", "c_name", "owners"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    lines = lines.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).join(names(supplier, "s_suppkey", "s_name", "sellers"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    side = lambda to, first, kind, predicate, confidence: F.struct(F.col(to).alias("who"), F.lit(first).alias("first"), F.lit(kind).alias("kind"), F.lit(predicate).alias("predicate"), confidence.cast("double").alias("confidence"))
    sides = F.array(side("sellers", 2 * 10**18, "ORG", "supplies", F.least(F.lit(1.0), F.col("l_quantity") / 50)), side("owners", 3 * 10**18, "PERSON", "ordered", 1 - F.col("l_discount")))
    said = lines.select(at.cast("bigint").alias("at"), doc("order", "l_orderkey").alias("doc"), "p_name", F.explode(sides).alias("side")).select("at", "doc", "p_name", "side.*").withColumn("who", F.explode("who"))
    entity = lambda name, kind: F.struct(name.alias("name"), kind.alias("entity_type"))
    said = said.select((F.col("first") + F.col("at")).alias("seq"), entity(F.col("who.name"), F.col("kind")).alias("subject"), "predicate", entity(F.col("p_name"), F.lit("PRODUCT")).alias("object"), "confidence", F.col("doc").alias("source_doc_id"), F.lit(None).cast(SPAN).alias("source_span"), F.lit(False).alias("inferred"))
    following = nation.select(F.col("n_nationkey").alias("next"), F.col("n_name").alias("next_name"))
    return (
        _facts(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")), 0, F.col("n_nationkey"), ("n_name", "GPE"), "is part of", ("r_name", "GPE"), F.lit(1.0), doc("nation", "n_nationkey"))
        .unionByName(_facts(supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")), 10**13, F.col("s_suppkey"), ("s_name", "ORG"), "is based in", ("n_name", "GPE"), F.lit(0.9), doc("supplier", "s_suppkey")))
        .unionByName(_facts(customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")), 2 * 10**13, F.col("c_custkey"), ("c_name", "PERSON"), "lives in", ("n_name", "GPE"), F.lit(0.8), doc("customer", "c_custkey")))
        .unionByName(_facts(region, 3 * 10**13, F.col("r_regionkey"), ("r_name", "GPE"), "borders", ("r_name", "GPE"), F.lit(0.5), doc("region", "r_regionkey")))
        .unionByName(_facts(nation, 4 * 10**13, F.col("n_nationkey"), ("n_name", "GPE"), "is also written", (F.lower("n_name"), "GPE"), F.lit(0.7), doc("nation", "n_nationkey")))
        .unionByName(_facts(nation.join(following, F.col("next") == (F.col("n_nationkey") + 1) % 25), 5 * 10**13, F.col("n_nationkey"), ("n_name", "GPE"), "trades with", ("next_name", "GPE"), F.lit(0.55), F.lit(INFERRED_DOC), True))
        .unionByName(said)
    )


#: (spark's application, directory) -> facts, written once, and the store that they were loaded into, once a query reads it.
_FACTS: dict[tuple[str, str], DataFrame] = {}
_LOADED: dict[tuple[str, str], tuple[DataFrame, GraphStore]] = {}


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts, written once for each application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FACTS:
        _FACTS[key] = cut(triples(spark, sf_dir), "facts")
    return _FACTS[key]


def loaded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, GraphStore]:
    """The facts, and a graph store that they were loaded into."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        own = facts(spark, sf_dir)
        store = GraphStore(spark, f"{shared_dir(spark)}/lexigraph-graph-{uuid.uuid4().hex}")
        store.upsert(own, "lower", written=True)
        _LOADED[key] = own, store
    return _LOADED[key]


#: The same facts in DuckDB's SQL, as the views that oracles of graph queries begin with.
SQL = """l as (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) + 1000000 * (l_orderkey * 1000 + l_linenumber) as place from lineitem),
t as (select n_nationkey::bigint as seq, n_name as s, 'GPE' as st, 'is part of' as p, r_name as o, 'GPE' as ot, 1.0::double as confidence, 'nation/' || n_nationkey as doc, false as inf from nation join region on n_regionkey = r_regionkey
union all select 10000000000000 + s_suppkey, s_name, 'ORG', 'is based in', n_name, 'GPE', 0.9, 'supplier/' || s_suppkey, false from supplier join nation on s_nationkey = n_nationkey
union all select 20000000000000 + c_custkey, c_name, 'PERSON', 'lives in', n_name, 'GPE', 0.8, 'customer/' || c_custkey, false from customer join nation on c_nationkey = n_nationkey
union all select 30000000000000 + r_regionkey, r_name, 'GPE', 'borders', r_name, 'GPE', 0.5, 'region/' || r_regionkey, false from region
union all select 40000000000000 + n_nationkey, n_name, 'GPE', 'is also written', lower(n_name), 'GPE', 0.7, 'nation/' || n_nationkey, false from nation
union all select 50000000000000 + a.n_nationkey, a.n_name, 'GPE', 'trades with', b.n_name, 'GPE', 0.55, '__inference__', true from nation a join nation b on b.n_nationkey = (a.n_nationkey + 1) % 25
union all select 2000000000000000000 + place, s_name, 'ORG', 'supplies', p_name, 'PRODUCT', least(1.0::double, l_quantity / 50), 'order/' || l_orderkey, false from l join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
union all select 3000000000000000000 + place, c_name, 'PERSON', 'ordered', p_name, 'PRODUCT', 1 - l_discount, 'order/' || l_orderkey, false from l join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey),
m as (select 2 * seq as mention, s as name, st as entity_type, doc from t union all select 2 * seq + 1, o, ot, doc from t),
n as (select name, arg_min(entity_type, mention) as entity_type, arg_min(doc, mention) as last_seen_doc from m group by name),
e as (select s as subject, p as predicate, o as object, arg_max(confidence, seq) as confidence, arg_max(doc, seq) as source_doc_id, arg_max(inf, seq) as inferred from t where lower(s) <> lower(o) group by s, p, o)"""
