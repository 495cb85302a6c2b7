"""The library's operators as queries over the benchmark's tables, with the same results in DuckDB's SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scores, text
from .operators import alias, bridges, changes, chunks, ontology, resolution, similarity, triples, views
from .operators import extraction as ex
from .plans import fixture, reads, store
from .plans.tables import shared_dir
from .sources import graphml
from .sources.completions import FirstWords
from .streaming.changes import event_windows as windows
from .streaming.changes import into_store
from .types import ExtractionConfig

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_WITH = "with " + fixture.SQL
#: Rows of the fixture's graph as a viewer has them.
_VIEW = _WITH + ", v as (select t.seq, s as source, o as target, p as predicate, confidence from t)"


def query(sql: str = "", base: str = _WITH) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"{base} {sql}" if base else sql
        return f

    return put


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _facts(spark, sf) -> DataFrame:
    return fixture.facts(spark, sf)


def _nodes(spark, sf) -> DataFrame:
    return fixture.loaded(spark, sf)[1].nodes


def _edges(spark, sf) -> DataFrame:
    return fixture.loaded(spark, sf)[1].edges


def _view_nodes(spark, sf) -> DataFrame:
    return _nodes(spark, sf).select(F.col("name").alias("id"), F.col("name").alias("label"), F.col("entity_type").alias("type"))


def _view_edges(spark, sf) -> DataFrame:
    return _facts(spark, sf).select("seq", F.col("subject.name").alias("source"), F.col("object.name").alias("target"), "predicate", "confidence", "inferred")


def _view(spark, sf) -> tuple[DataFrame, DataFrame]:
    return _view_nodes(spark, sf), _view_edges(spark, sf)


def _flat(t: DataFrame, *more) -> DataFrame:
    return t.select("seq", F.col("subject.name").alias("s"), F.col("subject.entity_type").alias("st"), "predicate", F.col("object.name").alias("o"), F.col("object.entity_type").alias("ot"), "confidence", "source_doc_id", *more)


_BOTH = "b as (select subject as name, object as other, * from e union all select object, subject, * from e where subject <> object)"


# graph reads


@query(f", {_BOTH} select name, count(*) as degree from b group by name order by degree desc, name limit 10")
def hubs(spark, sf):
    return reads.hubs(_edges(spark, sf), 10)


@query(f", {_BOTH} select name, count(*) as degree from b group by name order by degree desc, name limit 15")
def degree_distribution(spark, sf):
    return reads.hubs(_edges(spark, sf), 15)


@query("select entity_type as label, count(*) as count from n group by entity_type")
def labels(spark, sf):
    return reads.labels(_nodes(spark, sf))


@query("select count(*) as total, list_sort(list(distinct entity_type)) as types from n")
def node_stats(spark, sf):
    return reads.node_stats(_nodes(spark, sf))


@query("select count(*) as total, count(distinct predicate) as predicates, round(avg(confidence), 6) as mean_confidence from e")
def edge_stats(spark, sf):
    return reads.edge_stats(_edges(spark, sf))


_VARIANTS = ", x as (select name from n union all select upper(name) from n where entity_type in ('GPE', 'PRODUCT')), d as (select lower(name) as folded, list_sort(list(name)) as variants from x group by 1 having count(*) > 1)"


def _variants(spark, sf) -> DataFrame:
    nodes = _nodes(spark, sf)
    return nodes.select("name", "entity_type").unionByName(nodes.filter("entity_type in ('GPE', 'PRODUCT')").select(F.upper("name").alias("name"), "entity_type"))


@query(_VARIANTS + " select * from d order by folded limit 100")
def duplicate_clusters(spark, sf):
    return reads.duplicate_clusters(_variants(spark, sf))


@query(_VARIANTS + ", c as (select * from d order by folded limit 100) select (select count(*) from x) as nodes, (select count(*) from e) as edges, (select count(distinct predicate) from e) as predicates, (select round(avg(confidence), 6) from e) as mean_confidence, count(*) as clusters, list_sort(list(folded))[1:10] as examples, (select list_sort(list(distinct entity_type)) from n) as types from c")
def dedup_metrics(spark, sf):
    return reads.dedup_metrics(_variants(spark, sf), _edges(spark, sf))


@query(_VARIANTS + " select count(*) filter (len(variants) <= 2) as small, count(*) filter (len(variants) between 3 and 4) as medium, count(*) filter (len(variants) > 4) as large from d")
def cluster_buckets(spark, sf):
    return views.cluster_buckets(reads.duplicate_clusters(_variants(spark, sf), 1 << 30))


@query("select n.name as source, n.entity_type as source_type, e.predicate, e.object as target, k.entity_type as target_type, e.confidence, e.inferred from n left join e on e.subject = n.name left join n k on k.name = e.object order by 1, 3 nulls first, 4 nulls first limit 500")
def graph_limit(spark, sf):
    return reads.graph(_nodes(spark, sf), _edges(spark, sf), 500)


_NEAR = "select '{0}' as name, case when subject = '{0}' then 'out' else 'in' end as direction, predicate, case when subject = '{0}' then object else subject end as other, n.entity_type as other_type, confidence from e join n on n.name = case when subject = '{0}' then object else subject end where subject = '{0}' or object = '{0}' order by confidence desc, predicate, other, direction limit 200"


@query(_NEAR.format("NATION_3"))
def neighborhood(spark, sf):
    return fixture.loaded(spark, sf)[1].neighborhood("NATION_3")


@query(_NEAR.format("small ring"))
def neighborhood_limit(spark, sf):
    return reads.neighborhood(_nodes(spark, sf), _edges(spark, sf), "small ring")


_ASKED = ["NATION_3", "EUROPE", "Supplier#000000001"]
_ANCHOR = ", r as (select name, row_number() over (partition by name order by confidence desc, predicate, other, subject) as rank, subject, predicate, object, confidence, source_doc_id, inferred from b where name in ('NATION_3', 'EUROPE', 'Supplier#000000001') {}) select * from r where rank <= 25"


@query(f", {_BOTH}" + _ANCHOR.format(""))
def anchor_one_hop(spark, sf):
    return reads.anchors(_edges(spark, sf), _ASKED)


@query(f", {_BOTH}" + _ANCHOR.format("and predicate = 'is based in'"))
def anchor_with_hint(spark, sf):
    return reads.anchors(_edges(spark, sf), _ASKED, hint="is based in", max_degree=10)


@query(f", {_BOTH}, c as (select name from b where name in ('NATION_3', 'EUROPE', 'Supplier#000000001') group by name having count(*) <= 10)" + _ANCHOR.format("and name in (from c)"))
def anchor_hub_guard(spark, sf):
    return reads.anchors(_edges(spark, sf), _ASKED, max_degree=10)


@query(f", {_BOTH}, r as (select name, row_number() over (partition by name order by confidence desc, predicate, other, subject) as rank, predicate, other, confidence from b) select * from r where rank <= 3")
def all_anchors_top_hops(spark, sf):
    return reads.top_hops(_edges(spark, sf))


_PAIRS = [("NATION_3", "EUROPE"), ("NATION_3", "NATION_8"), ("EUROPE", "ASIA"), ("NATION_3", "NATION_5"), ("Supplier#000000001", "Customer#000000002"), ("EUROPE", "EUROPE")]
_PATHS = f""", q(s, t) as (values {", ".join(map(str, _PAIRS))}), z as (select u, v, bool_and(inferred) as inf from (select subject as u, object as v, inferred from e union all select object, subject, inferred from e) group by all),
h as (select s, t, 0 as hops, [s] as path, false as inf from q where s = t and s in (select u from z)
union all select s, t, 1, [s, t], inf from q join z on u = s and v = t
union all select s, t, 2, [s, x.v, t], x.inf and y.inf from q join z x on x.u = s join z y on y.v = t and y.u = x.v where s <> t and x.v <> t
union all select s, t, 3, [s, x.v, y.u, t], x.inf and y.inf and w.inf from q join z x on x.u = s join z y on y.v = t join z w on w.u = x.v and w.v = y.u where s <> t and x.v <> t and y.u <> s),
p as (select s as source, t as target, hops, path, inf as all_inferred from h qualify hops = min(hops) over (partition by s, t) and row_number() over (partition by s, t, hops order by array_to_string(path, chr(1))) <= 3)"""


def _paths(spark, sf) -> DataFrame:
    return reads.shortest_paths_of(_edges(spark, sf), _PAIRS)


@query(_PATHS + " select * from p")
def shortest_path_3(spark, sf):
    return _paths(spark, sf)


@query(_PATHS + " select * from p where not all_inferred")
def path_answers(spark, sf):
    return reads.answers(_paths(spark, sf))


@query("select subject, predicate, object, confidence, source_doc_id, inferred from e where inferred order by subject, predicate, object limit 10")
def inferred_edges(spark, sf):
    return fixture.loaded(spark, sf)[1].inferred_only(10)


@query("select subject, predicate, object, confidence, case when confidence < 0.5 then 'drop' when confidence <= 0.7 then 'supporting' else 'primary' end as band, case when confidence >= 0.8 then 'high' when confidence >= 0.5 then 'mid' else 'low' end as badge, 1 + 4 * greatest(0, least(1, confidence)) as width from e")
def confidence_bands(spark, sf):
    return _edges(spark, sf).select("subject", "predicate", "object", "confidence", scores.band("confidence").alias("band"), scores.badge("confidence").alias("badge"), scores.edge_width("confidence").alias("width"))


@query(", d as (select 'order/' || o_orderkey as doc_id from orders where o_orderpriority like '1%' union select 'nation/' || n_nationkey from nation), s as (select * from e where source_doc_id <> '__inference__'), k as (select subject as name, source_doc_id as doc from s union select object, source_doc_id from s), g as (select subject, predicate, object, source_doc_id as doc_id from s union select subject, predicate, object, doc from e join k on name in (subject, object) where source_doc_id = '__inference__') select * from g where doc_id in (from d)")
def grounding(spark, sf):
    orders = _t(spark, sf, "orders").filter("o_orderpriority like '1%'").select(F.concat(F.lit("order/"), F.col("o_orderkey").cast("string")).alias("doc_id"))
    return reads.grounding(_edges(spark, sf), orders.unionByName(_t(spark, sf, "nation").select(F.concat(F.lit("nation/"), F.col("n_nationkey").cast("string")).alias("doc_id"))))


@query("select subject, predicate, object, source_doc_id from e where starts_with(source_doc_id, 'supplier/')")
def edges_by_document(spark, sf):
    return fixture.loaded(spark, sf)[1].by_document("supplier/", prefix=True).select("subject", "predicate", "object", "source_doc_id")


@query("select subject, predicate, object, source_doc_id from e where source_doc_id = 'nation/3'")
def edges_of_one_document(spark, sf):
    return fixture.loaded(spark, sf)[1].by_document("nation/3").select("subject", "predicate", "object", "source_doc_id")


@query(", q(place, query) as (values (0, 'EUROPE'), (1, 'Hexagone'), (2, 'nowhere'), (3, 'NATION_7')) select place, query, coalesce(n.name, case when lower(trim(query)) = 'hexagone' then 'NATION_3' end) as anchor from q left join n on n.name = query where coalesce(n.name, case when lower(trim(query)) = 'hexagone' then 'NATION_3' end) is not null")
def entity_linking(spark, sf):
    table = spark.createDataFrame([("hexagone", "NATION_3"), ("europe", "wrong")], "alias string, canonical string")
    return reads.link_entities(_nodes(spark, sf), table, ["EUROPE", "Hexagone", "nowhere", "NATION_7"])


# triples


@query("select name, entity_type, last_seen_doc from n")
def node_rows(spark, sf):
    return _nodes(spark, sf)


@query("select subject, predicate, object, confidence, source_doc_id, inferred from e")
def edge_upsert_last_wins(spark, sf):
    return _edges(spark, sf)


@query("select count(*) as count, round(avg(confidence), 6) as mean, count(*) filter (confidence < 0.6) as low_confidence_count from t")
def confidence_stats(spark, sf):
    return triples.confidence_stats(_facts(spark, sf)).withColumn("mean", F.round("mean", 6))


@query("select seq, s, st, p as predicate, o, ot, confidence, doc as source_doc_id from t where confidence >= 0.95")
def confidence_floor(spark, sf):
    return _flat(triples.confidence_floor(_facts(spark, sf), 0.95))


@query("select arg_max(seq, (confidence, -seq)) as seq, max(confidence) as confidence, min(seq) as first, any_value(s) as s, any_value(p) as predicate, any_value(o) as o from t group by lower(s), lower(p), lower(o)")
def dedupe_triples(spark, sf):
    return triples.dedupe(_facts(spark, sf), "lower").select("seq", "confidence", "first", F.col("subject.name").alias("s"), "predicate", F.col("object.name").alias("o"))


@query("select round(1 - count(distinct lower(name)) / count(*), 9) as duplicate_rate from m")
def duplicate_rate(spark, sf):
    return triples.duplicate_rate(_facts(spark, sf), "lower").select(F.round("duplicate_rate", 9).alias("duplicate_rate"))


@query("select lower(name) as name, arg_max(entity_type, mention) as entity_type from m group by 1")
def entity_types_last_wins(spark, sf):
    return triples.entity_types(_facts(spark, sf), "lower")


@query("select l_orderkey, l_linenumber, l_quantity / 40 as raw, round(least(1.0::double, l_quantity / 40) * (case when l_linenumber % 2 = 0 then 1.0 else 0.8 end)::double, 4) as calibrated from lineitem", "")
def calibrated(spark, sf):
    raw = F.col("l_quantity") / 40
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"), scores.calibrate(raw, F.col("l_linenumber") % 2 == 0).alias("calibrated"))


@query("select seq, (row_number() over (order by seq) - 1) // 500 as batch from t")
def fixed_batches(spark, sf):
    return triples.fixed_batches(_facts(spark, sf).select("seq"), 500)


@query("select subject, predicate, object, source_doc_id from e where source_doc_id not in (select 'order/' || o_orderkey from orders where o_orderstatus = 'F')")
def delete_documents(spark, sf):
    gone = _t(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.concat(F.lit("order/"), F.col("o_orderkey").cast("string")).alias("doc_id"))
    return store.delete_documents(_edges(spark, sf), gone).select("subject", "predicate", "object", "source_doc_id")


@query("select count(*) as nodes, (select count(*) from e) as edges, (select sum(greatest(0, c)) from (select count(*) - 1 as c from e group by subject, predicate, object)) as repeated from n")
def upsert_twice(spark, sf):
    nodes, edges = _nodes(spark, sf), _edges(spark, sf)
    n2, e2 = store.merge_nodes(nodes, nodes), store.merge_edges(edges, edges, nodes)
    rep = e2.groupBy("subject", "predicate", "object").count().agg(F.sum(F.col("count") - 1).cast("decimal(38,0)").alias("repeated"))
    return n2.agg(F.count("*").alias("nodes")).join(e2.agg(F.count("*").alias("edges"))).join(rep)


@query("select subject, predicate, object, 0.25::double as confidence, source_doc_id from e where object not in (select name from n where entity_type = 'PRODUCT') union all select subject, predicate, object, confidence, source_doc_id from e where predicate = 'supplies'")
def edge_merge(spark, sf):
    """Changed edges replace stored ones; those to products, which aren't among the known nodes, vanish."""
    nodes, edges = _nodes(spark, sf), _edges(spark, sf)
    new = edges.withColumn("confidence", F.lit(0.25))
    return store.merge_edges(edges.filter("predicate = 'supplies'"), new, nodes.filter("entity_type <> 'PRODUCT'")).select("subject", "predicate", "object", "confidence", "source_doc_id")


# ontology

_RULES = [("ORG", "IS BASED IN", "GPE"), ("PERSON", "ordered", "PRODUCT"), ("person", "lives in", "GPE")]
_MATCH = "(st, lower(p), ot) in (('ORG', 'is based in', 'GPE'), ('PERSON', 'ordered', 'PRODUCT'), ('person', 'lives in', 'GPE'))"


@query(f"select seq, s, st, p as predicate, o, ot, confidence, doc as source_doc_id from t where {_MATCH}")
def ontology_kept(spark, sf):
    return _flat(ontology.kept(_facts(spark, sf), ontology.rules(spark, _RULES)))


@query(f"select seq, 'no ontology rule allows ' || st || ' -[' || p || ']-> ' || ot as reason from t where not {_MATCH}")
def ontology_violations(spark, sf):
    return ontology.violations(_facts(spark, sf), ontology.rules(spark, _RULES)).select("seq", "reason")


@query(f"select round(avg(case when {_MATCH} then 1 else 0 end), 9) as coverage from t")
def ontology_coverage(spark, sf):
    return ontology.coverage(_facts(spark, sf), ontology.rules(spark, _RULES)).select(F.round("coverage", 9).alias("coverage"))


@query("select st as subject_type, count(distinct (p, ot)) as rules from t group by st")
def ontology_summary(spark, sf):
    return ontology.summary(ontology.mine(_facts(spark, sf)))


@query("select distinct st as subject_type, p as predicate, ot as object_type from t")
def mined_rules(spark, sf):
    return ontology.mine(_facts(spark, sf))


@query("select distinct st as subject_type, p as predicate, ot as object_type from t where p not in ('is based in')")
def ontology_difference(spark, sf):
    return ontology.difference(ontology.mine(_facts(spark, sf)), ontology.rules(spark))


@query(f"select 'REJECT ' || s || ' -[' || p || ']-> ' || o || ': no ontology rule allows ' || st || ' -[' || p || ']-> ' || ot as line from t where not {_MATCH}")
def reject_lines(spark, sf):
    return ontology.reject_lines(ontology.violations(_facts(spark, sf), ontology.rules(spark, _RULES)))


@query("select distinct st as subject_type, p as predicate, ot as object_type from t union select * from (values ('A', 'b', 'C')) x")
def ontology_merged(spark, sf):
    return ontology.merge(ontology.mine(_facts(spark, sf)), ontology.rules(spark, [("A", "b", "C")]))


# components and bridges


def _islands(spark, sf) -> DataFrame:
    """Facts that leave several components: nations and regions, and suppliers with their nation's number as a place."""
    facts = _facts(spark, sf).filter("predicate in ('is part of', 'is based in')")
    far = F.concat(F.lit("SITE "), F.col("object.name"))
    return facts.withColumn("object", F.when(F.col("predicate") == "is based in", F.struct(far.alias("name"), F.lit("GPE").alias("entity_type"))).otherwise(F.col("object")))


_ISLANDS = _WITH + ", i as (select seq, lower(s) as s, st, case when p = 'is based in' then 'site ' || lower(o) else lower(o) end as o, ot from t where p in ('is part of', 'is based in')), c as (select distinct s as name, o as component from i), g as (select name, component from c union select component, component from c), h as (select name, min(m) over (partition by component) as component from (select g.name, g.component, least(g.name, g.component) as m from g))"


def _spread(rounds: int = 12) -> str:
    """Least names spread along edges, a step a round; the graph's diameter is less than the rounds."""
    steps = ", ".join(f"r{i + 1} as materialized (select r{i}.name, least(r{i}.c, coalesce(k.c, r{i}.c)) as c from r{i} left join (select a, min(c) as c from cb join r{i} on name = b group by a) k on k.a = r{i}.name)" for i in range(rounds))
    return f", ce as materialized (select distinct lower(s) as a, lower(o) as b from t where lower(s) <> lower(o)), cb as materialized (select * from ce union select b, a from ce), r0 as materialized (select distinct a as name, a as c from cb), {steps}, cc as (select name, c as component from r{rounds})"


@query(_spread() + " select name, component from cc")
def components(spark, sf):
    return bridges.entity_components(_facts(spark, sf), "lower")


@query(_spread() + " select count(distinct component) as components, count(*) as entities, (select max(n) from (select count(*) as n from cc group by component)) as largest from cc")
def component_report(spark, sf):
    return bridges.component_report(_facts(spark, sf), "lower")


@query(", k as (select name, min(component) as component from h group by name) select name, component from k", _ISLANDS)
def components_of_islands(spark, sf):
    return bridges.entity_components(_islands(spark, sf), "lower")


_BRIDGES = """, k as (select name, min(component) as component from h group by name),
a as (select s as name, 2 * seq as mention, st as type from i union all select o, 2 * seq + 1, ot from i),
y as (select name, arg_max(type, mention) as type, min(mention) as first from a group by name),
z as (select k.name, y.type, min(first) over (partition by component) as place, list_filter(string_split(k.name, ' '), lambda w: length(w) >= 4) as words from k join y using (name)),
q as (select l.name as source, r.name as target, l.place as lp, r.place as rp, least(0.95::double, 0.4::double + (case when l.type = r.type then 0.15 else 0 end)::double + (case when l.type = 'PERSON' and r.type = 'ORG' then 0.2 else 0 end)::double + (case when l.type = 'ORG' and r.type = 'ORG' then 0.1 else 0 end)::double + (case when list_has_any(l.words, r.words) then 0.1 else 0 end)::double) as score,
case when l.type = 'ORG' and r.type = 'ORG' then 'related to' when l.type = 'PERSON' and r.type = 'ORG' then 'affiliated with' when l.type = r.type then 'associated with' else 'relates to' end as predicate from z l join z r on l.place < r.place),
u as (select source, target, predicate, score from q where score >= 0.55 and (select count(distinct component) from k) <= 50 qualify row_number() over (partition by lp, rp order by score desc, source, target) <= 25)"""


@query(_BRIDGES + " select source, target, predicate, round(score, 6) as score from u", _ISLANDS)
def bridge_candidates(spark, sf):
    return bridges.bridges(_islands(spark, sf), fold="lower").withColumn("score", F.round("score", 6))


@query(_BRIDGES + " select count(*) as triples, count(*) filter (inferred) as inferred from (select false as inferred from i union all select true from u)", _ISLANDS)
def merge_inferred(spark, sf):
    own = _islands(spark, sf)
    got = bridges.merge_inferred(own, bridges.materialized(bridges.bridges(own, fold="lower")), "lower")
    return got.agg(F.count("*").alias("triples"), F.count_if(F.col("inferred")).alias("inferred"))


# similarity and resolution

_NAMES = "with d as (select distinct lower(p_name) as name from part), g as (select name, unnest(list_transform(range(1, length(name) + 1), lambda i: substring(' ' || name || ' ', i, 3))) as gram from d), v as (select name, (('0x' || substring(md5(gram), 1, 8))::bigint % 256)::int as bucket, count(*) as cnt from g group by all), q as (select a.name as left, b.name as right, sum(a.cnt * b.cnt)::bigint as dot from v a join v b on a.bucket = b.bucket and a.name < b.name group by all), z as (select name, sum(cnt * cnt) as n2 from v group by name), w as (select q.left, q.right, q.dot, round(q.dot / sqrt((x.n2 * y.n2)::double), 9) as similarity from q join z x on x.name = q.left join z y on y.name = q.right)"


def _names(spark, sf) -> DataFrame:
    return _t(spark, sf, "part").select(F.lower("p_name").alias("name")).distinct()


@query("select name, gram, count(*) as n from g group by all", _NAMES)
def name_ngrams(spark, sf):
    return _names(spark, sf).select("name", F.explode(text.ngrams("name")).alias("gram")).groupBy("name", "gram").agg(F.count("*").alias("n"))


@query("select name, bucket, cnt from v", _NAMES)
def ngram_vectors(spark, sf):
    return similarity.vectors(_names(spark, sf), hashing="md5")


@query('select "left", "right", dot, similarity from w where similarity >= 0.5', _NAMES)
def similarity_pairs(spark, sf):
    return similarity.pairs(similarity.vectors(_names(spark, sf), hashing="md5"), 0.5).withColumn("similarity", F.round("similarity", 9))


@query('select "left" as canonical, "right" as alias, similarity from w where similarity >= 0.7 and similarity < 0.85', _NAMES)
def borderline_pairs(spark, sf):
    return resolution.resolve_names(_names(spark, sf), hashing="md5")[2].withColumn("similarity", F.round("similarity", 9))


@query()
def canonical_map(spark, sf):
    return resolution.resolve_names(_names(spark, sf))[0]


@query()
def rewrite_triples(spark, sf):
    facts = _facts(spark, sf)
    mapping = resolution.resolve_names(_names(spark, sf))[0]
    return _flat(resolution.rewrite(facts, mapping))


@query("select a.vec_id as left_id, b.vec_id as right_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as similarity from embeddings a join embeddings b on a.vec_id < b.vec_id where list_cosine_similarity(a.embedding::double[], b.embedding::double[]) >= 0.3", "")
def dense_cosine(spark, sf):
    e = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    return similarity.dense_pairs(e, 0.3).withColumn("similarity", F.round("similarity", 6))


def _aliases(spark, sf) -> DataFrame:
    parts = _t(spark, sf, "part").select(F.lower("p_name").alias("canonical"), F.lower(F.concat("p_name", F.lit(" "), "p_brand")).alias("alias"), F.col("p_partkey").alias("seq"))
    return alias.add(spark.createDataFrame([], "alias string, canonical string"), parts, "lower")


_ALIASES = "with a as (select distinct lower(p_name || ' ' || p_brand) as alias, lower(p_name) as canonical from part)"


@query("select p_partkey as id, coalesce(a.canonical, lower(p_name || ' ' || p_type)) as canonical from (select p_partkey, p_name, p_brand, p_type, case when p_partkey % 2 = 0 then lower(p_name || ' ' || p_brand) else lower(p_name || ' ' || p_type) end as k from part) left join a on a.alias = k", _ALIASES)
def alias_lookup(spark, sf):
    names = _t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit(" "), "p_brand")).otherwise(F.concat("p_name", F.lit(" "), "p_type")).alias("name"))
    return alias.lookup(names, _aliases(spark, sf), "lower").select("id", "canonical")


@query("select count(*) as aliases, count(distinct canonical) as canonicals from a", _ALIASES)
def alias_stats(spark, sf):
    return alias.stats(_aliases(spark, sf))


@query("select canonical, list_sort(list(alias)) as aliases from a group by canonical", _ALIASES)
def aliases_of(spark, sf):
    return alias.aliases_of(_aliases(spark, sf))


@query(", x as (select unnest(list_filter(string_split(alias, ' '), lambda w: length(w) >= 4)) as w, canonical from a union select unnest(list_filter(string_split(canonical, ' '), lambda w: length(w) >= 4)), canonical from a), y as (select p_type as name, unnest(list_filter(string_split(lower(p_name), ' '), lambda w: length(w) >= 4)) as w from part where p_partkey <= 20) select distinct p_name as name, x.canonical from (select distinct p_name, unnest(list_filter(string_split(lower(p_name), ' '), lambda w: length(w) >= 4)) as w from part) join x using (w)", _ALIASES)
def alias_candidates(spark, sf):
    return alias.candidates(_t(spark, sf, "part").select(F.col("p_name").alias("name")).distinct(), _aliases(spark, sf), fold="lower")


@query(", r as (select row_number() over (order by \"left\", \"right\") - 1 as seq, \"left\" as canonical, \"right\" as alias, similarity from w where similarity >= 0.7 and similarity < 0.85) select seq, printf('review-%04d', seq) as item_id, canonical, alias, similarity from r", _NAMES)
def review_queue(spark, sf):
    return alias.queue(borderline_pairs(spark, sf)).drop("context")


# views


@query(", n2 as (select * from n where contains(lower(name), 'an') or contains(lower(entity_type), 'an')) select name as id, name as label, entity_type as type from n2")
def substring_filter(spark, sf):
    return views.substring_filter(_view_nodes(spark, sf), " AN ")


@query("select name as id, name as label, entity_type as type from n where regexp_matches(name, '(?i)^[a-m].*a$') or regexp_matches(entity_type, '(?i)^[a-m].*a$')")
def regex_filter(spark, sf):
    return views.regex_filter(_view_nodes(spark, sf), "^[a-m].*a$")


@query("select name as id, name as label, entity_type as type from n")
def regex_filter_broken(spark, sf):
    return views.regex_filter(_view_nodes(spark, sf), "([")


@query("select name as id, name as label, entity_type as type from n where entity_type not in ('PERSON', 'ORG')")
def type_filter(spark, sf):
    return views.type_filter(_view_nodes(spark, sf), ["PERSON", "ORG"])


@query("select v.* from v where source in (select name from n where entity_type in ('ORG', 'GPE')) and target in (select name from n where entity_type in ('ORG', 'GPE'))", _VIEW)
def induced_subgraph(spark, sf):
    nodes, edges = _view(spark, sf)
    return views.induced(nodes.filter("type in ('ORG', 'GPE')"), edges).drop("inferred")


@query("select v.* from v where not (source in (select name from n where entity_type in ('ORG', 'GPE')) and target in (select name from n where entity_type in ('ORG', 'GPE')))", _VIEW)
def dangling_edges(spark, sf):
    nodes, edges = _view(spark, sf)
    return views.dangling(nodes.filter("type in ('ORG', 'GPE')"), edges).drop("inferred")


@query("select entity_type as type, count(*) as count from n group by entity_type")
def legend_counts(spark, sf):
    return views.legend(_view_nodes(spark, sf))


@query("select n.entity_type as type, count(*) as count from (select case when source = 'NATION_3' then target else source end as id from v where source = 'NATION_3' or target = 'NATION_3') join n on n.name = id group by 1", _VIEW)
def related_types(spark, sf):
    return views.related_types(*_view(spark, sf), "NATION_3")


@query("select source || '-->' || target as id, source, target, string_agg(predicate, ', ' order by seq) as predicate, arg_min(confidence, seq) as confidence from v group by source, target", _VIEW)
def collapse_parallel(spark, sf):
    return views.collapse_parallel(_view_edges(spark, sf))


@query("select source, target, string_agg(predicate, ', ' order by seq) as label from (select source, target, predicate, min(seq) as seq from v group by all) group by source, target", _VIEW)
def distinct_predicate_labels(spark, sf):
    return views.distinct_predicates(_view_edges(spark, sf))


@query("select seq, source, target, (row_number() over (partition by source, target order by seq) - 1)::int as parallel_index, count(*) over (partition by source, target) as parallel_count from v", _VIEW)
def parallel_index(spark, sf):
    return views.parallel_index(_view_edges(spark, sf)).select("seq", "source", "target", "parallel_index", "parallel_count")


@query("select seq, predicate, case when source = 'EUROPE' then 'out' else 'in' end as direction from v where source = 'EUROPE' or target = 'EUROPE'", _VIEW)
def direction_split(spark, sf):
    return views.directions(_view_edges(spark, sf), "EUROPE").select("seq", "predicate", "direction")


@query("select name as id, name as label, entity_type as type from n where contains(lower(name), 'ia') order by label limit 6")
def type_ahead(spark, sf):
    return views.type_ahead(_view_nodes(spark, sf), "IA")


@query("select distinct source || '|' || predicate || '|' || target as key from v", _VIEW)
def edge_keys(spark, sf):
    return views.edge_keys(_view_edges(spark, sf))


@query("select name as id, count(*) as degree from (select source as name from v union all select target from v where source <> target) group by name", _VIEW)
def node_degrees(spark, sf):
    return views.degrees(_view_edges(spark, sf))


@query("select seq, case when confidence is null then predicate else predicate || printf(' (%.2f)', confidence) end as label from v", _VIEW)
def edge_labels(spark, sf):
    return _view_edges(spark, sf).select("seq", views.edge_label(True).alias("label"))


@query("select count(*) as loops, (select count(*) from v where source <> target) as others from v where source = target", _VIEW)
def self_loops(spark, sf):
    loops, others = views.self_loops(_view_edges(spark, sf))
    return loops.agg(F.count("*").alias("loops")).join(others.agg(F.count("*").alias("others")))


@query("select seq, source || ' —' || predicate || '→ ' || target || ' · confidence ' || printf('%.2f', v.confidence) || case when inf then ' · inferred' else '' end as tooltip, case when inf then 1 else 2 end as z_index from v join t using (seq)", _VIEW)
def edge_tooltips(spark, sf):
    return _view_edges(spark, sf).select("seq", views.edge_tooltip().alias("tooltip"), scores.z_index("inferred").alias("z_index"))


@query(", d as (select name, count(*) as degree from (select source as name from v union all select target from v where source <> target) group by name) select n.name as id, coalesce(degree, 0) as degree, 18 + least(coalesce(degree, 0), 20) / 20 * 24 as size, 'legend-' || lower(entity_type) as legend, n.name || ' · ' || entity_type as tooltip, 'node details: ' || n.name as title from n left join d on d.name = n.name", _VIEW)
def node_sizes(spark, sf):
    nodes, edges = _view(spark, sf)
    return views.node_sizes(nodes, edges).select("id", "degree", "size", text.legend_id("type").alias("legend"), views.node_tooltip().alias("tooltip"), text.panel_title("label").alias("title"))


# text

_SENTENCES = r"string_split(regexp_replace(coalesce(text, ''), '([.!?])([ \n\t])', '\1' || chr(1) || '\2', 'g'), chr(1))"


@query(f"select doc_id, (i - 1)::int as place, s[i] as sentence from (select doc_id, list_filter({_SENTENCES}, lambda x: x <> '') as s from documents), unnest(range(1, len(s) + 1)) as u(i)", "")
def sentences(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.posexplode(text.sentences(F.coalesce("text", F.lit("")))).alias("place", "sentence"))


@query("select doc_id, greatest(1, ceil(length(text) / 4))::int as tokens from documents", "")
def token_estimate(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.token_estimate("text").alias("tokens"))


@query(r"select page_id, md5(trim(regexp_replace(regexp_replace(replace(replace(html, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t]+(\n|$)', '\1', 'g'), '\n\n\n+', chr(10) || chr(10), 'g'), chr(10) || chr(9) || ' ')) as digest from pages", "")
def normalized_text(spark, sf):
    return _t(spark, sf, "pages").select("page_id", F.md5(text.normalize_text("html").cast("binary")).alias("digest"))


@query("select doc_id, case when length(text) > 200 then substring(text, 1, 200) || '...[truncated]' else text end as preview from documents", "")
def truncated(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.truncate("text", 200).alias("preview"))


@query("select page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;') as escaped from pages", "")
def xml_escape(spark, sf):
    return _t(spark, sf, "pages").select("page_id", text.escape_xml("html").alias("escaped"))


@query("select p_partkey, case when i > 0 then substring(p_name, 1, i - 1) else p_name end as before, case when i > 0 then substring(p_name, i, 2) else '' end as match, case when i > 0 then substring(p_name, i + 2) else '' end as after from (select p_partkey, p_name, instr(lower(p_name), 'an') as i from part)", "")
def highlights(spark, sf):
    h = text.highlight("p_name", "AN")
    return _t(spark, sf, "part").select("p_partkey", h["before"].alias("before"), h["match"].alias("match"), h["after"].alias("after"))


_STRIP = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160))"
#: Sentences packed into windows, then windows with their overlaps, each by one step for a row; the last row of a chunk has its end.
_CHUNKS = f"""with recursive d as (select doc_id, coalesce(text, '') as t from documents),
p as (select doc_id, list_transform(list_filter({_SENTENCES.replace("coalesce(text, '')", "t")}, lambda x: x <> ''), lambda x: length(x)) as n from d where {_STRIP.format("t")} <> ''),
s as (select doc_id, i, (list_sum(n[1:i]) - n[i])::int as a, list_sum(n[1:i])::int as z from p, unnest(range(1, len(n) + 1)) as u(i)),
w as (select doc_id, i, 0 as win, a, z from s where i = 1 union all select s.doc_id, s.i, case when s.z - w.a > 1200 then w.win + 1 else w.win end, case when s.z - w.a > 1200 then s.a else w.a end, s.z from w join s on s.doc_id = w.doc_id and s.i = w.i + 1),
v as (select doc_id, win, case when win > 0 then greatest(0, min(a) - 120) else min(a) end as a, max(z) as z from w group by doc_id, win),
x as (select v.*, length({_STRIP.format("substring(t, a + 1, z - a)")}) as n from v join d using (doc_id)),
c as (select doc_id, win, win as idx, a, z from x where win = 0 union all select x.doc_id, x.win, case when x.n < 200 then c.idx else x.win end, case when x.n < 200 then c.a else x.a end, x.z from c join x on x.doc_id = c.doc_id and x.win = c.win + 1),
k as (select doc_id, idx, min(a) as a, max(z) as z from c group by doc_id, idx),
chunk as (select doc_id::varchar as doc_id, idx, {_STRIP.format("substring(t, a + 1, z - a)")} as text, a, z from k join d using (doc_id))"""


@query('select doc_id, idx::int as "index", text, a::int as "start", z::int as "end" from chunk', _CHUNKS)
def document_chunks(spark, sf):
    return chunks.chunk(_t(spark, sf, "documents"))


@query("select d.doc_id::varchar as doc_id, count(idx)::int as count, coalesce(min(length(chunk.text)), 0)::int as min, coalesce(sum(length(chunk.text)) // count(idx), 0)::int as mean, coalesce(max(length(chunk.text)), 0)::int as max from d left join chunk on chunk.doc_id = d.doc_id::varchar group by d.doc_id", _CHUNKS)
def chunk_stats(spark, sf):
    return chunks.chunk_stats(_t(spark, sf, "documents"))


@query(', o as (select doc_id, idx, row_number() over (partition by doc_id order by idx) as i, greatest(1, ceil(length(text) / 4))::int as tokens from chunk), b as (select doc_id, idx, i, tokens, 0 as batch, tokens as used from o where i = 1 union all select o.doc_id, o.idx, o.i, o.tokens, case when b.used + o.tokens > 600 then b.batch + 1 else b.batch end, case when b.used + o.tokens > 600 then o.tokens else b.used + o.tokens end from b join o on o.doc_id = b.doc_id and o.i = b.i + 1) select doc_id, idx::int as "index", tokens, batch::int as batch from b', _CHUNKS)
def budget_batches(spark, sf):
    return chunks.budget_batches(chunks.chunk(_t(spark, sf, "documents")), 600)


@query("select sum(length(text)) as chars, round((sum(length(text)) / 4 + 400 * (sum(length(text)) / 4 / 6000 + 1)) / 1000 * 0.00015 + sum(length(text)) / 4 * 0.3 / 1000 * 0.0006, 9) as dollars from documents", "")
def cost_estimate(spark, sf):
    total = _t(spark, sf, "documents").agg(F.sum(F.length("text")).alias("chars"))
    return total.select(F.col("chars").cast("decimal(38,0)").alias("chars"), F.round(scores.extraction_cost("chars"), 9).alias("dollars"))


# extraction


def _answers(spark, sf) -> DataFrame:
    """Answers as a client might give them: prose around an array, items with a name or without."""
    span = F.when(F.col("c_custkey") % 3 == 0, F.struct(F.lit(0).alias("start"), F.length("c_name").alias("end"), F.col("c_name").alias("text")))
    item = F.to_json(F.struct(F.struct(F.col("c_name").alias("name"), F.lit("PERSON").alias("entity_type")).alias("subject"), F.lit("  holds \t an account in ").alias("predicate"), F.struct(F.col("c_mktsegment").alias("name")).alias("object"), F.when(F.col("c_custkey") % 5 == 0, F.lit("0.9")).otherwise((F.col("c_acctbal") / 1000).cast("string")).alias("confidence"), span.alias("source_span")))
    own = _t(spark, sf, "customer").select(F.col("c_custkey").alias("batch_id"), F.array(F.concat(F.lit("customer/"), F.col("c_custkey").cast("string"))).alias("doc_ids"), F.concat(F.lit("Here it is: ["), item, F.lit(", 7, "), item, F.when(F.col("c_custkey") % 7 == 0, F.lit(", oops")).otherwise(F.lit("")), F.lit("] done")).alias("raw"))
    return own


@query("select c_custkey as batch_id, i::int as item, 'customer/' || c_custkey as doc_id, c_name as s, 'holds an account in' as predicate, c_mktsegment as o, 'CONCEPT' as ot, case when c_custkey % 5 = 0 then 0.9 else greatest(0, least(1, c_acctbal / 1000)) end::double as confidence from customer, (values (0), (1)) x(i) where c_custkey % 7 <> 0", "")
def parse_completions(spark, sf):
    got = ex.parse(_answers(spark, sf)).filter("error is null")
    return got.select("batch_id", "item", "doc_id", F.col("subject.name").alias("s"), "predicate", F.col("object.name").alias("o"), F.col("object.entity_type").alias("ot"), "confidence")


@query("select count(*) filter (c >= 0.5 and c_custkey % 3 = 0) as triples, count(*) filter (c < 0.5) as dropped_low_confidence, count(*) filter (c >= 0.5 and c_custkey % 3 <> 0) as dropped_missing_span from (select c_custkey, case when c_custkey % 5 = 0 then 0.9 else greatest(0, least(1, c_acctbal / 1000)) end as c from customer, (values (0), (1)) x(i) where c_custkey % 7 <> 0)", "")
def extraction_counters(spark, sf):
    return ex.counters(ex.parse(_answers(spark, sf)), ExtractionConfig(min_confidence=0.5, require_citations=True))


@query("select c_custkey * 1000000 + i as seq, c_name as s, confidence from (select c_custkey, i, c_name, case when c_custkey % 5 = 0 then 0.9 else greatest(0, least(1, c_acctbal / 1000)) end::double as confidence from customer, (values (0), (1)) x(i) where c_custkey % 7 <> 0 and c_custkey % 3 = 0) where confidence >= 0.5", "")
def citations_required(spark, sf):
    got = ex.triples_of(ex.parse(_answers(spark, sf)), ExtractionConfig(min_confidence=0.5, require_citations=True))
    return got.select("seq", F.col("subject.name").alias("s"), "confidence")


@query("select batch_id, count(*)::int as docs from (select ((row_number() over (order by doc_id) - 1) // 8)::bigint as batch_id from documents) group by batch_id", "")
def extraction_batches(spark, sf):
    docs = _t(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    return ex.batches(docs, 8).select("batch_id", F.size("doc_ids").alias("docs"))


_WORDS = r"with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents), f as (select doc_id, w[1] as subject, w[2] as object from w where len(w) > 1)"


def _corpus(spark, sf) -> DataFrame:
    return _t(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("doc_id"), "text")


@query("select subject, 'comes before' as predicate, object, 0.9::double as confidence, max_by(doc_id, doc_id)::varchar as source_doc_id from f where lower(subject) <> lower(object) group by subject, object", _WORDS)
def ingest(spark, sf):
    """Documents to prompts, answers, triples and a stored graph."""
    got = ex.extract_with_result(_corpus(spark, sf), FirstWords, ExtractionConfig(batch_size=8))
    graph = store.GraphStore(spark, f"{shared_dir(spark)}/lexigraph-ingest-{uuid.uuid4().hex}")
    graph.upsert(got.triples, "lower")
    return graph.edges.drop("inferred")


@query("select (select ceil(count(*) / 8)::bigint from documents) as calls, 0::bigint as retries, count(*) as triples, 0::bigint as dropped_low_confidence, 0::bigint as dropped_missing_span from f", _WORDS)
def ingest_counters(spark, sf):
    return ex.extract_with_result(_corpus(spark, sf), FirstWords, ExtractionConfig(batch_size=8)).stats


@query(", g as (select * from f where lower(subject) <> lower(object)), n as (select subject, object, max(doc_id) as doc from g where doc_id % 10 in (1, 7) group by all), b as (select subject, object, max(doc_id) as doc from g where doc_id % 10 not in (1, 7) group by all) select subject, 'comes before' as predicate, object, doc::varchar as source_doc_id from (select * from n union all select * from b where doc % 10 <> 3 and (subject, object) not in (select (subject, object) from n))", _WORDS)
def ingest_changes(spark, sf):
    """A corpus is loaded, then documents go, come and change. An edge rests on the document that stated it last: it goes with that one, and comes anew with a load."""
    docs = _corpus(spark, sf).withColumn("old", F.col("seq") % 10 == 1)
    before = docs.withColumn("text", F.when(F.col("old"), F.concat(F.lit("zz old "), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))).filter("seq % 10 <> 7")
    now = docs.filter("seq % 10 <> 3")
    graph = store.GraphStore(spark, f"{shared_dir(spark)}/lexigraph-ingest-{uuid.uuid4().hex}")
    triples_of = lambda d: ex.extract(d.select("seq", "doc_id", "text"), FirstWords)
    graph.upsert(triples_of(before), "lower")
    state = lambda d: d.select("doc_id", text.content_hash(F.coalesce("text", F.lit(""))).alias("checksum"), F.lit(0.0).alias("modified_at"))
    into_store(graph, lambda: now, triples_of, "lower")(changes.diff(state(before), state(now)))
    return graph.edges.select("subject", "predicate", "object", "source_doc_id")


# changes

_STATES = "with b as (select doc_id, sha256(text) as c from documents where doc_id % 10 <> 3), a as (select doc_id, sha256(case when doc_id % 10 = 1 then text || '!' else text end) as c from documents where doc_id % 10 <> 7), ev as (select coalesce(a.doc_id, b.doc_id)::varchar as doc_id, case when a.doc_id is null then 'delete' else 'upsert' end as kind, coalesce(a.c, b.c) as checksum from a full join b on a.doc_id = b.doc_id where a.doc_id is null or b.doc_id is null or a.c <> b.c)"


def _events(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents").select(F.col("doc_id").alias("n"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    state = lambda x, t: x.select("doc_id", text.content_hash(t).alias("checksum"), F.lit(0.0).alias("modified_at"))
    now = F.when(F.col("n") % 10 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return changes.diff(state(d.filter("n % 10 <> 3"), F.col("text")), state(d.filter("n % 10 <> 7"), now))


@query("select doc_id, kind, checksum from ev", _STATES)
def cdc_diff(spark, sf):
    return _events(spark, sf).select("doc_id", "kind", "checksum")


@query("select count(*) filter (kind = 'upsert') as upserts, count(*) filter (kind = 'delete') as deletes from ev", _STATES)
def cdc_summary(spark, sf):
    return changes.summary(_events(spark, sf))


# files


def _xml(c: str) -> str:
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&apos;")):
        c = f"replace({c}, '{raw}', '{name}')"
    return c


_DATA = "'      <data key=\"{}\">' || {} || '</data>' || chr(10)"
_GRAPHML = f""", r as (select n.name as source, n.entity_type as st, e.predicate, e.object as target, k.entity_type as tt, e.confidence from n left join e on e.subject = n.name left join n k on k.name = e.object order by 1, 3 nulls first, 4 nulls first limit 500),
h as (select id, max(type) as type from (select source as id, st as type from r union all select target, tt from r where target is not null) group by id),
g as (select *, source || '|' || predicate || '|' || target as id, row_number() over (order by source || '|' || predicate || '|' || target) - 1 as nth from r where predicate is not null)
select 0 as kind, '' as id, '{graphml._HEAD.replace(chr(10), "' || chr(10) || '")}' as line union all select 3, '', '  </graph>' || chr(10) || '</graphml>'
union all select 1, id, '    <node id="' || {_xml("id")} || '">' || chr(10) || {_DATA.format("label", _xml("id"))} || {_DATA.format("type", _xml("type"))} || '    </node>' from h
union all select 2, id, '    <edge id="e' || nth || '" source="' || {_xml("source")} || '" target="' || {_xml("target")} || '">' || chr(10) || {_DATA.format("predicate", _xml("predicate"))} || {_DATA.format("confidence", "rtrim(rtrim(printf('%.15f', confidence), '0'), '.')")} || '    </edge>' from g"""


@query(_GRAPHML)
def graphml_lines(spark, sf):
    rows = reads.graph(_nodes(spark, sf), _edges(spark, sf), 500)
    return graphml.lines(reads.view_nodes(rows), reads.view_edges(rows))


@query("select time_bucket(interval 1 hour, ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all", "")
def event_windows(spark, sf):
    return windows(_t(spark, sf, "events"))
