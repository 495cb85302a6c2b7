"""What bounds work on large tables: each test failed before the change that it holds."""

import itertools
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexigraph import queries
from lexigraph.functions.text import norm_key, same_key
from lexigraph.operators import bridges, chunks, extraction, ontology, resolution, triples, views
from lexigraph.plans import fixture, reads, store, tables
from lexigraph.sources.completions import FirstWords
from lexigraph.types import TRIPLE
from test_whole import sf  # noqa: F401


def facts(spark, rows):
    return spark.createDataFrame([(seq, (s, st), p, (o, ot), 0.5, d, None, False) for seq, s, st, p, o, ot, d in rows], TRIPLE)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def folders(spark, name):
    return {n for n in os.listdir(tables.shared_dir(spark).removeprefix("file:")) if n.startswith(f"lexigraph-{name}-")}


def test_queries_of_facts_load_no_store(spark, sf):  # noqa: F811
    for q in (queries.merge_inferred, queries.ontology_summary, queries.distinct_predicate_labels, queries.components, queries.edge_keys):
        q(spark, sf).collect()
    assert (spark.sparkContext.applicationId, sf) not in fixture._LOADED


def test_fixture_reads_lineitem_once(spark, sf):  # noqa: F811
    got = fixture.triples(spark, sf)
    assert plan(got).count("Window [") == 1
    assert sorted(got.columns) == sorted(c.split()[0] for c in "seq subject predicate object confidence source_doc_id source_span inferred".split())


def test_keys_that_repeat_on_one_side_leave_the_other_alone(spark, tmp_path):
    small = {
        "region": ([(0, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": ([(0, "FRANCE", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(1, "S", 0), (1, "T", 0), (2, None, 0)], "s_suppkey long, s_name string, s_nationkey int"),
        "customer": ([(1, "C", 0)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(1, "p")], "p_partkey long, p_name string"),
        "orders": ([(7, 1)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(7, 1, 1, 1, 10.0, 0.1), (7, 1, 2, 2, 10.0, 0.1), (9, 1, 1, 1, 10.0, 0.1)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double"),
    }
    for name, (rows, schema) in small.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = [(x.subject.name, x.predicate, x.source_doc_id) for x in fixture.triples(spark, str(tmp_path)).filter("predicate in ('supplies', 'ordered')").collect()]
    want = [("S", "supplies", "order/7"), ("T", "supplies", "order/7"), (None, "supplies", "order/7"), ("S", "supplies", "order/9"), ("T", "supplies", "order/9"), ("C", "ordered", "order/7"), ("C", "ordered", "order/7")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_written_table_is_not_written_again(spark, tmp_path):
    own = facts(spark, [(0, "a", "X", "is", "b", "Y", "d"), (1, "b", "Z", "is", "B ", "Y", "e")])
    before = folders(spark, "load")
    g = store.GraphStore(spark, str(tmp_path / "g"))
    got = g.upsert(own, written=True)
    assert (got.nodes, got.relationships, got.skipped_self_loops) == (3, 1, 1) and folders(spark, "load") == before
    again = g.upsert(own)
    assert (again.nodes, again.relationships, again.skipped_self_loops) == (3, 1, 1) and g.nodes.count() == 3 and g.edges.count() == 1


def test_nodes_and_edges_compare_places_before_texts(spark, monkeypatch):
    rows = [(5, "a", "X", "is", "b", "Y", "d5"), (3, "b", "Z", "is", "c", "Y", "d3"), (3, "q", "Q", "is", "b", "R", "d3"), (-7, "a", "W", "is", "b", "V", "d-7"), (9, "a", "U", "is", "b", "T", "d9"), (None, "n", "N", "is", "a", "M", "d0")]
    own = facts(spark, rows)
    for few in (triples.FEW, 0):  # by broadcast, and dealt by places
        monkeypatch.setattr(triples, "FEW", few)
        nodes, edges = triples.node_rows(own), triples.edge_rows(own)
        assert "LeftSemi" in plan(nodes) and ("LeftSemi" in plan(edges)) == (few > 0)
        assert {(x.name, x.entity_type, x.last_seen_doc) for x in nodes.collect()} == {("a", "W", "d-7"), ("b", "V", "d-7"), ("c", "Y", "d3"), ("q", "Q", "d3"), ("n", None, None)}
        assert {(x.subject, x.object): x.source_doc_id for x in edges.collect()} == {("a", "b"): "d9", ("b", "c"): "d3", ("q", "b"): "d3", ("n", "a"): None}


def test_types_by_name_compare_numbers(spark):
    own = facts(spark, [(0, "A", "X", "is", "b", "Y", "d"), (1, "a ", "Z", "is", "B", "Y", "d"), (2, "b", "W", "is", "c", "V", "d")])
    got = triples.entity_types(own)
    assert {(x.name, x.entity_type) for x in got.collect()} == {("a", "Z"), ("b", "W"), ("c", "V")} and "max(mention" in plan(got)


def test_same_key(spark):
    names = ["", " ", "a", "A", " a", "a  b", "A B", "a\u00a0b", "ab", "ß", "ss", "sS", "K", "\u212a", "I", "i", "\u0130", "x\ty", "x y", "a\n", "~", "!", None]
    df = spark.createDataFrame(list(itertools.product(names, names)), "a string, b string")
    for fold in ("lower", "casefold"):
        assert df.filter(~same_key("a", "b", fold).eqNullSafe(norm_key("a", fold) == norm_key("b", fold))).collect() == []


def test_rules_do_not_deal_triples_by_type(spark):
    own = facts(spark, [(i, "a", "X", "is", "b", "Y", "d") for i in range(9)])
    rule_set = ontology.rules(spark, [("X", "IS", "Y")])
    for df in (ontology.kept(own, rule_set), ontology.violations(own, rule_set), ontology.coverage(own, rule_set)):
        assert "BroadcastHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)
    assert ontology.kept(own, rule_set).count() == 9 and ontology.violations(own, rule_set).count() == 0


def test_rewriting_folds_names_not_triples(spark):
    own = facts(spark, [(0, "Straße", "X", "is", "b", "Y", "d"), (1, " B", "X", "is", None, "Y", "d")])
    got = resolution.rewrite(own, spark.createDataFrame([("strasse", "road")], "name string, canonical string"))
    assert "Python" not in plan(got)
    assert {(x.seq, x.subject.name, x.object.name, x.object.entity_type) for x in got.collect()} == {(0, "road", "b", "Y"), (1, "b", None, "Y")}


def test_collapse_counts_edges_of_one_predicate(spark):
    rows = [(3, "a", "b", "x", 0.3), (1, "a", "b", "x", 0.1), (2, "a", "b", "y", 0.2), (4, "a", "c", "x", None), (5, "a", "c", "x", 0.5), (6, None, "c", "z", 0.6), (7, None, "c", "w", 0.7), (8, "c", None, None, 0.8), (9, "c", "d", None, 0.1), (10, "c", "d", "v", 0.2)]
    got = views.collapse_parallel(spark.createDataFrame(rows, "seq long, source string, target string, predicate string, confidence double"))
    assert {(x.source, x.target, x.predicate, x.confidence) for x in got.collect()} == {("a", "b", "x, y, x", 0.1), ("a", "c", "x, x", None), (None, "c", "z, w", 0.6), ("c", None, "", 0.8), ("c", "d", "v", 0.1)}
    assert got.filter("source = 'a' and target = 'b'").first().id == "a-->b"


def test_paths_of_many_pairs_are_those_of_each(spark):
    links = [("a", "b", False), ("b", "c", True), ("c", "d", True), ("a", "e", True), ("e", "c", True), ("d", "d", False), ("x", "y", False)]
    e = spark.createDataFrame([(s, "is", o, 0.5, "d", i) for s, o, i in links], "subject string, predicate string, object string, confidence double, source_doc_id string, inferred boolean")
    near = {}
    for s, o, i in links:
        near.setdefault(s, {})[o] = near.setdefault(o, {})[s] = i
    pairs = [("a", "d"), ("a", "c"), ("d", "d"), ("z", "z"), ("a", "x"), ("b", "e"), ("a", "d")]
    want = []
    for s, t in pairs:
        every = [[s]] if s in near else []
        for _ in range(4):
            hit = sorted(p for p in every if p[-1] == t)[:3]
            if hit:
                want += [(s, t, len(p) - 1, p, len(p) > 1 and all(near[u][v] for u, v in zip(p, p[1:]))) for p in hit]
                break
            every = [[*p, n] for p in every for n in near[p[-1]] if n not in p]
    assert [tuple(x) for x in reads.shortest_paths_of(e, pairs).collect()] == want and len(want) > 6


@pytest.mark.parametrize("what", ["chunks", "stats", "answers", "items"])
def test_batches_to_python_are_bounded_by_bytes(spark, what):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    docs = spark.createDataFrame([(i, str(i), "some words. " * 9) for i in range(20)], "seq long, doc_id string, text string")
    if what == "answers":
        got = extraction.extract(docs, FirstWords)
    elif what == "items":
        got = extraction.parse(docs.select(F.col("seq").alias("batch_id"), F.array("doc_id").alias("doc_ids"), F.lit("[]").alias("raw")))
    else:
        got = chunks.chunk(docs) if what == "chunks" else chunks.chunk_stats(docs)
    assert int(spark.conf.get(name)) <= tables.BATCH_BYTES
    got.collect()


def test_components_fold_links_not_facts(spark):
    before = folders(spark, "links")
    own = facts(spark, [(i, s, "X", "is", o, "Y", "d") for i, (s, o) in enumerate([("a", "B"), ("A", "b"), ("b ", "c"), ("d", "D")] * 5)])
    assert {(x.name, x.component) for x in bridges.entity_components(own).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d")}
    new = folders(spark, "links") - before
    assert [spark.read.parquet(f"{tables.shared_dir(spark)}/{n}").count() for n in new] == [3]
    assert pd.DataFrame(bridges.component_report(own).collect()).values.tolist() == [[2, 4, 3]]
