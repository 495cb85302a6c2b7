"""Queries do their whole job: no row, pair or kind is left out."""

import random

import pytest
from pyspark.sql import functions as F

from lexigraph import queries
from lexigraph.plans import fixture


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Small tables in which three rows of lineitem share a key and two of them are equal."""
    at = str(tmp_path_factory.mktemp("tables"))
    line = [(7, 1, 1, 1, 10.0, 0.1), (7, 2, 2, 1, 5.0, 0.2), (7, 2, 2, 1, 5.0, 0.2), (8, 1, 1, 2, 20.0, 0.3)]
    tables = {
        "region": ([(0, "EUROPE"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "FRANCE", 0), (1, "JAPAN", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(1, "Supplier#1", 0), (2, "Supplier#2", 1)], "s_suppkey long, s_name string, s_nationkey int"),
        "customer": ([(1, "Customer#1", 0), (2, "Customer#2", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(1, "azure linen lace"), (2, "azure linen laces")], "p_partkey long, p_name string"),
        "orders": ([(7, 1), (8, 2)], "o_orderkey long, o_custkey long"),
        "lineitem": (line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def test_every_row_of_lineitem_is_a_fact(spark, sf):
    got = fixture.triples(spark, sf).select("seq", F.col("subject.name").alias("s"), "predicate", F.col("object.name").alias("o"), "confidence").collect()
    assert len({x.seq for x in got}) == len(got) == 2 + 2 + 2 + 2 * 4 + 2 + 2 + 1  # the last: loops, second spellings, a guess
    assert max(x.seq for x in got) < 1 << 62  # twice a seq is a mention
    of = lambda p: sorted((x.s, x.o, round(x.confidence, 6)) for x in got if x.predicate == p)
    assert of("supplies") == [("Supplier#1", "azure linen lace", 0.2), ("Supplier#1", "azure linen lace", 0.4)] + 2 * [("Supplier#2", "azure linen laces", 0.1)]
    assert of("ordered") == [("Customer#1", "azure linen lace", 0.9)] + 2 * [("Customer#1", "azure linen laces", 0.8)] + [("Customer#2", "azure linen lace", 0.7)]


def test_dense_cosine_gives_all_pairs_over_its_floor(spark, tmp_path):
    from lexigraph.operators.similarity import dense_pairs

    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) for _ in range(4 + i % 2)], i % 3) for i in range(1, 60)] + [(60, [0.0] * 4, 0), (61, [], 0), (62, None, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    e = [(x.vec_id, x.embedding) for x in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect() if x.embedding and any(x.embedding)]
    norm = lambda v: sum(x * x for x in v) ** 0.5
    want = {(i, j): sum(map(float.__mul__, a, b)) / norm(a) / norm(b) for i, a in e for j, b in e if i < j and len(a) == len(b)}
    want = {k: round(s, 6) for k, s in want.items() if s >= 0.3}
    got = queries.dense_cosine(spark, str(tmp_path)).collect()
    assert {(x.left_id, x.right_id): x.similarity for x in got} == pytest.approx(want, abs=2e-6) and len(got) == len(want) > 100
    blocks = dense_pairs(spark.createDataFrame([(i, list(v)) for i, v in e], "id long, v array<double>"), 0.3, block_rows=9).collect()
    assert sorted((x.left_id, x.right_id) for x in blocks) == sorted(want)


def test_rewrite_and_labels_cover_every_fact(spark, sf):
    facts = fixture.triples(spark, sf).select("seq", "predicate", F.lower("subject.name").alias("s"), F.lower("object.name").alias("o"), "confidence").collect()
    got = {x.seq: x for x in queries.rewrite_triples(spark, sf).collect()}
    assert len(got) == len(facts) == 19
    for x in facts:  # the two part names are similar, and the shorter one is canonical
        assert (got[x.seq].s, got[x.seq].predicate, got[x.seq].o) == (x.s, x.predicate, x.o.replace("laces", "lace"))
    labels = {x.seq: x.label for x in queries.edge_labels(spark, sf).collect()}
    assert labels == {x.seq: f"{x.predicate} ({x.confidence:.2f})" for x in facts}


def test_components_cover_the_whole_graph(spark, sf):
    facts = fixture.triples(spark, sf).select(F.lower("subject.name").alias("s"), F.lower("object.name").alias("o")).collect()
    comp = {n: n for x in facts for n in (x.s, x.o)}
    for _ in comp:
        for x in facts:
            comp[x.s] = comp[x.o] = min(comp[x.s], comp[x.o])
    got = {x.name: x.component for x in queries.components(spark, sf).collect()}
    assert got == comp and {"customer#1", "azure linen lace"} < set(got)
    report = queries.component_report(spark, sf).first()
    sizes = [list(comp.values()).count(c) for c in set(comp.values())]
    assert (report.components, report.entities, report.largest) == (len(sizes), len(comp), max(sizes))
