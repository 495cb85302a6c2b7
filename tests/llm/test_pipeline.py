"""run() of the pipeline against a plain version of its stages."""

import random
import zlib

import plain
import pytest


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(40, 90))) + (" you horrid scum" if i % 5 == 0 else "")) for i in range(120)]
    text = dict(rows)
    rows += [(200, text[1]), (201, text[2] + " more"), (202, "fresh words " + " ".join(text[3].split()[:25]) + " then mail a.b@c.org or call +49 (30) 1234-5678")]
    rows += [(203, None), (204, ""), (205, "one two"), (206, "one two"), (207, "long " * 3000), (None, "no id at all in here, not one"), (208, "é" * 100 + " ünder"), (209, "é" * 80)]
    d = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, rows


def test_run_matches_plain_stages(spark, tables):
    tokenizers = pytest.importorskip("tokenizers")
    P = pytest.importorskip("public_tokenizers")
    import corpus_pipeline as cp
    from lexigraph.llm.toxicity import fit, score_text

    d, rows = tables
    model = fit(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    rows = [(i, t) for i, t in rows if score_text(model, t or "") < 0.3]
    assert all(i is None or i % 5 or i >= 120 for i, _ in rows) and len(rows) > 90
    comp = plain.components(rows, 80)
    rows = [(i, t) for i, t in rows if i is None or comp[i] == i]
    assert not {200, 201, 206} & {i for i, _ in rows}
    rows = [(i, b.decode("utf-8", "ignore") if any(gone) else t) for (i, t), (_, b, gone) in zip(rows, plain.without_repeats(rows))]
    rows = [(i, t if t is None else plain.redacted(t)) for i, t in rows]
    assert "[email] or call [phone]" in dict(rows)[202]
    t = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in rows}
    got = cp.run(spark, d).collect()
    assert {x.doc_id for x in got} == set(want)
    for i, ids in want.items():
        own = sorted((x.start, x.length, x.ids_crc32, x.doc_tokens) for x in got if x.doc_id == i)
        at = 0
        for start, n, crc, whole in own:
            assert (start, whole) == (at, len(ids))
            assert crc == zlib.crc32(b"".join(v.to_bytes(4, "little") for v in ids[start : start + n]))
            at += n
        assert at == len(ids)
    fill = {}
    for x in sorted(got, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == fill.get(x.sequence_id, 0)
        fill[x.sequence_id] = x.offset + x.length
    assert max(fill.values()) <= 2048


def test_stages_take_empty_and_odd_tables(spark, tables):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as cp
    from pyspark.sql import functions as F

    d, rows = tables
    docs = spark.read.parquet(f"{d}/documents.parquet").withColumn("spans", F.lit("clash")).withColumn("component_id", F.lit(1))
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), d).count() == 0
        out = stage(spark, docs, d)
        if name != "packing":
            assert out.columns == docs.columns and out.filter("doc_id is null").count() == 1
            kept = {x.doc_id for x in out.collect()}
            assert {203, 204, 205} <= kept
