"""The operators of this subpackage as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .sharding import shard

    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import digest, find_spans

    return digest(find_spans(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .toxicity import fit, held_out, score

    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vptree import search

    return search(table(spark, sf_dir, "embeddings"))


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import RepeatedStrings

    return RepeatedStrings().digests(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import NearDuplicates

    return NearDuplicates().components(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode

    return encode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), digests=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from . import minhash, pii, suffix, vptree

    return {"op3_pii": pii.oracle(), "op5_vptree": vptree.oracle(), "op6_suffix": suffix.oracle(), "op9_minhash": minhash.oracle()}
