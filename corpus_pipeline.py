"""The training-data pipeline: five stages over documents, each over all that its predecessor kept.

Every stage's result is written in the shared folder and read again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexigraph.llm.common import table
from lexigraph.llm.minhash import NearDuplicates
from lexigraph.llm.packing import pack
from lexigraph.llm.pii import redact
from lexigraph.llm.queries import tokenizer
from lexigraph.llm.suffix import RepeatedStrings
from lexigraph.llm.toxicity import clean, fit
from lexigraph.plans.tables import cut, drop_cut


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.3 or more go.

    Null and empty texts have the score of a text without features; null ids are scored, never trained on; equal rows have
    equal scores and go or stay together; an empty table stays empty; further columns of any name are kept.
    """
    return clean(docs, fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared five-word shingles (similarity 0.8 or more), the one with the smallest doc_id stays.

    Null and empty texts are linked with nothing and stay, rows with a null doc_id stay; rows of one doc_id stay or go
    together, also if they repeat; an empty table stays empty; further columns of any name are kept.
    """
    return NearDuplicates(percent=80).deduplicate(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages of 50 bytes or more that a document with a smaller doc_id has.

    Null texts stay null, and a document may end up with an empty text; rows of one doc_id take nothing from one another;
    rows with a null doc_id neither lose nor take; characters cut in two go wholly; an empty table stays empty; further columns of any
    name are kept.
    """
    return RepeatedStrings().deduplicate(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets.

    Null texts stay null, texts without spans stay as they are; overlapping spans become one, named after the first; equal rows
    stay equal; an empty table stays empty; further columns of any name are kept.
    """
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens.

    Null and empty texts are a piece of one token; null ids are packed too; rows that repeat are packed as often as they occur;
    an empty table gives an empty table; further columns go.
    """
    return pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeats", repeats), ("pii", pii), ("packing", packing)]
#: SQL can express neither the classifier nor the tokenizer; tests/llm/test_pipeline.py holds run() against plain stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; tables of the stages before it are removed as soon as the next one is written."""
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
        if held is not None:
            drop_cut(held)
        held = docs
    return docs
