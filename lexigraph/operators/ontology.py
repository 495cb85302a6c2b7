"""Ontology rules: which (subject type, predicate, object type) may be stated. Predicates match whatever their case, types exactly."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..types import RULE

#: The starter rules.
STARTER = [
    ("PERSON", "founded", "ORG"),
    ("PERSON", "joined", "ORG"),
    ("PERSON", "works at", "ORG"),
    ("ORG", "acquired", "ORG"),
    ("ORG", "is based in", "GPE"),
    ("SOFTWARE", "depends on", "SOFTWARE"),
    ("SOFTWARE", "ships with", "SOFTWARE"),
    ("SOFTWARE", "configures", "SOFTWARE"),
    ("DRUG", "inhibits", "GENE"),
    ("GENE", "mutates in", "DISEASE"),
]


def rules(spark: SparkSession, rows=STARTER) -> DataFrame:
    return spark.createDataFrame(list(rows), RULE)


def _on(rule: DataFrame) -> Column:
    return (F.col("subject.entity_type") == rule["__s"]) & (F.lower("predicate") == rule["__p"]) & (F.col("object.entity_type") == rule["__o"])


def _marked(rule_set: DataFrame) -> DataFrame:
    """Distinct rules to be broadcast: types and predicates are few, so a join by them would put all triples of a rule in one task."""
    return rule_set.select(F.col("subject_type").alias("__s"), F.lower("predicate").alias("__p"), F.col("object_type").alias("__o")).distinct()


def kept(triples: DataFrame, rule_set: DataFrame) -> DataFrame:
    """Triples that a rule allows; without rules all are."""
    own = _marked(rule_set)
    return triples if own.isEmpty() else triples.join(F.broadcast(own), _on(own), "left_semi")


def violations(triples: DataFrame, rule_set: DataFrame) -> DataFrame:
    """The other triples, with a reason."""
    own = _marked(rule_set)
    reason = F.format_string("no ontology rule allows %s -[%s]-> %s", "subject.entity_type", "predicate", "object.entity_type")
    rest = triples.limit(0) if own.isEmpty() else triples.join(F.broadcast(own), _on(own), "left_anti")
    return rest.withColumn("reason", reason)


def reject_lines(bad: DataFrame) -> DataFrame:
    """violations() as lines of a report, in their order."""
    return bad.orderBy("seq").select(F.format_string("REJECT %s -[%s]-> %s: %s", "subject.name", "predicate", "object.name", "reason").alias("line"))


def coverage(triples: DataFrame, rule_set: DataFrame) -> DataFrame:
    """The share of triples that are allowed; 1 without triples."""
    own = _marked(rule_set).withColumn("__hit", F.lit(1.0))
    if own.isEmpty():
        return triples.agg(F.lit(1.0).alias("coverage"))
    return triples.join(F.broadcast(own), _on(own), "left").agg(F.coalesce(F.avg(F.coalesce("__hit", F.lit(0.0))), F.lit(1.0)).alias("coverage"))


def summary(rule_set: DataFrame) -> DataFrame:
    return rule_set.groupBy("subject_type").agg(F.count("*").alias("rules"))


def mine(triples: DataFrame) -> DataFrame:
    """The distinct rules that the triples themselves follow; predicates keep their case."""
    return triples.select(F.col("subject.entity_type").alias("subject_type"), "predicate", F.col("object.entity_type").alias("object_type")).distinct()


def merge(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("subject_type", "predicate", "object_type").unionByName(right.select("subject_type", "predicate", "object_type")).distinct()


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("subject_type", "predicate", "object_type").subtract(right.select("subject_type", "predicate", "object_type"))


def parse_rule(shorthand: str) -> tuple[str, str, str]:
    """(type, predicate, type) of "TYPE predicate words TYPE"."""
    words = shorthand.split()
    if len(words) < 3:
        raise ValueError(f"a rule needs a type, a predicate and a type: {shorthand!r}")
    return words[0], " ".join(words[1:-1]), words[-1]


def load(spark: SparkSession, path: str) -> DataFrame:
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, list):
        raise ValueError(f"{path} must hold a JSON array")
    return rules(spark, [(r["subject_type"], r["predicate"], r["object_type"]) for r in data])


def save(rule_set: DataFrame, path: str) -> None:
    """A JSON array in the order of all three columns. Rule sets are small: written by hand or mined from types and predicates."""
    rows = [r.asDict() for r in rule_set.distinct().orderBy("subject_type", "predicate", "object_type").collect()]
    Path(path).write_text(json.dumps(rows, indent=2, ensure_ascii=False), encoding="utf-8")
