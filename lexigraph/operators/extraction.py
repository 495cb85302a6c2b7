"""Completions to triples: the JSON array in an answer, its items, their checks and filters."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import bounded_batches, cut
from ..sources.completions import completions
from ..sources.prompts import PromptConfig, prompt
from ..types import CONCEPT, ENTITY, SPAN, ExtractionConfig
from .chunks import budget_batches
from .triples import fixed_batches

_ITEMS = f"batch_id bigint, doc_id string, item int, subject {ENTITY}, predicate string, object {ENTITY}, confidence double, source_span {SPAN}, inferred boolean, error string"
_MOST = 2**31 - 1
_TRUE, _FALSE = {"1", "true", "t", "yes", "y", "on"}, {"0", "false", "f", "no", "n", "off"}


class _Bad(ValueError):
    pass


def _text(v) -> str:
    if not isinstance(v, str):
        raise _Bad("a string is needed")
    try:
        v.encode()
    except UnicodeEncodeError:  # half a surrogate pair, which JSON can spell
        raise _Bad("a string is no text") from None
    return v


def _whole(v) -> int:
    if isinstance(v, (bool, int)):
        return int(v)
    if isinstance(v, float) and v.is_integer():
        return int(v)
    if isinstance(v, str):
        try:
            return _whole(float(v)) if not v.strip().lstrip("+-").isdigit() else int(v)
        except (ValueError, OverflowError):
            pass
    raise _Bad("a whole number is needed")


def _truth(v) -> bool:
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) and v in (0, 1):
        return bool(v)
    if isinstance(v, str) and v.lower() in _TRUE | _FALSE:
        return v.lower() in _TRUE
    raise _Bad("a boolean is needed")


def _entity(v) -> dict:
    if not isinstance(v, dict):
        raise _Bad("an entity is needed")
    got = {"name": _text(v.get("name")).strip(), "entity_type": _text(v["entity_type"]).strip() if "entity_type" in v else CONCEPT}
    if not all(got.values()):
        raise _Bad("an entity is blank")
    return got


def _span(v) -> dict | None:
    if v is None:
        return None
    if not isinstance(v, dict):
        raise _Bad("a span is needed")
    got = {"start": _whole(v.get("start")), "end": _whole(v.get("end")), "text": _text(v.get("text"))}
    if got["start"] < 0 or got["end"] <= got["start"] or not got["text"]:
        raise _Bad("a span is empty")
    if got["end"] > _MOST:
        raise _Bad("a span ends beyond any text")
    return got


def check_item(item: dict, lenient: bool = True) -> dict:
    """The item's fields as a triple has them, or an error. lenient: a confidence that is there is read as a number and clamped; otherwise it must be a number from 0 to 1."""
    confidence = item.get("confidence", 1.0)
    if lenient and "confidence" in item:
        try:
            confidence = float(confidence)
        except (TypeError, ValueError, OverflowError):
            raise _Bad("confidence is no number") from None
        confidence = 1.0 if math.isnan(confidence) else max(0.0, min(1.0, confidence))
    try:
        confidence = float(confidence) if isinstance(confidence, (int, float, str)) else _text(None)
    except (ValueError, OverflowError):
        raise _Bad("confidence is no number") from None
    if not 0 <= confidence <= 1:
        raise _Bad("confidence is out of range")
    predicate = " ".join(_text(item.get("predicate")).split())
    if not predicate:
        raise _Bad("the predicate is blank")
    return {"subject": _entity(item.get("subject")), "predicate": predicate, "object": _entity(item.get("object")), "confidence": confidence, "source_span": _span(item.get("source_span")), "inferred": _truth(item.get("inferred", False))}


def items_of(raw: str) -> list[dict]:
    """The objects of the array between the first [ and the last ]; nothing if that is no JSON."""
    a, b = raw.find("["), raw.rfind("]")
    try:
        data = json.loads(raw[a : b + 1]) if 0 <= a < b else []
    except (ValueError, RecursionError):  # no JSON, or nested deeper than anything that can be a triple
        return []
    return [x for x in data if isinstance(x, dict)]


def shared_out(items: list[dict], docs: list[str]) -> list[tuple[str, dict]]:
    """Which document of a batch each item belongs to: the one that it names; if no item names any, all belong to the first. Items of other names are dropped; a document that is there twice gets its items twice."""
    if not any("doc_id" in x for x in items):
        return [(docs[0], x) for x in items] if docs else []
    return [(d, x) for d in docs for x in items if x.get("doc_id") == d]


def parse(answers: DataFrame, lenient: bool = True) -> DataFrame:
    """Items of answers (batch_id, doc_ids, raw), good ones and, with error set, others: (batch_id, doc_id, item, fields of a triple, error).

    Checks follow JSON and number rules that from_json doesn't have (numbers in strings, NaN, missing against null), so
    they run in Python, over batches.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["subject", "predicate", "object", "confidence", "source_span", "inferred"]
        for f in frames:
            out = []
            for batch, docs, raw in zip(f["batch_id"], f["doc_ids"], f["raw"]):
                for n, (doc, item) in enumerate(shared_out(items_of(raw or ""), list(docs))):
                    try:
                        got, error = check_item(item, lenient), None
                    except _Bad as e:
                        got, error = {}, f"item {n}: {e}"
                    except RecursionError:
                        got, error = {}, f"item {n}: it is nested too deeply"
                    out.append((batch, doc, n, *(got.get(k) for k in names), error))
            yield pd.DataFrame(out, columns=["batch_id", "doc_id", "item", *names, "error"])

    bounded_batches(answers.sparkSession)
    return answers.select("batch_id", "doc_ids", "raw").mapInPandas(run, _ITEMS)


def strict(items: DataFrame) -> DataFrame:
    """items, or a ValueError that shows the first three errors."""
    errors = [r[0] for r in items.filter("error is not null").orderBy("batch_id", "item").select("error").limit(3).collect()]
    if errors:
        raise ValueError("; ".join(errors))
    return items


def triples_of(items: DataFrame, how: ExtractionConfig = ExtractionConfig()) -> DataFrame:
    """Triples of good items over the confidence floor and, if asked for, with a span."""
    ok = items.filter("error is null").filter(F.col("confidence") >= how.min_confidence)
    if how.require_citations:
        ok = ok.filter("source_span is not null")
    seq = (F.col("batch_id") * 1_000_000 + F.col("item")).alias("seq")
    return ok.select(seq, "subject", "predicate", "object", "confidence", F.col("doc_id").alias("source_doc_id"), "source_span", "inferred")


def counters(items: DataFrame, how: ExtractionConfig = ExtractionConfig()) -> DataFrame:
    """One row: triples, dropped_low_confidence, dropped_missing_span. A row that fails both counts as low."""
    good = F.col("error").isNull()
    low = good & (F.col("confidence") < how.min_confidence)
    bare = good & ~low & F.col("source_span").isNull() & F.lit(how.require_citations)
    return items.agg(F.count_if(good & ~low & ~bare).alias("triples"), F.count_if(low).alias("dropped_low_confidence"), F.count_if(bare).alias("dropped_missing_span"))


def merge_counters(*some: DataFrame) -> DataFrame:
    """One row: the sums of counters, field by field; a field that one lacks counts as 0 there."""
    names = list(dict.fromkeys(c for t in some for c in t.columns))
    every = some[0]
    for t in some[1:]:
        every = every.unionByName(t, allowMissingColumns=True)
    return every.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names])


def batches(docs: DataFrame, size: int, budget: int | None = None) -> DataFrame:
    """(batch_id, doc_ids, text): documents (seq, doc_id, text) in the order of seq, in groups of size with numbered sections.

    Places, not seq, make the groups, so gaps in seq leave none short. budget: a group whose estimated tokens exceed it is
    cut further, in order; a text over it is alone. Null texts count as empty.
    """
    placed = fixed_batches(docs.select("seq", "doc_id", F.coalesce("text", F.lit("")).alias("text")), size).withColumnRenamed("batch", "batch_id")
    part = []
    if budget is not None:
        cut_in = budget_batches(placed, budget, "batch_id", "seq").select("batch_id", "seq", F.col("batch").alias("part"))
        placed, part = placed.join(cut_in, ["batch_id", "seq"]), ["part"]
    rows = placed.groupBy("batch_id", *part).agg(F.array_sort(F.collect_list(F.struct("seq", "doc_id", "text"))).alias("d"))  # size rows in each
    section = F.transform("d", lambda x, i: F.concat(F.lit("Document "), (i + 1).cast("string"), F.lit(" (doc_id "), x["doc_id"], F.lit("):\n"), x["text"]))
    number = F.col("batch_id") * size + F.col("part") if part else F.col("batch_id")
    return rows.select(number.alias("batch_id"), F.col("d.doc_id").alias("doc_ids"), F.array_join(section, "\n\n").alias("text"))


@dataclass(frozen=True)
class Extraction:
    """Triples, and one row of counters: calls, retries, triples, dropped_low_confidence, dropped_missing_span."""

    triples: DataFrame
    stats: DataFrame


def _asked(groups: DataFrame, client, how: ExtractionConfig, prompts: PromptConfig) -> Extraction:
    answers = completions(groups.withColumn("prompt", prompt("text", prompts)).select("batch_id", "doc_ids", "prompt"), client, how.max_retries)
    items = cut(parse(answers), "items")
    calls = answers.agg(F.count("*").alias("calls"), F.coalesce(F.sum("retries"), F.lit(0)).alias("retries"))
    return Extraction(triples_of(items, how), merge_counters(calls, counters(items, how)))


def extract_with_result(docs: DataFrame, client, how: ExtractionConfig = ExtractionConfig(), prompts: PromptConfig = PromptConfig(), by_tokens: bool = False) -> Extraction:
    """Documents (seq, doc_id, text) by a client factory, batch_size documents a call; by_tokens: batch_token_budget bounds a call too."""
    return _asked(batches(docs, how.batch_size, how.batch_token_budget if by_tokens else None), client, how, prompts)


def extract(docs: DataFrame, client, how: ExtractionConfig = ExtractionConfig(), prompts: PromptConfig = PromptConfig()) -> DataFrame:
    """The triples of extract_with_result."""
    return extract_with_result(docs, client, how, prompts).triples


def extract_text(docs: DataFrame, client, how: ExtractionConfig = ExtractionConfig(), prompts: PromptConfig = PromptConfig()) -> Extraction:
    """One completion for each document (seq, doc_id, text), whose text stands in the prompt as it is."""
    own = docs.select(F.col("seq").alias("batch_id"), F.array("doc_id").alias("doc_ids"), F.coalesce("text", F.lit("")).alias("text"))
    return _asked(own, client, how, prompts)


def extract_chunks(chunks: DataFrame, client, how: ExtractionConfig = ExtractionConfig(), prompts: PromptConfig = PromptConfig()) -> Extraction:
    """Chunks (seq, doc_id, text): a call for each if there are no more than batch_size, else calls of batch_size chunks, cut further at batch_token_budget tokens."""
    few = chunks.limit(how.batch_size + 1).count() <= how.batch_size
    return extract_text(chunks, client, how, prompts) if few else extract_with_result(chunks, client, how, prompts, by_tokens=True)


def describe(how: ExtractionConfig) -> str:
    return f"batch_size={how.batch_size} batch_token_budget={how.batch_token_budget} min_confidence={how.min_confidence} require_citations={how.require_citations} max_retries={how.max_retries}"


def stats_line(stats: DataFrame) -> DataFrame:
    """Counters as one line of a log."""
    names = stats.columns
    return stats.select(F.format_string(" ".join(f"{n}=%s" for n in names), *[F.col(n).cast("string") for n in names]).alias("line"))
