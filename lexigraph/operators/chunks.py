"""Sentence-aligned chunks of documents, and batches of them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions.text import spans_in, token_estimate
from ..plans.tables import bounded_batches
from ..types import ChunkConfig

_CHUNKS = "array<struct<index:int,text:string,start:int,end:int>>"
_KIND = pa.list_(pa.struct([("index", pa.int32()), ("text", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def windows_of(text: str, max_chars: int) -> list[tuple[int, int]]:
    """Sentences packed into windows of at most max_chars; a longer sentence is a window of its own."""
    out: list[tuple[int, int]] = []
    for s, e in spans_in(text):
        if out and e - out[-1][0] <= max_chars:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def chunks_of(text: str | None, how: ChunkConfig = ChunkConfig()) -> list[dict]:
    """The chunks of one text, in time linear in its length; a blank text has none.

    A window after the first also takes overlap_chars before it; one that is then shorter than min_chunk_chars joins the
    chunk before, so indices may skip.
    """
    out: list[dict] = []
    if not text or not text.strip():
        return out
    for i, (s, e) in enumerate(windows_of(text, how.max_chars)):
        s = max(0, s - how.overlap_chars) if i else s
        own = text[s:e].strip()
        if out and len(own) < how.min_chunk_chars:
            out[-1] |= {"text": text[out[-1]["start"] : e].strip(), "end": e}
        else:
            out.append({"index": i, "text": own, "start": s, "end": e})
    return out


def chunk_array(text: str, how: ChunkConfig = ChunkConfig()) -> Column:
    """The chunks of column text, in Arrow batches: folds in SQL copy their arrays at every step."""

    @F.arrow_udf(_CHUNKS)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([chunks_of(t, how) for t in texts.to_pylist()], _KIND)

    return run(F.col(text))


def chunk(docs: DataFrame, how: ChunkConfig = ChunkConfig(), id_col: str = "doc_id", text_col: str = "text", seq_col: str | None = None) -> DataFrame:
    """(doc_id, index, text, start, end) of all documents; start and end are code points before stripping.

    seq_col: the documents' order. Chunks then have seq, which grows by document and by index: documents keep their order,
    and a document's chunks theirs. A document has at most 2 ** 20 windows.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), *([F.col(seq_col).cast("bigint").alias("s")] if seq_col else []))
    got = own.withColumn("c", F.explode(chunk_array("t", how)))
    seq = [(F.col("s") * (1 << 20) + F.col("c.index")).alias("seq")] if seq_col else []
    return got.select(*seq, "doc_id", "c.index", "c.text", "c.start", "c.end")


def chunk_stats(docs: DataFrame, how: ChunkConfig = ChunkConfig()) -> DataFrame:
    """For each document: count, min, mean (rounded down) and max of its chunks' lengths; zeros without any."""
    bounded_batches(docs.sparkSession)
    n = F.transform(chunk_array("t", how), lambda c: F.length(c["text"]))
    own = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t")).select("doc_id", n.alias("n"))
    total = F.aggregate("n", F.lit(0), lambda a, x: a + x)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    return own.select("doc_id", F.size("n").alias("count"), zero(F.array_min("n")).alias("min"), zero(F.floor(F.try_divide(total, F.size("n")))).alias("mean"), zero(F.array_max("n")).alias("max"))


@F.arrow_udf(ArrayType(IntegerType()))
def _budgeted(tokens: pa.Array, budget: pa.Array) -> pa.Array:
    out = []
    for sizes, most in zip(tokens.to_pylist(), budget.to_pylist()):
        batch, used, own = 0, 0, []
        for n in sizes:
            if used and used + n > most:
                batch, used = batch + 1, 0
            used += n
            own.append(batch)
        out.append(own)
    return pa.array(out, pa.list_(pa.int32()))


def budget_batches(chunks: DataFrame, budget: int, key: str = "doc_id", order: str = "index") -> DataFrame:
    """Each key's chunks in order, in batches of at most budget estimated tokens; a chunk over the budget is alone. Column batch counts from 0.

    A batch depends on all before it, so one key's token counts (not its texts) meet in one row.
    """
    bounded_batches(chunks.sparkSession)
    got = chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, token_estimate("text").alias("tokens")))).alias("rows"))
    placed = got.select(key, F.explode(F.arrays_zip("rows", _budgeted(F.col("rows.tokens"), F.lit(budget)).alias("batch"))).alias("r"))
    return placed.select(key, f"r.rows.{order}", "r.rows.tokens", "r.batch")
