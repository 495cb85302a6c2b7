"""Harmonic packing of token sequences.

A document's ids are cut into pieces: full sequences first, then, at most max_cuts times, the largest 1/k of the capacity
that fits, then the rest. A piece of length l belongs to class k = the number of such pieces that a sequence holds
(capacity // l); class k's sequences hold exactly k pieces. Workers fill the sequences of a class independently: each
owns a gapless range of the class's piece numbers, known from counts by worker and class, and number // k is the
sequence. The last sequence of each class may be open; open ones, at most one a class, are merged first-fit by a plan
over the table of classes, whose size is fixed by the capacity.

Null texts count as empty: their only id is the closing one. Repeated rows are packed as often as they occur; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, materialize, texts, tidy
from .tokenize import IdBytes, Splitter

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, class int, nth long"


def piece_class(length: int, capacity: int, finest: int) -> int:
    """How many pieces of this length a sequence holds; beyond finest, classes are powers of two."""
    k = capacity // length
    if k > finest:
        k = 1 << (k.bit_length() - 1)
    return k


def cuts(tokens: int, capacity: int, max_cuts: int, smallest: int) -> list[int]:
    """The lengths of a document's pieces."""
    out = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    for _ in range(max_cuts):
        if rest < smallest:
            break
        k = -(-capacity // rest)  # capacity // k <= rest
        one = capacity // k
        out.append(one)
        rest -= one
        if not rest:
            break
    return out + [rest] * (rest > 0)


def pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 2048, max_cuts: int = 2, smallest: int = 64, finest: int = 64, payload: bool = False) -> DataFrame:
    """One row per piece with its class, the worker (partition) that made it and its number in the worker's class; payload adds the ids as bytes."""
    docs = texts(docs)
    schema = _PIECES + ", ids binary" * payload
    kinds = arrow_schema(docs.sparkSession, schema)
    end = end_id.to_bytes(4, "little")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, worker, counts = IdBytes(Splitter(path, lower=False)), TaskContext.get().partitionId(), {}
        for b in batches:
            out = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids, at = cache.of(text) + end, 0
                for n in cuts(len(ids) // 4, capacity, max_cuts, smallest):
                    k = piece_class(n, capacity, finest)
                    nth = counts[k] = counts.get(k, -1) + 1
                    own = ids[4 * at : 4 * (at + n)]
                    out.append((doc, at, n, zlib.crc32(own), len(ids) // 4, worker, k, nth, own)[: len(kinds)])
                    at += n
            cols = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds)], schema=kinds)

    return docs.mapInArrow(run, schema)


def _merge_plan(classes: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """(class, first sequence, its number of full ones, sequence of its open one) for (class, pieces, longest): full sequences first, then open ones by first-fit of their largest possible fill."""
    out, base = {}, 0
    for k, n, _ in sorted(classes):
        out[k] = [k, base, n // k, -1]
        base += n // k
    bins: list[int] = []
    for fill, k in sorted(((n % k * longest, k) for k, n, longest in classes if n % k), reverse=True):
        at = next((i for i, room in enumerate(bins) if room >= fill), len(bins))
        if at == len(bins):
            bins.append(capacity)
        bins[at] -= fill
        out[k][3] = base + at
    return [tuple(x) for x in out.values()]


def pack(docs: DataFrame, path: str, capacity: int = 2048, **how) -> DataFrame:
    """Every piece with its sequence_id and offset there."""
    got = materialize(pieces(docs, path, capacity=capacity, **how), "pieces")
    counts = got.groupBy("class", "worker").agg((F.max("nth") + 1).alias("n"), F.max("length").alias("longest"))
    first = counts.withColumn("first", F.coalesce(F.sum("n").over(Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    classes = [tuple(r) for r in counts.groupBy("class").agg(F.sum("n"), F.max("longest")).collect()]  # at most one row for each class
    plan = got.sparkSession.createDataFrame(_merge_plan(classes, capacity), "class int, base long, full long, open long")
    number = F.col("nth") + F.col("first")
    placed = got.join(first.select("class", "worker", "first"), ["class", "worker"]).join(F.broadcast(plan), "class")
    k = F.col("class").cast("long")
    placed = placed.withColumn("sequence_id", F.when(F.floor(number / k) < F.col("full"), F.col("base") + F.floor(number / k)).otherwise(F.col("open")))
    before = Window.partitionBy("sequence_id").orderBy("class", number).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("worker", "class", "nth", "first", "base", "full", "open")
