"""BPE encoding and decoding through a distinct-word table.

Texts are dealt into buckets of about bucket_bytes. Each bucket sends its distinct words, sorted, in slices by word hash
to the word table; there every distinct word is encoded once, and the ids of each slice go back to the bucket, where they
meet the words by position. Each distinct word's ids are decoded there by the id-to-piece table, which has a fixed size and
is held in memory; decode() does the same for whole documents by a join.

A slice for which a bucket has no words gets no message, so messages are as many as buckets times slices at most, and never
more than the buckets' distinct words. A row for each word, bucket and position would need no such product, but such rows took more than
the disk that this operator may use where texts repeat few words (README).

Null texts count as empty and give no ids; repeated rows give repeated rows; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, materialize, release, texts, tidy
from .tokenize import Splitter

_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_IDS = "doc_id long, ids array<int>, decoded string"


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list, list]]:
    """(bucket, ids, texts) of the partition at hand, in buckets of about size bytes."""
    part = TaskContext.get().partitionId()
    n, got, ids, rows = 0, 0, [], []
    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            ids.append(i)
            rows.append(t)
            got += len(t) + 50
            if got >= size:
                yield (part << 24) + n, ids, rows
                n, got, ids, rows = n + 1, 0, [], []
    if rows:
        yield (part << 24) + n, ids, rows


def _slices(split: Splitter, rows: list[str], n: int) -> list[list[str]]:
    """The distinct words of rows, sorted, by word hash."""
    out: list[list[str]] = [[] for _ in range(n)]
    for w in sorted(set().union(*map(split.words, rows))):
        out[zlib.crc32(w.encode()) % n].append(w)
    return out


def _joined(words: list[str]) -> bytes:
    return "\n".join(words).encode()


def encode(docs: DataFrame, path: str, lower: bool = True, bucket_bytes: int = 8 << 20, slice_bytes: int = 48 << 20, digests: bool = False) -> DataFrame:
    """doc_id with ids and the decoded text, or with their digests. path: a BPE vocabulary of the tokenizers library.

    lower: the vocabulary's normaliser is NFC, white space, lower case, and its decoder joins pieces with a space.
    """
    spark, docs = docs.sparkSession, texts(docs)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // slice_bytes))
    blobs, back, dealt = (arrow_schema(spark, s) for s in ("slice int, bucket long, mark long, words binary", "bucket long, slice int, mark long, ids binary", "bucket long, docs binary"))

    @tidy
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(path, lower)
        for bucket, _, rows in _chunks(batches, bucket_bytes):
            raw = {k: _joined(s) for k, s in enumerate(_slices(split, rows, n)) if s}
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((list(raw), [bucket] * len(raw), [zlib.crc32(r) for r in raw.values()], [zlib.compress(r, 3) for r in raw.values()]), blobs)], schema=blobs)

    @tidy
    def encoded(t: pa.Table) -> pa.Table:
        split, ids = Splitter(path, lower), {}
        out: list[bytes] = []
        for blob in t.column("words"):
            flat: list[int] = []
            sizes = []
            for w in zlib.decompress(blob.as_py()).decode().split("\n"):
                if (x := ids.get(w)) is None:
                    x = ids[w] = split.ids(w)
                flat += x
                sizes.append(len(x))
            out.append(zlib.compress(np.array([len(sizes), *sizes, *flat], "<u4").tobytes(), 1))
        return pa.Table.from_arrays([t.column("bucket"), t.column("slice"), t.column("mark"), pa.array(out, pa.binary())], schema=back)

    @tidy
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, ids, rows in _chunks(batches, bucket_bytes):
            blob = zstandard.ZstdCompressor(level=3).compress(json.dumps([ids, rows], ensure_ascii=False).encode())
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([blob], pa.binary())], schema=dealt)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        split = Splitter(path, lower)
        ids_of, rows = [], []
        for blob in left["docs"]:
            some = json.loads(zstandard.ZstdDecompressor().decompress(blob))
            ids_of += some[0]
            rows += some[1]
        word: dict[str, tuple[bytes, str, int]] = {}
        vocab = split.pieces()
        got = {s: (m, i) for s, m, i in zip(right["slice"], right["mark"], right["ids"])}
        for k, words in enumerate(_slices(split, rows, n)):
            mark, blob = got.get(k, (-1, b""))
            if mark == zlib.crc32(_joined(words)) and words:
                x = np.frombuffer(zlib.decompress(blob), "<u4").tolist()
                sizes, flat, at = x[1 : x[0] + 1], x[x[0] + 1 :], 0
                for w, m in zip(words, sizes):
                    word[w] = _forms(flat[at : at + m], vocab)
                    at += m
            else:  # rows of this bucket came in another order than before: encoded here
                for w in words:
                    word[w] = _forms(split.ids(w), vocab)
        out = []
        for i, t in zip(ids_of, rows):
            found = [word[w] for w in split.words(t)]
            text, count = " ".join([f[1] for f in found]), sum([f[2] for f in found])
            ids = " ".join([f[0] for f in found])
            out.append((i, count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()) if digests else (i, [int(x) for x in ids.split()], text))
        del word, got, rows
        release()
        return pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "ids", "decoded"]).astype({"doc_id": "Int64"})

    table = materialize(docs.mapInArrow(distinct, "slice int, bucket long, mark long, words binary").groupBy("slice").applyInArrow(encoded, "bucket long, slice int, mark long, ids binary"), "words")
    return docs.mapInArrow(deal, "bucket long, docs binary").groupBy("bucket").cogroup(table.groupBy("bucket")).applyInPandas(meet, _DIGESTS if digests else _IDS)


def _forms(ids: list[int], vocab: list[str]) -> tuple[str, str, int]:
    return " ".join(map(str, ids)), " ".join([vocab[i] for i in ids]), len(ids)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of (doc_id, ids array<int>): each id meets its piece in the vocabulary's table, which has a fixed number of rows."""
    spark = encoded.sparkSession
    pieces = F.broadcast(spark.createDataFrame(list(enumerate(Splitter(path, True).pieces())), "id int, piece string"))
    rows = encoded.select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids").select("row", "doc_id", F.posexplode_outer("ids").alias("at", "id"))
    got = rows.join(pieces, "id", "left").groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("p"))
    return got.select("doc_id", F.array_join(F.col("p.piece"), " ").alias("text"))
