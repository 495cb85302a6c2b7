"""Removal of long repeated byte strings by a column-wise built collection of strings.

A byte goes when a `length`-byte string that covers it also starts in a document with a smaller doc_id. Three facts keep
the work small and spread:

* Every `length`-byte window holds a k-gram of least hash (the leftmost of equals), and equal windows hold the same one at
  the same offset. Runs of windows with one such k-gram form one string of at most 80 bytes, and two windows can only be equal if
  their strings have the same k-gram. Texts are held in chunks; each chunk sends the hashes of its k-grams, sorted and
  compressed, to slices by hash, and hears which of them other documents have too. The rest of the text goes no further.
* The strings with shared k-grams go, by k-gram, to slices of bounded size. There each slice builds its collection column by column:
  strings are aligned at their k-grams, and each round puts one more symbol before every string's suffix. The order of the
  longer suffixes is the stable sort of the last round's order by the inserted symbols (the round's Burrows-Wheeler
  column), and the common prefix of neighbours is one more than the least common prefix between their places in the
  last round. Columns lie in a sequential scratch file, one read for each round, so memory holds one column, the order
  and the common prefixes. As equal windows are equally far from their k-gram, only suffixes of one length need an order;
  rows of older columns are dropped. From round `length` on, neighbours whose common prefix is `length` or more are equal windows, and
  all but those of the group's smallest document are marked.
* k-grams of more than `hot` documents are subdivided: their windows become strings of their own, dealt by the hash of the
  whole window. Equal strings of a chunk are sent once.

The scratch file has no name, lives within one task and is built again if the task is lost; all else is in tables.

Defined results: matches never cross documents, and rows of one doc_id don't remove one another; null texts are empty; rows
with a null doc_id neither lose nor remove bytes; of two equal texts the one with the larger doc_id loses everything
(if it has `length` bytes); an empty table gives an empty table; other columns are ignored by digests and kept by deduplicate.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import drop_cut
from .common import arrow_schema, bounded_batches, materialize, tidy
from .shingle import buffers, mix, prefix_sums, span_hash

_U = np.uint64
_FP = 48  # bits of a k-gram's hash that are sent
_BLOCK = 1 << 19
_NONE = np.iinfo(np.int64).max
_CHUNK, _ANSWER = "bucket long, rows binary", "bucket long, kind int, slice long, data binary"


def _press(a: np.ndarray, width: int) -> bytes:
    """Unsigned numbers below 256 ** width, by byte planes."""
    planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return planes.tobytes()


def _unpress(raw: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T
    return out.view("<u8").ravel()


def _zip(raw: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(raw)


_unzip = lambda raw: zstandard.ZstdDecompressor().decompress(raw)


class Strings:
    """The strings of a chunk: for each the k-gram's place, its first and last window and its document."""

    def __init__(self, column: pa.Array, ids: pa.Array, length: int, k: int):
        at, data = buffers(column)
        self.data, self.at, self.length, self.k = data[at[0] : at[-1]], at - at[0], length, k
        self.ids = ids.fill_null(_NONE).to_numpy()
        parts = [self._block(s, e) for s, e in self._blocks()]
        self.place, self.first, self.last, self.gram = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t) for i, t in enumerate((np.int64, np.int64, np.int64, _U)))
        self.doc = np.searchsorted(self.at, self.first, "right") - 1
        known = self.ids[self.doc] != _NONE
        self.place, self.first, self.last, self.gram, self.doc = (x[known] for x in (self.place, self.first, self.last, self.gram, self.doc))

    def _blocks(self) -> Iterator[tuple[int, int]]:
        """Ranges of window starts."""
        for s in range(0, max(0, len(self.data) - self.length + 1), _BLOCK):
            yield s, min(s + _BLOCK, len(self.data) - self.length + 1)

    def _block(self, s: int, e: int) -> tuple[np.ndarray, ...]:
        k, length = self.k, self.length
        data = self.data[s : e + length - 1]
        p = prefix_sums(data)
        grams = np.arange(len(data) - k + 1)
        h = span_hash(p, grams, grams + k)
        bits = _U(20)  # of a place in the block; block and overlap are smaller
        key = ((h >> bits) << bits) | grams.astype(_U)
        span, least = length - k + 1, key
        step = 1
        while 2 * step <= span:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < span:
            least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
        place = (least & _U((1 << 20) - 1)).astype(np.int64)
        start = np.arange(s, e)
        doc = np.searchsorted(self.at, start, "right") - 1
        ok = start + length <= self.at[doc + 1]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | ~ok[:-1]
        first = np.flatnonzero(new & ok)
        ends = np.flatnonzero(np.append(new[1:] | ~ok[1:], True) & ok)
        return place[first] + s, first + s, ends + s, h[place[first]]

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct fingerprints, sorted, how many documents have each, and which one each string has."""
        fp = mix(self.gram) >> _U(64 - _FP)
        order = np.lexsort((self.doc, fp))
        f, d = fp[order], self.doc[order]
        new = np.ones(len(f), bool)
        new[1:] = f[1:] != f[:-1]
        docs = new.copy()
        docs[1:] |= d[1:] != d[:-1]
        which = np.empty(len(f), np.int64)
        which[order] = np.cumsum(new) - 1
        return f[new], np.add.reduceat(docs.astype(np.int64), np.flatnonzero(new)) if len(f) else np.zeros(0, np.int64), which

    def take(self, keep: np.ndarray, split: np.ndarray) -> dict[str, np.ndarray]:
        """The strings to send: those of keep, and every window of those of split; equal ones of the chunk once, for their smallest document.

        In order of dest: dest (what deals them), lead (first of equals), low, high (offsets of the windows before the k-gram), place, doc.
        """
        n = (self.last - self.first + 1)[split]
        window = np.repeat(self.first[split], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out = {
            "place": np.concatenate([self.place[keep], window]),
            "first": np.concatenate([self.first[keep], window]),
            "last": np.concatenate([self.last[keep], window]),
            "doc": np.concatenate([self.doc[keep], np.repeat(self.doc[split], n)]),
        }
        own = self._hash(out["first"], out["last"] + self.length) + (out["place"] - out["first"]).astype(_U)
        out["dest"] = np.concatenate([mix(self.gram[keep]), mix(own[keep.sum() :] + _U(1))])
        out["id"] = self.ids[out["doc"]]
        order = np.lexsort((out["id"], own, out["dest"]))
        out = {c: v[order] for c, v in out.items()}
        own = own[order]
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
        same = np.array(lead)
        for i in range(0, len(own), 1 << 16):  # equal hashes aren't proof
            sl = slice(i, i + (1 << 16))
            rest = np.flatnonzero(~new[sl]) + i
            if len(rest):
                a, b = ({c: v[x] for c, v in out.items()} for x in (rest, lead[rest]))
                differs = (self.matrix(a) != self.matrix(b)).any(axis=1)
                same[rest[differs]] = rest[differs]
        return out | {"lead": same, "low": out["place"] - out["last"], "high": out["place"] - out["first"]}

    def _hash(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Hashes of data[s:e], by blocks."""
        out, cut = np.empty(len(s), _U), np.argsort(s, kind="stable")
        edges = np.searchsorted(s[cut], np.arange(0, len(self.data) + _BLOCK, _BLOCK))
        for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
            if j > i:
                own, at = cut[i:j], b * _BLOCK
                p = prefix_sums(self.data[at : at + _BLOCK + 2 * self.length])
                out[own] = span_hash(p, s[own] - at, e[own] - at)
        return out

    def matrix(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        """The strings as rows, aligned at their k-grams; 255, which no text holds, stands around them."""
        width = 2 * self.length - self.k
        at = rows["place"][:, None] + np.arange(-(self.length - self.k), self.length)
        out = self.data[np.clip(at, 0, max(len(self.data) - 1, 0))] if len(self.data) else np.zeros((0, width), np.uint8)
        out[(at < rows["first"][:, None]) | (at >= rows["last"][:, None] + self.length)] = 255
        return out


def covered_windows(columns, ids: np.ndarray, low: np.ndarray, high: np.ndarray, width: int, length: int) -> np.ndarray:
    """For each string a bit for each offset of a window whose equal has a smaller id. columns(j): the symbols of column j."""
    m = len(ids)
    mask, order, common = np.zeros(m, np.uint32), np.arange(m), np.zeros(m, np.uint8)
    for round_ in range(1, width + 1):
        symbol = columns(width - round_)[order]  # what precedes each suffix, in their order
        by = np.argsort(symbol, kind="stable")
        ranked = symbol[by]
        order = order[by]
        common = _prefixes(common, by, ranked)
        off = round_ - length
        if off >= 0:
            valid = (low[order] <= off) & (off <= high[order])
            group = np.flatnonzero(common < length)
            least = np.minimum.reduceat(np.where(valid, ids[order], _NONE), group) if m else ids
            beaten = valid & (ids[order] > np.repeat(least, np.diff(np.append(group, m))))
            mask[order[beaten]] |= np.uint32(1 << off)
    return mask


def _prefixes(common: np.ndarray, by: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """The common prefix of each suffix with its predecessor after one more symbol: one more than the least since the last place with that symbol."""
    out = np.zeros(len(by), np.uint8)
    follows = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
    if not len(follows):
        return out
    end, size = by[follows], by[follows] - by[follows - 1]
    near = size == 1
    out[follows[near]] = common[end[near]] + 1
    follows, end, size = follows[~near], end[~near], size[~near]
    level, step = common, 1
    while len(follows):  # level[i]: the least of step values from i on
        level = np.minimum(level[:-step], level[step:])
        step *= 2
        now = size < 2 * step
        e, s = end[now], size[now]
        out[follows[now]] = np.minimum(level[e - s + 1], level[e - step + 1]) + 1
        follows, end, size = follows[~now], end[~now], size[~now]
    return out


class RepeatedStrings:
    def __init__(self, length: int = 50, k: int = 20, hot: int = 1 << 14, chunk_bytes: int = 4 << 20, slice_bytes: int = 16 << 20):
        if not k <= length <= k + 31:
            raise ValueError("length must be from k to k + 31")
        self.length, self.k, self.hot, self.chunk_bytes, self.slice_bytes = length, k, hot, chunk_bytes, slice_bytes

    def _chunks(self, docs: DataFrame) -> DataFrame:
        """All rows of docs in chunks of about chunk_bytes of text."""
        kinds, size = arrow_schema(docs.sparkSession, _CHUNK), self.chunk_bytes

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, n, got, held = TaskContext.get().partitionId(), 0, 0, []

            def put() -> pa.RecordBatch:
                sink = pa.BufferOutputStream()
                t = pa.Table.from_batches(held).combine_chunks()
                with pa.ipc.new_stream(sink, t.schema) as w:
                    w.write_table(t)
                return pa.RecordBatch.from_arrays([pa.array([(part << 24) + n], pa.int64()), pa.array([_zip(sink.getvalue(), 3)], pa.binary())], schema=kinds)

            for b in batches:
                for i in range(0, b.num_rows, 64):
                    held.append(b.slice(i, 64))
                    got += held[-1].nbytes
                    if got >= size:
                        yield put()
                        n, got, held = n + 1, 0, []
            if held:
                yield put()

        return docs.mapInArrow(run, _CHUNK)

    def _strings(self, t: pa.Table) -> Strings:
        return Strings(t.column("__text").combine_chunks().fill_null(""), t.column("__id").combine_chunks(), self.length, self.k)

    def marked(self, docs: DataFrame, out: str, finish, keep: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """finish(rows of a chunk, its texts' bytes, their bounds, which bytes go) as a table of schema out. The rows have __id, __text and k0, k1, ... for the columns of keep."""
        spark = docs.sparkSession
        length, k, hot, width = self.length, self.k, self.hot, 2 * self.length - self.k
        bounded_batches(spark)
        own = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))
        chunks = materialize(self._chunks(own), "chunks")
        total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
        slices = max(1, -(-total // self.slice_bytes))
        sent, answer, result = (arrow_schema(spark, s) for s in ("slice long, bucket long, data binary", _ANSWER, out))

        def cuts(dest: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
            """(slice, from, to) of sorted dest, for slices with any."""
            bounds = [(i << bits) // slices + bool((i << bits) % slices) for i in range(1, slices)]
            at = [0, *np.searchsorted(dest, np.array(bounds, _U)).tolist(), len(dest)]
            return [(i, s, e) for i, (s, e) in enumerate(zip(at, at[1:])) if e > s]

        def read(blob: bytes) -> pa.Table:
            return pa.ipc.open_stream(_unzip(blob)).read_all()

        @tidy
        def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("rows")):
                    fp, docs_of, _ = self._strings(read(blob.as_py())).fingerprints()
                    for i, s, e in cuts(fp, _FP):
                        raw = (e - s).to_bytes(8, "little") + _press(np.diff(fp[s:e], prepend=_U(0)), 6) + _press(np.minimum(docs_of[s:e], 65535), 2)
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([i], [bucket], [_zip(raw)]), sent)], schema=sent)

        @tidy
        def shared(t: pa.Table) -> pa.Table:
            fps, counts, sizes = [], [], []
            for blob in t.column("data"):
                raw = _unzip(blob.as_py())
                n = int.from_bytes(raw[:8], "little")
                fps.append(np.cumsum(_unpress(raw[8:], n, 6), dtype=_U))
                counts.append(_unpress(raw[8 + 6 * n :], n, 2).astype(np.int64))
                sizes.append(n)
            fp, count = np.concatenate(fps), np.concatenate(counts)
            order = np.argsort(fp, kind="stable")
            new = np.ones(len(fp), bool)
            new[1:] = fp[order][1:] != fp[order][:-1]
            sums = np.add.reduceat(count[order], np.flatnonzero(new))
            found = np.empty(len(fp), np.int64)
            found[order] = np.repeat(sums, np.diff(np.append(np.flatnonzero(new), len(fp))))
            data, at = [], 0
            for n in sizes:
                x = found[at : at + n]
                data.append(_zip(np.packbits(np.concatenate([x > 1, x > hot])).tobytes()))
                at += n
            return pa.Table.from_arrays([t.column("bucket"), pa.array([0] * len(data), pa.int32()), t.column("slice"), pa.array(data, pa.binary())], schema=answer)

        def chosen(strings: Strings, right: pa.Table) -> dict[str, np.ndarray]:
            fp, _, which = strings.fingerprints()
            many, very = np.zeros(len(fp), bool), np.zeros(len(fp), bool)
            bits = {i: d.as_py() for kind, i, d in zip(right.column("kind").to_pylist(), right.column("slice").to_pylist(), right.column("data")) if kind == 0}
            for i, s, e in cuts(fp, _FP):
                x = np.unpackbits(np.frombuffer(_unzip(bits[i]), np.uint8), count=2 * (e - s)).astype(bool)
                many[s:e], very[s:e] = x[: e - s], x[e - s :]
            return strings.take((many & ~very)[which], very[which])

        @tidy
        def send(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            for bucket, blob in zip(left.column("bucket").to_pylist(), left.column("rows")):
                strings = self._strings(read(blob.as_py()))
                rows = chosen(strings, right)
                lead = rows["lead"] == np.arange(len(rows["lead"]))
                rows = {c: v[lead] for c, v in rows.items()}
                for i, s, e in cuts(rows["dest"], 64):
                    some = {c: v[s:e] for c, v in rows.items()}
                    size = some["last"] - some["first"] + length
                    flat = np.repeat(some["first"], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    raw = (e - s).to_bytes(8, "little") + _press(some["id"].view(_U), 8) + some["low"].astype(np.uint8).tobytes() + some["high"].astype(np.uint8).tobytes() + strings.data[flat].tobytes()
                    out.append((i, bucket, _zip(raw, 3)))
            return pa.Table.from_arrays([pa.array([o[j] for o in out], f.type) for j, f in enumerate(sent)], schema=sent)

        @tidy
        def build(t: pa.Table) -> pa.Table:
            ids, low, high, sizes = [], [], [], []
            raws = []
            for blob in t.column("data"):
                raw = _unzip(blob.as_py())
                n = int.from_bytes(raw[:8], "little")
                ids.append(_unpress(raw[8:], n, 8).view(np.int64))
                low.append(np.frombuffer(raw, np.uint8, n, 8 + 8 * n))
                high.append(np.frombuffer(raw, np.uint8, n, 8 + 9 * n))
                raws.append(np.frombuffer(raw, np.uint8, offset=8 + 10 * n))
                sizes.append(n)
            every = sum(sizes)
            with tempfile.TemporaryFile() as scratch:
                # the columns of all strings, one after the other; each blob adds its part to every column
                at = 0
                for x, lo, hi, n in zip(raws, low, high, sizes):
                    size = hi.astype(np.int64) - lo + length
                    begin = np.cumsum(size) - size
                    for j in range(width):
                        # column j is the byte at the k-gram's place plus j - (length - k); the string begins at place - high
                        rel = j - (length - k) + hi.astype(np.int64)
                        inside = (rel >= 0) & (rel < size)
                        col = np.full(n, 255, np.uint8)
                        col[inside] = x[(begin + rel)[inside]]
                        scratch.seek(j * every + at)
                        scratch.write(col.tobytes())
                    at += n
                raws.clear()

                def column(j: int) -> np.ndarray:
                    scratch.seek(j * every)
                    return np.frombuffer(scratch.read(every), np.uint8)

                mask = covered_windows(column, np.concatenate(ids), np.concatenate(low).astype(np.int64), np.concatenate(high).astype(np.int64), width, length)
            data, at = [], 0
            for n in sizes:
                data.append(_zip(_press(mask[at : at + n], 4)))
                at += n
            return pa.Table.from_arrays([t.column("bucket"), pa.array([1] * len(data), pa.int32()), t.column("slice"), pa.array(data, pa.binary())], schema=answer)

        @tidy
        def end(left: pa.Table, right: pa.Table) -> pa.Table:
            done = []
            for blob in left.column("rows"):
                t = read(blob.as_py())
                strings = self._strings(t)
                rows = chosen(strings, right)
                lead = np.flatnonzero(rows["lead"] == np.arange(len(rows["lead"])))
                got = {i: d.as_py() for kind, i, d in zip(right.column("kind").to_pylist(), right.column("slice").to_pylist(), right.column("data")) if kind == 1}
                mask = np.zeros(len(rows["lead"]), np.int64)
                for i, s, e in cuts(rows["dest"][lead], 64):
                    mask[lead[s:e]] = _unpress(_unzip(got[i]), e - s, 4)
                # equals of a smaller document's string go wholly, equals in the same document as it does
                first = rows["lead"]
                whole = ((np.int64(2) << rows["high"]) - 1) & ~((np.int64(1) << rows["low"]) - 1)
                mask = np.where(rows["id"] > rows["id"][first], whole, mask[first])
                starts = [np.zeros(0, np.int64)]
                for i in range(0, len(mask), 1 << 14):
                    row, off = np.nonzero((mask[i : i + (1 << 14), None] >> np.arange(length - k + 1)) & 1)
                    starts.append(rows["place"][row + i] - off)
                start, n = np.concatenate(starts), len(strings.data) + 1
                edge = np.bincount(start, minlength=n) - np.bincount(start + length, minlength=n)
                gone = np.cumsum(edge[:-1]) > 0
                done.append(finish(t, strings.data, strings.at, gone))
            return pa.concat_tables(done).cast(result)

        first = materialize(chunks.mapInArrow(offer, "slice long, bucket long, data binary").groupBy("slice").applyInArrow(shared, _ANSWER), "shared")
        chunk = lambda: chunks.groupBy("bucket")
        strings = chunk().cogroup(first.groupBy("bucket")).applyInArrow(send, "slice long, bucket long, data binary")
        second = materialize(strings.groupBy("slice").applyInArrow(build, _ANSWER), "windows")
        done = materialize(chunk().cogroup(first.unionByName(second).groupBy("bucket")).applyInArrow(end, out), "repeats")
        for x in (chunks, first, second):
            drop_cut(x)
        return done

    def digests(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of docs."""

        def finish(t: pa.Table, data: np.ndarray, at: np.ndarray, gone: np.ndarray) -> pa.Table:
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = at[1:-1][at[1:-1] < len(gone)]
            begins[inner] = gone[inner]
            removed, spans = (np.concatenate([[0], np.cumsum(x)])[at] for x in (gone, begins))
            hashes = [hashlib.sha256(data[s:e][~gone[s:e]] if r else data[s:e]).hexdigest() for s, e, r in zip(at, at[1:], np.diff(removed))]
            return pa.table({"doc_id": t.column("__id"), "n_bytes": np.diff(at), "n_removed": np.diff(removed), "n_spans": np.diff(spans), "kept_sha256": pa.array(hashes, pa.string())})

        return self.marked(docs, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", finish, [])

    def deduplicate(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """docs without the repeated bytes of their texts; characters that a cut goes through go wholly; texts without repeats stay as they are, null ones too."""
        names = docs.columns
        keep = [c for c in names if c != text_col]

        def finish(t: pa.Table, data: np.ndarray, at: np.ndarray, gone: np.ndarray) -> pa.Table:
            old, new = t.column("__text").to_pylist(), []
            for i, (s, e) in enumerate(zip(at, at[1:])):
                new.append(data[s:e][~gone[s:e]].tobytes().decode("utf-8", "ignore") if gone[s:e].any() else old[i])
            return pa.table([pa.array(new, pa.string()) if c == text_col else t.column(f"k{keep.index(c)}") for c in names], names=names)

        return self.marked(docs, docs.schema, finish, keep, text_col=text_col)


def oracle(length: int = 50) -> str:
    """digests(documents) in DuckDB's SQL, over the hexadecimal digits of the texts."""
    return f"""with d as (select doc_id, lower(hex(encode(coalesce(text, '')))) as h from documents),
w as (select doc_id, i, substring(h, 2 * i + 1, {2 * length}) as g from d, unnest(range(0, length(h) // 2 - {length} + 1)) as u(i)),
f as (select g, min(doc_id) as m from w group by g having min(doc_id) < max(doc_id)),
c as (select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i) > {length}, true) as new from w join f using (g) where doc_id > m),
r as (select doc_id, i, sum(new::int) over (partition by doc_id order by i) as run from c),
s as (select doc_id, run, min(i) as s, max(i) + {length} as e from r group by doc_id, run),
p as (select doc_id, s, e, lag(e, 1, 0) over (partition by doc_id order by s) as before from s),
k as (select p.doc_id, sum(e - s) as n, count(*) as c, string_agg(substring(h, 2 * before + 1, 2 * (s - before)), '' order by s) as head, max(e) as last from p join d on d.doc_id = p.doc_id group by p.doc_id)
select d.doc_id, length(h) // 2 as n_bytes, coalesce(n, 0)::bigint as n_removed, coalesce(c, 0)::bigint as n_spans, sha256(unhex(coalesce(head, '') || substring(h, 2 * coalesce(last, 0) + 1))) as kept_sha256 from d left join k on k.doc_id = d.doc_id"""
