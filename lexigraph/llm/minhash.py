"""Near-duplicates by MinHash bands, sequential Bayesian verification and confirmation on full shingle sets.

1. Every text becomes its set of word shingles, the set's digest and a signature of `bands` times `rows` minima. Equal sets
   form one node, named by its smallest doc_id.
2. Nodes that share a band meet. Every node is first compared with the smallest node of each of its bands (a star, not all
   pairs): the two signatures are read in batches of `batch` minima, and after each one a pair is pruned when the posterior
   probability that its similarity reaches the threshold falls under `miss`. The node's closest surviving partner is
   confirmed on the full sets of both, and confirmed links give components.
3. Bands of three nodes or more that still hold several components are searched in blocks inside one task: at first for
   each node's closest surviving partner outside its component, one over all its bands, which is confirmed and joins
   components. Then every surviving pair between different components is verified on the hashes of both full sets, in the
   block of the first band that it shares; the task keeps the components that its links join and gives out only links that
   join two, so a group whose pairs all fail costs comparisons but no rows. These, and the star's other survivors between
   components, are confirmed on the words.
Pairs inside one component are never needed, so groups of copies cost a few pairs for each member. A band that weighs over
`tile` nodes is cut into tiles, and its blocks are the pairs of tiles, so that all its nodes still meet while no task holds
the band; tiles of one large component don't meet each other.

Two documents at the threshold share no band with probability (1 - t ** rows) ** bands (7e-11 for 0.85 and the
defaults, 1e-7 for 0.80), and a pair that does is pruned wrongly with probability of about `miss`, whatever the band's size.

Defined results: null and empty texts have the empty set, which is linked with nothing; rows of one doc_id are one
document; a null doc_id takes no part (no component, kept); equal texts have one component; an empty table gives an
empty table; other columns are ignored by components and kept by deduplicate.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected
from ..plans.tables import drop_cut
from .common import arrow_schema, materialize, texts, tidy
from .shingle import mix, shingles

_SIGS = "doc_id long, n_shingles long, d1 long, d2 long, sig binary"


@lru_cache(maxsize=8)
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240501)
    return (r.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1))[:, None], r.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """The lower 16 bits of n minima; many hashes are taken in blocks."""
    mul, add = _multipliers(n)
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 2048):
        low = np.minimum(low, (mul * h[None, i : i + 2048] + add).min(axis=1))
    return (mix(low.astype(np.uint64)) & np.uint64(0xFFFF)).astype("<u2")


@lru_cache(maxsize=32)
def least_matches(n: int, percent: int, miss: float) -> int:
    """The fewest equal minima of n with which P(similarity >= percent / 100) is miss at least, similarities being equally likely before."""
    t, tail = percent / 100, 0.0
    for m in range(n + 1):  # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
        tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def surviving(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int, miss: float, batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows x of the signature matrix a and y of b survive every batch, and how many minima they share."""
    alive, same = np.arange(len(x)), np.zeros(len(x), np.int32)
    for i in range(0, a.shape[1], batch):
        same = same + (a[x[alive], i : i + batch] == b[y[alive], i : i + batch]).sum(axis=1, dtype=np.int32)
        ok = same >= least_matches(min(i + batch, a.shape[1]), percent, miss)
        alive, same = alive[ok], same[ok]
    return alive, same


def _sig_matrix(column: pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, n)


def _band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.zeros((len(sig), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    for r in range(rows):
        h = mix(h) * np.uint64(31) + x[:, :, r]
    return mix(h).view(np.int64)


def _put(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class _Block:
    """Nodes of one key: those of side 0 meet those of side 1, or, without side 1, one another."""

    STEP = 50_000  # pairs at a time

    def __init__(self, held: list[pa.RecordBatch], n: int):
        t = pa.Table.from_batches(held)
        self.key, self.node, self.comp, self.w, self.size, side = (t.column(k).to_numpy() for k in ("key", "node", "comp", "w", "size", "side"))
        self.sig = _sig_matrix(t.column("sig"), 2 * n).view("<u2")
        self.low = np.ascontiguousarray(self.sig.view(np.uint8)[:, ::2])
        self.words = t.column("words") if "words" in t.schema.names else None
        self.left = int((side == 0).sum())
        self.crosses = self.comp.min() != self.comp.max()

    def survivors(self, how: "NearDuplicates") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(x, y, same): places of pairs of different components that no batch prunes, and how many minima they share."""
        two, n = self.left < len(self.node), len(self.node)
        ys = slice(self.left, n) if two else slice(0, n)
        step = max(1, self.STEP // (ys.stop - ys.start))
        for i in range(0, self.left, step):
            x, y = np.nonzero(self.comp[i : min(i + step, self.left), None] != self.comp[None, ys])
            x, y = x + i, y + ys.start
            if not two:
                x, y = x[x < y], y[x < y]
            ok, same = how._alike(self.low, self.low, x, y, self.size[x], self.size[y])
            if len(ok):
                yield x[ok], y[ok], same

    def first_shared(self, how: "NearDuplicates") -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The survivors for which this key is the first band that they share."""
        for x, y, _ in self.survivors(how):
            for i in range(0, len(x), 4096):
                u, v = x[i : i + 4096], y[i : i + 4096]
                ku, kv = (_band_keys(self.sig[z], how.bands, how.rows) for z in (u, v))
                first = ku[np.arange(len(u)), (ku == kv).argmax(axis=1)] == self.key[u]
                if first.any():
                    yield u[first], v[first]

    def joining(self, how: "NearDuplicates") -> Iterator[tuple[int, int]]:
        """Links by the hashes of the full sets, each of which joins two components of the block."""
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = c = parent.get(up, up)
            return c

        texts_of = pa.array([zstandard.ZstdDecompressor().decompress(w.as_py()) for w in self.words], pa.binary()).cast(pa.string())
        sets = list(shingles(texts_of, how.size))
        for us, vs in self.first_shared(how):
            for x in np.unique(us).tolist():
                own, r = sets[x], root(int(self.comp[x]))
                ys = [y for y in vs[us == x].tolist() if root(int(self.comp[y])) != r]
                for some in _runs(ys, [len(sets[y]) for y in ys]):
                    every = np.concatenate([sets[y] for y in some])
                    sizes = np.array([len(sets[y]) for y in some])
                    at = np.minimum(np.searchsorted(own, every), len(own) - 1)
                    common = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
                    for k in np.flatnonzero(100 * common >= how.percent * (len(own) + sizes - common)).tolist():
                        u, v = root(int(self.comp[x])), root(int(self.comp[some[k]]))
                        if u != v:
                            parent[max(u, v)] = min(u, v)
                            yield int(self.node[x]), int(self.node[some[k]])


def _runs(items: list[int], sizes: list[int], most: int = 1 << 19) -> Iterator[list[int]]:
    """items in runs of at most `most` in size, or single ones."""
    run, held = [], 0
    for x, n in zip(items, sizes):
        if run and held + n > most:
            yield run
            run, held = [], 0
        run.append(x)
        held += n
    if run:
        yield run


class NearDuplicates:
    def __init__(self, percent: int = 85, size: int = 5, bands: int = 40, rows: int = 5, miss: float = 1e-5, batch: int = 40, tile: int = 2048):
        self.percent, self.size, self.bands, self.rows, self.miss, self.batch, self.tile = percent, size, bands, rows, miss, batch, tile

    @property
    def n(self) -> int:
        return self.bands * self.rows

    def signatures(self, docs: DataFrame) -> DataFrame:
        kinds, size, n = arrow_schema(docs.sparkSession, _SIGS), self.size, self.n

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                counts, d1, d2, sigs = [], [], [], []
                for h in shingles(b.column("text"), size):
                    d = xxhash.xxh3_128_digest(h.tobytes())
                    counts.append(len(h))
                    d1.append(int.from_bytes(d[:8], "little", signed=True))
                    d2.append(int.from_bytes(d[8:], "little", signed=True))
                    sigs.append(signature(h, n).tobytes() if len(h) else None)
                yield _put(kinds, b.column("doc_id"), counts, d1, d2, sigs)

        return texts(docs).mapInArrow(run, _SIGS)

    def components(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_shingles, component_id and kept of every row of docs."""
        sigs = materialize(self.signatures(docs), "signatures")
        named = sigs.filter("doc_id is not null and n_shingles > 0")
        reps = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"))
        some = named.select(F.col("doc_id").alias("node"), F.col("n_shingles").cast("int").alias("n"), "d1", "d2", "sig")
        nodes = some.join(reps.hint("merge"), ["node", "d1", "d2"], "left_semi").dropDuplicates(["node", "d1", "d2"]).select("node", "n", "sig")
        nodes = materialize(nodes, "nodes")
        comps = self._linked(docs, nodes)
        known = reps.join(comps.hint("merge"), "node", "left").select("d1", "d2", F.coalesce("component", "node").alias("component"))
        # the rows of one doc_id are one document: they take its least component
        rows = sigs.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("d1")).alias("d1"), "d2").join(known.hint("merge"), ["d1", "d2"], "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        out = materialize(rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")), "components")
        for t in (sigs, nodes, comps):
            drop_cut(t)
        return out

    def _linked(self, docs: DataFrame, nodes: DataFrame) -> DataFrame:
        """(node, component) of linked nodes."""
        bands = self._bands(nodes)
        sizes = bands.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("most"), F.count("*").alias("n")).filter("b < most").select("key", "b", "n")
        shared = materialize(bands.join(sizes.hint("merge"), "key"), "bands")
        stars = materialize(self._pruned(nodes, shared.filter("node != b").select(F.col("node").alias("a"), "b").distinct()), "stars")
        some = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).unionByName(shared.filter("n > 2").select("node")).distinct()
        packed = materialize(self._packed(docs, some), "packed")
        links = materialize(self._confirmed(packed, stars.groupBy("a").agg(F.max(F.struct("same", "b"))["b"].alias("b"))), "links")
        comps = connected(links)
        found = [links, self._nearest(nodes, shared, packed, comps)]
        links, old = found[0].unionByName(found[1]), comps
        comps = connected(links)
        drop_cut(old)
        found.append(materialize(self._confirmed(packed, self._crossing(stars.select("a", "b"), comps).unionByName(self._rest(nodes, shared, packed, comps))), "links"))
        links, old = links.unionByName(found[2]), comps
        comps = connected(links)
        for t in (shared, packed, stars, old, *found):
            drop_cut(t)
        return comps

    def _bands(self, nodes: DataFrame) -> DataFrame:
        """(key, node) for each band."""
        schema = "key long, node long"
        kinds, bands, rows, n = arrow_schema(nodes.sparkSession, schema), self.bands, self.rows, self.n

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    keys = _band_keys(_sig_matrix(b.column("sig"), 2 * n).view("<u2"), bands, rows)
                    yield _put(kinds, keys.ravel(), np.repeat(b.column("node").to_numpy(), bands))

        return nodes.select("node", "sig").mapInArrow(run, schema)

    def _lower_bytes(self, nodes: DataFrame) -> DataFrame:
        """nodes with a byte for each minimum, which is what pairs are compared by."""
        kinds, n = arrow_schema(nodes.sparkSession, "node long, n int, sig binary"), self.n

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    yield _put(kinds, b.column("node"), b.column("n"), [x.tobytes() for x in _sig_matrix(b.column("sig"), 2 * n)[:, ::2]])

        return nodes.select("node", "n", "sig").mapInArrow(run, "node long, n int, sig binary")

    def _alike(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs of rows x of a and y of b may be links by the sizes of their sets and by their signatures, and how many minima they share."""
        near = np.flatnonzero(100 * np.minimum(nx, ny).astype(np.int64) >= self.percent * np.maximum(nx, ny).astype(np.int64))
        alive, same = surviving(a, b, x[near], y[near], self.percent, self.miss, self.batch)
        return near[alive], same

    def _pruned(self, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
        schema = "a long, b long, same int"
        kinds, n, alike = arrow_schema(nodes.sparkSession, schema), self.n, self._alike

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x, y = (_sig_matrix(b.column(k), n) for k in ("sig_a", "sig_b"))
                    every = np.arange(len(x))
                    ok, same = alike(x, y, every, every, b.column("n_a").to_numpy(), b.column("n_b").to_numpy())
                    yield _put(kinds, b.column("a").take(pa.array(ok)), b.column("b").take(pa.array(ok)), same)

        low = self._lower_bytes(nodes)
        left, right = (low.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"sig_{k}")).hint("merge") for k in "ab")
        return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(run, schema)

    def _nearest(self, nodes: DataFrame, shared: DataFrame, packed: DataFrame, comps: DataFrame) -> DataFrame:
        """Links between each node and its closest surviving partner outside its component, over all its bands."""

        def closest(block: "_Block") -> Iterator[tuple]:
            found = list(block.survivors(self))
            if not found:
                return
            x, y, same = map(np.concatenate, zip(*found))
            ends, others, same = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([same, same])
            order = np.lexsort((-same, ends))
            new = np.ones(len(order), bool)
            new[1:] = ends[order][1:] != ends[order][:-1]
            pick = order[new]
            yield block.node[ends[pick]], same[pick], block.node[others[pick]]

        got = self._in_blocks(self._placed(nodes, shared, comps), nodes, None, "a long, same int, b long", closest)
        best = got.groupBy("a").agg(F.max(F.struct("same", "b"))["b"].alias("b"))
        return materialize(self._confirmed(packed, best.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), "links")

    def _rest(self, nodes: DataFrame, shared: DataFrame, packed: DataFrame, comps: DataFrame) -> DataFrame:
        """Links, at most one for each two components of a block, found by comparing every surviving pair between components inside the first band that the pair shares."""

        def marks(block: "_Block") -> Iterator[tuple]:
            some = np.unique(np.concatenate([np.zeros(0, np.int64), *(z for pair in block.first_shared(self) for z in pair)]))
            yield block.key[some], block.node[some], block.comp[some], block.w[some]

        def verified(block: "_Block") -> Iterator[tuple]:
            links = np.array(list(block.joining(self)), np.int64).reshape(-1, 2)
            yield links.max(axis=1), links.min(axis=1)

        where = "key long, node long, comp long, w long"
        marked = materialize(self._in_blocks(self._placed(nodes, shared, comps), nodes, None, where, marks).distinct(), "marked")
        got = materialize(self._in_blocks(marked, nodes, packed, "a long, b long", verified).distinct(), "found")
        drop_cut(marked)
        return got

    @staticmethod
    def _placed(nodes: DataFrame, shared: DataFrame, comps: DataFrame) -> DataFrame:
        """(key, node, comp, w) in bands of three nodes or more that hold several components; w weighs a node by its set."""
        placed = shared.filter("n > 2").join(comps.hint("merge"), "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"))
        several = placed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1").select("key")
        weights = nodes.groupBy("node").agg((1 + F.floor(F.max("n") / 1000)).alias("w"))
        return placed.join(several.hint("merge"), "key", "left_semi").join(weights.hint("merge"), "node").select("key", "node", "comp", "w")

    def _tiled(self, rows: DataFrame) -> DataFrame:
        """rows in blocks (block, side) so that any two nodes of a key that are of different components meet in one.

        A key that weighs over `tile` is cut into tiles, and its blocks are pairs of tiles. A component that weighs more has
        tiles of its own, which never meet one another, so a key with one large component has about as many blocks as tiles.
        """
        of_comp = rows.groupBy("key", "comp").agg(F.sum("w").alias("wc"))
        heavy = of_comp.groupBy("key").agg(F.sum("wc").alias("wk")).filter(F.col("wk") > self.tile)
        cuts = materialize(of_comp.join(heavy.hint("merge"), "key"), "cuts")
        whole = rows.withColumns({"block": F.col("key"), "side": F.lit(0)})
        if cuts.isEmpty():
            return whole
        solo = F.col("wc") > self.tile
        cuts = cuts.select("key", "comp", solo.alias("solo"), F.when(solo, F.col("comp")).otherwise(0).alias("own"), F.ceil(F.when(solo, F.col("wc")).otherwise(F.col("wk")) / self.tile).alias("n"))
        nth = F.pmod(F.when(F.col("solo"), F.xxhash64("node")).otherwise(F.xxhash64("comp")), F.col("n"))
        tiled = rows.join(cuts.hint("merge"), ["key", "comp"]).withColumn("tile", F.xxhash64("key", "solo", "own", nth))
        tiles = tiled.select("key", "solo", "own", "tile").distinct()
        left, right = (tiles.select("key", F.col("solo").alias(f"s{k}"), F.col("own").alias(f"o{k}"), F.col("tile").alias(f"t{k}")) for k in "ab")
        meets = left.join(right.hint("merge"), "key").filter("ta <= tb and not (sa and sb and oa = ob)").select(F.xxhash64("ta", "tb").alias("block"), "ta", "tb")
        meets = materialize(meets, "meets")
        sides = [tiled.join(m.hint("merge"), "tile").select(*rows.columns, "block", F.lit(i).alias("side")) for i, m in enumerate((meets.select("block", F.col("ta").alias("tile")), meets.filter("ta < tb").select("block", F.col("tb").alias("tile"))))]
        return whole.join(heavy.hint("merge"), "key", "left_anti").unionByName(sides[0]).unionByName(sides[1])

    def _in_blocks(self, rows: DataFrame, nodes: DataFrame, packed: DataFrame | None, schema: str, fn) -> DataFrame:
        """fn of each block of rows (key, node, comp, w) that holds several components; with the words of packed."""
        n, kinds = self.n, arrow_schema(nodes.sparkSession, schema)
        dealt = self._tiled(materialize(rows, "placed")).join(nodes.select("node", F.col("n").alias("size"), "sig").hint("merge"), "node")
        if packed is not None:
            dealt = dealt.join(packed.withColumnRenamed("doc_id", "node").hint("merge"), "node")
        parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = dealt.repartition(parts, "block").sortWithinPartitions("block", "side")

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []  # the last block's rows so far

            def done() -> Iterator[pa.RecordBatch]:
                block = _Block(held, n)
                if block.crosses:
                    for out in fn(block):
                        yield _put(kinds, *out)

            for b in batches:
                if b.num_rows:
                    at = b.column("block").to_numpy()
                    cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
                    for s, e in zip(cuts, cuts[1:]):
                        if held and held[0].column("block")[0].as_py() != at[s]:
                            yield from done()
                            held = []
                        held.append(b.slice(s, e - s))
            if held:
                yield from done()

        return dealt.mapInArrow(run, schema)

    @staticmethod
    def _crossing(pairs: DataFrame, comps: DataFrame) -> DataFrame:
        """Distinct pairs whose ends are in different components."""
        left, right = (comps.select(F.col("node").alias(k), F.col("component").alias(f"c{k}")) for k in "ab")
        got = pairs.distinct().join(left.hint("merge"), "a", "left").join(right.hint("merge"), "b", "left")
        return got.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    @staticmethod
    def _packed(docs: DataFrame, nodes: DataFrame) -> DataFrame:
        """(doc_id, words): the lower-cased texts of nodes, compressed."""
        blob = arrow_schema(docs.sparkSession, "doc_id long, words binary")

        @tidy
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z = zstandard.ZstdCompressor(level=6)
            for b in batches:
                yield _put(blob, b.column("doc_id"), [z.compress(b" ".join(t.encode().lower().split())) for t in b.column("text").to_pylist()])

        packed = texts(docs).mapInArrow(pack, "doc_id long, words binary")
        return packed.join(nodes.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "words"])

    def _confirmed(self, packed: DataFrame, pairs: DataFrame) -> DataFrame:
        """The pairs that are links, by the full sets of both texts."""
        size, percent, kinds = self.size, self.percent, arrow_schema(packed.sparkSession, "a long, b long")

        def sets(raw: bytes) -> set:
            w = zstandard.ZstdDecompressor().decompress(raw).split()
            return set(zip(*(w[k:] for k in range(size)))) if len(w) >= size else {tuple(w)}

        @tidy
        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, right = None, set()
            for b in batches:
                keep = []
                for x, y, m in zip(b.column("words_a"), b.column("words_b"), b.column("b").to_pylist()):
                    if m != last:
                        last, right = m, sets(y.as_py())
                    left = sets(x.as_py())
                    common = len(left & right)
                    keep.append(100 * common >= percent * (len(left) + len(right) - common))
                yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).cast(kinds)

        left, right = (packed.select(F.col("doc_id").alias(k), F.col("words").alias(f"words_{k}")).hint("merge") for k in "ab")
        return pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b").mapInArrow(check, "a long, b long")

    def deduplicate(self, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
        """The rows of docs whose document is its component's smallest, with all their columns."""
        gone = self.components(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
        return docs.join(gone.hint("merge"), F.col(id_col).cast("long") == F.col("__gone"), "left_anti")


def oracle(percent: int = 85) -> str:
    """components(documents) in DuckDB's SQL, by all pairs that share a shingle."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    return f"""with recursive w as (select doc_id, {words} as ws from documents),
s as (select distinct doc_id, case when len(ws) < 5 then array_to_string(ws, ' ') else array_to_string(ws[i:i + 4], ' ') end as g from w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as u(i) where len(ws) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= {percent} * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as node, doc_id as seen from documents union select e.b, r.seen from r join e on e.a = r.node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id, d.doc_id = m.component_id as kept from documents d left join n on n.doc_id = d.doc_id join (select node, min(seen) as component_id from r group by node) m on m.node = d.doc_id"""
