"""Nearest neighbours by largest inner product, with vantage-point trees in shards.

Vectors become points of a metric space by one more component, sqrt(m - |x|^2) with m the largest squared length of all (0
for queries): the nearest point by distance is then the one of largest inner product. Rows with equal vectors are one point
that keeps its `k` + 1 smallest ids, pre-aggregated in every batch, so that a vector shared by very many rows stays small. Points are dealt by
hash into shards of about shard_rows; each shard holds a tree: a vantage point, the median distance to it, and the nearer
and the farther half, down to leaves. Blocks of queries meet every shard (a stated query set against all rows), so tasks are
as many as shards times blocks, and a row that meets a shard carries about as many bytes of queries as of points; a half is
skipped when its least possible distance, by the triangle inequality, is over factor times the query's k-th best so far.
factor one is exact; smaller ones prune more and may miss neighbours. Candidates that survive are scored anew on the original
vectors, in double precision, component by component.

Defined results: vectors that are null, empty, zero, or that hold null or non-finite components take no part, neither do rows with a null id;
vectors of different sizes don't meet; ties go to the smaller id; rows that repeat an id and a vector count once; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, bounded_batches, materialize, tidy

_FOUND = "query_id long, vec_id long, score double"


class VPTree:
    """points: (n, d) doubles, each with a weight of ids; the tree holds positions of points."""

    def __init__(self, points: np.ndarray, leaf: int = 512, seed: int = 7):
        self.points, self.leaf = points, leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, own: np.ndarray):
        if len(own) <= self.leaf:
            return own
        vantage = self.points[own[self.rng.integers(len(own))]]
        d = np.sqrt(((self.points[own] - vantage) ** 2).sum(axis=1))
        half = np.argsort(d, kind="stable")
        cut = len(own) // 2
        near, far = half[:cut], half[cut:]
        if d[half[-1]] <= 0:
            return own
        return vantage, (d[near].min(), d[near].max()), self._build(own[near]), (d[far].min(), d[far].max()), self._build(own[far])

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, position) of each query's k nearest points and of those no farther than the k-th."""
        best = np.full((len(queries), k), np.inf)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        stack = [(self.root, np.arange(len(queries)), np.zeros(len(queries)))]
        while stack:
            node, who, bound = stack.pop()
            who = who[bound <= factor * best[who, -1] + 1e-9]
            if not len(who):
                continue
            if isinstance(node, np.ndarray):
                for some in np.array_split(who, -(-len(who) // 2048)):
                    x, q = self.points[node], queries[some]
                    d = np.sqrt(np.maximum((q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None, :] - 2 * q @ x.T, 0))
                    best[some] = np.sort(np.partition(np.concatenate([best[some], d], axis=1), k - 1, axis=1)[:, :k], axis=1)
                    row, at = np.nonzero(d <= best[some, -1:] + 1e-9)
                    held.append((some[row], node[at], d[row, at]))
                continue
            vantage, (n0, n1), near, (f0, f1), far = node
            d = np.sqrt(((queries[who] - vantage) ** 2).sum(axis=1))
            low_near, low_far = np.maximum(np.maximum(n0 - d, d - n1), 0), np.maximum(np.maximum(f0 - d, d - f1), 0)
            first = low_near <= low_far
            # the half that may be nearer is searched first: it is pushed last
            stack += [(near, who[~first], low_near[~first]), (far, who[first], low_far[first]), (far, who[~first], low_far[~first]), (near, who[first], low_near[first])]
        who, at, d = (np.concatenate(c) for c in zip(*held))
        ok = d <= best[who, -1] + 1e-9
        return who[ok], at[ok]


def _usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))


def _scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products, row by row, summed in the order of the components."""
    out = np.zeros(len(points))
    for j in range(points.shape[1]):
        out += queries[:, j] * points[:, j]
    return out


def _nearest(q: np.ndarray, who: np.ndarray, x: np.ndarray, ids: pa.ListArray, pairs: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k nearest ids but its own, among pairs of queries and points."""
    at, point = pairs
    score = _scores(q[at], x[point])
    offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
    n = (offsets[1:] - offsets[:-1])[point]
    own = np.repeat(offsets[point], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at, score, other = np.repeat(at, n), np.repeat(score, n), flat[own]
    keep = other != who[at]
    at, score, other = at[keep], score[keep], other[keep]
    order = np.lexsort((other, -score, at))
    at, score, other = at[order], score[order], other[order]
    first = np.searchsorted(at, at)
    best = np.arange(len(at)) - first < k
    return who[at[best]], other[best], score[best]


def search(vectors: DataFrame, k: int = 20, every: int = 20, factor: float = 1.0, shard_rows: int = 4096, block_rows: int = 8192, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by every, its k nearest other rows."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = _usable(vectors, id_col, vec_col)
    n, top = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    shards = max(1, -(-n // shard_rows))
    point, result = arrow_schema(spark, "key long, size int, v binary, ids array<long>"), arrow_schema(spark, _FOUND)

    def grouped(found: dict[bytes, list[int]]) -> pa.RecordBatch:
        keys = [xxhash.xxh3_64_intdigest(v) >> 1 for v in found]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((keys, [len(v) // 8 for v in found], list(found), [sorted(set(i))[: k + 1] for i in found.values()]), point)], schema=point)

    @tidy
    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[bytes, list[int]] = {}
            for i, v in zip(b.column("id").to_pylist(), b.column("v")):
                found.setdefault((v.values.to_numpy() + 0.0).tobytes(), []).append(i)
            yield grouped(found)

    @tidy
    def block(t: pa.Table) -> pa.Table:
        found: dict[bytes, list[int]] = {}
        for v, ids in zip(t.column("v").to_pylist(), t.column("ids").to_pylist()):
            found.setdefault(v, []).extend(ids)
        sizes = sorted({len(v) for v in found})
        out = []
        for s in sizes:
            own = [v for v in sorted(found) if len(v) == s]
            out.append((s // 8, b"".join(own), [sorted(set(found[v]))[: k + 1] for v in own]))
        shard = t.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([shard] * len(out), pa.int32()), "size": pa.array([o[0] for o in out], pa.int32()), "vs": pa.array([o[1] for o in out], pa.binary()), "ids": pa.array([o[2] for o in out], pa.list_(pa.list_(pa.int64())))})

    points = rows.mapInArrow(collapse, "key long, size int, v binary, ids array<long>")
    dealt = points.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "v", "ids")
    index = materialize(dealt.groupBy("shard").applyInArrow(block, "shard int, size int, vs binary, ids array<array<long>>"), "shards")

    @tidy
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, block_rows):
                part: dict[int, list[tuple[int, bytes]]] = {}
                for i, v in zip(b.column("id").to_pylist()[s : s + block_rows], b.column("v")[s : s + block_rows]):
                    part.setdefault(len(v), []).append((i, v.values.to_numpy().tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((list(part), [[i for i, _ in p] for p in part.values()], [b"".join(v for _, v in p) for p in part.values()]), kinds)], schema=kinds)

    kinds = arrow_schema(spark, "size int, query_ids array<long>, qs binary")
    asked = rows.filter(F.col("id") % every == 0).dropDuplicates(["id"])
    asked = asked.mapInArrow(blocks, "size int, query_ids array<long>, qs binary").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    @tidy
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree, x = None, None, None
        for b in batches:
            for shard, size, vs, own, qids, qs in zip(*(b.column(c) for c in ("shard", "size", "vs", "ids", "query_ids", "qs"))):
                if last != (shard.as_py(), size.as_py()):
                    last = (shard.as_py(), size.as_py())
                    x = np.frombuffer(vs.as_py()).reshape(-1, last[1])
                    tree = VPTree(np.column_stack([x, np.sqrt(np.maximum(top - (x**2).sum(axis=1), 0))]))
                q, who = np.frombuffer(qs.as_py()).reshape(-1, last[1]), qids.values.to_numpy()
                # a query's own row is a point too, so one more than k
                pairs = tree.search(np.column_stack([q, np.zeros(len(q))]), min(k + 1, len(x)), factor)
                out = _nearest(q, who, x, pa.array(own.as_py(), pa.list_(pa.int64())), pairs, k)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, result)], schema=result)

    found = index.join(asked, ["shard", "size"]).sortWithinPartitions("shard", "size").mapInArrow(look, _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int = 20, every: int = 20) -> str:
    """The exact result of search(embeddings) in DuckDB's SQL, for vectors of one size."""
    return f"""with v as (select vec_id, embedding::double[] as e from embeddings where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (select q.vec_id as query_id, v.vec_id, list_dot_product(q.e, v.e) as score from v q join v on q.vec_id <> v.vec_id where q.vec_id % {every} = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s qualify rank <= {k}"""
