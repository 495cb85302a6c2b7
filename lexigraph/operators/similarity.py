"""Names as hashed n-gram vectors, and the exact similarity join over them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..functions.text import ngrams
from ..plans.tables import cut


def _blake_bucket(dimensions: int):
    @F.pandas_udf(IntegerType())
    def bucket(s: pd.Series) -> pd.Series:
        return s.map(lambda g: int.from_bytes(hashlib.blake2b(g.encode(), digest_size=4).digest(), "big") % dimensions)

    return bucket


def md5_bucket(gram: Column, dimensions: int) -> Column:
    return (F.conv(F.substring(F.md5(gram.cast("binary")), 1, 8), 16, 10).cast("bigint") % dimensions).cast("int")


def vectors(names: DataFrame, dimensions: int = 256, n: int = 3, hashing: str = "blake2b", name: str = "name") -> DataFrame:
    """(name, bucket, cnt) of the distinct names. Each distinct n-gram is hashed once."""
    grams = names.select(F.col(name).alias("name")).distinct().withColumn("gram", F.explode(ngrams("name", n)))
    if hashing == "md5":
        placed = grams.withColumn("bucket", md5_bucket(F.col("gram"), dimensions))
    else:
        table = grams.select("gram").distinct().withColumn("bucket", _blake_bucket(dimensions)("gram"))
        placed = grams.join(table, "gram")
    return placed.groupBy("name", "bucket").agg(F.count("*").alias("cnt"))


def pairs(vecs: DataFrame, floor: float) -> DataFrame:
    """(left, right, dot, similarity) of all pairs with left < right and a cosine of floor at least.

    Counts are not negative, so a pair over a positive floor shares a bucket. Buckets are taken from the rarest to the
    most frequent, and a name only offers the prefix of its buckets without which it could not reach the floor (what is left has a
    squared length under floor squared of the whole); the most frequent buckets are in no prefix. A candidate's dot
    product is then computed over all buckets, in whole numbers.
    """
    if floor <= 0:
        raise ValueError("the floor must be positive")
    freq = vecs.groupBy("bucket").agg(F.count("*").alias("df"))
    w = vecs.join(F.broadcast(freq), "bucket")  # as many rows as dimensions
    rest = Window.partitionBy("name").orderBy("df", "bucket").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy("name")
    w = w.withColumns({"left_over": F.sum(F.col("cnt") * F.col("cnt")).over(rest), "norm2": F.sum(F.col("cnt") * F.col("cnt")).over(whole)})
    offered = w.filter(F.col("left_over") >= F.lit(floor * floor * (1 - 1e-9)) * F.col("norm2")).select("name", "bucket", "df", "norm2")
    one, two = (offered.select(F.col("name").alias(s), F.col("bucket").alias("b"), F.col("norm2").alias(f"n_{s}")) for s in ("left", "right"))
    met = one.join(two, "b").filter("left < right").select("left", "right", "n_left", "n_right").distinct()
    a, b = (vecs.groupBy(F.col("name").alias(s)).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "cnt"))).alias(f"v_{s}")) for s in ("left", "right"))
    dot = F.aggregate(F.map_keys("v_left"), F.lit(0).cast("bigint"), lambda t, k: t + F.element_at("v_left", k) * F.coalesce(F.try_element_at("v_right", k), F.lit(0)))
    got = met.join(a, "left").join(b, "right").withColumn("dot", dot)
    return got.withColumn("similarity", F.col("dot") / F.sqrt((F.col("n_left") * F.col("n_right")).cast("double"))).filter(F.col("similarity") >= floor).select("left", "right", "dot", "similarity")


def dense(vecs: DataFrame, dimensions: int = 256) -> DataFrame:
    """(name, embedding): unit vectors of doubles, for readers that want arrays."""
    m = F.map_from_entries(F.collect_list(F.struct("bucket", "cnt")))
    got = vecs.groupBy("name").agg(m.alias("m"), F.sqrt(F.sum(F.col("cnt") * F.col("cnt")).cast("double")).alias("norm"))
    return got.select("name", F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)) / F.col("norm")).alias("embedding"))


def dense_pairs(vecs: DataFrame, floor: float, block_rows: int = 4096) -> DataFrame:
    """(left_id, right_id, similarity) of all pairs of rows (id, v array<double>) with left_id < right_id and a cosine of floor at least.

    Exact: rows are dealt into blocks by their ids, and every two blocks meet. Pairs near the floor or over it are scored anew,
    component by component. Vectors that are empty, zero or not all finite have no pair, nor do vectors of different sizes.
    """
    if floor <= 0:
        raise ValueError("the floor must be positive")
    spark = vecs.sparkSession
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = vecs.select(F.col("id").cast("bigint").alias("id"), "v").filter(F.col("id").isNotNull() & ok)
    n = max(1, -(-rows.count() // block_rows))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pack(t: pa.Table) -> pa.Table:
        v = t.column("v").combine_chunks().flatten().to_numpy()
        ids = t.column("id").to_numpy().astype(np.int64)
        return pa.table({"size": t.column("size")[:1], "block": t.column("block")[:1], "ids": pa.array([ids.tobytes()], pa.binary()), "vs": pa.array([v.tobytes()], pa.binary())})

    dealt = rows.select(F.size("v").alias("size"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("block"), "id", "v")
    blocks = cut(dealt.groupBy("size", "block").applyInArrow(pack, "size int, block int, ids binary, vs binary"), "blocks")
    names = ["size", "l", "r"]
    left = blocks.select("size", F.col("block").alias("l"), F.explode(F.sequence("block", F.lit(n - 1))).alias("r"), F.col("ids").alias("x_ids"), F.col("vs").alias("xs"))
    right = blocks.select("size", F.explode(F.sequence(F.lit(0), "block")).alias("l"), F.col("block").alias("r"), F.col("ids").alias("y_ids"), F.col("vs").alias("ys"))
    met = left.repartition(parts, *names).join(right.repartition(parts, *names).hint("merge"), names)

    def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros(len(v))
        for k in range(v.shape[1]):
            total += v[:, k] * v[:, k]
        return np.sqrt(total), v / np.sqrt(total)[:, None]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for size, l, r, x_ids, xs, y_ids, ys in zip(*(b.column(c).to_pylist() for c in (*names, "x_ids", "xs", "y_ids", "ys"))):
                x, y = (np.frombuffer(v).reshape(-1, size) for v in (xs, ys))
                i, j = np.frombuffer(x_ids, np.int64), np.frombuffer(y_ids, np.int64)
                (nx, ux), (ny, uy) = unit(x), unit(y)
                for at in range(0, len(x), 256):
                    p, q = np.nonzero(ux[at : at + 256] @ uy.T >= floor - 1e-9)
                    p += at
                    if l == r:
                        p, q = p[i[p] < j[q]], q[i[p] < j[q]]
                    for k in range(0, len(p), 65536):
                        a, c = p[k : k + 65536], q[k : k + 65536]
                        dot = np.zeros(len(a))
                        for d in range(size):
                            dot += x[a, d] * y[c, d]
                        s = dot / (nx[a] * ny[c])
                        a, c, s = a[s >= floor], c[s >= floor], s[s >= floor]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i[a], j[c])), pa.array(np.maximum(i[a], j[c])), pa.array(s)], names=["left_id", "right_id", "similarity"])

    return met.select(*names, "x_ids", "xs", "y_ids", "ys").mapInArrow(score, "left_id bigint, right_id bigint, similarity double")
