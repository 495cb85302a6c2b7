"""Size-balanced shards by sampled splitters, in DataFrame functions only.

Records are ordered by (hash of their text, doc_id), so equal texts are neighbours. Every record enters the sample with a
chance in proportion to its size; quantiles of the sample bound fine ranges of the text key. Ranges that turn out overfull
(one text may hold a third of all rows) are subdivided by a second hash of the row, finer as they are fuller. Within a fine range,
records are numbered and their bytes summed; with the totals of all fine ranges that gives every record its place in the
whole order, and the shard is the sixteenth (1 / shards) of all bytes that the place falls into. A group of equal texts of
less than a hundredth of a shard stays in one shard.

Null texts count as empty (size 1); repeated rows are placed as often as they occur; null ids sort first; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.tables import drop_cut
from .common import materialize


def _step(splitters: list[int], key: Column) -> Column:
    """How many splitters are at or below key, by two levels of about sqrt(n) comparisons."""
    width = max(1, round(len(splitters) ** 0.5))
    tops = splitters[::width]
    blocks = [splitters[i : i + width] for i in range(0, len(splitters), width)]

    def count(xs: Column) -> Column:
        return F.size(F.filter(xs, lambda x: x <= key))

    top = count(F.array(*map(F.lit, tops)))
    inner = F.element_at(F.array(*[F.array(*map(F.lit, b)) for b in blocks]), top)
    return F.when(top == 0, 0).otherwise((top - 1) * width + count(inner)).cast("int")


def shard(docs: DataFrame, shards: int = 16, ranges: int = 1024, sample: int = 16384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard).

    ranges: fine ranges; sample: the expected number of sampled keys that the driver sees; both bound what it holds.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.xxhash64(text).alias("text_key"))
    rows = materialize(rows.withColumn("copy", F.monotonically_increasing_id()), "sizes")  # copy parts rows that are alike in all else
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(sample / max(total, 1)))
    unit = F.pmod(F.xxhash64(F.lit(7), "doc_id", "text_key"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = [r[0] for r in rows.filter(unit < chance).select("text_key").orderBy("text_key").collect()]
    splitters = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []
    placed = rows.withColumn("range", _step(splitters, F.col("text_key")) if splitters else F.lit(0))
    # Overfull ranges are subdivided; equal texts are then apart only within such ranges.
    full = placed.groupBy("range").agg(F.sum("size").alias("b")).filter(F.col("b") > 4 * max(total // ranges, 1)).collect()
    parts = {r["range"]: int(r["b"] * ranges // max(total, 1)) + 1 for r in full}
    part = F.lit(0)
    if parts:
        finer = F.element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("range"))
        part = F.coalesce(F.pmod(F.xxhash64(F.lit(11), "doc_id", "text_crc32", "copy"), finer), F.lit(0)).cast("int")
    placed = placed.withColumn("part", part)
    fine, order = ["range", "part"], ["text_key", "doc_id"]
    win = Window.partitionBy(*fine).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*fine, "text_key")
    placed = placed.withColumns({"before": F.coalesce(F.sum("size").over(win), F.lit(0)), "nth": F.count("size").over(win)})
    placed = placed.withColumns({"group_at": F.min("before").over(group), "group_size": F.sum("size").over(group)})
    # At most a row for each fine range.
    sums = placed.groupBy(*fine).agg(F.sum("size").alias("b"), F.count("*").alias("n")).orderBy(*fine).collect()
    first, at, n = [], 0, 0
    for r in sums:
        first.append((r["range"], r["part"], at, n))
        at, n = at + r["b"], n + r["n"]
    spark = docs.sparkSession
    starts = F.broadcast(spark.createDataFrame(first, "range int, part int, range_at long, range_n long"))
    whole = F.col("group_size") * 100 * shards <= F.lit(total)
    middle = F.col("range_at") + F.when(whole, F.col("group_at") + F.expr("group_size div 2")).otherwise(F.col("before") + F.expr("size div 2"))
    out = placed.join(starts, fine).select("doc_id", "size", "text_crc32", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(max(total, 1)))).cast("int").alias("shard"), (F.col("range_n") + F.col("nth")).alias("place"))
    out = materialize(out, "shards")
    begin = F.broadcast(out.groupBy("shard").agg(F.min("place").alias("begin")))  # a row for each shard
    drop_cut(rows)
    return out.join(begin, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("begin")).alias("slot"))
