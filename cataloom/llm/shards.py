"""Sharding by sampled splitters: near equal bytes, equal texts side by side.

Records are ordered by a hash of their text, then by ``doc_id``. Splitters are quantiles of a
sample that takes a record with a chance in proportion to its size. Ranges that hold more than
their share are subdivided, first by key and then, where one key is itself too large, by record.
The cells so made have bounded size; their sums give every record its exact place in bytes and
rows, and the place gives the shard. All work is DataFrame work on narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage


def _chance(doc_id: Column, key: Column) -> Column:
    """A fixed number in [0, 1) for a record."""
    return F.pmod(F.xxhash64(doc_id, key, F.lit(17)), F.lit(1 << 40)) / float(1 << 40)


def splitters(records: DataFrame, total: int, count: int, ranges: int, oversample: int = 32) -> list[int]:
    """At most ``ranges - 1`` keys that cut the records into ranges of about equal bytes.

    The sample holds about ``ranges * oversample`` records whatever the input; quantiles are taken
    where the sample lies, so only the splitters reach the driver. A record larger than the
    sampling step counts as often as it would be drawn.
    """
    if not total or not count:
        return []
    draws = F.col("size") * F.lit(ranges * oversample / total)
    times = F.floor(draws).cast("int") + (_chance(F.col("doc_id"), F.col("key")) < draws - F.floor(draws)).cast("int")
    sample = records.select("key", times.alias("times")).where("times > 0")
    wanted = [i / ranges for i in range(1, ranges)]
    points = ",".join(map(repr, wanted))
    row = sample.agg(F.expr(f"percentile(key, array({points}), times)").alias("cuts")).first()
    return sorted({int(x) for x in row["cuts"] or []})


def range_of(key: Column, cuts: list[int]) -> Column:
    """Number of splitters at or below ``key``, as a balanced tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, ranges_per_shard: int = 8, cells_per_shard: int = 32, cell_bytes: int = 64 << 20
) -> DataFrame:
    """One row per document row: ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Size is the UTF-8 bytes of the text plus 8 (8 for a null text, which goes with the empty one).
    Documents with the same text stay in one shard unless the group is larger than the largest
    document, in which case it may run on into the next shard. Shards differ by at most about
    two such documents. Repeated rows each get a slot; no rows give no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    records = stage(docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
    ))
    sums = records.agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("size").alias("m")).first()
    total, largest = sums["b"] or 0, sums["m"] or 0
    ranges = shards * ranges_per_shard
    cuts = splitters(records, total, sums["n"], ranges)
    cell = max(1, min(cell_bytes, total // (shards * cells_per_shard) or 1))

    # size of each range and of each key that is too large for one cell; equal keys combine before the shuffle
    records = records.withColumn("range", range_of(F.col("key"), cuts))
    keys = records.groupBy("range", "key").agg(F.sum("size").alias("bytes"))
    range_bytes = keys.groupBy("range").agg(F.sum("bytes").alias("range_bytes"))
    # a group up to the largest document lies whole in its cell: places are no coarser than that anyhow
    heavy = keys.where(F.col("bytes") > max(cell, largest)).select(
        F.col("key").alias("heavy_key"), F.ceil(F.col("bytes") / cell).cast("int").alias("parts"))
    celled = (
        records.join(F.broadcast(range_bytes), "range")  # as many rows as there are ranges
        .join(heavy, F.col("key") == F.col("heavy_key"), "left")
        .withColumn("by_key", F.pmod(F.xxhash64("key", F.lit(3)), F.ceil(F.col("range_bytes") / cell).cast("long")))
        .withColumn("by_row", F.pmod(F.xxhash64("doc_id", "key", F.lit(5)), F.coalesce("parts", F.lit(1)).cast("long")))
        .withColumn("by_row", F.when(F.col("heavy_key").isNull(), F.lit(-1).cast("long")).otherwise(F.col("by_row")))
        # a large key has cells of its own
        .withColumn("alone", F.when(F.col("heavy_key").isNull(), F.lit(0).cast("long")).otherwise(F.col("key")))
        .select("doc_id", "size", "text_crc32", "key", "range", "by_key", "alone", "by_row")
    )
    cell_columns = ["range", "by_key", "alone", "by_row"]
    cells = stage(celled.groupBy(cell_columns).agg(F.sum("size").alias("cell_bytes"), F.count("*").alias("cell_rows")))
    # prefix sums: over the cells of a range, then over the ranges
    inside = W.partitionBy("range").orderBy("by_key", "alone", "by_row").rowsBetween(W.unboundedPreceding, -1)
    whole = cells.groupBy("range").agg(F.sum("cell_bytes").alias("b"), F.sum("cell_rows").alias("r"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    starts = whole.select(
        "range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("range_byte"),
        F.coalesce(F.sum("r").over(before), F.lit(0)).alias("range_row"),
    )
    cells = cells.join(F.broadcast(starts), "range").select(
        *cell_columns,
        (F.col("range_byte") + F.coalesce(F.sum("cell_bytes").over(inside), F.lit(0))).alias("byte0"),
        (F.col("range_row") + F.coalesce(F.sum("cell_rows").over(inside), F.lit(0))).alias("row0"),
    )
    order = W.partitionBy(*cell_columns).orderBy("key", "doc_id", "size")
    running = order.rowsBetween(W.unboundedPreceding, -1)
    same = W.partitionBy(*cell_columns, "key")
    placed = (
        celled.withColumn("at", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("group_at", F.min("at").over(same))
        .withColumn("group_bytes", F.sum("size").over(same))
        .join(cells, cell_columns)
    )
    small_group = (F.col("alone") == 0) & (F.col("by_row") == -1) & (F.col("group_bytes") <= largest)
    middle = F.when(small_group, F.col("byte0") + F.col("group_at") + F.col("group_bytes") / 2).otherwise(
        F.col("byte0") + F.col("at") + F.col("size") / 2)
    placed = stage(placed.select(
        "doc_id", "size", "text_crc32", (F.col("row0") + F.col("nth")).alias("row"),
        F.least(F.floor(middle * shards / F.lit(max(total, 1))), F.lit(shards - 1)).cast("int").alias("shard"),
    ))
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"))
