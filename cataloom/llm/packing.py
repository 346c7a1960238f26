"""Best-fit packing with large-item matching.

Only lengths decide a packing, so the plan is made from the number of pieces of each length:
a table of at most ``capacity`` rows, however many documents there are. Pieces above a third of
the capacity meet at most twice in a sequence: from the longest down, each takes the longest
partner that fits. The others, from the longest down, go into the smallest gap that takes them.
The plan says, for ranks of a length, in which sequences and at which offset they lie; pieces are
ranked within their length and joined to it.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import _columns, _type
from .library import library_encoder
from .workers import map_arrow

CAPACITY = 2048


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: full ones, the first one shorter if need be."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned 32 bit).

    Every row's whole text (null: empty) is encoded by the tokenizers library and closed with
    ``end_id``, so each document has at least one piece. Repeated rows are packed as often as they
    come; null ids of documents pass through; other columns are not read.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches):
        e = library_encoder(path)
        for doc_ids, texts in _columns(batches):
            rows = [
                (k, i, start, n, ids[4 * start : 4 * (start + n)])
                for k, ids in enumerate(x + end for x in e.encode_all(texts))
                for i, (start, n) in enumerate(cut(len(ids) // 4, capacity))
            ]
            if not rows:
                continue
            k, i, start, n, ids = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(k)), pa.array(i, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "piece", "start", "length", "ids"])

    return map_arrow(
        docs.select("doc_id", "text"), run,
        f"doc_id {_type(docs)}, piece int, start long, length long, ids binary")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, offset): rank ``first + j`` goes to sequence ``+ j``."""
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    left = {s: c for s, c in counts.items() if c}
    rank = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free room: runs of sequences (first, number)
    sizes: list[int] = []  # the gaps there are, ascending
    opened = 0

    def put(size: int, number: int, first: int, offset: int) -> None:
        rows.append((size, rank[size], rank[size] + number, first, offset))
        rank[size] += number
        left[size] -= number

    def leave(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, number))

    large = sorted(s for s in left if 3 * s > capacity)
    for size in reversed(large):
        while left[size]:
            partner, number = 0, left[size]
            for k in range(bisect_left(large, capacity - size + 1) - 1, -1, -1):
                other = large[k]
                if other == size and left[size] > 1:
                    partner, number = size, left[size] // 2
                    break
                if other < size and left[other]:
                    partner, number = other, min(left[size], left[other])
                    break
            put(size, number, opened, 0)
            if partner:
                put(partner, number, opened, size)
            leave(capacity - size - partner, opened, number)
            opened += number
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            k = bisect_left(sizes, size)
            if k == len(sizes):
                each = capacity // size
                number = left[size] // each or 1
                there = min(each, left[size])
                for j in range(there):
                    put(size, number, opened, j * size)
                leave(capacity - there * size, opened, number)
                opened += number
                continue
            gap = sizes[k]
            first, number = gaps[gap].pop()
            taken = min(number, left[size])
            if number > taken:
                gaps[gap].append((first + taken, number - taken))
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(k)
            put(size, taken, first, capacity - gap)
            leave(gap - size, first, taken)
    return rows


def best_fit(parts: DataFrame, key: list[str], capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset`` (both long) added.

    ``key`` orders pieces of one length; rows with equal keys get places of their own. The plan
    that is broadcast has a number of rows that the capacity bounds, not the input. ``parts`` is
    read several times and should be a written table. No rows give no rows.
    """
    spark = parts.sparkSession
    counts = {r[0]: r[1] for r in parts.groupBy(length).count().collect()}  # at most ``capacity`` rows
    rows = plan(counts, capacity)
    planned = spark.createDataFrame(rows, "pack_length long, rank0 long, rank1 long, bin0 long, offset long")
    # rank within a length, by way of slices so that no length is ranked in one task
    slices = max(16, min(4096, sum(counts.values()) // 200_000))
    cell = [F.col(length), F.col("pack_slice")]
    sliced = parts.withColumn("pack_slice", F.pmod(F.xxhash64(*key), F.lit(slices)).cast("int"))
    before = W.partitionBy(length).orderBy("pack_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sliced.groupBy(*cell).count().select(
        F.col(length).alias("at_length"), F.col("pack_slice").alias("at_slice"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("pack_start"))
    ranked = sliced.withColumn("pack_rank", F.row_number().over(W.partitionBy(*cell).orderBy(*key)) - 1)
    ranked = ranked.join(
        starts, (F.col(length) == F.col("at_length")) & (F.col("pack_slice") == F.col("at_slice"))
    ).withColumn("pack_rank", F.col("pack_rank") + F.col("pack_start"))
    return ranked.join(
        F.broadcast(planned),
        (F.col(length) == F.col("pack_length")) & (F.col("pack_rank") >= F.col("rank0"))
        & (F.col("pack_rank") < F.col("rank1")),
    ).select(
        *parts.columns, (F.col("bin0") + F.col("pack_rank") - F.col("rank0")).alias("sequence_id"), F.col("offset"))
