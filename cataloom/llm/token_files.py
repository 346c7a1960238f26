"""Token-id files: ids in the fewest bits that hold the vocabulary.

A folder has ``blocks`` and ``offsets``. A block row holds the ids of whole documents, bit-packed
with ``width`` bits each, least significant bit first, and the ids and lengths of its documents;
``first`` counts the ids before it within its range of documents, and ``offsets`` has the number
of ids before each range. So any id is found by its place, and a block unpacks with a few
vectorised operations. Spark's writer commits the files, so a lost executor leaves no half file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import ROWS, _type
from .library import library_encoder, vocabulary_size
from .workers import map_arrow

BLOCK_IDS = 1 << 16

BLOCKS = (
    "part int, block int, first long, n_ids long, width int, payload binary, "
    "doc_ids array<{type}>, lengths array<long>"
)


def bits_for(size: int) -> int:
    """Bits that hold the ids 0 to ``size - 1``."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids (unsigned 32 bit) to ``width`` bits each."""
    if width % 8 == 0:
        return np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : width // 8]).tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, count: int, first: int = 0) -> np.ndarray:
    """``count`` ids from place ``first`` on; only the bytes that hold them are touched."""
    lo, hi = first * width, (first + count) * width
    raw = np.frombuffer(payload, np.uint8)[lo // 8 : (hi + 7) // 8]
    out = np.zeros((count, 4), np.uint8)
    if width % 8 == 0:
        out[:, : width // 8] = raw.reshape(count, width // 8)
        return out.view("<u4").ravel()
    bits = np.unpackbits(raw, bitorder="little")[lo % 8 : lo % 8 + count * width].reshape(count, width)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out[:, : packed.shape[1]] = packed
    return out.view("<u4").ravel()


def write_tokens(docs: DataFrame, path: str, end_id: int, folder: str, block_ids: int = BLOCK_IDS) -> None:
    """Encode every row's whole text (null: empty), close it with ``end_id``, write in ``doc_id`` order.

    Documents are dealt by ranges of ``doc_id``; ids move once, packed. Null ids of documents come
    first, rows with equal ids in the order of their length and tokens. A block holds at least one
    whole document and no further one beyond ``block_ids`` ids. No rows give an empty table.
    """
    spark = docs.sparkSession
    parts = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts)).first()
    cuts = np.array(sorted(set(row[0] or [])), np.int64)
    kind = _type(docs)
    width = bits_for(vocabulary_size(path))
    # whole bytes need no packing document by document
    id_bytes = width // 8 if width % 8 == 0 else 4

    def encoded(batches: Iterator[pa.RecordBatch]):
        e, end = library_encoder(path, id_bytes), end_id.to_bytes(id_bytes, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [x + end for x in e.encode_all(part.column(1))]
                sizes = [len(x) // id_bytes for x in ids]
                if width % 8:
                    ids = [pack(np.frombuffer(x, "<u4"), width) for x in ids]
                doc_ids = part.column(0)
                plain = doc_ids.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.searchsorted(cuts, plain, "right"), pa.int32()), doc_ids,
                     pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    ["part", "doc_id", "n", "packed"])

    def blocks(batches: Iterator[pa.RecordBatch]):
        names = [f.split()[0] for f in BLOCKS.format(type="long").split(", ")]
        part, block, first, held, n_ids = None, 0, 0, [], 0

        def close():
            nonlocal block, first, held, n_ids
            if width % 8:
                payload = pack(np.concatenate([unpack(p, width, n) for _, n, p in held]), width)
            else:
                payload = b"".join([p for _, _, p in held])
            values = (part, block, first, n_ids, width, payload, [d for d, _, _ in held], [n for _, n, _ in held])
            block, first, held, n_ids = block + 1, first + n_ids, [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        types = None
        for batch in batches:
            if types is None:
                types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
                         pa.list_(batch.schema.field("doc_id").type), pa.list_(pa.int64())]
            columns = (batch.column(k).to_pylist() for k in range(4))
            for p, doc_id, n, packed in zip(*columns, strict=True):
                if held and (p != part or n_ids + n > block_ids):
                    yield close()
                if p != part:
                    part, block, first = p, 0, 0
                held.append((doc_id, n, packed))
                n_ids += n
        if held:
            yield close()

    dealt = map_arrow(docs.select("doc_id", "text"), encoded, f"part int, doc_id {kind}, n long, packed binary")
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "n", "packed")
    map_arrow(dealt, blocks, BLOCKS.format(type=kind)).write.parquet(f"{folder}/blocks")
    ranges = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    ranges.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).write.parquet(
        f"{folder}/offsets")


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    offsets = spark.read.parquet(f"{folder}/offsets")
    return spark.read.parquet(f"{folder}/blocks").join(F.broadcast(offsets), "part").withColumn(
        "start", F.col("start") + F.col("first"))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids``."""
    found = _blocks(spark, folder).select("start", "n_ids", "width", "payload", "doc_ids", "lengths")
    kind = found.schema["doc_ids"].dataType.elementType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for k in range(batch.num_rows):
                start, n_ids, width, payload, doc_ids, lengths = (c[k].as_py() for c in batch.columns)
                ids = unpack(payload, width, n_ids)
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(4)[k].values, pa.array(start + ends - lengths, pa.int64()),
                     pa.array(lengths, pa.int64()),
                     pa.array([ids[e - n : e].tobytes() for e, n in zip(ends, lengths, strict=True)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return map_arrow(found, rows, f"doc_id {kind}, start long, n_tokens long, ids binary")


def read_span(spark: SparkSession, folder: str, first: int, count: int) -> np.ndarray:
    """``count`` ids from place ``first`` of the whole collection on; reads only the blocks that hold them."""
    hit = _blocks(spark, folder).where(
        (F.col("start") < first + count) & (F.col("start") + F.col("n_ids") > first)
    ).select("start", "n_ids", "width", "payload").orderBy("start").collect()
    out = [
        unpack(bytes(r.payload), r.width, min(r.n_ids, first + count - r.start) - max(0, first - r.start),
               max(0, first - r.start))
        for r in hit
    ]
    return np.concatenate(out) if out else np.zeros(0, "<u4")
