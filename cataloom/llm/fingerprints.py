"""Document fingerprints: SimHash with signed votes of weighted terms, and block tables for search.

Terms are pairs of neighbouring words (``A-Z`` lower-cased; a text of one word has that word as its
term). A term that occurs f times weighs ``1 + log2 f``, in quarters. Each of the 64 bits is 1 where the
terms whose hash has the bit outweigh the others. A text without words has the fingerprint 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ROWS, _type
from .shards import range_of
from .words import per_row, windows, word_hashes
from .workers import map_arrow

BITS = 64
VOTES = 1 << 15  # terms that vote at a time
FIRST = -(1 << 63)  # a null document id comes before all others


def simhash(texts: pa.Array) -> np.ndarray:
    """Fingerprints (unsigned 64 bit) of a string column."""
    rows, words = word_hashes(texts)
    out = np.zeros(len(texts), np.uint64)
    for k, terms in enumerate(per_row(*windows(rows, words, 2), len(texts))):
        if not len(terms):
            continue
        terms, times = np.unique(terms, return_counts=True)
        weight = np.round(4 + 4 * np.log2(times))
        votes = np.zeros(BITS)
        for at in range(0, len(terms), VOTES):
            part = terms[at : at + VOTES]
            bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS)
            votes += weight[at : at + VOTES].astype(np.float32) @ bits.astype(np.float32)
        out[k] = np.packbits(2 * votes > weight.sum(), bitorder="little").view(np.uint64)[0]
    return out


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) of every row's whole ``text`` (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(simhash(part.column(1)).view(np.int64))], ["doc_id", "fingerprint"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {_type(docs)}, fingerprint long")


def likeness(a, b):
    """Share of equal bits of two fingerprint columns, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / float(BITS)


def within_radius(queries: DataFrame, all_prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All (``query``, ``fingerprint``) that differ in at most ``radius`` bits.

    The bits fall into ``blocks`` blocks, of which at least ``blocks - radius`` must be equal: one
    table for each choice of so many blocks, keyed by their bits, finds every such pair. Both inputs
    have a long column of that name; they are reduced to distinct values first, so copies meet once.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("radius must be below the number of blocks")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)

    def tables(df: DataFrame, name: str) -> DataFrame:
        entries = F.array(*(
            F.struct(F.lit(t).alias("t"), F.col(name).bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)
        ))
        return df.select(name).where(F.col(name).isNotNull()).distinct().select(name, F.explode(entries).alias("e")).select(
            name, "e.t", "e.key")

    met = tables(queries, "query").join(tables(all_prints, "fingerprint"), ["t", "key"])
    close = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint"))) <= radius
    return met.where(close).select("query", "fingerprint").distinct()


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form and of the next document's text.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many (or all) of
    the next document's, in ascending ``doc_id``; after the last comes the first. Columns: ``doc_id``,
    ``n_chars``, ``edited``, ``fingerprint``, ``edited_fingerprint``, ``next_fingerprint`` (long). Texts move
    once, by ranges of ``doc_id``; the first document of a range is also sent to the range before.
    Null ids come first, rows with equal ids in the order of their texts; null texts are empty.
    """
    spark = docs.sparkSession
    kind = _type(docs)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
    parts = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = keyed.agg(
        F.min("key"), F.percentile_approx("key", [i / parts for i in range(1, parts)], 10 * parts)).first()
    first = row[0]
    # quantiles are keys that occur, so each one is the first of its range
    cuts = sorted(set(row[1] or []) - {first})
    dealt = keyed.withColumn("part", range_of(F.col("key"), cuts)).withColumn("tail", F.lit(0))
    heads = keyed.where(F.col("key").isin([first, *cuts])) if first is not None else keyed.limit(0)
    heads = heads.withColumn("part", F.pmod(range_of(F.col("key"), cuts) - 1, F.lit(len(cuts) + 1))).withColumn(
        "tail", F.lit(1))
    dealt = dealt.unionByName(heads).repartition(parts, "part").sortWithinPartitions("part", "tail", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[tuple] = []  # (doc_id, text) in order; the last one only follows
        part = None
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(4))
            for doc_id, text, p, tail in zip(*columns, strict=True):
                if p != part:
                    held, part = [], p
                if tail:
                    if len(held):
                        yield edited([*held, (doc_id, text)])
                    held = []  # further rows of the same id lie in the next range
                    continue
                held.append((doc_id, text))
                if len(held) > ROWS:
                    yield edited(held)
                    held = held[-1:]

    def edited(held: list[tuple]) -> pa.RecordBatch:
        texts = [x[1] for x in held]
        changed = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, texts[1:], strict=False)]
        prints = simhash(pa.array(texts, pa.string())).view(np.int64)
        other = simhash(pa.array(changed, pa.string())).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in held[:-1]], types[kind]), pa.array(map(len, texts[:-1]), pa.int64()),
             pa.array(changed, pa.string()), pa.array(prints[:-1]), pa.array(other), pa.array(prints[1:])],
            ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint"])

    types = {"bigint": pa.int64(), "int": pa.int32()}
    return map_arrow(
        dealt.select("doc_id", "text", "part", "tail"), run,
        f"doc_id {kind}, n_chars long, edited string, fingerprint long, edited_fingerprint long, next_fingerprint long")
