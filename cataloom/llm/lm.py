"""LM scoring with a weighted backoff automaton of order two.

States are the empty history and one for each word seen in training. From the state of a word v, an arc
for every w that followed it in training bears ``l(v) c(v, w) / c(v) + (1 - l(v)) P(w)``; for any other w the
failure arc to the empty state bears ``1 - l(v)`` and the empty state's arc ``P(w)``. ``P`` is the smoothed
unigram ``(c + 0.1) / (N + 0.1 (V + 1))``, the last share of which stands for all unknown words. With
``l(v) = WEIGHT c(v) / (c(v) + DAMP)`` the arcs of each state sum to one. A text starts in the empty state; each word leads to its
own state, or to the empty one if training has not seen it; the text's end is a token that has no state.

Words are counted in blocks of documents. A block sends the hashes of its distinct words, then word pairs,
to the partition of the hash, which adds the counts of all blocks and sends the totals back: so each key
moves once per block, a frequent one as cheaply as a rare one, and no task holds the vocabulary.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage, staging_path
from .bpe import _type
from .token_files import pack, unpack
from .words import mix, word_hashes
from .workers import map_arrow

BLOCK_TOKENS = 1_000_000
WEIGHT, DAMP = 0.5, 1.0
END = np.uint64(0x5851F42D4C957F2D)  # hash of the end token
_LEFT, _RIGHT = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E3779B97F4A7C15)

BLOCK = (
    "block long, doc_ids array<{type}>, lengths binary, held binary, words binary, counts binary, "
    "width int, places binary, trained long"
)


def _blocks(docs: DataFrame) -> DataFrame:
    """Documents as blocks: distinct words (sorted hashes), their counts in training, and the places of all words."""
    kind = _type(docs)
    names = [x.split()[0] for x in BLOCK.format(type=kind).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]):
        base, n, held = TaskContext.get().partitionId() << 32, 0, []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, words = word_hashes(part.column(1))
                lengths = np.bincount(rows, minlength=part.num_rows)
                held.append((part.column(0), lengths, part.column(2).to_numpy(zero_copy_only=False), words))
                size += len(words) + part.num_rows
                if size >= BLOCK_TOKENS:
                    yield block(base + n, held)
                    n, held, size = n + 1, [], 0
        if held:
            yield block(base + n, held)

    def block(number: int, held: list) -> pa.RecordBatch:
        doc_ids = pa.concat_arrays([x[0] for x in held])
        lengths = np.concatenate([x[1] for x in held])
        out = np.concatenate([x[2] for x in held]).astype(bool)
        words, places = np.unique(np.concatenate([x[3] for x in held]), return_inverse=True)
        counts = np.bincount(places[~np.repeat(out, lengths)], minlength=len(words))
        width = 8 * max(1, (max(1, len(words) - 1).bit_length() + 7) // 8)
        values = [number, doc_ids.to_pylist(), lengths.astype("<i8").tobytes(), out.tobytes(), words.tobytes(),
                  counts.astype("<i8").tobytes(), width, pack(places.astype("<u4"), width), int((~out).sum())]
        types = [pa.int64(), pa.list_(doc_ids.type), *[pa.binary()] * 4, pa.int32(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    # a document is held out if the crc32 of its id, as text, ends in 0; a null id is for training
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return map_arrow(docs.select("doc_id", "text", out.alias("held")), run, BLOCK.format(type=kind))


def _requests(number: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch | None:
    """Sorted keys of a block, cut by their partition."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    edges = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(edges))
    cut = [(edges[p], edges[p + 1]) for p in full]
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), pa.array(np.full(len(full), number), pa.int64()),
         pa.array([keys[a:b].tobytes() for a, b in cut], pa.binary()),
         pa.array([counts[a:b].astype("<i8").tobytes() for a, b in cut], pa.binary())],
        ["part", "block", "keys", "counts"])


REQUEST = "part int, block long, keys binary, counts binary"


def _totals(requests: DataFrame, parts: int, kind: str) -> DataFrame:
    """The total of each requested key over all blocks, per block; a row of block -1 has the number of keys with
    a total and their sum for each partition."""

    def run(batches: Iterator[pa.RecordBatch]):
        part, held = None, []
        for batch in batches:
            for p, number, keys, counts in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if p != part:
                    yield from close(part, held)
                    part, held = p, []
                held.append((number, np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<i8")))
        yield from close(part, held)

    def close(part, held):
        if not held:
            return
        keys, where = np.unique(np.concatenate([x[1] for x in held]), return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, where, np.concatenate([x[2] for x in held]))
        ends = np.cumsum([len(x[1]) for x in held])[:-1]
        answers = [totals[w].astype(kind).tobytes() for w in np.split(where, ends)]
        n = len(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in held] + [-1], pa.int64()), pa.array([part] * (n + 1), pa.int32()),
             pa.array([*answers, None], pa.binary()), pa.array([None] * n + [int((totals > 0).sum())], pa.int64()),
             pa.array([None] * n + [int(totals.sum())], pa.int64())], ["block", "part", "totals", "distinct", "sum"])

    dealt = requests.repartition(parts, "part").sortWithinPartitions("part")
    return map_arrow(dealt, run, "block long, part int, totals binary, distinct long, sum long")


def _per_block(replies: DataFrame, name: str) -> DataFrame:
    """The answers of a block in the order of its sorted keys; a block has a bounded number of keys."""
    rows = F.array_sort(F.collect_list(F.struct("part", "totals")))
    return replies.where("block >= 0").groupBy("block").agg(
        F.transform(rows, lambda x: x["totals"]).alias(name))


class Block:
    """A block row with its totals: tokens in order, with the end of each document."""

    def __init__(self, row: dict, trained: int):
        self.words = np.frombuffer(row["words"], "<u8")
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.held = np.frombuffer(row["held"], bool)
        self.totals = np.frombuffer(b"".join(row["word_totals"] or []), "<i8")
        n, end = int(self.lengths.sum()), len(self.words)
        ends = np.cumsum(self.lengths + 1) - 1
        # tokens are places in ``words``; the end token is one beyond
        self.tokens = np.full(n + len(ends), end, np.int64)
        inside = np.ones(len(self.tokens), bool)
        inside[ends] = False
        self.tokens[inside] = unpack(row["places"], row["width"], n) if n else 0
        self.ends = ends
        self.starts = ends - self.lengths
        self.count = np.append(self.totals, trained)  # training count of each token
        # state before each token: the word before it, or -1 for the empty history
        self.state = np.concatenate([[-1], self.tokens[:-1]]) if len(self.tokens) else self.tokens
        self.state[self.starts] = -1
        self.state[(self.state >= 0) & (self.count[self.state] == 0)] = -1

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of tokens whose pair is looked up, sorted keys, key of each such token)."""
        at = np.flatnonzero((self.state >= 0) & (self.count[self.tokens] > 0))
        hashes = np.append(self.words, END)
        codes, where = np.unique(self.state[at] * len(hashes) + self.tokens[at], return_inverse=True)
        keys = mix(hashes[codes // len(hashes)] * _LEFT ^ mix(hashes[codes % len(hashes)] * _RIGHT))
        order = np.argsort(keys, kind="stable")
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        return at, keys[order], rank[where]


def score(docs: DataFrame, weight: float = WEIGHT, damp: float = DAMP) -> DataFrame:
    """Per document row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Trains on every whole text whose document is not held out and scores all whole texts (null: empty).
    An empty text is its end token alone. Repeated rows count and are scored each time. Without any training
    document all counts are 0 and every token is unknown; no rows give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = _type(docs)
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # bucketed by block, so that only answers move when they meet their block
    table = f"cataloom_blocks_{uuid.uuid4().hex}"
    _blocks(docs).write.option("compression", "zstd").option("path", staging_path(spark)).bucketBy(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(table)
    blocks = spark.table(table)

    def ask_words(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for number, words, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                yield _requests(number, np.frombuffer(words, "<u8"), np.frombuffer(counts, "<i8"), parts)

    asked = map_arrow(blocks.select("block", "words", "counts"), ask_words, REQUEST)
    words = stage(_totals(asked, parts, "<i8"), "zstd")
    sums = words.where("block = -1").agg(F.sum("distinct").alias("v"), F.sum("sum").alias("n")).first()
    trained = blocks.agg(F.sum("trained")).first()[0] or 0
    # the end of a training text is a token like its words
    n, v = (sums["n"] or 0) + trained, (sums["v"] or 0) + (trained > 0)
    columns = ["block", "lengths", "held", "words", "width", "places"]
    with_words = blocks.select("doc_ids", *columns).join(_per_block(words, "word_totals"), "block", "left")

    def ask_pairs(batches: Iterator[pa.RecordBatch]):
        for row in _rows(batches):
            b = Block(row, trained)
            at, keys, which = b.pairs()
            taught = ~b.held[np.searchsorted(b.ends, at)]
            yield _requests(row["block"], keys, np.bincount(which[taught], minlength=len(keys)), parts)

    asked = map_arrow(with_words.select(*columns, "word_totals"), ask_pairs, REQUEST)
    pairs = stage(_totals(asked, parts, "<f4"), "zstd")
    joined = with_words.join(_per_block(pairs, "pair_totals"), "block", "left")

    def run(batches: Iterator[pa.RecordBatch]):
        for row in _rows(batches):
            b = Block(row, trained)
            count = b.count[b.tokens].astype(float)
            p = (count + 0.1) / (n + 0.1 * (v + 1))
            # failure arc of each state; the empty state needs none
            seen = np.where(b.state >= 0, b.count[b.state], 0).astype(float)
            share = weight * seen / (seen + damp)
            arc = np.zeros(len(p))
            at, keys, which = b.pairs()
            arc[at] = np.frombuffer(b"".join(row["pair_totals"] or []), "<f4")[which]
            arc = share * arc / np.maximum(seen, 1) + (1 - share) * p
            sums = [np.add.reduceat(np.log10(x), b.starts) if len(x) else x for x in (p, arc)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], ids), pa.array(b.held), pa.array(b.lengths + 1),
                 pa.array(np.add.reduceat((count > 0).astype(np.int64), b.starts)),
                 pa.array(np.full(len(b.starts), n), pa.int64()), pa.array(sums[0]), pa.array(sums[1])],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    ids = pa.int32() if kind == "int" else pa.int64()
    return map_arrow(
        joined.select("doc_ids", *columns, "word_totals", "pair_totals"), run,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}
