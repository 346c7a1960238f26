"""Merkle manifest of a table: a three-way hash tree per group, one over the groups, and a proof for every row.

Rows are numbered within their group from ranges of the sorted leaves. Every aligned subtree of ``HEIGHT`` levels is one
block, a row with its digests in van Emde Boas order: the top half of the levels first, then each
subtree below it, each laid out the same way, so that a path from leaf to root touches few stretches of the block whatever the
line or page size. Addresses come from arithmetic on (level, place) alone, for building and for the siblings of a proof.
The roots of the blocks are the leaves of the next layer, until one root per group is left; the roots of
the groups are hashed by the same layers. A proof goes down the layers: what a block's root needs is found once per
block and joined to the block below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .workers import map_arrow

ARITY = 3
#: levels of hashing within a block: 729 leaves
HEIGHT = 6

STEP = "struct<left: string, right: string>"


def complete_size(levels: int) -> int:
    """Nodes of a complete tree."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, place: np.ndarray) -> np.ndarray:
    """Where the nodes ``place`` of ``depth`` (0: the root) lie in a complete tree of so many levels."""
    base = np.zeros(len(place), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth, levels = depth - top, levels - top
        below = ARITY**depth
        base += complete_size(top) + place // below * complete_size(levels)
        place = place % below
    return base


def height_of(leaves: int) -> int:
    """Levels of hashing that bring ``leaves`` nodes to one."""
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


@lru_cache(64)
def layout(height: int, leaves: int) -> list[np.ndarray]:
    """Places of the nodes of each depth in the packed block; nodes that a block with few leaves lacks take no room."""
    found = [address(height + 1, d, np.arange(-(-leaves // ARITY ** (height - d)))) for d in range(height + 1)]
    rank = np.argsort(np.argsort(np.concatenate(found)))
    return np.split(rank, np.cumsum([len(x) for x in found])[:-1])


def build(leaves: list[str], height: int) -> list[str]:
    """The block of ``leaves`` (hex digests)."""
    places = layout(height, len(leaves))
    nodes = [""] * sum(map(len, places))
    level = leaves
    for depth in range(height, -1, -1):
        for at, node in zip(places[depth].tolist(), level, strict=True):
            nodes[at] = node
        if depth:
            level = [hashlib.sha256("".join(level[k : k + ARITY]).encode()).hexdigest() for k in range(0, len(level), ARITY)]
    return nodes


def siblings(nodes: list[str], height: int, leaves: int, place: int) -> list[tuple[str, str]]:
    """What stands left and right of the path from a leaf up to the block's root, level by level."""
    places = layout(height, leaves)
    out = []
    for depth in range(height, 0, -1):
        row, first = places[depth], place - place % ARITY
        out.append((
            "".join([nodes[row[k]] for k in range(first, place)]),
            "".join([nodes[row[k]] for k in range(place + 1, min(first + ARITY, len(row)))]),
        ))
        place //= ARITY
    return out


def _pack(nodes: list[str]) -> bytes:
    return bytes.fromhex("".join(nodes))


def _unpack(nodes: bytes) -> list[str]:
    text = nodes.hex()
    return [text[k : k + 64] for k in range(0, len(text), 64)]


def encoded(value: Column) -> Column:
    """``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """Hex sha256 of a row's encoded values."""
    return F.sha2(F.concat(*map(encoded, values)), 256)


def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``place`` (from 0) of every row within its ``group`` in the given order, and ``total``, the rows of its group.

    Rows are dealt by sampled ranges of (group, order), so a group of any size spreads over the tasks; one count per range and
    group moves rows' numbers on. Rows that agree in the whole order take any of their places, which then hold equal rows.
    """
    spark = leaves.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(c).asc_nulls_first() for c in ["group", *order]]
    dealt = leaves.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = stage(dealt.withColumn("seen", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("part", F.shiftright("seen", 33)).withColumn("seen", F.col("seen").bitwiseAND((1 << 33) - 1))
    counts = dealt.groupBy("group", "part").agg(F.count("*").alias("n"), F.min("seen").alias("low"))
    of_group = W.partitionBy("group")
    before = of_group.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(
        F.col("group").alias("its_group"), F.col("part").alias("its_part"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift"),
        F.sum("n").over(of_group).alias("total"))
    same = F.col("group").eqNullSafe(F.col("its_group")) & (F.col("part") == F.col("its_part"))
    return dealt.join(counts, same).select(*leaves.columns, (F.col("seen") + F.col("shift")).alias("place"), "total")


def _blocks(rows: DataFrame, kept: str) -> DataFrame:
    """Blocks of numbered ``leaf`` rows (``group``, ``place``, ``total``, ``leaf``, and the struct ``row``, kept per leaf)."""
    kind = rows.schema["group"].dataType.simpleString()
    size = ARITY**HEIGHT

    def run(batches: Iterator[pa.RecordBatch]):
        held: list = []
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(4))
            for group, place, total, leaf, row in zip(*columns, batch.column(4), strict=True):
                if held and (group != held[0][0] or place // size != held[0][1] // size):
                    yield close(held)
                    held = []
                held.append((group, place, total, leaf, row))
        if held:
            yield close(held)

    def close(held):
        group, place, total = held[0][:3]
        height = min(HEIGHT, height_of(total))
        nodes = build([x[3] for x in held], height)
        rows = pa.array([[x[4].as_py() for x in held]], pa.list_(held[0][4].type))
        return pa.RecordBatch.from_arrays(
            [pa.array([group], None if group is not None else pa.string()), pa.array([place // size], pa.int64()),
             pa.array([height], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([-(-total // size)], pa.int64()),
             pa.array([nodes[0]]), pa.array([_pack(nodes)], pa.binary()), rows],
            ["group", "block", "height", "leaves", "blocks", "root", "nodes", "rows"])

    dealt = rows.select("group", "place", "total", "leaf", "row").repartition("group", F.floor(F.col("place") / size))
    dealt = dealt.sortWithinPartitions("group", "place")
    shape = f"group {kind}, block long, height int, leaves long, blocks long, root string, nodes binary, rows array<{kept}>"
    return stage(map_arrow(dealt, run, shape))


def tree_layers(leaves: DataFrame, order: list[str]) -> list[DataFrame]:
    """The layers of blocks over ``leaves`` (``group``, ``leaf``, the struct ``row``, and the columns of the order), leaves' blocks first.

    The last layer holds one block per group. The table of a layer has 1/729 of the rows of the one below it.
    """
    rows = numbered(leaves, order)
    layers = [_blocks(rows, leaves.schema["row"].dataType.simpleString())]
    while layers[-1].where("blocks > 1").limit(1).count():
        # groups that have reached their root are done
        roots = layers[-1].where("blocks > 1").select(
            "group", F.col("block").alias("place"), F.col("blocks").alias("total"), F.col("root").alias("leaf"), F.struct("block").alias("row"))
        layers.append(_blocks(roots, "struct<block: bigint>"))
    return layers


def group_roots(layers: list[DataFrame]) -> DataFrame:
    """``group`` and ``root`` of every group."""
    tops = [x.where("blocks = 1").select("group", "root") for x in layers]
    out = tops[0]
    for x in tops[1:]:
        out = out.unionAll(x)
    return out


def proofs(layers: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """``group``, ``row`` and ``proof`` of every leaf: the texts of the siblings left and right of its path, level by level to the root.

    ``above`` (``group``, ``proof``) goes on from the root of each group.
    """
    kind = layers[0].schema["group"].dataType.simpleString()
    upper = None
    for k in range(len(layers) - 1, -1, -1):
        blocks = layers[k].withColumnRenamed("group", "g")
        top = F.lit(None).cast(f"array<{STEP}>")
        if upper is not None:
            at = upper.select(F.col("group").alias("g2"), F.col("row.block").alias("b2"), F.col("proof").alias("p2"))
            blocks = blocks.join(at, F.col("g").eqNullSafe(F.col("g2")) & (F.col("block") == F.col("b2")), "left")
            top = F.col("p2")
        if above is not None:
            end = above.select(F.col("group").alias("g3"), F.col("proof").alias("p3"))
            blocks = blocks.join(end, F.col("g").eqNullSafe(F.col("g3")), "left")
            top = F.when(F.col("blocks") == 1, F.col("p3")).otherwise(top)
        row = layers[k].schema["rows"].dataType.elementType.simpleString()
        blocks = blocks.select(F.col("g").alias("group"), "height", "leaves", "nodes", "rows", top.alias("top"))
        upper = map_arrow(blocks, _proofs_of_blocks, f"group {kind}, row {row}, proof array<{STEP}>")
    return upper


def _proofs_of_blocks(batches: Iterator[pa.RecordBatch]):
    step = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    for batch in batches:
        for k in range(batch.num_rows):
            group, height, leaves, nodes, rows, top = (batch.column(c)[k] for c in range(6))
            height, leaves = height.as_py(), leaves.as_py()
            nodes, top = _unpack(nodes.as_py()), [(s["left"], s["right"]) for s in top.as_py() or []]
            found = [siblings(nodes, height, leaves, place) + top for place in range(leaves)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([group.as_py()] * leaves, group.type), rows.values,
                 pa.array([[{"left": a, "right": b} for a, b in p] for p in found], step)], ["group", "row", "proof"])


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def build_manifest(docs: DataFrame, tampered: Column | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Proofs of all documents, and the manifest's layers of blocks (one table per layer; leaves first, groups last).

    A leaf is the digest of ``doc_id``, ``source``, ``lang``, ``n_chars`` and ``text``; leaves of a source ascend by ``doc_id`` (null
    first; rows with equal ids by their digest, so repeated rows have places of their own), sources ascend by their bytes, null
    first. The proofs hold ``doc_id``, ``leaf``, ``other`` (the digest with the text ``tampered``), ``subroot``, ``root``, ``proof``.
    Nulls are encoded as ``-``, empty texts as ``0:``; a table with one row has its leaf as root and an empty proof; no rows
    give no rows. Other columns play no part.
    """
    def leaf_with(text: Column) -> Column:
        return digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    own = leaf_with(F.col("text"))
    other = own if tampered is None else leaf_with(tampered)
    rows = docs.select(F.col("source").cast("string").alias("group"), "doc_id", own.alias("leaf"), other.alias("other"))
    rows = stage(rows.select("group", "doc_id", "leaf", F.struct("doc_id", "leaf", "other").alias("row")))
    layers = tree_layers(rows, ["doc_id", "leaf"])
    subroots = stage(group_roots(layers))
    tops = tree_layers(subroots.select(
        F.lit("").alias("group"), F.col("group").alias("name"), F.col("root").alias("leaf"),
        F.struct(F.col("group").alias("name"), F.col("root").alias("subroot")).alias("row")), ["name"])
    above = proofs(tops).select(F.col("row.name").alias("group"), "proof")
    root = group_roots(tops).agg(F.first("root").alias("root"))
    found = proofs(layers, above).select("group", "row.*", "proof")
    names = subroots.select(F.col("group").alias("its"), F.col("root").alias("subroot"))
    found = found.join(names, F.col("group").eqNullSafe(F.col("its")))
    found = found.select("doc_id", "leaf", "other", "subroot", root.scalar().alias("root"), "proof")
    return found, [*layers, *tops]


def proof_text(proof: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")
