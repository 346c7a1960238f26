"""N-gram Jaccard join with several global token orders.

A text's tokens are its distinct windows of ``SIZE`` words. Texts whose sets have a Jaccard similarity of
``PERCENT`` / 100 or more share, under every global order of the tokens, one of the first ``n - ceil(n PERCENT / 100) + 1``
of each. Three orders are intersected before a pair is verified:

1. rarity: tokens whose hash lies in the lower ``LOW`` part of the hash range, the rarest first, then the others. Only
   that part, or as much as a prefix needs, is counted. Texts whose prefix holds only tokens of their own drop out; the others
   meet in the buckets of their prefix tokens.
2. hash, ascending: of the tokens in the lower part a pair must share as many as the rest cannot make up for.
3. hash, descending: the same for the upper part.

What is left is verified on the middle part. A bucket with more than ``SMALL`` texts emits no pairs: its whole sets come to
one task (or to blocks of bounded size), which returns a spanning forest of the links it finds. Equal sets are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .bpe import ROWS, _type
from .components import components
from .lines import WORD
from .words import per_row, windows, word_hashes
from .workers import map_arrow

SIZE, PERCENT = 5, 80
LOW, HIGH = int(0.3 * 2**64), int(0.65 * 2**64)
SMALL = 64
BLOCK_NODES, BLOCK_ITEMS = 1024, 1 << 20
RARE_LIMIT = 1 << 20  # tokens of more texts count as equally common
FILTER_BITS = 1 << 21


def token_sets(texts: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct window hashes (unsigned 64 bit) of each text."""
    rows, words = word_hashes(texts)
    return [np.unique(x) for x in per_row(*windows(rows, words, size), len(texts))]


def node_of(items: np.ndarray) -> int:
    """The name of a set: a 64-bit hash of its sorted tokens."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(items.tobytes())).view(np.int64))


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def _sets(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, token_sets(part.column(column), size)


def _signed(x) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def sizes(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id``, ``n`` (set size), ``node`` (name of the set) of every row's whole text."""

    def run(batches):
        for part, found in _sets(batches, 1, size):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(map(len, found), pa.int64()), pa.array(map(node_of, found), pa.int64())],
                ["doc_id", "n", "node"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {_type(docs)}, n long, node long")


def _lower_tokens(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(token, node, n, low) for the lower part of each set, or as much as a prefix takes; ``low`` counts the lower part."""

    def run(batches):
        for _, found in _sets(batches, 0, size):
            sets = {node_of(x): x for x in found if len(x)}
            low = [int(np.searchsorted(x, np.uint64(LOW))) for x in sets.values()]
            sent = [max(m, prefix_length(len(x), percent)) for x, m in zip(sets.values(), low, strict=True)]
            if not sets:
                continue
            rep = lambda v: np.repeat(np.array(v, np.int64), sent)
            yield pa.RecordBatch.from_arrays(
                [_signed(np.concatenate([x[:k] for x, k in zip(sets.values(), sent, strict=True)])),
                 pa.array(rep(list(sets))), pa.array(rep([len(x) for x in sets.values()]).astype(np.int32)),
                 pa.array(rep(low).astype(np.int32))], ["token", "node", "n", "low"])

    return map_arrow(docs.select("text"), run, "token long, node long, n int, low int")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, node), those of tokens with two nodes or more, with the number of nodes."""
    held, common = None, None
    for batch in batches:
        rows = [batch.column(k).to_numpy() for k in range(4)]
        if not len(rows[0]):
            continue
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        token, node = rows[:2]
        fresh = np.r_[True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])]
        rows = [x[fresh] for x in rows]
        token = rows[0]
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        times = np.diff(np.r_[starts, len(token)])
        if common is not None and token[0] == common:
            times[0] = RARE_LIMIT
        last = starts[-1]
        if times[-1] >= RARE_LIMIT:  # no need to hold more of it
            common = token[-1]
            times[-1] = RARE_LIMIT
            last = len(token) - 1
        yield _with_times([x[:last] for x in rows], np.repeat(times, np.diff(np.r_[starts, len(token)]))[:last])
        held = [x[last:] for x in rows]
    if held is not None:
        n = RARE_LIMIT if held[0][0] == common else len(held[0])
        yield _with_times(held, np.full(len(held[0]), n))


def _with_times(rows: list[np.ndarray], times: np.ndarray) -> pa.RecordBatch:
    kept = times > 1
    token, node, n, low = (x[kept] for x in rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(token), pa.array(node), pa.array(n), pa.array(low), pa.array(np.minimum(times[kept], RARE_LIMIT), pa.int32()),
         pa.array(token.view(np.uint64) >= np.uint64(LOW))], ["token", "node", "n", "low", "times", "upper"])


def _prefixes(percent: int):
    """Prefix tokens under the rarity order, from a node's shared tokens sorted by (node, upper, times, token)."""

    def run(batches: Iterator[pa.RecordBatch]):
        held = None
        for batch in batches:
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            last = np.searchsorted(rows[1], rows[1][-1], "left")
            yield select([x[:last] for x in rows])
            held = [x[last:] for x in rows]
        if held is not None:
            yield select(held)

    def select(rows):
        token, node, n, low, _, upper = rows
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, int)
        sizes = np.diff(np.r_[starts, len(node)])
        group = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(node)) - starts[group]
        shared_low = np.bincount(group, ~upper, len(starts)).astype(np.int64)
        # tokens of this node alone come first; all that was sent of the upper part lies in the prefix
        room = prefix_length(n.astype(np.int64), percent) - (low - shared_low[group] if len(node) else 0)
        kept = upper | (place < room)
        return pa.RecordBatch.from_arrays(
            [pa.array(token[kept]), pa.array(node[kept]), pa.array(n[kept])], ["token", "node", "n"])

    return run


def _meetings(percent: int):
    """Pairs of a bucket whose sizes allow a link; of a large bucket its members (``y`` null)."""

    def run(batches: Iterator[pa.RecordBatch]):
        held, large = None, None
        for batch in batches:
            rows = [batch.column(k).to_numpy() for k in range(3)]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            token = rows[0]
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            ends = np.r_[starts[1:], len(token)]
            several = np.flatnonzero(np.diff(starts) > 1)
            if large is not None and len(starts) > 1:
                several = np.union1d(several, [0])
            for k in several:
                yield from bucket([x[starts[k] : ends[k]] for x in rows], token[starts[k]] == large)
            held = [x[starts[-1] :] for x in rows]
            if large is not None and token[-1] != large:
                large = None
            if len(held[0]) > SMALL:
                large = token[-1]
                yield members([x[:-1] for x in held])
                held = [x[-1:] for x in held]
        if held is not None:
            yield from bucket(held, held[0][0] == large)

    def bucket(rows, is_large):
        if is_large or len(rows[0]) > SMALL:
            yield members(rows)
        elif len(rows[0]) > 1:
            _, node, n = rows
            i, j = np.triu_indices(len(node), 1)
            fit = 100 * np.minimum(n[i], n[j]).astype(np.int64) >= percent * np.maximum(n[i], n[j]).astype(np.int64)
            x, y = node[i[fit]], node[j[fit]]
            yield batch_of(np.minimum(x, y), np.maximum(x, y), np.zeros(len(x), np.int64), np.zeros(len(x), np.int32))

    def members(rows):
        return batch_of(rows[1], None, rows[0], rows[2])

    def batch_of(x, y, token, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()), pa.nulls(len(x), pa.int64()) if y is None else pa.array(y, pa.int64()),
             pa.array(token, pa.int64()), pa.array(n, pa.int32())], ["x", "y", "token", "n"])

    return run


def _parts_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node``, ``n`` and the three parts of the sets of the ``wanted`` nodes (and of some others).

    A filter of fixed size, made from the names, tells the tasks which sets are worth sending.
    """
    words = wanted.select(F.pmod("node", F.lit(FILTER_BITS)).alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:
        bits[r["w"]] = r["bits"]
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        bits = sent.value
        for _, found in _sets(batches, 0, size):
            sets = {}
            for items in found:
                if len(items):
                    node = node_of(items)
                    if bits[node % FILTER_BITS >> 6] >> (node % FILTER_BITS & 63) & 1:
                        sets[node] = np.split(items, np.searchsorted(items, np.array([LOW, HIGH], np.uint64)))
            columns = [[x[k].tobytes() for x in sets.values()] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets, pa.int64()), pa.array([sum(map(len, x)) for x in sets.values()], pa.int64()),
                 *(pa.array(c, pa.binary()) for c in columns)], ["node", "n", "low", "middle", "high"])

    found = map_arrow(docs.select("text"), run, "node long, n long, low binary, middle binary, high binary")
    return found.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "low", "middle", "high")))


def _narrowed(pairs: DataFrame, parts: DataFrame, column: str, percent: int) -> DataFrame:
    """Pairs that can still be links once the tokens of one more part are counted."""
    side = lambda s: parts.select(
        F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col(column).alias(f"p{s}"))
    met = pairs.join(side("x"), "x").join(side("y"), "y")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x, y, known, left_x, left_y, nx, ny, px, py = (batch.column(k).to_pylist() for k in range(9))
            out = []
            for k in range(batch.num_rows):
                a, b = np.frombuffer(px[k], "<u8"), np.frombuffer(py[k], "<u8")
                both = known[k] + len(np.intersect1d(a, b, assume_unique=True))
                rest_x = (nx[k] if left_x[k] is None else left_x[k]) - len(a)
                rest_y = (ny[k] if left_y[k] is None else left_y[k]) - len(b)
                most = both + min(rest_x, rest_y)
                if 100 * most >= percent * (nx[k] + ny[k] - most):
                    out.append((x[k], y[k], both, rest_x, rest_y))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["x", "y", "known", "left_x", "left_y"])

    return map_arrow(
        met.select("x", "y", "known", "left_x", "left_y", "nx", "ny", "px", "py"), run,
        "x long, y long, known long, left_x long, left_y long")


def _forest(percent: int):
    """Links within groups of whole sets (rows sorted by group), as stars that span what they connect."""

    def run(batches: Iterator[pa.RecordBatch]):
        group, nodes, sets = None, [], []
        for batch in batches:
            for k in range(batch.num_rows):
                row = [batch.column(i)[k].as_py() for i in range(7)]
                if tuple(row[:3]) != group:
                    yield from links(nodes, sets)
                    group, nodes, sets = tuple(row[:3]), [], []
                nodes.append(row[3])
                sets.append(np.frombuffer(b"".join(row[4:]), "<u8"))
        yield from links(nodes, sets)

    def links(nodes: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(nodes) < 2:
            return
        n = np.array([len(s) for s in sets])
        order = np.argsort(n, kind="stable")
        n, sets, nodes = n[order], [sets[k] for k in order], np.array(nodes)[order]
        tokens, places, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # tokens of one set alone link nothing
        rank = np.cumsum(times > 1) - 1
        owner = np.repeat(np.arange(len(n)), n)
        kept = times[places] > 1
        owner, places = owner[kept], rank[places[kept]]
        width = int(rank[-1]) + 1
        edges = np.searchsorted(owner, np.arange(len(n) + 1))
        label = np.arange(len(n))
        step = max(1, min(256, (1 << 23) // max(width, 1)))

        def dense(lo: int, hi: int) -> np.ndarray:
            out = np.zeros((hi - lo, width), np.float32)
            out[owner[edges[lo] : edges[hi]] - lo, places[edges[lo] : edges[hi]]] = 1
            return out

        def root(k: int) -> int:
            while label[k] != k:
                label[k] = label[label[k]]
                k = label[k]
            return k

        for lo in range(0, len(n), step):
            hi = min(lo + step, len(n))
            a = dense(lo, hi)
            for at in range(lo, len(n), step):
                if percent * n[at] > 100 * n[hi - 1]:
                    break  # all further sets are too large
                to = min(at + step, len(n))
                both = np.rint(a @ (a if at == lo else dense(at, to)).T).astype(np.int64)
                linked = 100 * both >= percent * (n[lo:hi, None] + n[None, at:to] - both)
                for p, q in zip(*np.nonzero(linked), strict=True):
                    i, j = root(lo + p), root(at + q)
                    if i != j:
                        label[max(i, j)] = min(i, j)
        heads = np.array([root(k) for k in range(len(n))])
        other = np.flatnonzero(heads != np.arange(len(n)))
        x, y = nodes[heads[other]], nodes[other]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64())], ["x", "y"])

    return run


def set_links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Links between nodes (``x``, ``y``): enough of them to connect all that similarity connects."""
    lower = _lower_tokens(docs, size, percent)
    shared = map_arrow(
        lower.repartition("token").sortWithinPartitions("token", "node"), _shared,
        "token long, node long, n int, low int, times int, upper boolean")
    prefix = map_arrow(
        shared.repartition("node").sortWithinPartitions("node", "upper", "times", "token"), _prefixes(percent),
        "token long, node long, n int")
    met = stage(map_arrow(
        prefix.repartition("token").sortWithinPartitions("token", "n", "node"), _meetings(percent),
        "x long, y long, token long, n int"))
    pairs = met.where("y is not null").select("x", "y").distinct()
    members = met.where("y is null").select("token", F.col("x").alias("node"), "n")
    wanted = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).union(members.select("node"))
    parts = stage(_parts_of(docs, wanted, size))

    left = F.lit(None).cast("long")
    pairs = pairs.select("x", "y", F.lit(0).cast("long").alias("known"), left.alias("left_x"), left.alias("left_y"))
    for column in ("low", "high", "middle"):
        pairs = stage(_narrowed(pairs, parts, column, percent))

    # large buckets, in blocks where one task should not hold them
    blocks = members.groupBy("token").agg(F.count("*").alias("c"), F.sum("n").alias("s")).select(
        "token", F.greatest(F.ceil(F.col("c") / BLOCK_NODES), F.ceil(F.col("s") / BLOCK_ITEMS)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    groups = members.join(blocks, "token").withColumn("own", own).select("token", "node", F.explode(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
            F.least("own", k).alias("p"), F.greatest("own", k).alias("q")))).alias("g"))
    groups = groups.select("token", "g.p", "g.q", "node").join(parts, "node").select(
        "token", "p", "q", "node", "low", "middle", "high")
    groups = groups.repartition("token", "p", "q").sortWithinPartitions("token", "p", "q")
    forest = map_arrow(groups, _forest(percent), "x long, y long")
    return pairs.select("x", "y").union(forest)


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` per document row.

    Every whole text is used. A text with fewer words than ``size`` has one token, its whole sequence; a null or
    wordless one has none, is linked with nothing and is its own component. Equal sets are linked. Rows with the
    same id share a component; rows without an id are linked like others, and a component of such rows only has a null id.
    """
    rows = stage(sizes(docs, size))
    nodes = stage(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").cast("long").alias("first")))
    # documents whose id occurs with several texts connect those texts
    twice = rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min("node").alias("a"), F.max("node").alias("b")).where("a != b").select("doc_id", "a")
    same = rows.where("n > 0").join(twice, "doc_id").select(F.col("node").alias("u"), F.col("a").alias("v"))
    # whole sets are connected, with an id or without; a component is then named by its smallest id
    found = components(set_links(docs, size, percent).select(F.col("x").alias("u"), F.col("y").alias("v")).union(same))
    found = stage(found.join(nodes, "node"))
    names = found.groupBy("component").agg(F.min("first").alias("component_id"))
    found = found.select("node", "component").join(names, "component").select("node", "component_id")
    named = nodes.join(found, "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id"))
    full = rows.where("n > 0").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").cast("long").alias("component_id"))
    return full.union(empty)


def keep_one(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` per component, with its own columns: of the rows with the smallest id, where that id is
    repeated, one with a word, by the hash of its text. Rows without an id stay."""
    found = near_duplicates(docs, size, percent).where("doc_id is not null").groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    marked = stage(found.where("component_id != doc_id or n > 1"))
    single = docs.join(marked.select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    # rows that share the id that stays
    several = docs.join(marked.where("component_id = doc_id").select("doc_id"), "doc_id", "left_semi")
    several = several.select(F.struct(*docs.columns).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    order = Window.partitionBy("row.doc_id").orderBy(text.rlike(WORD).desc(), F.xxhash64(text), text)
    first = several.withColumn("place", F.row_number().over(order)).where("place = 1")
    return single.union(first.select(*(F.col("row")[c].alias(c) for c in docs.columns)))
