"""Line dedup: a segment-partition join on edit distance.

Lines are ``\\n``-separated; lines of at least ``MIN_CHARS`` code points are judged. A line goes when
an earlier one (by ``doc_id``, then place) is within ``THRESHOLD`` edits of it, the earliest of a set of
equal lines standing for all. Shorter lines are no matter for the edit join; with ``exact_chars`` they go when an
earlier one equals them. Two lines within ``t`` edits share one of ``t + 1`` segments of the shorter,
at a place that the edits before and after it allow: each line enters the index with its own segments and
probes it with the substrings that can match a line up to ``t`` shorter. Lines that meet another whose letter counts
allow it are verified within their bucket by a banded bit-parallel edit distance, until each has one earlier partner.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .workers import map_arrow

THRESHOLD = 2
MIN_CHARS = 20
#: entries of a bucket that are compared at once; larger buckets are first dealt again by letter counts, then in pairs of blocks
BUCKET = 4096
FILTER_BITS = 1 << 21
TOGETHER = 1 << 18  # characters of lines indexed or verified together
_hash = xxhash.xxh3_64_intdigest
WORD = r"[^\x20\x09-\x0D]"


def segment_bounds(length: int, threshold: int) -> list[tuple[int, int]]:
    """Start and end of the ``threshold + 1`` even segments of a line."""
    n = threshold + 1
    edges = [length * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:], strict=False))


def probe_starts(i: int, start: int, size: int, extra: int, length: int, threshold: int) -> range:
    """Where segment ``i`` of a line ``extra`` shorter may lie in one of ``length``.

    At most ``i`` edits lie before it and ``threshold - i`` after it, for some matching segment.
    """
    lo = max(start - i, start + extra - (threshold - i), 0)
    hi = min(start + i, start + extra + (threshold - i), length - size)
    return range(lo, hi + 1)


def line_key(line: bytes) -> int:
    """The same value as Spark's ``xxhash64`` of the line."""
    h = xxhash.xxh64_intdigest(line, 42)
    return h - (1 << 64) if h >> 63 else h


def letter_counts(lines: list[str]) -> np.ndarray:
    """Per line, counts of eight classes of characters, modulo 16, in 32 bits. An edit moves their sum of differences by 2 at most."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    counts = np.bincount(owner * 8 + (codes & 7), minlength=8 * len(lines)).reshape(-1, 8) & 15
    return (counts << np.arange(0, 32, 4)).sum(axis=1)


@lru_cache(4096)
def _places(n: int, threshold: int) -> tuple[list[tuple[int, int, int]], list[int]]:
    """For lines of ``n`` characters: (first byte, end byte, seed) of every key, and 0 for an own segment or 1 for a probe only."""
    places, kinds = [], []
    for extra in range(min(threshold, n) + 1):
        length = n - extra
        for i, (a, b) in enumerate(segment_bounds(length, threshold)):
            for at in probe_starts(i, a, b - a, extra, n, threshold):
                places.append((4 * at, 4 * (at + b - a), length * 64 + i))
                kinds.append(int(extra > 0 or at != a))
    return places, kinds


def keys_of(line: str, threshold: int) -> tuple[list[int], list[int]]:
    """Keys of a line (its length, the number of the segment and its characters) and their kinds."""
    places, kinds = _places(len(line), threshold)
    raw = line.encode("utf-32-le")
    return [_hash(raw[a:b], seed) for a, b, seed in places], kinds


def edit_within(first: list[str], second: list[str], threshold: int) -> np.ndarray:
    """Whether each pair of strings is within ``threshold`` (up to 31) edits.

    All pairs advance together, one character of the shorter string a step. A 64-bit word per pair
    holds the differences down the band of ``2 * threshold + 1`` diagonals; its top bit is the lowest diagonal.
    """
    n = len(first)
    out = np.zeros(n, bool)
    pairs = [(a, b) if len(a) >= len(b) else (b, a) for a, b in zip(first, second, strict=True)]
    short = [k for k, (a, _) in enumerate(pairs) if len(a) <= threshold]
    out[short] = True  # no more than that many edits are possible
    todo = [k for k, (a, b) in enumerate(pairs) if len(a) > threshold and len(a) - len(b) <= threshold]
    todo.sort(key=lambda k: len(pairs[k][1]))
    step = 8192
    for at in range(0, len(todo), step):
        part = np.array(todo[at : at + step])
        longest = max(len(pairs[k][0]) for k in part)
        step_rows = max(1, (1 << 24) // (longest + 2 * threshold + 1))
        for lo in range(0, len(part), step_rows):
            some = part[lo : lo + step_rows]
            out[some] = _band([pairs[k][0] for k in some], [pairs[k][1] for k in some], threshold)
    return out


def _codes(texts: list[str], width: int, before: int, filler: int) -> np.ndarray:
    out = np.full((len(texts), width), filler, np.int32)
    for k, t in enumerate(texts):
        out[k, before : before + len(t)] = np.frombuffer(t.encode("utf-32-le"), "<i4")
    return out


def _band(longer: list[str], shorter: list[str], t: int) -> np.ndarray:
    one, top = np.uint64(1), np.uint64(63)
    n1, n2 = np.array([len(x) for x in longer]), np.array([len(x) for x in shorter])
    # step i sees the characters i - t .. i + t of the longer string
    wide = _codes(longer, int(n1.max()) + 3 * t + 1, t, -1)
    thin = _codes(shorter, int(n2.max()) + 1, 0, -2)
    keep = np.arange(len(longer))
    vp = np.full(len(longer), ((1 << 64) - 1) << (63 - t) & ((1 << 64) - 1), np.uint64)
    vn = np.zeros(len(longer), np.uint64)
    dist = np.full(len(longer), t)
    side = np.full(len(longer), 1 << 62, np.uint64)
    verdict = np.zeros(len(longer), bool)
    for i in range(int(n2.max())):
        done = n2 == i
        leave = done | (dist > t + np.maximum(0, n2 - np.maximum(i, n1 - t)))
        if leave.any():
            verdict[keep[done]] = dist[done] <= t
            stay = ~leave
            keep, vp, vn, dist, side, n1, n2 = (x[stay] for x in (keep, vp, vn, dist, side, n1, n2))
            wide, thin = wide[stay], thin[stay]
            if not len(keep):
                return verdict
        x = np.zeros(len(keep), np.uint64)
        for k in range(2 * t + 1):
            x |= (wide[:, i + k] == thin[:, i]).astype(np.uint64) << np.uint64(63 - 2 * t + k)
        d0 = (((x & vp) + vp) ^ vp) | x | vn
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        # along the lowest diagonal until it reaches the end of the longer string, then along that end
        sloping = i < n1 - t
        dist = dist + np.where(sloping, (d0 >> top == 0).astype(int), ((hp & side) != 0).astype(int) - ((hn & side) != 0))
        side = np.where(sloping, side, side >> one)
        vp = hn | ~((d0 >> one) | hp)
        vn = (d0 >> one) & hp
    verdict[keep] = dist <= t
    return verdict


def _compatible(a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    """Matrix of whether letter counts (32 bits each) differ by what ``threshold`` edits can do."""
    total = np.zeros((len(a), len(b)), np.int16)
    for k in range(0, 32, 4):
        d = ((a >> k) & 15).astype(np.int16)[:, None] - ((b >> k) & 15).astype(np.int16)[None, :]
        d = np.abs(d)
        total += np.minimum(d, 16 - d)
    return total <= 2 * threshold


def _meets(counts: np.ndarray, kinds: np.ndarray, threshold: int) -> np.ndarray:
    """Which lines of a bucket may be near another of it, at least one of the two by its own segment."""
    out = np.zeros(len(counts), bool)
    own = np.flatnonzero((kinds & 1) == 0)
    for lo in range(0, len(counts), 1024):
        for at in range(0, len(own), 1024):
            some = own[at : at + 1024]
            fit = _compatible(counts[lo : lo + 1024], counts[some], threshold)
            fit &= np.arange(lo, min(lo + 1024, len(counts)))[:, None] != some[None, :]
            out[lo : lo + 1024] |= fit.any(axis=1)
            out[some] |= fit.any(axis=0)
    return out


def _buckets(threshold: int, limit: int):
    """Lines that may have a partner, from rows sorted by key. Of buckets beyond ``limit`` lines all rows come out, as heavy."""
    columns = ["key", "line", "heavy", "counts", "kind"]

    def batch_of(key, line, heavy, counts, kind):
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(line, pa.int64()), pa.array(np.full(len(key), heavy)),
             pa.array(counts, pa.int32()), pa.array(kind, pa.int8())], columns)

    def run(batches: Iterator[pa.RecordBatch]):
        held = None  # rows of the last key so far
        spilled = None  # a key that proved heavy
        for batch in batches:
            rows = [batch.column(k).to_numpy() for k in range(4)]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            order = np.lexsort((rows[3], rows[1], rows[0]))
            rows = [x[order] for x in rows]
            keys = rows[0]
            # the same line once per bucket, by its own segment if it has one there
            fresh = np.r_[True, (keys[1:] != keys[:-1]) | (rows[1][1:] != rows[1][:-1])]
            rows = [x[fresh] for x in rows]
            keys = rows[0]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[starts[1:], len(keys)]
            several = np.flatnonzero(np.diff(starts) > 1)
            if spilled is not None and len(starts) > 1:
                several = np.union1d(several, [0])  # the line kept back, even if no other follows it
            for k in several:
                yield from bucket([x[starts[k] : ends[k]] for x in rows], keys[starts[k]] == spilled)
            held = [x[starts[-1] :] for x in rows]
            if spilled is not None and keys[starts[-1]] != spilled:
                spilled = None
            if len(held[0]) > limit:
                spilled = held[0][0]
                # a line may come out once more with a later batch; heavy rows are made distinct after this
                yield batch_of(held[0][:-1], held[1][:-1], True, held[2][:-1], held[3][:-1])
                held = [x[-1:] for x in held]  # kept so that the next batch is known to go on with this key
        if held is not None:
            yield from bucket(held, held[0][0] == spilled)

    def bucket(rows, was_heavy):
        if was_heavy or len(rows[0]) > limit:
            yield batch_of(rows[0], rows[1], True, rows[2], rows[3])
        elif len(rows[0]) > 1:
            some = _meets(rows[2], rows[3], threshold)
            if some.any():
                yield batch_of(rows[0][some], rows[1][some], False, rows[2][some], rows[3][some])

    return run


def _dealt_again(heavy: DataFrame, threshold: int) -> DataFrame:
    """``key``, ``line`` of heavy buckets, in smaller buckets that lines within ``threshold`` edits still share."""
    groups = 2 * threshold + 1
    if groups > 8:
        return heavy.select("key", "line").distinct()  # too few classes of letters for that many groups
    # 2t units of change leave one of 2t + 1 groups of letter classes as it is
    masks = [sum(15 << (4 * k) for k in range(8) if k % groups == g) for g in range(groups)]
    return heavy.select(
        F.explode(F.array(*(F.xxhash64("key", F.lit(g), F.col("counts").cast("long").bitwiseAND(m)) for g, m in enumerate(masks)))).alias("key"),
        "line").distinct()


def _blocks(members: DataFrame) -> DataFrame:
    """Members of buckets, dealt to every pair of blocks of theirs: ``block`` holds about ``BUCKET`` lines; ``side`` is 0 where the
    block is one with itself, else 1 or 2."""
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(
        "key", F.ceil(F.col("n") / max(1, BUCKET // 2)).cast("int").alias("blocks"))
    rows = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("line", F.lit(7)), F.col("blocks")).cast("int"))
    rows = rows.select("key", "line", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return rows.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("block"), "line", side.alias("side"))


def _fits(a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    """``_compatible`` pair by pair."""
    total = np.zeros(len(a), np.int16)
    for k in range(0, 32, 4):
        d = np.abs(((a >> k) & 15).astype(np.int16) - ((b >> k) & 15).astype(np.int16))
        total += np.minimum(d, 16 - d)
    return total <= 2 * threshold


def _earlier(texts: list[str], sides: np.ndarray, starts: np.ndarray, threshold: int) -> np.ndarray:
    """Which lines of whole blocks (``starts``: where each begins), in order within each, have a near one before them.

    All lines that are still open are compared with the first line of their block, then with the second, and so on, the blocks
    together; a line drops out with its first partner, so a group of near copies is done after one round.
    """
    counts = np.concatenate([letter_counts(texts[k : k + 4096]) for k in range(0, len(texts), 4096)])
    found = np.zeros(len(texts), bool)
    sizes = np.diff(np.r_[starts, len(texts)])
    base = np.repeat(starts, sizes)
    open_ = np.flatnonzero(np.arange(len(texts)) > base)
    k = 0
    while len(open_):
        partner = base[open_] + k
        fit = _fits(counts[partner], counts[open_], threshold)
        fit &= (sides[partner] == 0) | (sides[partner] != sides[open_])
        some, other = open_[fit], partner[fit]
        if len(some):
            near = edit_within([texts[i] for i in other], [texts[i] for i in some], threshold)
            found[some[near]] = True
        k += 1
        open_ = open_[~found[open_] & (open_ > base[open_] + k)]
    return found


def near_lines(docs: DataFrame, first: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """Keys (``line``) of the judged lines that are within ``threshold`` (0 to 31) edits of a different earlier line, each once.

    ``first`` has the place (``first``) of each ``line``. Every line comes out at most once per block of a bucket it is in, never
    once per partner.
    """
    if not 0 <= threshold <= 31:
        raise ValueError(f"threshold {threshold}: the edit distance counts 0 to 31 edits")
    spark = docs.sparkSession

    def segments(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lines = {line for text in batch.column(0).to_pylist() if text for line in text.split("\n") if len(line) >= min_chars}
            some, size = [], 0
            for line in lines:
                some.append(line)
                size += len(line)
                if size > TOGETHER:
                    yield indexed(some)
                    some, size = [], 0
            if some:
                yield indexed(some)

    def indexed(lines: list[str]) -> pa.RecordBatch:
        keys, kinds, times = [], [], []
        for line in lines:
            found, kind = keys_of(line, threshold)
            keys += found
            kinds += kind
            times.append(len(found))
        own = np.repeat(np.array([line_key(x.encode()) for x in lines], np.int64), times)
        counts = np.repeat(letter_counts(lines).astype(np.uint32).view(np.int32), times)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(own, pa.int64()),
             pa.array(counts, pa.int32()), pa.array(np.array(kinds, np.int8))], ["key", "line", "counts", "kind"])

    rows = map_arrow(docs.select("text"), segments, "key long, line long, counts int, kind byte")
    # one sort column: Spark sorts by radix; the few rows of a key are put in order where they are compared
    dealt = rows.repartition("key").sortWithinPartitions("key")
    met = stage(map_arrow(dealt, _buckets(threshold, BUCKET), "key long, line long, heavy boolean, counts int, kind byte"))
    members = met.where("not heavy").select("key", "line").union(_dealt_again(met.where("heavy"), threshold))
    members = stage(_blocks(members))

    # texts of lines that met: a filter of fixed size keeps most others from moving
    words = members.select(F.pmod("line", F.lit(FILTER_BITS)).alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:
        bits[r["w"]] = r["bits"]
    sent = spark.sparkContext.broadcast(bits)

    def wanted(batches: Iterator[pa.RecordBatch]):
        bits = sent.value
        for batch in batches:
            found = {}
            for text in batch.column(0).to_pylist():
                for line in text.split("\n") if text else ():
                    if len(line) >= min_chars and line not in found:
                        k = line_key(line.encode())
                        if bits[k % FILTER_BITS >> 6] >> (k % FILTER_BITS & 63) & 1:
                            found[line] = k
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.values(), pa.int64()), pa.array(found, pa.string())], ["line", "words"])

    texts = map_arrow(docs.select("text"), wanted, "line long, words string").groupBy("line").agg(
        F.first("words").alias("words"))
    # only lines that met are looked up, and each line's text joins its blocks
    texts = stage(texts.join(members.select("line").distinct(), "line", "left_semi").join(first.select("line", "first"), "line"))
    both = members.join(texts, "line").select("block", "first", "line", "side", "words")
    # sizes in bytes say little about this work: it is not packed into fewer tasks
    both = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortWithinPartitions("block", "first").select("block", "line", "side", "words")

    def verified(batches: Iterator[pa.RecordBatch]):
        block, size = None, 0
        lines, sides, texts, starts = [], [], [], []

        def close():
            late = _earlier(texts, np.array(sides), np.array(starts), threshold)
            return pa.RecordBatch.from_arrays([pa.array(np.array(lines, np.int64)[late])], ["line"])

        for batch in batches:
            for b, line, side, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if b != block:
                    if size > TOGETHER:
                        yield close()
                        lines, sides, texts, starts, size = [], [], [], [], 0
                    block = b
                    starts.append(len(lines))
                elif line == lines[-1]:
                    continue
                lines.append(line)
                sides.append(side)
                texts.append(text)
                size += len(text)
        if lines:
            yield close()

    return map_arrow(both, verified, "line long").distinct()


def judged_lines(docs: DataFrame, min_chars: int = MIN_CHARS, exact_chars: int | None = None) -> DataFrame:
    """``doc_id``, ``twin`` (hash of the text), ``line_no`` from 0, ``line`` (key) of every judged line."""
    t = F.coalesce(F.col("text"), F.lit(""))
    judged = F.length("l") >= min_chars
    if exact_chars is not None:
        judged |= (F.length("l") >= exact_chars) & F.col("l").rlike(WORD)
    return docs.select("doc_id", F.xxhash64(t).alias("twin"), F.posexplode(F.split(t, "\n")).alias("line_no", "l")).where(
        judged).select("doc_id", "twin", "line_no", F.xxhash64("l").alias("line"))


def repeated_lines(
    docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, exact_chars: int | None = None,
) -> DataFrame:
    """The judged lines that have an earlier equal or near one: ``doc_id``, ``twin``, ``line_no``."""
    lines = stage(judged_lines(docs, min_chars, exact_chars))
    at = stage(lines.groupBy("line").agg(F.min(F.struct("doc_id", "twin", "line_no")).alias("first"), F.count("*").alias("n")))
    late = near_lines(docs, at, threshold, min_chars).withColumn("near", F.lit(True))
    # all copies of a line with an earlier near one go; of others, all but the first
    marked = at.join(late, "line", "left").where("n > 1 or near")
    return lines.join(marked, "line").where(
        F.coalesce("near", F.lit(False)) | (F.struct("doc_id", "twin", "line_no") > F.col("first"))
    ).select("doc_id", "twin", "line_no")


def dedup_lines(
    docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, info: str | None = None,
    exact_chars: int | None = None,
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; all other columns as they were.

    With ``info``, a struct column of that name tells ``n_lines`` (with a word) and ``n_removed``. Lines under ``min_chars``
    stay, unless ``exact_chars`` is given: then those with a word and at least that many code points go when an earlier line equals
    them, so that nothing is left of an equal copy. A null or empty text stays as it is. Rows with the same id and text are one
    document: they lose the same lines. A text that loses all its lines becomes empty.
    """
    gone = repeated_lines(docs, threshold, min_chars, exact_chars).groupBy("doc_id", "twin").agg(
        F.collect_set("line_no").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("gone_doc"), F.col("twin").alias("gone_twin"), "gone")
    # columns travel in a struct, so that no name of theirs can clash
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = rows.join(
        gone, F.col("row.doc_id").eqNullSafe(F.col("gone_doc")) & (F.xxhash64(text) == F.col("gone_twin")), "left")
    rows = rows.withColumn("lines", F.split(text, "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    rows = rows.withColumn("left", F.when(F.col("gone").isNotNull(), left))
    new = F.when(
        F.col("left").isNotNull(), F.array_join(F.transform("left", lambda i: F.get(F.col("lines"), i)), "\n")
    ).otherwise(F.col("row.text"))
    out = [new.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    if info:
        with_word = F.size(F.filter("lines", lambda x: x.rlike(WORD)))
        removed = F.coalesce(F.size("gone"), F.lit(0))
        out.append(F.struct(with_word.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed")).alias(info))
    return rows.select(*out)
