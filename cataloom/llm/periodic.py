"""Periodic runs of words, found from minimizers at several scales.

A run is a longest stretch of words that repeats with smallest period ``q`` and has at least ``max(MIN_WORDS, 2 * q)``
words. Words are numbered exactly (no hashes decide). Periods below ``SHORT`` come from direct scans at each lag.
For periods from ``S`` to ``2 S - 1`` (``S`` = 32, 64, ...) every window of ``S`` words marks its smallest
``S / 2``-gram. Inside a run the windows at its start and one period on hold the same words and mark the same gram, so the
period shows as the distance of equal marks; each such pair is extended both ways, and the extension alone decides.
Marks in a stretch of shorter period are equal all along it: such a stretch counts once, by its two ends and by
where it meets the next one, so the pairs grow with the words and not with the square of a repeated passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import _type
from .words import mix
from .workers import map_arrow

MIN_WORDS = 12
SHORT = 32  # a power of two
#: words looked at together; a longer text is looked at alone
TOGETHER = 1 << 19

SHAPE = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _stretches(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the stretches of consecutive places."""
    if not len(hits):
        return hits, hits
    cut = np.flatnonzero(np.diff(hits) != 1)
    return hits[np.r_[0, cut + 1]], hits[np.r_[cut, len(hits) - 1]] + 1


class Found:
    """Runs by (start, end), each with its smallest period."""

    def __init__(self, size: int):
        self.size = size + 1
        self.spans, self.periods = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        spans = np.concatenate([self.spans, start * self.size + end])
        periods = np.concatenate([self.periods, period])
        order = np.lexsort((periods, spans))
        spans, periods = spans[order], periods[order]
        fresh = np.r_[True, spans[1:] != spans[:-1]] if len(spans) else np.zeros(0, bool)
        self.spans, self.periods = spans[fresh], periods[fresh]

    def period_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """0 where no run has these ends."""
        if not len(self.spans):
            return np.zeros(len(start), np.int64)
        wanted = start * self.size + end
        at = np.minimum(np.searchsorted(self.spans, wanted), len(self.spans) - 1)
        return np.where(self.spans[at] == wanted, self.periods[at], 0)


def _lag_scans(x: np.ndarray, found: Found, longest: int) -> None:
    starts, ends, periods = [], [], []
    for q in range(1, min(SHORT - 1, longest // 2) + 1):
        a, b = _stretches(np.flatnonzero(x[q:] == x[:-q]))
        long = b - a >= max(q, MIN_WORDS - q)
        starts.append(a[long])
        ends.append(b[long] + q)
        periods.append(np.full(int(long.sum()), q, np.int64))
    if starts:
        found.add(np.concatenate(starts), np.concatenate(ends), np.concatenate(periods))


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` over every ``width`` consecutive values."""
    out, have = values, 1
    while 2 * have <= width:
        out = best(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return best(out[: len(out) - rest], out[rest:]) if rest else out


class Names:
    """Exact numbers of all ``2 ** j``-grams; equal grams, and only they, have equal numbers."""

    def __init__(self, x: np.ndarray, longest: int):
        self.levels = [x.astype(np.int64)]
        while 2 << (len(self.levels) - 1) <= longest:
            half = 1 << (len(self.levels) - 1)
            last = self.levels[-1]
            if len(last) <= half:
                break
            self.levels.append(pd.factorize((last[:-half] << 32) | last[half:])[0].astype(np.int64))

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` on are equal."""
        return self._extend(a, b, 1)

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before ``b`` are equal."""
        return self._extend(a, b, -1)

    def _extend(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            names, step = self.levels[j], 1 << j
            todo = np.arange(len(a))
            while len(todo):
                moved = out[todo] if way > 0 else -out[todo] - step
                p, q = a[todo] + moved, b[todo] + moved
                ok = (np.minimum(p, q) >= 0) & (np.maximum(p, q) < len(names))
                todo, p, q = todo[ok], p[ok], q[ok]
                todo = todo[names[p] == names[q]]
                out[todo] += step
                if j < len(self.levels) - 1:
                    break  # a shorter step fits at most once
        return out


def _scale(names: Names, row: np.ndarray, scale: int, found: Found) -> None:
    """Add the runs with periods from ``scale`` to ``2 * scale - 1``; shorter periods are known."""
    m = scale // 2
    grams = names.levels[m.bit_length() - 1]
    width = scale - m + 1
    if len(grams) < width:
        return
    h = mix(grams.astype(np.uint64))
    least = _sliding(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    marked = _sliding(np.concatenate([pad, least, pad]), width, np.maximum) == h
    at = np.flatnonzero(marked)
    order = np.argsort(grams[at], kind="stable")
    at, gram = at[order], grams[at[order]]
    # marks of one gram in one text; those close together lie in one stretch of a shorter period
    group = np.r_[True, (gram[1:] != gram[:-1]) | (row[at[1:]] != row[at[:-1]])]
    gaps = np.r_[0, np.diff(at)]
    first = np.flatnonzero(group | (gaps > m // 2))
    step = np.where(group | (gaps > m // 2), np.iinfo(np.int64).max, gaps)
    group_no = np.cumsum(group) - 1
    period = np.full(int(group_no[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(period, group_no, step)
    where, of = at[first], group_no[first]
    several = np.bincount(of, minlength=len(period))[of] > 1
    where, of = where[several | (period[of] < scale)], of[several | (period[of] < scale)]
    d = period[of]
    close = d < scale
    a, b = where.copy(), where + m
    p, t = where[close], where[close] + d[close]
    a[close] = p - names.left(p, t)
    b[close] = t + names.right(p, t)
    fresh = np.r_[True, (of[1:] != of[:-1]) | (a[1:] != a[:-1])] if len(of) else np.zeros(0, bool)
    where, of, a, b, close = where[fresh], of[fresh], a[fresh], b[fresh], close[fresh]
    own = found.period_of(a, b)
    seeds, lags = [], []
    k = 1
    while k < len(of):
        i = np.arange(len(of) - k)
        i = i[(of[i] == of[i + k])]
        i = i[a[i + k] - (b[i] - m) < 2 * scale]
        if not len(i):
            break
        seeds += [a[i], b[i] - m]
        lags += [a[i + k] - a[i], b[i + k] - b[i]]
        # two stretches of the same shorter period that meet: every length of both that fits in phase
        j = i[close[i] & (b[i] >= a[i + k]) & (own[i] > 0)]
        if len(j):
            unit = own[j]
            phase = (where[j + k] - where[j]) % unit
            low = scale + (phase - scale) % unit
            high = np.minimum(2 * scale - 1, np.minimum(b[j] - a[j], b[j + k] - a[j + k]))
            n = np.maximum(0, (high - low) // unit + 1)
            again = np.repeat(np.arange(len(j)), n)
            q = low[again] + unit[again] * (np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n))
            lags.append(q)
            seeds.append(np.maximum(a[j][again], a[j + k][again] - q))
        k += 1
    if not seeds:
        return
    seed, lag = np.concatenate(seeds), np.concatenate(lags)
    fits = (lag >= scale) & (lag < 2 * scale)
    pairs = np.unique(np.stack([seed[fits], lag[fits]]), axis=1)
    seed, lag = pairs
    start = seed - names.left(seed, seed + lag)
    end = seed + names.right(seed, seed + lag)
    whole = end - start >= np.maximum(lag, MIN_WORDS - lag)
    found.add(start[whole], end[whole] + lag[whole], lag[whole])


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts with a number of its own after each text; the text of each place; where each starts."""
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    x = np.empty(int(sizes.sum()), np.int64)
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    for k, t in enumerate(texts):
        x[starts[k] : starts[k] + len(t)] = t
        x[starts[k] + len(t)] = top + k
    return x, np.repeat(np.arange(len(texts)), sizes), starts


def _with_copies(x: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Texts that hold some ``SHORT / 2``-gram twice. Equal hashes of different grams only add a text."""
    h = mix(x.astype(np.uint64))
    size = 1
    while size < SHORT // 2:
        h = mix(h[:-size] * np.uint64(0x9E3779B97F4A7C15) + h[size:])
        size *= 2
    own = row[: len(h)]
    h ^= mix(own.astype(np.uint64) + np.uint64(1 << 40))
    order = np.argsort(h)
    same = np.flatnonzero(h[order][1:] == h[order][:-1])
    out = np.zeros(n, bool)
    out[own[order[same]]] = True
    return out


def runs_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of texts given as word numbers: (text, start, length, period), by text, start and period."""
    none = np.zeros(0, np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    chosen = np.flatnonzero(sizes >= MIN_WORDS)
    if not len(chosen):
        return none, none, none, none
    x, row, starts = _joined([texts[k] for k in chosen])
    short = Found(len(x))
    _lag_scans(x, short, int(sizes[chosen].max()))
    parts = [(chosen, row, starts, short)]
    long = np.flatnonzero(sizes[chosen] >= 2 * SHORT)
    if len(long):
        long = long[_with_copies(x, row, len(chosen))[long]]
    if len(long):
        chosen = chosen[long]
        x, row, starts = _joined([texts[k] for k in chosen])
        deep, scale, longest = Found(len(x)), SHORT, int(sizes[chosen].max())
        _lag_scans(x, deep, longest)
        names = Names(x, longest // 2)
        while 2 * scale <= longest:
            _scale(names, row, scale, deep)
            scale *= 2
        parts.append((chosen, row, starts, deep))
    out = []
    for chosen, row, starts, found in parts:
        start, end = np.divmod(found.spans, found.size)
        text = row[start]
        out.append(np.stack([chosen[text], start - starts[text], end - start, found.periods]))
    # the short periods of the texts looked at twice were found twice
    every = np.unique(np.concatenate(out, axis=1), axis=1)
    text, start, length, period = every[:, np.lexsort((every[3], every[1], every[0]))]
    return text, start, length, period


def _batch(column: pa.Array) -> Iterator[tuple]:
    """(words, runs, collapsed text) of every row."""
    words = [x.split() if x else [] for x in column.cast(pa.binary()).to_pylist()]
    flat = pa.array([w for row in words for w in row], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    ends = np.cumsum([len(w) for w in words])
    texts = np.split(flat.astype(np.int64), ends[:-1]) if words else []
    text, start, length, period = runs_of(texts)
    edges = np.searchsorted(text, np.arange(len(words) + 1))
    for k, row in enumerate(words):
        lo, hi = edges[k], edges[k + 1]
        runs = np.stack([start[lo:hi], length[lo:hi], period[lo:hi]])
        if hi > lo:
            cover = np.zeros(len(row) + 1, np.int64)
            np.add.at(cover, runs[0] + runs[2], 1)
            np.add.at(cover, runs[0] + runs[1], -1)
            row_kept = np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()
            yield len(row), runs, b" ".join([row[i] for i in row_kept])
        else:
            yield len(row), runs, b" ".join(row)


def _slices(column: pa.Array) -> Iterator[pa.Array]:
    """Rows of about ``TOGETHER`` words at most, or one longer row."""
    held, at = 0, 0
    for k, size in enumerate(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()):
        if k > at and held + size > 6 * TOGETHER:
            yield column.slice(at, k - at)
            held, at = 0, k
        held += size
    if at < len(column):
        yield column.slice(at)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """Periodic runs of each row's whole ``text`` and the text without their repeats.

    Returns ``doc_id``, ``n_words``, ``runs`` (``start`` word from 0, ``length``, ``period``; by start, then period) and ``collapsed``:
    the words that no run holds after its first period, with one blank between. Words are ``[^\\x20\\x09-\\x0D]+``. A null,
    empty or wordless text has no runs and collapses to an empty text. Repeated rows and null ids pass through one by one, other
    columns play no part, no rows give no rows. Rows are independent: nothing is shuffled, and a task holds
    one text or about ``TOGETHER`` words at a time.
    """
    columns = ["doc_id", "n_words", "runs", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            at = 0
            for part in _slices(batch.column(1)):
                found = list(_batch(part))
                runs = np.concatenate([r for _, r, _ in found], axis=1)
                offsets = np.r_[0, np.cumsum([r.shape[1] for _, r, _ in found])].astype(np.int32)
                runs = pa.ListArray.from_arrays(
                    offsets, pa.StructArray.from_arrays([pa.array(r, pa.int64()) for r in runs], ["start", "length", "period"]))
                texts = pa.array([t for _, _, t in found], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array([n for n, _, _ in found], pa.int64()), runs, texts], columns)
                at += len(part)

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {_type(docs)}, {SHAPE}")
