"""Texts as units, cut and looked up for many documents at once.

A unit is a run of white space, or a run of other characters with at most one blank before it (``lead``), as the
pre-token pattern of byte-level vocabularies cuts them; without ``lead``, only the runs of other characters. Units are cut
on the bytes of an Arrow column and told apart by 64-bit hashes. A worker keeps the ids of the units it has met in
sorted arrays, about thirty bytes each, and encodes only new ones.

Texts that this cannot cut go to a function for single texts: those with white space beyond ASCII, with what may be
a special string, or of more than ``LONG`` bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .words import _IN_WORD, bytes_of, span_hashes

CHUNK = 1 << 21  # bytes looked up at a time
LONG = 1 << 22
#: units and ids that a worker keeps
UNITS_KEPT, IDS_KEPT = 1_200_000, 4_000_000


def awkward(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which rows need a single treatment."""
    out = np.diff(rows) > LONG
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)) | (data == 0x3C))
    lead = lead[lead + 1 < len(data)]
    a, b = data[lead], data[lead + 1]
    c = data[np.minimum(lead + 2, len(data) - 1)]
    blank = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    blank |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    blank |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    blank |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    blank |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    blank |= (a == 0x3C) & (b == 0x7C)  # special strings begin like this
    out[np.searchsorted(rows, lead[blank], "right") - 1] = True
    return out


def unit_spans(data: np.ndarray, rows: np.ndarray, lead: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every unit of the rows, in order."""
    inside = _IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    bounds = rows[(rows > 0) & (rows < len(data))]
    first[bounds] = inside[bounds]
    last[bounds - 1] = inside[bounds - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not lead:
        return start, end
    begins = np.zeros(len(data) + 1, bool)
    begins[rows] = True
    # a blank before a word belongs to it
    before = np.maximum(start - 1, 0)
    joined = ~begins[start] & (data[before] == 0x20)
    # white space between: what is left of each run, where a word follows without its last character
    space = ~inside
    run_first, run_last = space.copy(), space.copy()
    run_first[1:] &= inside[:-1]
    run_last[:-1] &= inside[1:]
    run_first[bounds] = space[bounds]
    run_last[bounds - 1] = space[bounds - 1]
    a, b = np.flatnonzero(run_first), np.flatnonzero(run_last) + 1
    followed = ~begins[b]
    cut = b - followed
    keep = cut > a
    single = followed & (data[b - 1] != 0x20)
    starts = np.concatenate([start - joined, a[keep], b[single] - 1])
    ends = np.concatenate([end, cut[keep], b[single]])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


class UnitTable:
    """Ids of all rows of a column, unit by unit."""

    def __init__(self, encode_unit: Callable[[str], bytes], encode_text: Callable[[str], bytes], lead: bool, id_bytes: int = 4):
        self.encode_unit, self.encode_text, self.lead = encode_unit, encode_text, lead
        self.type = np.dtype(f"<u{id_bytes}")
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, self.type), 0

    def _find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each unit, after encoding those not met before."""
        value = span_hashes(data, start, end)
        keys, first, where = np.unique(value, return_index=True, return_inverse=True)
        if len(self.keys) > UNITS_KEPT or self.used > IDS_KEPT:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        missing = np.flatnonzero(~known)
        if len(missing):
            raw, encode = data.tobytes(), self.encode_unit
            a, b = start[first[missing]].tolist(), end[first[missing]].tolist()
            new = [encode(raw[x:y].decode()) for x, y in zip(a, b, strict=True)]
            size = self.type.itemsize
            counts = np.array([len(x) // size for x in new], np.int32)
            flat = np.frombuffer(b"".join(new), self.type)
            if self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(self.ids), 2 * len(flat)), self.type)])
            self.ids[self.used : self.used + len(flat)] = flat
            places = self.used + np.cumsum(counts) - counts
            self.used += len(flat)
            self.keys = np.insert(self.keys, at[missing], keys[missing])
            self.starts = np.insert(self.starts, at[missing], places)
            self.counts = np.insert(self.counts, at[missing], counts)
            at = np.searchsorted(self.keys, keys)
        return at[where]

    def _groups(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray | None, np.ndarray | None]]:
        """Stretches of rows: (first, end, bytes, starts), or without bytes a row to treat singly."""
        data, rows = bytes_of(column)
        single = awkward(data, rows)
        at, n = 0, len(column)
        while at < n:
            if single[at]:
                yield at, at + 1, None, None
                at += 1
                continue
            to = at + 1
            while to < n and not single[to] and rows[to + 1] - rows[at] <= CHUNK:
                to += 1
            yield at, to, data[rows[at] : rows[to]], rows[at : to + 1] - rows[at]
            at = to

    def encode(self, column: pa.Array) -> list[bytes]:
        """Ids of every row."""
        out: list[bytes] = []
        for at, to, data, rows in self._groups(column):
            if data is None:
                out.append(self.encode_text(column[at].as_py() or ""))
            elif not len(data):
                out += [b""] * (to - at)
            else:
                start, end = unit_spans(data, rows, self.lead)
                found = self._find(data, start, end)
                counts = self.counts[found].astype(np.int64)
                before = np.cumsum(counts) - counts
                total = int(counts.sum())
                ids = self.ids[np.repeat(self.starts[found] - before, counts) + np.arange(total)]
                edges = np.append(before, total)[np.searchsorted(start, rows)].tolist()
                out += [ids[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
        return out

    def count(self, column: pa.Array) -> np.ndarray:
        """Number of ids of every row."""
        out = np.zeros(len(column), np.int64)
        for at, to, data, rows in self._groups(column):
            if data is None:
                out[at] = len(self.encode_text(column[at].as_py() or "")) // self.type.itemsize
            elif len(data):
                start, end = unit_spans(data, rows, self.lead)
                found = self._find(data, start, end)
                counts = np.append(0, np.cumsum(self.counts[found], dtype=np.int64))
                edges = counts[np.searchsorted(start, rows)]
                out[at:to] = np.diff(edges)
        return out
