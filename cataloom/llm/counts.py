"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is tried once: if it is a pre-token by itself and the merge list
joins it back into one token, a pre-token equal to it counts 1 without any merging. Only the rest
is merged.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import PIECES, UNIT, Merges, Transducer, _columns, _type, segments, slices
from .units import UnitTable
from .words import bytes_of
from .workers import map_arrow


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings proved to be one pre-token and one token."""
    merges = Merges(path)
    proved = set()
    for token in merges.ids:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue  # part of a character: never a pre-token
        if PIECES.findall(text) == [text] and merges.merge(token) == [token]:
            proved.add(text)
    return frozenset(proved)


class Counter:
    """Numbers of tokens of texts; a count stands as so many bytes in the table of units."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.merges, self.whole = Merges(path), whole
        self.table = UnitTable(lambda unit: bytes(self.count_unit(unit)), lambda text: bytes(self.count(text)), True, 1)
        if not all(x.startswith("<|") for x in self.merges.special):
            raise ValueError("special strings must begin with <|")

    def count_unit(self, unit: str) -> int:
        whole = self.whole
        if unit in whole:
            return 1
        return sum([1 if piece in whole else self._merged(piece.encode()) for piece in PIECES.findall(unit)])

    def _merged(self, piece: bytes) -> int:
        if len(piece) <= 2 * self.merges.lookahead:
            return len(self.merges.merge_ids(piece))
        t = Transducer(self.merges)  # rule by rule would be quadratic here
        return sum(len(t.feed(piece[at : at + 4096])) for at in range(0, len(piece), 4096)) + len(t.finish())

    def count(self, text: str) -> int:
        n = 0
        for part, is_special in segments(text, self.merges.special_cut):
            if is_special:
                n += 1
            else:
                n += sum(sum(map(self.count_unit, UNIT.findall(piece))) for piece in slices(part))
        return n


_counters: dict[str, Counter] = {}


def _counter(path: str, whole) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path, whole.value)
    return _counters[path]


@lru_cache(2)
def _proved(path: str) -> frozenset[str]:
    return whole_tokens(path)


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` of every row's whole ``text``; 0 for a null or empty one.

    Special strings in a text count as their one token. Repeated rows and null ids pass through,
    other columns are not read. The proved strings are broadcast; the vocabulary bounds them.
    """
    whole = docs.sparkSession.sparkContext.broadcast(_proved(path))

    def run(batches):
        c = _counter(path, whole)
        for ids, texts in _columns(batches):
            sizes = np.diff(bytes_of(texts)[1])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes), pa.array(c.table.count(texts))], ["doc_id", "n_bytes", "n_tokens"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {_type(docs)}, n_bytes long, n_tokens long")
