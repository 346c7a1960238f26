"""Byte-level BPE as a bounded-lookahead streaming transducer, and its decoder.

A text is cut into units: a run of white space, or one run of other characters with at most one
blank before it. The pre-token pattern never looks past a unit, so units are encoded alone and
remembered. Inside a pre-token the transducer reads bytes from left to right and keeps, for each
of the last ``lookahead`` positions, the last token of the encoding that ends there. ``lookahead``
is the length of the longest token of the merge list: whatever follows, the encoding passes
through one of those positions. As soon as their chains of tokens meet, everything before the
meeting point is stable and is emitted.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .units import UnitTable
from .workers import map_arrow

#: white space of the pre-token pattern (fixed values)
BLANK = "\t-\r \x85\xa0  -     　"
#: pre-token pattern of the byte-level vocabularies (fixed value)
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

UNIT = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]")
PIECES = regex.compile(PRE_TOKEN)
CUT = re.compile(f"(?<=[^{BLANK}]) (?=[^{BLANK}])")
SLICE = 1 << 16

#: entries that a worker remembers: states of the transducer, token pairs
STATES_KEPT, PAIRS_KEPT = 800_000, 800_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if chr(b) not in letters]
    letters.update((chr(256 + i), b) for i, b in enumerate(others))
    return letters


class Merges:
    """A byte-level merge list: token bytes, ids, ranks and how each token is put together."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids = {as_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.ranks, made = {}, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = map(as_bytes, pair if isinstance(pair, list) else pair.split(" "))
            self.ranks[a, b] = rank
            made.setdefault(a + b, (a, b, rank))
        #: the rules over ids: rank of a pair (first id in the upper bits), token that a rank makes
        self.pair_ranks = {self.ids[a] << 32 | self.ids[b]: rank for (a, b), rank in self.ranks.items()}
        self.made_by = {rank: self.ids[a + b] for (a, b), rank in self.ranks.items()}
        self.byte_ids = [self.ids.get(bytes([x]), -1) for x in range(256)]
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.bytes_of = [b""] * size
        for k, v in self.ids.items():
            self.bytes_of[v] = k
        for k, v in self.special.items():
            self.bytes_of[v] = k.encode()
        #: no token is longer, so this many positions decide what stays open
        self.lookahead = max(map(len, made))
        #: the longest token that ends with these two bytes
        self.reach: dict[bytes, int] = {}
        for token in self.ids:
            self.reach[token[-2:]] = max(self.reach.get(token[-2:], 1), len(token))
        # along its right (left) edge, the tokens that a token is built from, each with the rank at which the next takes it up
        never = len(self.ranks)
        self.right_edge, self.left_edge = [()] * size, [()] * size
        for token, i in self.ids.items():
            for edge, side in ((self.right_edge, 1), (self.left_edge, 0)):
                steps, at, rank = [(token, never)], token, never
                while at in made:
                    at, rank = made[at][side], made[at][2]
                    steps.append((at, rank))
                edge[i] = tuple(steps)
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self._fits: dict[int, bool] = {}
        self._states: dict[bytes, int] = {b"": -1}

    def merge(self, piece: bytes) -> list[bytes]:
        """Apply the merge list to a short piece, rule by rule."""
        return [self.bytes_of[i] for i in self.merge_ids(piece)]

    def merge_ids(self, piece: bytes) -> list[int]:
        """Ids of a short piece: the rule of the lowest rank first, of equal ones the left place.

        The ranks of all neighbours stand in a list beside the tokens; a step changes two of them.
        """
        rank_of, never = self.pair_ranks.get, len(self.ranks)
        parts = [self.byte_ids[x] for x in piece]
        ranks = [rank_of(a << 32 | b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) < never:
            i = ranks.index(best)
            token = parts[i] = self.made_by[best]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(token << 32 | parts[i + 1], never)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << 32 | token, never)
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay apart when they meet.

        They do unless some rule joins a token on the edge of ``a`` with one on the edge of ``b``
        before either is taken up into its own next token. Of equal rules the left one goes first.
        """
        key = a << 32 | b
        known = self._fits.get(key)
        if known is None:
            ranks = self.ranks
            known = True
            for x, until_x in self.right_edge[a]:
                for y, until_y in self.left_edge[b]:
                    rank = ranks.get((x, y))
                    if rank is not None and rank < until_x and rank <= until_y:
                        known = False
            if len(self._fits) >= PAIRS_KEPT:
                self._fits.clear()
            self._fits[key] = known
        return known

    def token_at(self, text: bytes, end: int, last) -> int:
        """The one token that ends the encoding of ``text[:end]``; ``last`` gives those of shorter prefixes."""
        far = end - self.reach.get(text[end - 2 : end], 1) if end > 1 else 0
        id_of, fits = self.ids.get, self.fits
        for begin in range(far if far > 0 else 0, end):
            token = id_of(text[begin:end])
            if token is not None and ((left := last(begin)) < 0 or fits(left, token)):
                return token
        raise ValueError("the merge list does not cover all bytes")

    def encode_short(self, piece: bytes) -> bytes:
        """Ids of a short pre-token; states after its prefixes are remembered for the next ones."""
        states, n = self._states, len(piece)
        if len(states) > STATES_KEPT:
            states.clear()
            states[b""] = -1
        end = n
        while piece[:end] not in states:
            end -= 1
        last = lambda at: states[piece[:at]]
        while end < n:
            end += 1
            states[piece[:end]] = self.token_at(piece, end, last)
        out, at = [], n
        while at > 0:
            token = states[piece[:at]]
            out.append(self.packed[token])
            at -= len(self.bytes_of[token])
        out.reverse()
        return b"".join(out)


class Transducer:
    """Encodes one pre-token fed in chunks of bytes; emits ids once no continuation can change them."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.pending = b""  # bytes after the last emitted token
        #: id of the last token of the encoding that ends at each place; at 0, of the last emitted one
        self.last: list[int] = [-1]

    def feed(self, chunk: bytes) -> list[int]:
        ahead = self.m.lookahead
        if len(self.pending) + len(chunk) <= 2 * ahead:
            self._read(chunk)
            return []
        out: list[int] = []
        for at in range(0, len(chunk), ahead):
            self._read(chunk[at : at + ahead])
            if len(self.pending) > 2 * ahead:
                out += self._emit(self._meeting())
        return out

    def finish(self) -> list[int]:
        return self._emit(len(self.pending))

    def _read(self, chunk: bytes) -> None:
        start = len(self.pending)
        self.pending = buffer = self.pending + chunk
        for end in range(start + 1, len(buffer) + 1):
            self.last.append(self.m.token_at(buffer, end, self.last.__getitem__))

    def _meeting(self) -> int:
        """The last place that the chains of all the last ``lookahead`` places go through."""
        places = set(range(max(0, len(self.pending) - self.m.lookahead + 1), len(self.pending) + 1))
        while len(places) > 1:
            end = max(places)
            places.remove(end)
            places.add(end - len(self.m.bytes_of[self.last[end]]))
        return places.pop()

    def _emit(self, end: int) -> list[int]:
        tokens, at = [], end
        while at > 0:
            tokens.append(self.last[at])
            at -= len(self.m.bytes_of[self.last[at]])
        self.pending = self.pending[end:]
        self.last = self.last[end:]
        tokens.reverse()
        return tokens


def slices(text: str) -> Iterator[str]:
    """Cut a long text between two units, about every 64 thousand characters."""
    start = 0
    while len(text) - start > SLICE:
        cut = CUT.search(text, start + SLICE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def segments(text: str, special: re.Pattern | None) -> Iterator[tuple[str, bool]]:
    """Ordinary stretches and special strings, in order."""
    at = 0
    for found in special.finditer(text) if special else ():
        if found.start() > at:
            yield text[at : found.start()], False
        yield found.group(), True
        at = found.end()
    if at < len(text):
        yield text[at:], False


class Encoder:
    """Whole texts to ids (little-endian 32 bit)."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.table = UnitTable(self.encode_unit, self.encode, lead=True)
        # special strings must be told apart from other texts by how they begin
        if not all(x.startswith("<|") for x in self.merges.special):
            raise ValueError("special strings must begin with <|")

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of every row of a string column; a null row is empty."""
        return self.table.encode(texts)

    def encode(self, text: str) -> bytes:
        """Ids of one text, slice by slice."""
        return b"".join(self._chunks(text))

    def _chunks(self, text: str) -> Iterator[bytes]:
        for part, is_special in segments(text, self.merges.special_cut):
            if is_special:
                yield self.merges.packed[self.merges.special[part]]
            else:
                for piece in slices(part):
                    yield from map(self.encode_unit, UNIT.findall(piece))

    def encode_unit(self, unit: str) -> bytes:
        found = PIECES.findall(unit)
        if len(unit) > 2 * self.merges.lookahead:
            return b"".join(map(self._long, found))
        short = self.merges.encode_short
        return b"".join([short(x.encode()) for x in found])

    def _long(self, piece: str) -> bytes:
        t, out = Transducer(self.merges), []
        for at in range(0, len(piece), 4096):
            out += t.feed(piece[at : at + 4096].encode())
        return b"".join(map(self.merges.packed.__getitem__, out + t.finish()))


class Decoder:
    """Ids to text, chunk by chunk: bytes of a character that is cut in two wait for the rest."""

    def __init__(self, merges: Merges):
        self.bytes_of = merges.bytes_of.__getitem__

    def decode(self, ids: np.ndarray) -> str:
        state, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        for at in range(0, len(ids), SLICE):
            out.append(state.decode(b"".join(map(self.bytes_of, ids[at : at + SLICE].tolist()))))
        out.append(state.decode(b"", True))
        return "".join(out)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process: its memory of units serves all tasks there."""
    return Encoder(path)


ROWS = 512  # documents per output batch


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part.column(0), part.column(1)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32 bit) of every row's whole ``text``.

    A null text is empty and has no ids. Special strings in a text become their ids, as the
    library does by default. Repeated rows and null ids of documents pass through; other columns
    are not read. A text of any length is encoded in slices.
    """

    def run(batches):
        e = encoder(path)
        for ids, texts in _columns(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array(e.encode_all(texts), pa.binary())], ["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {_type(docs)}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``text`` of rows made by :func:`encode`; null ids give an empty text."""

    def run(batches):
        d = Decoder(encoder(path).merges)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [d.decode(np.frombuffer(x or b"", "<u4")) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, f"doc_id {_type(encoded)}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` decoded from them, in one pass of the same two machines."""

    def run(batches):
        e = encoder(path)
        d = Decoder(e.merges)
        for ids, texts in _columns(batches):
            packed = e.encode_all(texts)
            back = [d.decode(np.frombuffer(x, "<u4")) for x in packed]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(packed, pa.binary()), pa.array(back, pa.string())], ["doc_id", "ids", "text"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {_type(docs)}, ids binary, text string")


def _type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()
