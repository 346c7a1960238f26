"""Whole texts through the tokenizers library, unit by unit.

Where a vocabulary's own rules never look across white space, a text is cut at white space as its rules
do, and the library's model encodes each distinct pre-token once; the worker remembers the ids of
pre-tokens and of units. Other vocabularies get the whole text.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import pyarrow as pa
import regex
from tokenizers import Tokenizer

from .bpe import BLANK, PIECES, UNIT, byte_letters, segments, slices
from .units import UnitTable

RUN = re.compile(f"[^{BLANK}]+")
#: entries that a worker remembers of either kind
KEPT = 200_000


class LibraryEncoder:
    """Ids of texts and units, ``id_bytes`` little-endian bytes each."""

    def __init__(self, path: str, id_bytes: int = 4):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.unit, self.split_special, self.piece = _units_of(spec)
        self.size = self.tokenizer.get_vocab_size()
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.letters = {b: c for c, b in byte_letters().items()}
        self.packed = [i.to_bytes(id_bytes, "little") for i in range(self.size)]
        self.pieces: dict[str, bytes] = {}
        self.table = UnitTable(self.encode_unit, self.encode, self.split_special, id_bytes)
        # special strings must be told apart from other texts by how they begin
        self.cut = self.unit is not None and all(x.startswith("<|") for x in special)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of every row of a string column; a null row is empty."""
        return self.table.encode(texts) if self.cut else [self._library(x or "") for x in texts.to_pylist()]

    def encode(self, text: str) -> bytes:
        """Ids of one text."""
        return b"".join(self._chunks(text)) if self.cut else self._library(text)

    def _chunks(self, text: str):
        if self.split_special and self.special and self.special.search(text):
            # white space before a special string is the end of a text for the library
            for part, is_special in segments(text, self.special):
                if is_special:
                    yield self._library(part)
                else:
                    yield from self._known(part)
        else:
            yield from self._known(text)

    def _known(self, text: str):
        for part in slices(text):
            yield b"".join(map(self.encode_unit, self.unit.findall(part)))

    def _library(self, text: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.tokenizer.encode(text, add_special_tokens=False).ids))

    def encode_unit(self, unit: str) -> bytes:
        if not self.split_special and self.special and "<|" in unit and self.special.search(unit):
            return self._library(unit)
        if self.normalizer is not None:
            unit = unit.lower() if unit.isascii() else self.normalizer.normalize_str(unit)
        found = self.piece.findall(unit)
        return self._piece(found[0]) if len(found) == 1 else b"".join(map(self._piece, found))

    def _piece(self, piece: str) -> bytes:
        out = self.pieces.get(piece)
        if out is None:
            letters, packed = self.letters, self.packed
            if piece.isascii() and piece.isprintable():
                spelled = piece.replace(" ", letters[32])
            else:
                spelled = "".join([letters[b] for b in piece.encode()])
            found = self.model.tokenize(spelled)
            out = b"".join([packed[t.id] for t in found])
            if len(piece) <= 256:
                if len(self.pieces) >= KEPT:
                    self.pieces.clear()
                self.pieces[piece] = out
        return out


def _units_of(spec: dict) -> tuple[re.Pattern | None, bool, regex.Pattern | None]:
    """How a vocabulary cuts texts: into units, with special strings taken out first or not, and units into pre-tokens."""
    before = spec.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [before])
    cleaned = spec.get("normalizer") or {}
    cleaners = [x["type"] for x in cleaned.get("normalizers", [cleaned]) if x]
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
    if spec["model"]["type"] != "BPE" or not plain:
        return None, False, None
    if len(steps) == 1 and _byte_level(steps[0], True) and not cleaners:
        return UNIT, True, PIECES
    if (
        len(steps) == 2 and _byte_level(steps[1], False) and set(cleaners) <= {"NFC", "Replace", "Lowercase"}
        and cleaners[-1:] == ["Lowercase"] and steps[0]["type"] == "Split" and steps[0]["invert"]
        and steps[0]["behavior"] == "Removed" and "[^\\s" in steps[0]["pattern"].get("Regex", "")
    ):
        # white space is dropped, so runs of other characters stand alone
        return RUN, False, regex.compile(steps[0]["pattern"]["Regex"])
    return None, False, None


def _byte_level(step: dict, own_pattern: bool) -> bool:
    return step.get("type") == "ByteLevel" and step["use_regex"] is own_pattern and not step["add_prefix_space"]


@lru_cache(2)
def library_encoder(path: str, id_bytes: int = 4) -> LibraryEncoder:
    """One per worker process."""
    return LibraryEncoder(path, id_bytes)


@lru_cache(2)
def vocabulary_size(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size()
