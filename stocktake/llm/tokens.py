"""Token ids of whole texts by a public tokenizer file, with the ids of repeated words kept.

In the files used here (byte-level BPE with a leading-space convention, and word BPE that drops
white space) no token joins the two sides of a single space or line feed: the split patterns of
both start a new piece there. A text is therefore cut into units at single spaces and line feeds,
each distinct unit is encoded once by the ``tokenizers`` library, and the ids are gathered.
Texts where a space or line feed stands next to other white space are encoded whole.
Which way a text goes never changes its ids (tested against whole-text encoding).
"""

from __future__ import annotations

from array import array
from string import punctuation
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stocktake.llm.text import flat

#: A space or line feed next to other white space, or the separator used here: such texts are encoded whole.
SPACE = r"[\s\v\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
MIXED_SPACE = rf"[ \n]{SPACE}|{SPACE}[ \n]|\x00"
#: Distinct units kept by a worker between batches, in two generations of half as many.
KEPT_UNITS = 1 << 19
#: Distinct runs of punctuation kept.
KEPT_TAILS = 1 << 12

_encoders: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder of a tokenizer file (read once per worker process)."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


def drop_encoders() -> None:
    """Gives back what this worker's encoders keep; whoever encodes next reads the file again."""
    _encoders.clear()


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves; the others follow, in order, from U+0100 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_CHARACTERS = byte_characters()
SPACE_CHARACTER = BYTE_CHARACTERS[ord(" ")]


class UnitEncoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Does a unit carry the space before it?
        self.spaced = self._whole(" a") != self._whole("a")
        self.tails: dict[str, list[int]] = {}  # ids of the ASCII punctuation after a word
        self.kept: dict[str, bytes] = {}  # ids as packed uint32, a quarter of a list's size
        self.older: dict[str, bytes] = {}  # the generation before; what is used of it moves on

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _letters(self, unit: str) -> list[int]:
        """Ids of a unit of letters alone (after one space): the model's on its byte characters, as one piece."""
        if unit.isascii():  # letters stand for themselves
            return [t.id for t in self.model.tokenize(SPACE_CHARACTER + unit[1:] if unit[:1] == " " else unit)]
        return [t.id for t in self.model.tokenize(unit.encode().decode("latin-1").translate(BYTE_CHARACTERS))]

    def _unit(self, unit: str) -> list[int]:
        """A unit of letters, with ASCII punctuation after them, is one piece or two; everything else goes the whole way."""
        given = unit  # the library normalises what goes to it itself; doing it twice would compose more
        if not self.spaced:
            unit = normalize("NFC", unit)
            if "Σ" in unit:  # its lower case depends on its place, but not in the library
                return self._whole(given)
            unit = unit.lower()
        body = unit[1:] if unit[:1] == " " else unit
        if body.isalpha():
            return self._letters(unit)
        if body.rstrip(punctuation).isalpha():
            word = unit.rstrip(punctuation)
            tail = unit[len(word) :]
            if tail not in self.tails:
                if len(self.tails) > KEPT_TAILS:
                    self.tails.clear()
                self.tails[tail] = self._whole(tail)
            stem = given[: -len(tail)]
            kept = self.kept.get(stem) or self.older.get(stem)  # most words also stand without it
            return (self._letters(word) if kept is None else array("I", kept).tolist()) + self.tails[tail]
        return self._whole(given) if given else []

    def _units(self, units: list[str]) -> list[bytes]:
        kept, older = self.kept, self.older
        out = []
        for unit in units:
            ids = kept.get(unit)
            if ids is None:
                ids = older.get(unit)
                if ids is None:
                    ids = array("I", self._unit(unit)).tobytes()
                kept[unit] = ids
                if 2 * len(kept) > KEPT_UNITS:
                    self.older = older = kept
                    self.kept = kept = {}
            out.append(ids)
        return out

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts (null: empty), and row offsets."""
        text = pc.fill_null(flat(text), "")
        whole = pc.match_substring_regex(text, MIXED_SPACE).to_numpy(zero_copy_only=False)
        simple = pc.if_else(pa.array(whole), "", text)
        # A line feed becomes a unit of its own; each other unit begins with the space before it, if any.
        lists = flat(pc.split_pattern(pc.replace_substring(pc.replace_substring(simple, "\n", "\x00\n\x00"), " ", "\x00 "), "\x00"))
        encoded = lists.flatten().dictionary_encode()
        known = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()  # many times faster than to_pylist
        if not self.spaced:
            known = [u.strip(" ") for u in known]
        # Ids are gathered as packed bytes, so that no numbers as wide as places stand beside them.
        gathered = pa.array(self._units(known), pa.large_binary()).take(encoded.indices)
        data = gathered.buffers()[2]
        offsets = lists.offsets.to_numpy()
        ends = np.frombuffer(gathered.buffers()[1], np.int64, len(gathered) + 1)[offsets - offsets[0]] // 4
        flat_ids = np.frombuffer(data, np.uint32, int(ends[-1])) if data is not None else np.empty(0, np.uint32)
        counts = np.diff(ends)
        odd = np.flatnonzero(whole)
        if len(odd):
            parts = np.split(flat_ids, np.cumsum(counts)[:-1])
            for r in odd:
                parts[r] = np.array(self._whole(text[int(r)].as_py()), np.uint32)
                counts[r] = len(parts[r])
            flat_ids = np.concatenate(parts)
        return flat_ids, np.concatenate([[0], np.cumsum(counts)])
