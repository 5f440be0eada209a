"""Token ids of whole texts, one library call per distinct piece.

A text is cut only where its tokenizer is certain to cut (at white space),
so the ids of the pieces, joined, are those of the whole text as the library
encodes it by default: strings of added tokens in a text give their ids.  Pieces recur
often: each worker keeps the ids of those it has seen in a table of bounded
size, and the tokenizers library encodes the others.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder(dict):
    """piece -> ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, max_pieces: int = 500_000):
        super().__init__()
        self.earlier: dict[str, bytes] = {}  # the table before the last time it was full
        self.plain, self.lower = None, False
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.max_pieces = max_pieces
        self.dtype = id_dtype(path)
        self.code = np.dtype(self.dtype).char
        spec = json.loads(self.tokenizer.to_str())
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        added = spec.get("added_tokens") or []
        # strings that the library cuts out first; texts without the first two characters of any hold none
        self.added = re.compile("|".join(re.escape(t["content"][:2]) for t in added), re.I) if added else None
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in added):
            self.cut = lambda text: [text]
        elif pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            self.cut, self.plain = self._before_space, re.compile(f"(\n?)( ?[{_LETTERS}]+)({_MARKS}*)")
        elif _drops_space(pre) and {n["type"] for n in norm.get("normalizers", [])} <= {"NFC", "Replace", "Lowercase"}:
            self.lower = any(n["type"] == "Lowercase" for n in norm["normalizers"])
            self.cut, self.plain = self._at_space, re.compile(f"()([{_LETTERS}]+)({_MARKS}*)")
        else:
            self.cut = lambda text: [text]

    def __missing__(self, piece: str) -> bytes:
        ids = self.earlier.get(piece)
        if ids is None:
            ids = self._new(piece)
        if len(piece) <= 64:
            if len(self) >= self.max_pieces:
                self.earlier = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _new(self, piece: str) -> bytes:
        parts = self.plain.fullmatch(piece) if self.plain else None
        if parts:
            lead, word, marks = parts.groups()
            if lead or marks:  # a line break before a word and a run of marks after it are pieces of their own
                return (self[lead] if lead else b"") + self[word] + (self[marks] if marks else b"")
            # one word: normalised here, and left to the library's model alone
            word = (word.lower() if self.lower else word).encode().decode("latin-1").translate(_BYTE_CHARS)
            return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _at_space(self, text: str) -> list[str]:
        """For tokenizers that drop white space."""
        if self.lower and text.isascii() and not (self.added and self.added.search(text)):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def _before_space(self, text: str) -> list[str]:
        """For byte-level tokenizers, whose pieces begin with their space: a
        cut is sure before a space that follows a character that is none."""
        if _SPACES.search(text) or "\x00" in text:
            return _SURE_CUT.split(text)
        return text.replace("\n", "\x00\n").replace(" ", "\x00 ").split("\x00")

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.cut(text))) if text else b""


# Letters of Latin-1: one code point each in either case, and composed already.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# Marks of ASCII: no letter, digit or white space, so a run of them is cut from a word.
_MARKS = r"[!-/:-@\[-`{-~]"


def _byte_chars() -> dict[int, str]:
    """The character that byte-level tokenizers write for each byte: printable
    Latin-1 characters for themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(others)}


_BYTE_CHARS = _byte_chars()
_SPACES = re.compile(r"\s[ \n]")
_SURE_CUT = re.compile(r"(?<=\S)(?=[ \n\t\r])")
_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def _drops_space(pre: dict) -> bool:
    """A Split that keeps only what its pattern finds, none of it white space."""
    first = (pre.get("pretokenizers") or [{}])[0]
    pattern = str(first.get("pattern", {}).get("Regex", ""))
    return first.get("behavior") == "Removed" and bool(first.get("invert")) and r"[^\s" in pattern and r"|\s" not in pattern


def id_dtype(path: str) -> str:
    """The smallest unsigned type that holds every id of the vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def encoder(path: str, max_pieces: int = 500_000) -> PieceEncoder:
    """This worker's encoder; kept between tasks.  Its table takes about 100
    MB for every 300,000 of ``max_pieces``."""
    if (path, max_pieces) not in _ENCODERS:
        _ENCODERS[path, max_pieces] = PieceEncoder(path, max_pieces)
    return _ENCODERS[path, max_pieces]
