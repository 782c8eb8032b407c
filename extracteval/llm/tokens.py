"""Whole-text encoding with the public tokenizers library, one library call per distinct word.

A text is cut only where no token of the tokenizer's own pre-split can span the cut: before white
space that follows another character, and between a Latin letter and one of a few ASCII marks.
Encoding the pieces one after another therefore gives exactly the ids of encoding the text whole,
and a worker asks the library once for each distinct piece.  Texts for which that does not hold
(U+001C..U+001F, which Python and the library class differently) are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from sys import getsizeof

import numpy as np

# Latin-1 letters and the ASCII marks that always start a token of their own.
_WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[,.;:!?*#$%&|])"
_WITH_SPACE = re.compile(rf"\s*+{_WORD}|\s*+\S++|\s++").findall
_NO_SPACE = re.compile(rf"{_WORD}|\S++").findall
_ODD_SPACE = "\x1c\x1d\x1e\x1f"
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
# Byte-level vocabularies write a byte as itself where it prints, else as the next sign from U+0100.
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTS)}
_SPACE_SIGN = chr(_BYTE_SIGNS[32])
CACHE_BYTES = 256 << 20  # memory bound of a worker's cache
_ENTRY_BYTES = 64  # of a dictionary slot


class _Unsafe(Exception):
    """A space follows other white space, so the text cannot be cut before it."""


class _Pieces(dict):
    """Piece -> id bytes, filled on demand; ``lead`` is put before a piece that is looked up.

    Entries that fill their share of the bytes become the older half, which is still asked; an older
    half is dropped when the next one is full.  Pieces that are met again stay.
    """

    def __init__(self, owner: TextEncoder, lead: str, cut: bool, limit: int):
        super().__init__()
        self.owner, self.lead, self.cut = owner, lead, cut
        self.limit, self.used, self.older = limit // 2, 0, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None and piece.isalpha() and piece.isascii():
            # one token of the pre-split
            ids = self.owner.letters(self.lead + piece)
            if len(piece) > 48:
                return ids
        if ids is None:
            if self.lead and (not piece or piece[-1].isspace()):
                raise _Unsafe
            parts = self.owner.findall(self.lead + piece) if self.cut else ()
            ids = b"".join(map(self.owner.part, parts)) if len(parts) > 1 else self.owner.word(self.lead + piece)
            if len(piece) > 48 or len(parts) > 2:
                return ids
        if self.used >= self.limit:
            self.older, self.used = dict(self), 0
            self.clear()
        self[piece] = ids
        self.used += _ENTRY_BYTES + getsizeof(piece) + getsizeof(ids)
        return ids


class TextEncoder:
    """Texts to little-endian id bytes (``dtype``), as the library encodes them whole.

    ``spaces``: the tokenizer keeps white space (byte-level BPE) or drops it (BPE with word ends).
    """

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        # a public vocabulary's name is looked up where the encoder runs
        self.tokenizer = Tokenizer.from_file(path if os.path.isfile(path) else public_path(path))
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.spaces = spaces
        self.findall = _WITH_SPACE if spaces else _NO_SPACE
        self.after_space = _Pieces(self, " " if spaces else "", cut=True, limit=CACHE_BYTES * 3 // 4)
        self.bare = _Pieces(self, "", cut=False, limit=CACHE_BYTES // 4)
        self.model = self.tokenizer.model

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.code, ids).tobytes()

    def word(self, piece: str) -> bytes:
        """One piece; plain Latin letters are one pre-split token, so the model alone decides."""
        bare = piece[1:] if piece[:1] == " " else piece
        if _LETTERS(bare):
            return self.letters(piece)
        return self.whole(piece)

    def letters(self, piece: str) -> bytes:
        """Latin letters, perhaps after one space."""
        if not self.spaces:
            piece = piece.lstrip(" ").lower()
        # ASCII letters are their own signs
        signs = piece.replace(" ", _SPACE_SIGN) if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_SIGNS)
        return array(self.code, [t.id for t in self.model.tokenize(signs)]).tobytes()

    def part(self, piece: str) -> bytes:
        """A piece of a longer one, looked up where the cache holds its kind."""
        if self.spaces and piece[:1] == " " and len(piece) > 1 and not piece[1].isspace():
            return self.after_space[piece[1:]]
        return self.bare[piece]

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(c in text for c in _ODD_SPACE):
            return self.whole(text)
        if not self.spaces:
            return b"".join(map(self.after_space.__getitem__, text.split()))
        head, *rest = text.split(" ")
        try:
            if not head or head[-1].isspace():
                raise _Unsafe
            start = b"".join(map(self.part, self.findall(head)))
            return start + b"".join(map(self.after_space.__getitem__, rest))
        except _Unsafe:
            return b"".join(map(self.bare.__getitem__, self.findall(text)))

    def blobs(self, texts: Iterable[str | None], end: int) -> Iterable[bytes]:
        """Id bytes of each text followed by ``end``."""
        tail = np.array([end], dtype=self.dtype).tobytes()
        for text in texts:
            yield self(text) + tail

    def ids(self, texts: Iterable[str | None], end: int) -> Iterable[np.ndarray]:
        """Ids of each text followed by ``end``."""
        for blob in self.blobs(texts, end):
            yield np.frombuffer(blob, dtype=self.dtype)


@lru_cache(maxsize=1)
def encoder(path: str, spaces: bool) -> TextEncoder:
    """The worker's encoder; kept between tasks of the same worker."""
    return TextEncoder(path, spaces)


def public_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
