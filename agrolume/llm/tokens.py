"""Subword ids of whole texts with a public word-level BPE vocabulary.

The vocabulary lower-cases, drops white space and never joins two words, so the
ids of a text are those of its words one after another. Words repeat far more
than texts do: each distinct word is encoded once and kept.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

#: Bytes of words and ids that a worker keeps in one of two generations: bounds its memory, never its results.
KEEP_BYTES = 48_000_000
#: What an entry costs besides its letters and ids.
ENTRY = 150
#: A word of letters below U+0100 and ASCII marks behind it needs no normaliser but lower case.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def _little(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}H", *ids)


class Kept(dict):
    """Ids by word, made where they are missing. A full generation becomes the older one; words still in use come back from it."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__({"": b""})
        self.make, self.older, self.size = make, {}, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        self.size += ENTRY + len(word) + len(ids)
        if self.size > KEEP_BYTES:
            self.older = dict(self)
            self.clear()
            self[""], self.size = b"", ENTRY
        self[word] = ids
        return ids


class Encoder:
    """Ids as little-endian unsigned 16-bit bytes per text; equal to encoding each text whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kept = Kept(self._word)
        self.marks = {"": b""}
        # The vocabulary writes each byte as a printable character: learnt from its own pre-tokenizer.
        self.table = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}

    def _whole(self, word: str) -> bytes:
        return _little(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        if m := _PLAIN.fullmatch(word):
            letters, mark = m.groups()
            letters = letters.lower()
            if not letters.isascii():
                letters = letters.translate(self.table)
            if mark not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks = {"": b""}
                self.marks[mark] = self._whole(mark)
            return _little([t.id for t in self.model.tokenize(letters)]) + self.marks[mark]
        return self._whole(word)

    def encode(self, text: str) -> bytes:
        if "<|" not in text:  # the strings of special tokens are told apart by their case
            text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
        return b"".join(map(self.kept.__getitem__, text.replace("\n", " ").split(" ")))


_encoders: dict[str, Encoder] = {}


def forget() -> None:
    """Let go of kept words, in a worker that goes on to other work."""
    _encoders.clear()


def encoder(path: str) -> Encoder:
    """One encoder a worker process, so that kept words outlive a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary file lies on this machine (never copied into the repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)
