"""Token ids of whole texts, with a bounded cache of words.

The public word tokenizer cuts a normalised text into pieces (runs of letters,
single digits, runs of other characters; white space is dropped) and no token
spans two of them, so none spans white space.  Each distinct word is therefore cut
and merged once per task while the cache holds it, and a text's ids are its words'
ids joined.  Texts within Latin-1 are normalised and cut here by the tokenizer's
own rules and only merged by it; all others, and texts that may hold the strings of
special tokens, go through the tokenizer whole.
"""

from __future__ import annotations

import re
import struct

import numpy as np

#: The cache starts anew when it holds so many words; longer words are not held.
MAX_WORDS = 500_000
MAX_CHARS = 64

# How the tokenizer file cuts a lower-case text, for the characters of Latin-1.
# (Fixed values: must equal its pattern and Unicode's letters, numbers and spaces.)
_LETTER = "a-zªµºß-öø-ÿ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t-\r \x85\xa0"
PIECES = f"[{_LETTER}]+|[{_NUMBER}]|'s|'t|'re|'ve|'m|'ll|'d|[^{_SPACE}{_LETTER}{_NUMBER}]+"

_SEPARATORS = re.compile("[\x1c-\x1f]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    itself where printable, else the next free one from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, more = [], 256
    for b in range(256):
        out.append(chr(b if b in keep else more))
        more += b not in keep
    return out


class _Words(dict):
    """Ids of lower-case words, as little-endian unsigned 32-bit bytes; cut and merged when first met."""

    def __init__(self, merged):
        self.merged = merged
        self.letters = _byte_letters()
        self.cut = re.compile(PIECES).findall

    def __missing__(self, word: str) -> bytes:
        # letters alone are one piece, as most words are
        if word.isalpha() or (pieces := self.cut(word)) == [word]:
            name = word if word.isascii() and word.isprintable() else "".join(
                [self.letters[b] for b in word.encode()])
            ids = [t.id for t in self.merged(name)]
            raw = struct.pack(f"<{len(ids)}I", *ids)
        else:
            raw = b"".join([self[p] for p in pieces])
        if len(word) <= MAX_CHARS:
            self[word] = raw
        return raw


class WordTokens:
    """Ids of texts by the tokenizer file ``path``; use one per task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.words = _Words(self.full.model.tokenize)

    def _split(self, text: str) -> list[str] | None:
        """The text's words in lower case, or None where it needs the whole tokenizer."""
        if "<|" in text:
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        # Python splits at these four too, the tokenizer does not
        if not text.isprintable() and _SEPARATORS.search(text):
            return None
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        return text.lower().split()

    def raw(self, text: str) -> bytes:
        """Token ids of a text, as little-endian unsigned 32-bit bytes."""
        words = self._split(text)
        if words is None:
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, words))

    def ids(self, text: str) -> np.ndarray:
        """Token ids of a text, unsigned 32-bit."""
        return np.frombuffer(self.raw(text), "<u4")

    def count(self, text: str) -> int:
        """Number of token ids of a text."""
        words = self._split(text)
        if words is None:
            return len(self.full.encode(text, add_special_tokens=False).ids)
        return sum(map(len, map(self.words.__getitem__, words))) // 4
