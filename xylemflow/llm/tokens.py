"""Token ids of texts, with caches in front of the tokenizer.

The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)`` for tokenizers whose
pre-tokenizer never lets a token cross ASCII white space, as :func:`word_tokenizer` expects. Text of
printable Latin-1 is split by the tokenizer's own pattern, and its pieces are looked up; a new one
goes to the merge model. Other text is looked up by the words between its blanks; a new one goes
through the whole tokenizer, or by its pieces if it is Latin-1.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator

#: Entries of a cache of one Python worker, and characters of a text that are split at a time.
CACHE_WORDS, SPAN = 300_000, 1 << 20

# The pattern of the tokenizer, its letters and numbers restricted to Latin-1.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
_PLAIN = re.compile("[ !-~\xa1-\xff]*")
#: How an id is packed, little-endian.
_CODES = {"<u2": "H", "<u4": "I"}


class Cache(dict):
    """Results of a function of short strings, emptied when it is full."""

    def __init__(self, function: Callable[[str], bytes]):
        super().__init__()
        self.function = function

    def __missing__(self, word: str) -> bytes:
        found = self.function(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) < 64:
            self[word] = found
        return found


class WordTokenizer:
    """Texts to the bytes of their ids, little-endian ``dtype``."""

    def __init__(self, path: str, dtype: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = _CODES[dtype]
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.mapped = {code: level.pre_tokenize_str(chr(code))[0][0] for code in (*range(33, 127), *range(161, 256))}
        self.pieces, self.words = Cache(self._piece), Cache(self._word)

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _piece(self, piece: str) -> bytes:
        return self._packed([t.id for t in self.model.tokenize(piece.translate(self.mapped))])

    def _word(self, word: str) -> bytes:
        if _by_pieces(word):
            return self._plain(word)
        return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))

    def encode(self, text: str) -> bytes:
        return b"".join(
            self._plain(span) if _by_pieces(span) else b"".join(map(self.words.__getitem__, span.split(" "))) for span in spans(text)
        )


def _by_pieces(text: str) -> bool:
    """Whether the text is of Latin-1 alone and holds no special token."""
    return "<|" not in text and _PLAIN.fullmatch(text) is not None


def spans(text: str) -> Iterator[str]:
    """The text in parts of about :data:`SPAN` characters that end at blanks, other blanks as spaces."""
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    low = 0
    while low < len(text):
        high = text.find(" ", low + SPAN) if low + SPAN < len(text) else -1
        high = len(text) if high < 0 else high
        yield text[low:high]
        low = high


_KEPT: dict[tuple[str, str], WordTokenizer] = {}


def word_tokenizer(path: str, dtype: str) -> WordTokenizer:
    """The tokenizer of this Python worker for a vocabulary file."""
    if (path, dtype) not in _KEPT:
        _KEPT[path, dtype] = WordTokenizer(path, dtype)
    return _KEPT[path, dtype]
