"""Encoding texts by way of a bounded memo of their words.

The vocabulary `word_bpe_49k` drops white space and never joins ids across it, so a text's ids are those of its
white-space separated words in turn. Words repeat; each Python worker remembers the ids of the first words it meets and
encodes only the others. What is remembered changes the speed, never the ids.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

#: Fixed values of the vocabulary's file: what is one piece, which strings are single ids, and the word-end mark.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPECIAL = {"<|startoftext|>": 49406, "<|endoftext|>": 49407}
WORD_END = "</w>"

#: str.split also splits at these four, which the vocabulary takes as symbols.
_CONTROL = ("\x1c", "\x1d", "\x1e", "\x1f")
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Marks that are pieces of their own behind letters; the first character past Latin letters, below which every text is in form NFC.
_MARKS, _PLAIN_END = frozenset(".,;:!?"), "\u0250"
_SPECIAL = re.compile("(" + "|".join(map(re.escape, SPECIAL)) + ")")

#: Words and pieces that a worker remembers, and characters encoded at once.
MEMO_WORDS, MEMO_PIECES, AT_ONCE = 300_000, 250_000, 1 << 20

#: Encodes many pieces (normalised, without white space) into arrays of ids, or into bytes as the memo keeps them.
PieceEncoder = Callable[[list[str]], list[np.ndarray] | list[bytes]]


@lru_cache(1)
def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are, the others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = itertools.count(256)
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def split_words(text: str) -> list[str]:
    """White-space separated words; lower-cased at once where that can't change what `pieces` makes of them."""
    if "<|" not in text and "Σ" not in text and unicodedata.is_normalized("NFC", text):
        low = text.lower()
        if unicodedata.is_normalized("NFC", low):  # else normalising after lower-casing would compose more
            text = low
    if any(c in text for c in _CONTROL):
        return [x for x in _SPACE.split(text) if x]
    return text.split()


def pieces(word: str) -> list[str]:
    """A word's pieces after normalisation; letters are lower-cased one by one, without a rule for final sigma."""
    low = word.lower()
    if low.isascii() or max(low) < _PLAIN_END:  # most words; nothing there to normalise
        if low.isalpha():
            return [low]
        if low[-1:] in _MARKS and low[:-1].isalpha():
            return [low[:-1], low[-1]]
        return PIECES.findall(low)
    return PIECES.findall(unicodedata.normalize("NFC", word).replace("Σ", "σ").lower())


class WordMemo:
    """Encodes texts into little-endian 32-bit ids; `encode` is asked for unknown pieces only."""

    def __init__(self, encode: PieceEncoder, words: int = MEMO_WORDS, pieces_: int = MEMO_PIECES):
        self._encode, self._caps = encode, (words, pieces_)
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {text: np.int32(i).tobytes() for text, i in SPECIAL.items()}

    def ids(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order; null is empty."""
        held, size = [], 0
        for text in texts:
            held.append(split_words(text or ""))
            size += len(text or "")
            if size >= AT_ONCE:
                yield from self._some(held)
                held, size = [], 0
        yield from self._some(held)

    def _some(self, texts: list[list[str]]) -> Iterator[bytes]:
        known = self._words
        found = [list(map(known.get, words)) for words in texts]
        self._learn({w for words, ids in zip(texts, found, strict=True) if None in ids for w, x in zip(words, ids, strict=True) if x is None})
        for words, ids in zip(texts, found, strict=True):
            if None in ids:
                ids = [known[w] if x is None else x for w, x in zip(words, ids, strict=True)]
            yield b"".join(ids)
        _forget(self._words, self._caps[0])
        _forget(self._pieces, self._caps[1])

    def _learn(self, words: Iterable[str]) -> None:
        whole, cut = {}, {}  # words of one piece apart: a list for each would keep the garbage collector busy
        for word in words:
            if "<|" in word:
                ps = [y for x in _SPECIAL.split(word) for y in ([x] if x in SPECIAL else pieces(x))]
            else:
                ps = pieces(word)
            if len(ps) == 1:
                whole[word] = ps[0]
            else:
                cut[word] = ps
        unknown = list(set(whole.values()).union(*cut.values()).difference(self._pieces))
        encoded = (x if isinstance(x, bytes) else x.astype("<i4").tobytes() for x in self._encode(unknown))
        self._pieces.update(zip(unknown, encoded, strict=True))
        known = self._pieces
        self._words.update((word, known[p]) for word, p in whole.items())
        self._words.update((word, b"".join([known[p] for p in ps])) for word, ps in cut.items())


def _forget(memo: dict, cap: int) -> None:
    """Drop the entries added last; those met first are the frequent ones."""
    for _ in range(len(memo) - cap):
        memo.popitem()


def library_encoder(path: str) -> PieceEncoder:
    """Pieces by the model of the `tokenizers` library."""
    from tokenizers import Tokenizer

    tokenizer, letters = Tokenizer.from_file(path), byte_letters()
    model, packed = tokenizer.model, [i.to_bytes(4, "little") for i in range(max(tokenizer.get_vocab().values()) + 1)]

    def encode(found: list[str]) -> list[bytes]:
        # The letters of ASCII letters, digits and marks are these themselves.
        mapped = (p if p.isascii() and p.isprintable() else "".join([letters[b] for b in p.encode()]) for p in found)
        return [b"".join([packed[t.id] for t in model.tokenize(p)]) for p in mapped]

    return encode


@lru_cache(4)
def library_memo(path: str) -> WordMemo:
    """One memo per worker process and vocabulary file."""
    return WordMemo(library_encoder(path))


def slices(batch: pa.RecordBatch, text: int, limit: int = 4 * AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The rows of `batch` in runs of about `limit` bytes of column `text`, so that what is made of a run stays small."""
    at, size = 0, 0
    for row, value in enumerate(batch.column(text)):
        size += len(value.as_buffer()) if value.is_valid else 0
        if size >= limit:
            yield batch.slice(at, row + 1 - at)
            at, size = row + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def id_lists(encoded: Iterable[bytes]) -> pa.Array:
    """Encoded texts as an Arrow column of lists of 32-bit ids."""
    encoded = list(encoded)
    offsets = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in encoded], out=offsets[1:])
    values = np.frombuffer(b"".join(encoded), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
