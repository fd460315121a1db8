"""Ids of whole texts by a public byte-level BPE vocabulary, with a bounded cache of words."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words held by the cache; beyond that it starts anew.
CACHE_WORDS = 1_000_000
#: Longer texts are encoded piece by piece, cut where the splitting pattern has a boundary.
PIECE_CHARS = 1 << 19
#: Rows encoded together.
GROUP_ROWS = 128
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_OTHERS = "!-/:-@\\[-`{-~¡-©«¬®-±´¶-¸»¿×÷‐-‧‰-⁞"
_SIMPLE = re.compile(rf"[\t-\r {_LETTERS}0-9{_OTHERS}]*")
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\t-\r {_LETTERS}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_CUT = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")


def _byte_chars() -> dict[int, str]:
    """The vocabulary's character for each byte: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def pieces(text: str, size: int = PIECE_CHARS, *, keep: tuple[str, ...] = ()):
    """The text in pieces that encode to the same ids as the whole. No cut touches a string of keep."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        while cut and any(text.find(k, max(cut.start() - len(k), 0), cut.start() + len(k)) >= 0 for k in keep):
            cut = _CUT.search(text, cut.start() + 1)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Encoder:
    """Encodes texts as Tokenizer.encode(add_special_tokens=False) does: an added token's string gives that token's id.

    Texts of plain Latin characters without an added token are split by an equal pattern and each new word goes through
    the tokenizer's model once; all other texts go through the tokenizer as they are.
    """

    def __init__(self, path: str, most_words: int | None = None):
        from tokenizers import Tokenizer

        self.most_words = most_words

        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.chars = _byte_chars()
        self._empty()

    def _empty(self) -> None:
        tokenize, chars, space = self.tokenizer.model.tokenize, self.chars, self.chars[32]
        self.ids, self.starts = array("I"), array("i", [0])
        ids, starts = self.ids, self.starts

        class Words(dict):
            def __missing__(self, word: str) -> int:
                plain = space + word[1:] if word[0] == " " else word
                if not plain[1:].isalpha() or not word.isascii():
                    plain = word.encode().decode("latin-1").translate(chars)
                ids.extend([t.id for t in tokenize(plain)])
                starts.append(len(ids))
                self[word] = place = len(starts) - 2
                return place

        self.words = Words()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one text as unsigned 32-bit; null is empty."""
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the ids of all texts one after another, and how many each has."""
        if len(self.words) > (self.most_words or CACHE_WORDS):
            self._empty()
        found: list[str] = []
        upto, whole = [], {}
        for i, text in enumerate(texts):
            if text:
                added = tuple(k for k in self.added if k in text)
                if not added and _SIMPLE.fullmatch(text):
                    for p in pieces(text):
                        found += _SPLIT.findall(p)
                else:
                    parts = [np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, np.uint32) for p in pieces(text, keep=added)]
                    whole[i] = np.concatenate(parts)
            upto.append(len(found))
        at = np.fromiter(map(self.words.__getitem__, found), np.int32, len(found))
        starts = np.frombuffer(self.starts, np.int32)
        first = starts[at]
        size = starts[at + 1] - first
        ends = np.cumsum(size, dtype=np.int32)
        total = int(ends[-1]) if len(ends) else 0
        flat = np.frombuffer(self.ids, np.uint32)[np.arange(total, dtype=np.int32) + np.repeat(first - ends + size, size)]
        edges = np.concatenate([np.zeros(1, np.int64), ends.astype(np.int64)])[np.array([0, *upto])]
        sizes = np.diff(edges)
        if whole:
            parts = np.split(flat, edges[1:-1])
            for i, ids in whole.items():
                parts[i], sizes[i] = ids, len(ids)
            flat = np.concatenate(parts)
        return flat, sizes


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, most_words: int | None = None) -> Encoder:
    """One encoder per worker, vocabulary and size of cache."""
    key = (path, most_words)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def encoded(batches: Iterator[pa.RecordBatch], enc: Encoder, end_id: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(documents, ids, ends) of groups of rows of batches with a document and a text: the ids of all texts of a group,
    end_id after each, and where each text's ids end."""
    for batch in batches:
        for at in range(0, batch.num_rows, GROUP_ROWS):
            part = batch.slice(at, GROUP_ROWS)
            flat, sizes = enc.encode_batch(part.column(1).to_pylist())
            yield part.column(0).to_pylist(), np.insert(flat, np.cumsum(sizes), np.uint32(end_id)), np.cumsum(sizes + 1)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
