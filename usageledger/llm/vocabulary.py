"""A byte-level merge vocabulary file and the splitting of text before its merges."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache
from itertools import islice

import numpy as np
import regex

# Fixed value: the pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A space inside white space that does not lead to a word: there a text cannot be cut at spaces.
_LOOSE = regex.compile(r"\s (?:\s|\Z)")
# Characters outside the blocks whose classes all versions of the character tables agree on.
_VERSIONED = regex.compile(r"[^\u0000-\u0557\u2010-\u2060\u20a0-\u20bf\u2190-\u23ff\u3000-\u9fcc\uac00-\ud7a3]")
_MIXED = 1 << 17
_SLOT_BITS = 20
NONE = np.iinfo(np.int32).max
_STOPS = (",", ".")


def _byte_symbols() -> dict[int, str]:
    """Printable bytes stand for themselves, the rest for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def _hashed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Open addressing: keys and their positions by slot, and the longest probe."""
    slots = np.full((1 << _SLOT_BITS) + 64, -1, dtype=np.int64)
    values = np.full(len(slots), NONE, dtype=np.int32)
    longest = 1
    for i, (key, at) in enumerate(zip(keys.tolist(), _slot(keys).tolist(), strict=True)):
        step = 0
        while slots[at + step] >= 0:
            step += 1
        slots[at + step], values[at + step] = key, i
        longest = max(longest, step + 1)
    return slots, values, longest


class Vocabulary:
    """Merge ranks in a hash table of arrays, and the bytes of every id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        ids = self.spec["model"]["vocab"]
        symbols = _byte_symbols()
        self.path = path
        self.byte_of = {c: b for b, c in symbols.items()}
        self.byte_id = np.array([ids[symbols[b]] for b in range(256)], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in self.spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        self.right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        self._slots, self._slot_ranks, self._probes = _hashed(self.left * _MIXED + self.right)
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"] if t.get("special")}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = bytes(self.byte_of[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        lengths = np.array([len(t) for t in self.token_bytes], dtype=np.int64)
        self._starts = np.concatenate([[0], np.cumsum(lengths)])
        self._bytes = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)
        self._pattern = regex.compile(PATTERN)
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where the pair never merges."""
        keys = left * _MIXED + right
        at = _slot(keys)
        out = np.where(self._slots[at] == keys, self._slot_ranks[at], NONE)
        # Few pairs share a slot; only those whose slot holds another one look further.
        open_ = np.flatnonzero((out == NONE) & (self._slots[at] >= 0))
        for step in range(1, self._probes):
            at_next = at[open_] + step
            hit = self._slots[at_next] == keys[open_]
            out[open_[hit]] = self._slot_ranks[at_next[hit]]
            open_ = open_[~hit & (self._slots[at_next] >= 0)]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids, special ones included."""
        lengths = self._starts[ids + 1] - self._starts[ids]
        return self._bytes[ragged(self._starts[ids], lengths)].tobytes().decode("utf-8", "replace")

    def segments(self, text: str) -> list:
        """The text cut where no pre-token can span the cut.

        A string stands for itself behind a space; a pair holds a piece as it is, as text that is
        still to be split by the pattern, as the bytes of one pre-token, or as a special token.
        """
        if self._specials and any(s in text for s in self.special):
            parts = self._specials.split(text)
            return [p for part in parts if part for p in ([(part, "special")] if part in self.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list:
        if not text.isascii() and _VERSIONED.search(text):
            return [(bytes(self.byte_of[c] for c in piece), "whole") for piece, _ in _splitter(self.path).pre_tokenize_str(text)]
        if _LOOSE.search(text):
            return [(piece, "text") for piece in self._pattern.findall(text)]
        parts = text.split(" ")
        if parts[0]:
            parts[0] = (parts[0], "text")
            return parts
        return parts[1:]

    def pretokens(self, segment) -> list:
        """The pre-tokens of a segment: strings, or what a pair holds if it is not text."""
        if isinstance(segment, str):
            return self._pattern.findall(" " + segment)
        piece, kind = segment
        return self._pattern.findall(piece) if kind == "text" else [piece if kind == "whole" else segment]


@lru_cache(maxsize=4)
def _splitter(path: str):
    """The library's own splitter, for characters whose class depends on its tables' version."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).pre_tokenizer


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per Python worker and file."""
    return Vocabulary(path)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs starts[i] .. starts[i] + lengths[i], one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class _Numbered(dict):
    """Numbers new keys as they are looked up."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


class Encoder:
    """Ids of whole texts; every distinct piece is merged once by `merge`.

    `merge(vocabulary, words)` takes distinct pre-tokens and returns their ids, flat, and their
    lengths. The memory of pieces is cleared at MAX_PIECES, between calls.
    """

    MAX_PIECES = 300_000

    def __init__(self, vocab: Vocabulary, merge: Callable) -> None:
        self.vocab, self.merge = vocab, merge
        self._clear()

    def _clear(self) -> None:
        self._index = _Numbered()
        self._words = _Numbered()
        empty = np.zeros(0, dtype=np.int64)
        self.ids = self.starts = self.lengths = empty
        self._word_ids = self._word_starts = self._word_lengths = empty

    def pieces(self, texts: list[str]) -> list[np.ndarray]:
        """Each text as indices of pieces, whose ids are at `starts`, `lengths` in `ids`."""
        if len(self._index) > self.MAX_PIECES:
            self._clear()
        index, before = self._index, len(self._index)
        number = index.__getitem__
        out = [np.array(list(map(number, self.vocab.segments(text))), dtype=np.int64) for text in texts]
        if len(index) > before:
            self._learn(list(islice(index, before, None)))
        return out

    def _learn(self, fresh: list) -> None:
        """Ids of new pieces; of their pre-tokens only those never seen are merged."""
        words, special, split = self._words, self.vocab.special, self.vocab.pretokens
        known = len(words)
        found: list = []
        sizes: list[int] = []
        for segment in fresh:
            # Letters alone, or with a comma or full stop behind, need no pattern.
            if type(segment) is str:
                if segment.isalpha():
                    found.append(" " + segment)
                    sizes.append(1)
                    continue
                if segment[-1:] in _STOPS and segment[:-1].isalpha():
                    found += (" " + segment[:-1], segment[-1])
                    sizes.append(2)
                    continue
            parts = split(segment)
            found += parts
            sizes.append(len(parts))
        at = np.array(list(map(words.__getitem__, found)), dtype=np.int64)
        new = list(islice(words, known, None))
        plain = [w if isinstance(w, bytes) else w.encode("utf-8", "replace") for w in new if not isinstance(w, tuple)]
        ids, lengths = self.merge(self.vocab, plain)
        if len(plain) < len(new):
            # The pairs among the words are special tokens, of one id each.
            marked = np.array([isinstance(w, tuple) for w in new])
            all_lengths = np.ones(len(new), dtype=np.int64)
            all_lengths[~marked] = lengths
            all_ids = np.empty(int(all_lengths.sum()), dtype=np.int64)
            hold = np.repeat(marked, all_lengths)
            all_ids[~hold] = ids
            all_ids[hold] = [special[w[0]] for w in new if isinstance(w, tuple)]
            ids, lengths = all_ids, all_lengths
        self._word_starts = np.concatenate([self._word_starts, len(self._word_ids) + np.cumsum(lengths) - lengths])
        self._word_lengths = np.concatenate([self._word_lengths, lengths])
        self._word_ids = np.concatenate([self._word_ids, ids])

        piece_ids = self._word_ids[ragged(self._word_starts[at], self._word_lengths[at])]
        per_word = np.concatenate([[0], np.cumsum(self._word_lengths[at])])
        ends = np.cumsum(np.array(sizes, dtype=np.int64))
        counts = per_word[ends] - per_word[ends - np.array(sizes, dtype=np.int64)]
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.lengths = np.concatenate([self.lengths, counts])
        self.ids = np.concatenate([self.ids, piece_ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return [self.ids[ragged(self.starts[p], self.lengths[p])] for p in self.pieces(texts)]


def batches(texts: list, chars: int = 1_000_000):
    """Ranges of a batch of texts holding about so many characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
