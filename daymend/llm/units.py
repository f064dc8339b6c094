"""Exact token counts and ids by way of the distinct words of a block of text.

A tokenizer whose pieces never reach across a word boundary gives a text the tokens of its words, one word after
the other. Each distinct word is then encoded once by the library and looked up for all its places. The cut
points below are chosen so that this holds byte for byte; ``Words`` and ``Pieces`` check what they rely on when a
vocabulary is opened, and fall back to whole texts where it does not hold.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from daymend.llm import textops as T

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = True
_LETTER[97:123] = True
_WIDE = np.arange(256) >= 0x80
_WORDISH = _LETTER | _WIDE
#: Words of these letters only are lower-cased one to one and are in normal form already.
_SIMPLE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: The splitting pattern that the word cuts below follow.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Cache:
    """Sorted hashes with the bytes and what is known of each; starts anew beyond ``most`` entries, which only costs time.

    A hash is taken for its word only where the bytes are equal too.
    """

    def __init__(self, most: int = 1_500_000):
        self.most, self.empty = most, True
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint16)
        self.used = 0
        self.bytes = np.zeros(1 << 16, np.uint8)
        self.written = 0
        self.place, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def missing(self, keys: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """Which of the words are not known; None where one has the hash of another word."""
        if len(self.keys) + len(keys) > self.most or self.written > 16 * self.most:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        at, size = at[known], (ends - starts)[known]
        if not _same(self.bytes, self.place[at], self.length[at], _padded(text), starts[known], size):
            return None
        return ~known

    def _remember(self, at: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        size = ends - starts
        total = int(size.sum())
        if self.written + total + 8 > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros(max(len(self.bytes), total + 8), np.uint8)])
        place = self.written + np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        self.bytes[self.written : self.written + total] = text[T.ranges(starts, size)]
        self.written += total
        self.place, self.length = np.insert(self.place, at, place), np.insert(self.length, at, size)

    def add(self, keys: np.ndarray, ids: list, counts: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        flat = np.fromiter((x for y in ids for x in y), np.int64, int(counts.sum())) if ids is not None else None
        first = self.used + np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
        if flat is not None:
            if len(flat) and flat.max() > np.iinfo(self.ids.dtype).max:
                self.ids = self.ids.astype(np.uint32)
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        if len(keys):
            self._remember(at, text, starts, ends)
        self.keys = np.insert(self.keys, at, keys)
        self.first = np.insert(self.first, at, first)
        self.count = np.insert(self.count, at, counts)


#: Bytes of long words that are compared at once.
_COMPARE = 1 << 20
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _eights(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of a buffer on; the last eight of the buffer are no part of a word."""
    return np.ndarray(len(buffer) - 7, "<u8", buffer, strides=1)


def _padded(text: np.ndarray) -> np.ndarray:
    return np.concatenate([text, np.zeros(8, np.uint8)])


def _same(left: np.ndarray, left_at, left_size, right: np.ndarray, right_at, right_size) -> bool:
    """Are all ranges of two padded buffers equal, byte by byte?

    Up to 16 bytes are compared as their first and their last eight, longer ranges one byte after the other.
    """
    if not (left_size == right_size).all():
        return False
    a, b = _eights(left), _eights(right)
    if ((a[left_at] ^ b[right_at]) & _FIRST[np.minimum(left_size, 8)]).any():
        return False
    more = np.flatnonzero(left_size > 8)
    ends = left_size[more] - 8
    if (a[left_at[more] + ends] != b[right_at[more] + ends]).any():
        return False
    long = np.flatnonzero(left_size > 16)
    left_at, right_at, size = left_at[long], right_at[long], left_size[long]
    for lo, hi in T.blocks(np.concatenate([[0], np.cumsum(size)]), _COMPARE):
        if not (left[T.ranges(left_at[lo:hi], size[lo:hi])] == right[T.ranges(right_at[lo:hi], size[lo:hi])]).all():
            return False
    return True


def _spread(text: np.ndarray, starts, ends):
    """Distinct byte ranges: hashes, one place of each, and which of them each range is; None where hashes collide."""
    keys, first, which = np.unique(T.text_hashes(text, starts, ends), return_index=True, return_inverse=True)
    again = np.flatnonzero(first[which] != np.arange(len(starts)))
    one, size, padded = first[which[again]], ends - starts, _padded(text)
    if not _same(padded, starts[one], size[one], padded, starts[again], size[again]):
        return None
    return keys, starts[first], ends[first], which


def _strings(text: np.ndarray, starts, ends) -> list[str]:
    raw = text.tobytes()
    return [raw[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class Words:
    """Ids of a byte-level word BPE that drops white space (``.json`` files of the tokenizers library)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        split = [x for x in (config.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"]
        normalizers = [x["type"] for x in (config.get("normalizer") or {}).get("normalizers", [])]
        self.by_words = (
            config["model"]["type"] == "BPE" and normalizers == ["NFC", "Replace", "Lowercase"]
            and len(split) == 1 and split[0]["pattern"] == {"Regex": _PATTERN} and split[0]["behavior"] == "Removed"
            and all(x["content"].startswith("<|") and not re.search(r"\s", x["content"]) and not x["normalized"]
                    for x in config["added_tokens"]))
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [x for x in range(256) if x not in printable]
        self.letters = {x: x for x in printable} | {x: 256 + k for k, x in enumerate(other)}
        self.cache = _Cache()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, found: list[str]) -> list[list[int]]:
        model, letters, out, hard = self.tokenizer.model, self.letters, [], []
        for k, word in enumerate(found):
            if _SIMPLE.fullmatch(word):
                word = word.lower()
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(letters)
                out.append([x.id for x in model.tokenize(word)])
            else:
                out.append(None)
                hard.append(k)
        for k, ids in zip(hard, self.encode([found[k] for k in hard]), strict=True):
            out[k] = ids
        return out

    def cuts(self, text: np.ndarray, offsets: np.ndarray):
        """White-space runs are cut out; words without ' and < are also cut between a Latin letter and ASCII signs."""
        starts, ends, rows = T.runs(~T.WHITE[text], offsets)
        if not len(starts):
            return starts, ends, rows
        wordish = _WORDISH[text]
        edge = np.flatnonzero(wordish[1:] != wordish[:-1]) + 1
        edge = edge[~T.WHITE[text[edge]] & ~T.WHITE[text[edge - 1]]]
        left = wordish[edge - 1]
        second = np.where(left, text[edge - 1], text[np.minimum(edge + 1, len(text) - 1)])
        lead = np.where(left, text[np.maximum(edge - 2, 0)], text[edge])
        latin = (lead == 0xC3) & (second >= 0x80) & (second < 0xC0) & (second != 0x97) & (second != 0xB7)
        near = np.where(left, text[edge - 1], text[edge])
        edge = edge[_LETTER[near] | latin]
        word = np.searchsorted(starts, edge, "right") - 1
        plain = np.ones(len(starts), bool)
        plain[np.searchsorted(starts, np.flatnonzero((text == 0x27) | (text == 0x3C)), "right") - 1] = False
        edge = edge[(edge > starts[word]) & (edge < ends[word]) & plain[word]]
        begin = np.sort(np.concatenate([starts, edge]))
        end = np.sort(np.concatenate([ends, edge]))
        return begin, end, np.searchsorted(offsets, begin, "right") - 1

    def whole(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, without cuts."""
        each = self.encode(_strings(text, offsets[:-1], offsets[1:]))
        lengths = np.array([len(x) for x in each], np.int64)
        flat = np.fromiter((x for y in each for x in y), np.int64, int(lengths.sum()))
        return flat.astype(np.uint32), np.concatenate([[0], np.cumsum(lengths)])

    def ids(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, one row after the other, and the bounds of the rows."""
        n_rows = len(offsets) - 1
        if not self.by_words:
            return self.whole(text, offsets)
        starts, ends, rows = self.cuts(text, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n_rows + 1, np.int64)
        if (found := _spread(text, starts, ends)) is None:
            return self.whole(text, offsets)
        keys, a, b, which = found
        if (new := self.cache.missing(keys, text, a, b)) is None:
            return self.whole(text, offsets)
        if new.any():
            each = self.encode_words(_strings(text, a[new], b[new]))
            self.cache.add(keys[new], each, np.array([len(x) for x in each], np.int64), text, a[new], b[new])
        at = np.searchsorted(self.cache.keys, keys)[which]
        counts = self.cache.count[at]
        flat = self.cache.ids[T.ranges(self.cache.first[at], counts)].astype(np.uint32)
        lengths = np.bincount(rows, counts, minlength=n_rows).astype(np.int64)
        return flat, np.concatenate([[0], np.cumsum(lengths)])

    def counts(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.diff(self.ids(text, offsets)[1])


class Pieces:
    """Token counts of a sentencepiece model (``.model`` files)."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        probe = ["a b", " a  b ", "a\nb", "\n\n a", "x  \n y\t z", "▁a ▁\nb", "a　b \n", "  ", "\n", " \n "]
        self.by_words = not any("▁" in x.lstrip("▁") or "\n" in x for x in pieces)
        self.cache = _Cache()
        self.by_words = self.by_words and all(
            self.counts(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]))[0]
            == len(self.model.encode(x, num_threads=1)) for x in probe)
        self.cache.clear()

    def count_words(self, found: list[str]) -> list[int]:
        """A leading space is the word start that the library adds itself; before a line end it is one more piece."""
        each = self.model.encode([x[1:] if x[0] == " " else x for x in found], num_threads=1)
        return [(1 if x == " " else len(ids)) - (x[0] == "\n") for x, ids in zip(found, each, strict=True)]

    def whole(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The counts of whole texts, without cuts."""
        texts = _strings(text, offsets[:-1], offsets[1:])
        return np.array([len(x) for x in self.model.encode(texts, num_threads=1)], np.int64)

    def counts(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Cut ahead of each run of spaces and each line end; what begins a text counts as if after a space."""
        n_rows = len(offsets) - 1
        if not self.by_words:
            return self.whole(text, offsets)
        if not len(text):
            return np.zeros(n_rows, np.int64)
        full = np.flatnonzero(np.diff(offsets))
        moved = np.insert(text, offsets[:-1][full], 0x20)  # every text that is not empty gets a space ahead
        bounds = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        space, line = moved == 0x20, moved == 0x0A
        cut = line | space
        cut[1:] &= line[1:] | ~space[:-1]
        sign = np.flatnonzero((moved[:-3] == 0xE2) & (moved[1:-2] == 0x96) & (moved[2:-1] == 0x81)) + 3
        cut[sign] = line[sign]  # a written U+2581 is a space to the library
        cut[bounds[:-1][full]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(moved))
        rows = np.searchsorted(bounds, starts, "right") - 1
        if (found := _spread(moved, starts, ends)) is None:
            return self.whole(text, offsets)
        keys, a, b, which = found
        if (new := self.cache.missing(keys, moved, a, b)) is None:
            return self.whole(text, offsets)
        if new.any():
            counted = np.array(self.count_words(_strings(moved, a[new], b[new])), np.int64)
            self.cache.add(keys[new], None, counted, moved, a[new], b[new])
        counts = self.cache.count[np.searchsorted(self.cache.keys, keys)[which]]
        return np.bincount(rows, counts, minlength=n_rows).astype(np.int64)


_open: dict[str, Words | Pieces] = {}


def opened(path: str) -> Words | Pieces:
    """The tokenizer of a file, opened once in each Python worker."""
    if path not in _open:
        _open[path] = Words(path) if path.endswith(".json") else Pieces(path)
    return _open[path]
