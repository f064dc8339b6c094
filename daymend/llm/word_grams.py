"""Modified Kneser-Ney counts of words, in shards; what is gathered grows with the trusted text.

A token is a run of characters that are not white space, lower-cased; a character of a script without spaces is a
token of its own. The shards go through the orders from the longest down. Parts tell the shards of an order the grams
of their trusted text; a shard sums them and answers each part the sums and which of its grams it is to speak for. For
these the part tells the order below the continuation counts and the totals of contexts, so each gram is told once,
only keys and counts travel, and nothing of the model is broadcast. Parts then ask for the grams of all their text.

A part is scored by what all other parts counted. Shards know the sums over all parts only; a part takes its own grams
out by itself, as it knows them and is answered their sums (``PartModel``). Trusted documents are scored by text that
is not their own, as all others are, and their quantile is a threshold that holds for both.

Grams are known by ``KEY`` bits of a hash in their shard, so an unseen one passes for a seen one with a probability of
the number of grams in a shard over 2**34. Sorted keys travel as gaps and all numbers by planes of bytes, so a key
takes few more bits than tell it from its neighbours.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.llm import textops as T
from daymend.llm.dealing import batch
from daymend.llm.frames import dropped, stored

ORDER, KEY = 3, 34
TOLD, MODEL, STATS = range(3)
MESSAGE = "part int, bucket int, level int, kind int, body binary"
ASKED = "part int, bucket int, body binary"
BEGIN, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return T.mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


#: The context of the first token of a text.
START = _pair(np.array([BEGIN]), np.array([BEGIN]))[0]


def shrunk(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 on, each plane of bytes compressed by itself."""
    out = []
    for x in arrays:
        planes = np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)
        width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        out.append((len(x), [zstandard.compress(planes[:, k].tobytes(), 1) for k in range(width)]))
    return pickle.dumps(out, protocol=5)


def grown(blob) -> list[np.ndarray]:
    """The arrays of ``shrunk``."""
    out = []
    for n, found in pickle.loads(memoryview(blob.as_buffer() if hasattr(blob, "as_buffer") else blob)):
        planes = np.zeros((n, 8), np.uint8)
        for k, plane in enumerate(found):
            planes[:, k] = np.frombuffer(zstandard.decompress(plane), np.uint8)
        out.append(planes.view("<u8").reshape(-1).astype(np.int64))
    return out


def alone(codes: np.ndarray) -> np.ndarray:
    """Characters of scripts that do not put spaces between words."""
    out = np.zeros(len(codes), bool)
    for a, b in ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)):
        out |= (codes >= a) & (codes <= b)
    return out


def tokens(texts: list[str], symbols: bool = True) -> dict[str, np.ndarray]:
    """Keys of the grams of one to three that end at each token, the token's text, and the token of each symbol.

    A text has its words and an end as tokens, and its characters and an end as symbols.
    """
    lowered = [x.lower() for x in texts]
    lengths = np.array([len(x) for x in lowered], np.int64)
    codes = np.frombuffer(("\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)[: int(lengths.sum()) + len(texts)]
    ends = np.cumsum(lengths + 1) - 1
    first = ends - lengths
    final = np.zeros(len(codes), bool)
    final[ends] = True
    white = ((codes == 32) | ((codes >= 9) & (codes <= 13))) & ~final
    start = ~white
    most = codes.max(initial=0)
    if most >= 0x0E00:
        single = alone(codes) & ~final
        start[1:] &= white[:-1] | single[1:] | single[:-1] | final[:-1] | final[1:]
    else:
        start[1:] &= white[:-1] | final[:-1] | final[1:]
    start[first] = ~white[first]
    own = np.flatnonzero(start | white | final)  # a word ends where the next of these stands
    begun = np.flatnonzero(start[own])
    begins, after = own[begun], np.append(own, len(codes))[begun + 1]
    row = np.searchsorted(ends, begins)
    words = T.text_hashes(codes.astype(np.uint8) if most < 256 else codes, begins, after)
    words = np.where(final[begins], END, words)
    head = np.flatnonzero(np.diff(row, prepend=-1))
    back = lambda keys, border: _headed(keys, head, border)
    two = _pair(back(words, BEGIN), words)
    out = {"row": row, "lengths": lengths, "one": words, "two": two, "three": _pair(back(two, START), words)}
    return out | {"symbol": np.maximum(np.cumsum(start) - 1, np.repeat(head, lengths + 1))} if symbols else out


def _headed(of: np.ndarray, head: np.ndarray, border) -> np.ndarray:
    """What the token before has, with another value for the first tokens of texts."""
    out = np.empty_like(of)
    out[1:] = of[:-1]
    out[head] = border
    return out


def _ids(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Shard in the upper bits, what is known of the gram there in the lower ones."""
    return ((((keys & np.uint64(0xFFFFFF)) % np.uint64(buckets)) << np.uint64(KEY)) | (keys >> np.uint64(64 - KEY))).astype(np.int64)


def _of(n: np.ndarray) -> list[np.ndarray]:
    """What a gram of each count adds to its context: the count, and to the numbers of grams counted 1, 2 and more."""
    return [n, *((n == k).astype(np.int64) for k in (1, 2)), (n > 2).astype(np.int64)]


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ids and the place of each id in them.

    Ids are sorted with their positions in the lower bits of one number, and again without if bits that did not fit tell.
    """
    at_bits = max(1, len(ids).bit_length())
    shift = max(0, int(ids.max(initial=0)).bit_length() + at_bits - 63)
    order = np.sort(((ids >> shift) << at_bits) | np.arange(len(ids))) & ((1 << at_bits) - 1)
    ranked = ids[order]
    if shift and (ranked[1:] < ranked[:-1]).any():
        order = np.argsort(ids, kind="stable")
        ranked = ids[order]
    new = np.diff(ranked, prepend=-1) != 0
    place = np.empty(len(ids), np.int32)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


class Part:
    """The distinct grams of a part by order: sorted ids, and the places in them of each token's gram and context."""

    def __init__(self, found: list[dict[str, np.ndarray]], buckets: int, levels: tuple[int, ...] = (1, 2, 3)):
        self.ids: dict[int, np.ndarray] = {}
        self.gram: dict[int, np.ndarray] = {}
        self.context: dict[int, np.ndarray] = {}
        joined = lambda name, kind: np.concatenate([np.zeros(0, kind), *(x[name] for x in found)])
        heads = [np.diff(x["row"], prepend=-1) != 0 for x in found]
        head = np.flatnonzero(np.concatenate([np.zeros(0, bool), *heads]))
        for level, name, border in ((3, "three", None), (2, "two", START), (1, "one", BEGIN)):
            if level not in levels:
                continue
            keys = joined(name, np.uint64)
            if border is not None:
                keys = np.append(keys, border)  # is a context only
            self.ids[level], place = _distinct(_ids(keys, buckets))
            if border is not None:
                self.context[level + 1] = _headed(place[:-1], head, place[-1])
                place = place[:-1]
            self.gram[level] = place

    def cuts(self) -> dict[int, dict[int, tuple[int, int]]]:
        """By shard: where its ids begin and end in each order."""
        out: dict[int, dict[int, tuple[int, int]]] = {}
        for level, ids in self.ids.items():
            shard = ids >> KEY
            first = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(ids)], strict=False):
                out.setdefault(int(shard[a]), {})[level] = (a, b)
        return out

    def gaps(self, level: int, a: int, b: int) -> np.ndarray:
        return np.diff(self.ids[level][a:b] & ((1 << KEY) - 1), prepend=0)

    def sums(self, level: int, place: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.bincount(place, values, len(self.ids[level])).astype(np.int64)

    def once(self, level: int, tokens: np.ndarray) -> np.ndarray:
        """One of the tokens for each of their grams, by its place."""
        return tokens[np.unique(self.gram[level][tokens], return_index=True)[1]]


def _answered(bodies: list[tuple[int, list[np.ndarray]]], columns: int) -> list[np.ndarray]:
    """Columns of the answers of all shards, in the order of the ids."""
    bodies = sorted(bodies, key=lambda x: x[0])
    return [np.concatenate([np.zeros(0, np.int64), *(x[k] for _, x in bodies)]) for k in range(columns)]


def tell(level: int, part: Part, number: int, answers: pa.Table | None) -> list[tuple]:
    """What a part of trusted tokens tells the shards of an order, after the answers of the order above."""
    if not len(part.gram[level]):
        return []
    every = np.arange(len(part.gram[level]))
    if level == ORDER:
        values = [part.sums(level, part.gram[level], np.ones(len(every)))]
    else:
        n, speaks = _answered([(b, grown(x)) for b, x in zip(answers.column("bucket").to_pylist(), answers.column("body"), strict=True)], 2)
        once = part.once(level + 1, every)
        once = once[speaks[part.gram[level + 1][once]] > 0]
        whole = n[part.gram[level + 1][once]]
        values = [part.sums(level, part.gram[level][once], np.ones(len(once))),
                  *(part.sums(level, part.context[level + 1][once], x) for x in _of(whole))]
    return [(number, shard, level, TOLD, shrunk(part.gaps(level, a, b), *(x[a:b] for x in values)))
            for shard, at in part.cuts().items() if level in at for a, b in [at[level]]]


def shard_step(table: pa.Table) -> pa.Table:
    """The sums of a shard, kept for all who ask, and its answers to the parts that told it."""
    shard, level = (table.column(x)[0].as_py() for x in ("bucket", "level"))
    told = sorted(zip(table.column("part").to_pylist(), (grown(x) for x in table.column("body")), strict=True), key=lambda x: x[0])
    keys = [np.cumsum(x[0]) for _, x in told]
    key, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    sums = [np.bincount(which, np.concatenate([x[k] for _, x in told]), len(key)).astype(np.int64) for k in range(1, len(told[0][1]))]
    n = sums[0]
    out = [(-1, shard, level, MODEL, shrunk(np.diff(key, prepend=0), *sums)),
           (-1, shard, level, STATS, shrunk(*(np.array([x]) for x in (*((n == k).sum() for k in (1, 2, 3, 4)), *(v.sum() for v in _of(n))))))]
    speaks = np.zeros(len(which), np.int64)
    speaks[first] = 1  # the part of the smallest number
    a = 0
    for (part, _), own in zip(told, keys, strict=True):
        b = a + len(own)
        if level > 1:
            out.append((part, shard, level, TOLD, shrunk(n[which[a:b]], speaks[a:b])))
        a = b
    return batch(MESSAGE, out)


def learn(own: DataFrame, found: Callable[[pa.Table], list[dict[str, np.ndarray]]], buckets: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """The model of trusted parts in rows of ``MESSAGE``; by order how many grams are counted 1 to 4 times and what all add up to.

    ``found`` gives the tokens of a part.
    """
    def teller(level: int):
        def first(key: tuple, docs: pa.Table) -> pa.Table:
            return later(key, docs, None)

        def later(key: tuple, docs: pa.Table, answers: pa.Table | None) -> pa.Table:
            return batch(MESSAGE, tell(level, Part(found(docs), buckets, (level, level + 1)), key[0].as_py(), answers))

        return first if level == ORDER else later

    levels = []
    for level in range(ORDER, 0, -1):
        parts = own.groupBy("part")
        if levels:
            parts = parts.cogroup(levels[-1].where(F.col("kind") == TOLD).groupBy("part"))
        levels.append(stored(parts.applyInArrow(teller(level), MESSAGE).groupBy("bucket").applyInArrow(shard_step, MESSAGE), f"grams{level}"))
    every = levels[0].union(levels[1]).union(levels[2])
    stats: dict[int, list[int]] = {}
    for r in every.where(F.col("kind") == STATS).select("level", "body").toLocalIterator():
        sums = [int(x[0]) for x in grown(bytes(r["body"]))]
        stats[r["level"]] = [a + b for a, b in zip(stats.get(r["level"], [0] * len(sums)), sums, strict=True)]
    model = stored(every.where(F.col("kind") == MODEL).select("bucket", "level", "body"), "model")
    for level in levels:
        dropped(level)
    return model, stats


def ask(part: Part, number: int) -> list[tuple]:
    """What a part asks of each shard, in one row for all orders."""
    return [(number, shard, shrunk(*(part.gaps(level, *at.get(level, (0, 0))) for level in (1, 2, 3)))) for shard, at in part.cuts().items()]


def answer(asked: pa.Table, model: pa.Table) -> list[tuple]:
    """The answers of a shard: by order the counts, and below the longest one what grams in the context of each add up to."""
    known = {level: grown(body) for level, body in zip(model.column("level").to_pylist(), model.column("body"), strict=True)}
    keys = {level: np.cumsum(x[0]) for level, x in known.items()}
    out = []
    for number, shard, body in zip(*(asked.column(x).to_pylist() for x in ("part", "bucket", "body")), strict=True):
        values = []
        for level, gaps in zip((1, 2, 3), grown(body), strict=True):
            want = np.cumsum(gaps)
            columns = 1 if level == ORDER else 5
            if level not in keys:
                values += [np.zeros(len(want), np.int64)] * columns
                continue
            at = np.minimum(np.searchsorted(keys[level], want), len(keys[level]) - 1)
            hit = keys[level][at] == want
            values += [np.where(hit, x[at], 0) for x in known[level][1:]]
        out.append((number, shard, shrunk(*values)))
    return out


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts of grams counted once, twice and more often."""
    n1, n2, n3, n4 = (max(1, x) for x in (n1, n2, n3, n4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(x, 0.05), k - 0.05) for k, x in
            ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]


class PartModel:
    """What a part was answered, less what its own trusted tokens add to it; probabilities of its tokens."""

    def __init__(self, part: Part, trusted: np.ndarray, answers: list[tuple[int, list[np.ndarray]]], stats: dict[int, list[int]]):
        self.part = part
        *low, top = _answered(answers, 11)
        self.n = {1: low[0], 2: low[5], 3: top}
        self.sums = {2: low[1:5], 3: low[6:10]}  # of the contexts, which are grams of the order below
        self.sums[1] = [np.array([x]) for x in stats.get(1, [0] * 8)[4:]]
        self.discounts = {k: np.array([0.0, *discounts_of(*stats.get(k, [0] * 8)[:4])]) for k in (1, 2, 3)}
        self._leave_out(np.flatnonzero(trusted))

    def _leave_out(self, own: np.ndarray):
        """A gram that only the part has is no continuation of the order below for it."""
        part = self.part
        lost = part.sums(ORDER, part.gram[ORDER][own], np.ones(len(own)))
        for level in range(ORDER, 0, -1):
            own = part.once(level, own)
            place = part.gram[level][own]
            before = self.n[level][place]
            after = before - lost[place]
            self.n[level][place] = after
            above = part.context[level][own] if level > 1 else np.zeros(len(own), np.int64)
            for sums, a, b in zip(self.sums[level], _of(before), _of(after), strict=True):
                sums -= np.bincount(above, a - b, len(sums)).astype(np.int64)
            own = own[(after == 0) & (before > 0)]
            if level > 1:
                lost = part.sums(level - 1, part.gram[level - 1][own], np.ones(len(own)))

    def log_probabilities(self, spelled: np.ndarray) -> np.ndarray:
        """Of each token, where ``spelled`` is the logarithm of its probability by its characters."""
        part = self.part
        seen, rest = np.zeros(len(spelled)), np.ones(len(spelled))
        for level in range(ORDER, 0, -1):
            total, *kinds = self.sums[level]
            discount = self.discounts[level]
            n = self.n[level]
            known = total > 0
            over = np.where(known, total, 1)
            left = np.where(known, sum(d * k for d, k in zip(discount[1:], kinds, strict=True)) / over, 1)
            context = part.context[level] if level > 1 else np.zeros(len(spelled), np.int64)
            share = (n - discount[np.minimum(n, 3)])[part.gram[level]]
            seen += rest * np.where(known[context], share / over[context], 0)
            rest = rest * left[context]
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(np.maximum(seen, 0)), np.log(rest) + spelled)
