"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``min_match`` words: runs of Unicode letters, marks and digits, in normal form (NFKC) and without
case. Documents meet test items on shared
seeds; for each such pair all maximal common runs are found by a rolling (Karp-Rabin) hash, and the longest one that
overlaps no tile is marked again and again until none of ``min_match`` words is left. A document is contaminated
when the tiles cover at least ``coverage`` of an item's words, in whatever order its parts stand in the document.

A text's seeds are counted by item first, each distinct seed once, and only pairs whose seeds could cover enough
are tiled, one pair at a time. So a phrase that a text repeats and that very many items hold costs its items once.

The benchmark goes to the tasks in blocks of at most ``BLOCK_WORDS`` words (16 MB), a pass over the documents for
each block, so its size is bounded at any size of the benchmark. Documents are never shuffled, whatever they share.

Cases: null or empty texts match nothing; an item with fewer than ``min_match`` words matches where all of them stand
in a row; each of several equal items or equal documents is reported by itself; of runs of one length the first in
the document is marked first; empty tables give empty results. Whole texts are compared, however long.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.llm import textops as T
from daymend.llm.frames import text_or_empty

BLOCK_WORDS = 1 << 20
#: Pairs of a seed of a text and a place in an item that are looked at together.
MET = 1 << 20
_word: list[np.ndarray] = []


def _in_words() -> np.ndarray:
    """Is each code point part of a word?"""
    if not _word:
        _word.append(np.array([unicodedata.category(chr(k))[0] in "LMN" for k in range(0x110000)]))
    return _word[0]


def folded(text: str) -> str:
    """Normal form without case; texts that differ in these only become equal."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())


def word_hashes(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of folded words."""
    raw, ends = text.tobytes(), offsets.tolist()
    texts = [folded(raw[a:b].decode("utf-8", "replace")) for a, b in zip(ends, ends[1:], strict=False)]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, ends, rows = T.runs(_in_words()[codes], np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]))
    return T.text_hashes(codes, starts, ends), rows


def maximal_runs(doc_at: np.ndarray, item_at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document place, item place, words) of the maximal common runs, from all common seeds of ``size`` words."""
    order = np.lexsort((doc_at, doc_at - item_at))
    doc_at, item_at = doc_at[order], item_at[order]
    new = np.ones(len(doc_at), bool)
    new[1:] = (np.diff(doc_at) != 1) | (np.diff(item_at) != 1)
    first = np.flatnonzero(new)
    return doc_at[first], item_at[first], np.diff(np.append(first, len(doc_at))) + size - 1


def tile(doc_at: np.ndarray, item_at: np.ndarray, size: int, item_words: int) -> tuple[int, int]:
    """Number of tiles and words they cover: longest first, ties by place in the document, then in the item."""
    heap = [(-n, d, i) for d, i, n in zip(*(x.tolist() for x in maximal_runs(doc_at, item_at, size)), strict=True)]
    heapq.heapify(heap)
    low = int(doc_at.min())
    in_doc, in_item = np.zeros(int(doc_at.max()) - low + size, bool), np.zeros(item_words, bool)
    tiles = covered = 0
    while heap:
        n, d, i = heapq.heappop(heap)
        taken = in_doc[d - low : d - low - n] | in_item[i : i - n]
        if not taken.any():
            in_doc[d - low : d - low - n] = in_item[i : i - n] = True
            tiles, covered = tiles + 1, covered - n
            continue
        free = np.concatenate([[0], (~taken).view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(free))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= size:
                heapq.heappush(heap, (a - b, d + a, i + a))
    return tiles, covered


class Items:
    """One block of the benchmark: seeds with the items and places they come from."""

    def __init__(self, ids: list, texts: list[str], size: int):
        text, offsets = T.buffers(pa.array(texts, pa.large_string()))
        hashes, rows = word_hashes(text, offsets)
        self.ids, self.size = ids, size
        self.words = np.bincount(rows, minlength=len(ids))
        seeds = T.sequence_hashes(hashes, size)
        whole = np.flatnonzero(rows[: len(seeds)] == rows[size - 1 :][: len(seeds)])
        first = np.concatenate([[0], np.cumsum(self.words)])
        order = whole[np.argsort(seeds[whole], kind="stable")]
        self.seeds, self.rows = seeds[order], rows[order]
        order = whole[np.lexsort((seeds[whole], rows[whole]))]  # the same by item
        self.own_seeds, self.own_at = seeds[order], order - first[rows[order]]
        self.own_first = np.searchsorted(rows[order], np.arange(len(ids) + 1))
        self.short = {}  # items below the size of a seed, by their number of words
        for n in range(1, size):
            few = np.flatnonzero(self.words == n)
            whole = T.sequence_hashes(hashes, n)[first[few]] if len(few) else np.zeros(0, np.uint64)
            if len(few):
                order = np.argsort(whole, kind="stable")
                self.short[n] = whole[order], few[order]
        self.marks = np.zeros(1 << 22, bool)
        self.marks[(self.seeds & np.uint64(0x3FFFFF)).astype(np.int64)] = True

    def matches(self, text: np.ndarray, offsets: np.ndarray, coverage: float) -> Iterator[tuple]:
        """(row, item id, tiles, matched words, item words) of the contaminated rows."""
        hashes, rows = word_hashes(text, offsets)
        for words, (known, items) in self.short.items():
            found = T.sequence_hashes(hashes, words)
            inside = np.flatnonzero(rows[: len(found)] == rows[words - 1 :][: len(found)])
            for row, k, _ in _met(rows[inside], found[inside], known, items, len(self.ids)):
                yield row, self.ids[k], 1, words, words
        seeds = T.sequence_hashes(hashes, self.size)
        near = np.flatnonzero(self.marks[(seeds & np.uint64(0x3FFFFF)).astype(np.int64)])
        near = near[rows[near] == rows[near + self.size - 1]]
        places = np.searchsorted(rows[near], np.arange(len(offsets)))
        for row, k, n in _met(rows[near], seeds[near], self.seeds, self.rows, len(self.ids)):
            need = coverage * self.words[k]
            if n * self.size < need:
                continue  # even apart from one another the seeds cover too little
            at, own = near[places[row] : places[row + 1]], slice(self.own_first[k], self.own_first[k + 1])
            lo = np.searchsorted(self.own_seeds[own], seeds[at], "left")
            many = np.searchsorted(self.own_seeds[own], seeds[at], "right") - lo
            tiles, covered = tile(np.repeat(at, many), self.own_at[own][T.ranges(lo, many)], self.size, int(self.words[k]))
            if covered >= need:
                yield row, self.ids[k], tiles, covered, int(self.words[k])


def _met(rows: np.ndarray, seeds: np.ndarray, known: np.ndarray, items: np.ndarray, n_items: int) -> Iterator[tuple[int, int, int]]:
    """(row, item, places of the item that the row's seeds match) of all that share a seed.

    ``known`` are the seeds of the items, sorted, and ``items`` where they come from. A seed counts once for a row however often the
    row repeats it; the places are counted in slices of about ``MET``, so that frequent seeds do not fill the memory.
    """
    order = np.lexsort((seeds, rows))
    rows, seeds = rows[order], seeds[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (seeds[1:] != seeds[:-1])
    rows, seeds = rows[new], seeds[new]
    lo = np.searchsorted(known, seeds, "left")
    n = np.searchsorted(known, seeds, "right") - lo
    rows, lo, n = rows[n > 0], lo[n > 0], n[n > 0]
    upto = np.concatenate([[0], np.cumsum(n)])
    first = np.append(np.flatnonzero(np.diff(rows, prepend=-1)), len(rows))
    for a, b in T.blocks(upto[first], MET):
        part = slice(first[a], first[b])
        if b - a > 1 or upto[first[b]] - upto[first[a]] <= MET:
            pair = np.repeat(rows[part], n[part]) * max(1, n_items) + items[T.ranges(lo[part], n[part])]
            found, count = np.unique(pair, return_counts=True)
            row, item = found // max(1, n_items), found % max(1, n_items)
        else:  # one row that meets very many places
            total = np.zeros(n_items, np.int64)
            for c, d in T.blocks(upto[first[a] : first[b] + 1], MET):
                some = slice(first[a] + c, first[a] + d)
                total += np.bincount(items[T.ranges(lo[some], n[some])], minlength=n_items)
            item = np.flatnonzero(total)
            row, count = np.full(len(item), rows[first[a]]), total[item]
        yield from zip(row.tolist(), item.tolist(), count.tolist(), strict=True)


def item_blocks(benchmark: DataFrame, size: int) -> Iterator[Items]:
    """The benchmark in blocks that are dealt by a hash of the item."""
    items = benchmark.select("item_id", text_or_empty().alias("text"))
    words = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"] // 3
    n = 1 + words // BLOCK_WORDS
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        if rows:
            yield Items([r["item_id"] for r in rows], [r["text"] for r in rows], size)


def contaminations(docs: DataFrame, benchmark: DataFrame, min_match: int = 4, coverage: float = 0.6) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_tiles, matched_words, item_words, coverage."""
    spark = docs.sparkSession
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " \
            f"item_id {benchmark.schema['item_id'].dataType.simpleString()}"
    schema = f"{kinds}, n_tiles long, matched_words long, item_words long"
    out = spark.createDataFrame([], schema)
    item_type = pa.int64() if "bigint" in kinds.split(",")[1] else None
    for items in item_blocks(benchmark, min_match):
        shared = spark.sparkContext.broadcast(items)

        def found(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                text, offsets = T.buffers(batch.column("text"))
                rows = [(lo + r, *x) for lo, hi in T.blocks(offsets) for r, *x in shared.value.matches(
                    text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], coverage)]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(cols[0])), pa.array(cols[1], item_type),
                         *(pa.array(c, pa.int64()) for c in cols[2:])],
                        ["doc_id", "item_id", "n_tiles", "matched_words", "item_words"])

        out = out.union(docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(found, schema))
    return out.withColumn("coverage", F.col("matched_words") / F.col("item_words"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 4, coverage: float = 0.6) -> DataFrame:
    """The rows of ``docs`` without the contaminated ones, all columns kept; a pass for each block of items."""
    for items in item_blocks(benchmark, min_match):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        column = docs.columns.index("text")

        def kept(batches: Iterator[pa.RecordBatch], shared=shared, column=column) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                text, offsets = T.buffers(batch.column(column).fill_null("").cast(pa.string()))
                keep = np.ones(batch.num_rows, bool)
                for lo, hi in T.blocks(offsets):
                    for row, *_ in shared.value.matches(text[offsets[lo] : offsets[hi]],
                                                        offsets[lo : hi + 1] - offsets[lo], coverage):
                        keep[lo + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(kept, docs.schema)
    return docs
