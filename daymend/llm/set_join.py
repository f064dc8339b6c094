"""Jaccard join of word-shingle sets over count-vector R-trees.

Tokens (hashes of five-word shingles) are dealt into groups, and a document is the point of its group counts. Two
sets share at most the sum of the smaller counts, group by group, so a pair whose sum stays below what the
threshold needs is out without a look at its tokens.

One tree over all points would not prune: in many dimensions its boxes overlap. The points are therefore first
dealt into cells on fine coordinate blocks, and a tree is built in each cell:

1. Blocks. Sizes of linked sets differ by a quarter at most, so levels of doubling size and, near a border, the next
   one hold both. A level of up to n tokens has n/5 blocks of groups; linked sets differ in at most 2n/9 tokens and
   so agree on each block with a probability of about one third. A document has up to ``BLOCKS`` blocks (small sets
   several independent rounds of them); that no block of a linked pair agrees has a probability below 1e-11.
   Documents with the same counts in a block share a cell.
2. Equal sets are one class, and only one document of it tells cell keys. Parts tell the sums of a key, which are all
   that meets in a task, and are answered its weight. In each cell the class whose cells are the fullest stands for the others, which for
   copies of one text is that text: every class is compared with the one that stands for it most often, by bound and
   then by tokens. This joins most copies without any pairs among them.
3. Cells whose classes are not all connected by then are searched by their R-trees: packed by size and leading
   coordinates, joined with themselves from the root, node pairs cut by the summed minima of their corners.
   Surviving pairs of different components are verified by tokens. Very full cells are searched chunk by chunk.
4. Components of all verified links are the answer.

Tokens travel only to the tasks that verify them, at most twice for each pair; pairs are dealt by their second
document, so one that very many are compared with is spread over all tasks. Nothing is capped.

Cases: a null or empty text, or one of white space, has no shingles and links with nothing; with fewer than five
words the whole sequence is the one shingle; equal ids are one document; rows with a null id get a null component;
empty tables give empty results; further columns are dropped. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.llm import textops as T
from daymend.llm.dealing import deal, n_parts, pack, rows_of, unpack
from daymend.llm.frames import components, stored, text_or_empty

SIZE = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
BLOCKS = 64
#: Tokens of a block at the upper end of a level.
PER_BLOCK = 5
GROUPS = 256
FAN = 16
#: Classes of a cell that one task searches.
CELL = 2048
#: Pairs that one task verifies, about.
PAIRS = 2000


def _per_row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def points(tokens: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Group counts of each set."""
    n = np.diff(bounds)
    rows = np.repeat(np.arange(len(n)), n)
    counts = np.bincount(rows * GROUPS + (tokens >> np.uint64(56)).astype(np.int64), minlength=len(n) * GROUPS)
    counts = counts.reshape(len(n), GROUPS)
    return [counts[k].astype(_kind(n[k])).tobytes() for k in range(len(n))]


def _kind(n: int) -> str:
    """The smallest type that holds any count of a set of ``n`` tokens."""
    return "<u1" if n < 1 << 8 else "<u2" if n < 1 << 16 else "<u4"


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, n_shingles, digest, point)."""
    for batch in batches:
        text, offsets = T.buffers(batch.column("text"))
        for lo, hi in T.blocks(offsets):
            for a in range(lo, hi, 4096):
                b = min(a + 4096, hi)
                tokens, bounds = T.shingles(text[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SIZE)
                n = np.diff(bounds)
                both = np.stack([_per_row_sums(T.mix(tokens), bounds),
                                 _per_row_sums(T.mix(tokens ^ np.uint64(T.BASE)), bounds)], axis=1).astype("<u8")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(n), pa.array([x.tobytes() for x in both], pa.binary()),
                     pa.array(points(tokens, bounds), pa.binary())], ["doc_id", "n_shingles", "digest", "point"])


def block_keys(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell keys of the sets and the set each belongs to."""
    n = np.diff(bounds)
    level = np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)
    keys, owners = [], []
    for up in (0, 1):
        top = level + up
        # a set can only link with one of the next level if it is at least PERCENT of the smallest there
        use = (n > 0) & (top >= 3) & ((up == 0) | (100 * n >= PERCENT * (2**level + 1)))
        for k in np.unique(top[use]).tolist():
            rows = np.flatnonzero(use & (top == k))
            blocks = max(2, round(2**k / PER_BLOCK))
            at = T.ranges(bounds[rows], n[rows])
            own = np.repeat(np.arange(len(rows)), n[rows])
            for turn in range(-(-BLOCKS // blocks)):
                salted = T.mix(tokens[at] + np.uint64(((turn + 1) * T.BASE) & T._MASK))
                block = (salted % np.uint64(blocks)).astype(np.int64)
                near = block < BLOCKS - turn * blocks
                place = own[near] * min(blocks, BLOCKS) + block[near]
                order = np.argsort(place, kind="stable")
                place, value = place[order], T.mix(salted[near][order])
                first = np.flatnonzero(np.diff(place, prepend=-1))
                sums = _per_row_sums(value, np.append(first, len(place)))
                place = place[first]
                tag = np.uint64((k << 40) | (turn << 32)) | (place % min(blocks, BLOCKS)).astype(np.uint64)
                keys.append(T.mix(sums ^ T.mix(tag)))
                owners.append(rows[place // min(blocks, BLOCKS)])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def tell_keys(buckets: int):
    """Cell keys of a part's classes by bucket: (key, number of classes, weight) in ``sums``, the classes in ``docs``.

    Only the document that stands for a class of equal sets speaks, with the size of the class as its weight.
    """

    def told(key: tuple, docs: pa.Table, classes: pa.Table) -> pa.Table:
        classes = classes.sort_by("id")
        ids, size = classes.column("id").to_numpy(), classes.column("size").to_numpy()
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for rows in rows_of(docs) if len(ids) else ():
            rows = rows.filter(pa.array(np.isin(rows.column("doc_id").to_numpy(), ids))).combine_chunks()
            text, offsets = T.buffers(rows.column("text"))
            own = rows.column("doc_id").to_numpy()
            for lo, hi in T.blocks(offsets):
                tokens, bounds = T.shingles(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], SIZE)
                found, of = block_keys(tokens, bounds)
                keys.append(found)
                owners.append(own[lo:hi][of])
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((owners, keys, bucket))
        keys, owners, bucket = keys[order], owners[order], bucket[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
        keys, owners, bucket = keys[new], owners[new], bucket[new]
        found, first = np.unique(bucket, return_index=True)
        sums, docs_of = [], []
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=False):
            at = np.flatnonzero(np.append(True, keys[a + 1 : b] != keys[a : b - 1]))
            n = np.diff(np.append(at, b - a))
            sums.append(pack(key=keys[a:b][at], n=n, weight=np.add.reduceat(size[np.searchsorted(ids, owners[a:b])], at)))
            docs_of.append(pack(doc=owners[a:b]))
        return pa.table({"bucket": pa.array(found, pa.int32()), "part": pa.array([key[0].as_py()] * len(found), pa.int32()),
                         "sums": pa.array(sums, pa.binary()), "docs": pa.array(docs_of, pa.binary())})

    return told


def cell_weights(table: pa.Table) -> pa.Table:
    """Answers each part the weights of its keys over the whole bucket; 0 where one class is alone."""
    told = [unpack(x) for x in table.column("sums")]
    keys, which = np.unique(np.concatenate([x["key"] for x in told]), return_inverse=True)
    total = lambda name: np.bincount(which, np.concatenate([x[name] for x in told]), len(keys)).astype(np.int64)
    full = np.where(total("n") > 1, total("weight"), 0)[which]
    ends = np.cumsum([len(x["key"]) for x in told])[:-1]
    return pa.table({"bucket": table.column("bucket"), "part": table.column("part"),
                     "answer": pa.array([pack(full=x) for x in np.split(full, ends)], pa.binary())})


def shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc, full) of the cells with several classes, ``full`` documents together."""
    for batch in batches:
        for sums, docs, answer in zip(*(batch.column(x) for x in ("sums", "docs", "answer")), strict=True):
            sums, docs, full = unpack(sums), unpack(docs)["doc"], unpack(answer)["full"]
            keys, full = np.repeat(sums["key"], sums["n"]), np.repeat(full, sums["n"])
            several = full > 0
            if several.any():
                yield pa.RecordBatch.from_arrays([pa.array(keys[several].view(np.int64)), pa.array(docs[several]), pa.array(full[several])],
                                                 ["key", "doc", "full"])


def needed(total: np.ndarray) -> np.ndarray:
    """Least overlap of two linked sets with ``total`` tokens together."""
    return -(-PERCENT * total // (100 + PERCENT))


def _matrix(blobs: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Points as rows of counts."""
    out = np.empty((len(blobs), GROUPS), np.int32)
    for k, blob in enumerate(blobs):
        out[k] = np.frombuffer(blob, _kind(sizes[k]))
    return out


def may_link(a: list[bytes], b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Does the sum of the smaller counts reach what a link needs?"""
    return np.minimum(_matrix(a, n_a), _matrix(b, n_b)).sum(axis=1) >= needed(n_a + n_b)


class Tree:
    """An R-tree packed bottom-up; a node keeps the upper corner of its box and the smallest set in it."""

    def __init__(self, matrix: np.ndarray, sizes: np.ndarray):
        spread = np.argsort(-matrix.var(axis=0))[:2] if len(matrix) else [0, 1]
        slabs = np.argsort(sizes, kind="stable").argsort() // (FAN * FAN)
        self.order = np.lexsort((matrix[:, spread[1]], matrix[:, spread[0]] // 2, slabs))
        self.corners, self.sizes = [matrix[self.order]], [sizes[self.order]]
        while len(self.sizes[-1]) > 1:
            first = np.arange(0, len(self.sizes[-1]), FAN)
            self.corners.append(np.maximum.reduceat(self.corners[-1], first, axis=0))
            self.sizes.append(np.minimum.reduceat(self.sizes[-1], first))

    def join(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (a, b) of the pairs of points whose bound allows a link, depth first, some at a time."""
        stack = [(len(self.sizes) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))] if len(self.sizes[0]) > 1 else []
        while stack:
            depth, a, b = stack.pop()
            if depth == 0:
                yield self.order[a], self.order[b]
                continue
            below = len(self.sizes[depth - 1])
            step = np.arange(FAN)
            left = np.repeat(a[:, None] * FAN + step, FAN, axis=1).ravel()
            right = np.tile(b[:, None] * FAN + step, (1, FAN)).ravel()
            fine = (left < below) & (right < below) & ((left < right) if depth == 1 else (left <= right))
            left, right = left[fine], right[fine]
            corners, sizes = self.corners[depth - 1], self.sizes[depth - 1]
            for k in range(0, len(left), 2048):
                x, y = left[k : k + 2048], right[k : k + 2048]
                keep = np.minimum(corners[x], corners[y]).sum(axis=1) >= needed(sizes[x] + sizes[y])
                if keep.any():
                    stack.append((depth - 1, x[keep], y[keep]))


def search_cells(table: pa.Table) -> pa.Table:
    """Pairs (a, b) of different components that a cell's tree lets through."""
    cell, chunk, ids, comp, sizes = (table.column(x).to_numpy() for x in ("cell", "chunk", "id", "component_id", "n"))
    blobs = table.column("point").to_pylist()
    order = np.argsort(cell, kind="stable")
    out = []
    for rows in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
        own = ids[rows]
        n, mixed = sizes[rows], chunk[rows].min() != chunk[rows].max()
        tree = Tree(_matrix([blobs[k] for k in rows.tolist()], n), n)
        for a, b in tree.join():
            apart = comp[rows[a]] != comp[rows[b]]
            if mixed:
                apart &= chunk[rows[a]] != chunk[rows[b]]  # the others are searched where their chunk is alone
            out.append(np.stack([np.minimum(own[a], own[b]), np.maximum(own[a], own[b])], axis=1)[apart])
    pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def send_tokens(docs: pa.Table, wanted: pa.Table) -> pa.Table:
    """The tokens of a part's documents to the tasks that asked for them."""
    ids, tasks = wanted.column("doc").to_numpy(), wanted.column("task").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, tasks = ids[order], tasks[order]
    to, who, sets = [], [], []
    for rows in rows_of(docs) if len(ids) else ():
        own = rows.column("doc_id").fill_null(-1).to_numpy()
        asked = np.flatnonzero(np.isin(own, ids))
        if not len(asked):
            continue
        text, offsets = T.buffers(rows.column("text").take(pa.array(asked)))
        for lo, hi in T.blocks(offsets):
            tokens, bounds = T.shingles(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], SIZE)
            for k in range(lo, hi):
                doc = own[asked[k]]
                blob = tokens[bounds[k - lo] : bounds[k - lo + 1]].tobytes()
                for task in tasks[np.searchsorted(ids, doc) : np.searchsorted(ids, doc, "right")].tolist():
                    to.append(task)
                    who.append(doc)
                    sets.append(blob)
    return pa.table({"task": pa.array(to, pa.int64()), "doc": pa.array(who, pa.int64()), "tokens": pa.array(sets, pa.large_binary()).cast(pa.binary())})


def verify_pairs(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """The pairs that link, by their tokens."""
    known: dict[int, list[np.ndarray]] = {}
    for doc, tokens in zip(sets.column("doc").to_pylist(), sets.column("tokens"), strict=True):
        known.setdefault(doc, []).append(np.frombuffer(tokens.as_buffer(), np.uint64))
    left, right = [], []
    for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
        for x in known.get(a, ()):
            for y in known.get(b, ()):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if len(x) and len(y) and 100 * both >= PERCENT * (len(x) + len(y) - both):
                    left.append(a)
                    right.append(b)
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def verified(pairs: DataFrame, docs: DataFrame, parts: int, files: int | None = None) -> DataFrame:
    """Links among distinct pairs (a, b), in tasks of about PAIRS pairs."""
    pairs = stored(pairs, "pairs", files)
    total = pairs.count()
    if not total:
        return pairs
    tasks = max(parts, -(-total // PAIRS))
    dealt = pairs.withColumn("task", F.pmod(F.xxhash64("b"), F.lit(tasks)))
    wanted = (dealt.select("task", F.col("a").alias("doc")).union(dealt.select("task", F.col("b").alias("doc"))).distinct()
              .withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(parts)).cast("int")))
    sets = (deal(docs, parts).groupBy("part").cogroup(wanted.groupBy("part"))
            .applyInArrow(send_tokens, "task long, doc long, tokens binary"))
    return stored(dealt.groupBy("task").cogroup(sets.groupBy("task")).applyInArrow(verify_pairs, "a long, b long"),
                  "links", tasks)


def set_join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    parts = n_parts(texts)
    known = stored(texts.mapInArrow(describe, "doc_id long, n_shingles long, digest binary, point binary"), "points")
    n_docs = known.count()
    files = lambda rows: 1 + n_docs // rows  # noqa: E731  for results of a few rows a document at most
    full = known.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("n_shingles", "digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("size"))
    sized = stored(classes, "classes", files(50_000))
    classes = sized.drop("size")

    texts = texts.where("doc_id is not null")
    standing = (sized.groupBy("id").agg(F.sum("size").alias("size"))
                .withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")))
    told = stored(deal(texts, parts).groupBy("part").cogroup(standing.groupBy("part"))
                  .applyInArrow(tell_keys(parts), "bucket int, part int, sums binary, docs binary"), "told")
    weights = told.select("bucket", "part", "sums").groupBy("bucket").applyInArrow(cell_weights, "bucket int, part int, answer binary")
    cells = stored(told.join(weights, ["bucket", "part"]).mapInArrow(shared_cells, "key long, doc long, full long"), "cells")
    of_doc = cells.groupBy("doc").agg(F.sum("full").alias("weight"))
    members = cells.join(of_doc, "doc").select("key", F.col("doc").alias("id"), "weight")
    roots = members.groupBy("key").agg(
        F.max_by("id", F.struct("weight", -F.col("id"))).alias("root"), F.count("*").alias("n"))
    members = stored(members.drop("weight").join(roots.where("n > 1"), "key"), "members", files(5_000))

    stands = members.where("id <> root").groupBy("id", "root").agg(F.count("*").alias("shared"))
    first = stored(stands.groupBy("id").agg(F.max_by("root", F.struct("shared", -F.col("root"))).alias("root")), "stands", files(50_000))
    point = full.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "point").join(
        members.select("id").distinct(), "id")
    point = stored(point, "cell_points", files(10_000))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = may_link(*(batch.column(x).to_pylist() for x in ("pa", "pb")),
                            *(batch.column(x).to_numpy() for x in ("na", "nb")))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    sides = (first.select(F.col("root").alias("a"), F.col("id").alias("b"))
             .join(point.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa")), "a")
             .join(point.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb")), "b"))
    links = verified(sides.mapInArrow(bounded, "a long, b long").distinct(), texts, parts, files(50_000))
    joined = stored(components(links), "first_components", files(50_000))

    state = members.select("key", "id").join(joined, "id", "left").select(
        "key", "id", F.coalesce("component_id", "id").alias("component_id"))
    open_cells = (state.groupBy("key").agg(
        F.count("*").alias("m"), F.min("component_id").alias("lo"), F.max("component_id").alias("hi"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("xor"))
        .where("lo < hi").groupBy("m", "sum", "xor").agg(F.min("key").alias("key")))  # cells of equal members once
    chunks = F.ceil(F.col("m") / CELL)
    dealt = (state.join(open_cells.select("key", "m"), "key").join(point, "id")
             .withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(2)), chunks))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
             .select("id", "component_id", "n", "point", "chunk", F.xxhash64(
                 "key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("cell"))
             .withColumn("task", F.pmod(F.xxhash64("cell"), F.lit(4 * parts))))
    pairs = (dealt.groupBy("task").applyInArrow(search_cells, "a long, b long").distinct()
             .join(first.select(F.least("root", "id").alias("a"), F.greatest("root", "id").alias("b")), ["a", "b"], "left_anti"))
    more = verified(pairs, texts, parts)
    final = joined if more.isEmpty() else components(links.union(more))
    return (known.select("doc_id", "n_shingles", "digest").join(classes, ["n_shingles", "digest"], "left")
            .join(final, "id", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(
                "component_id", "id", "doc_id")).alias("component_id")))
