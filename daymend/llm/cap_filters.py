"""Embedding near-duplicates by spherical-cap filters with random product codes.

A filter is a direction, and it holds the vectors in the cap around it. Directions are products of ``blocks`` random
codes on blocks of the (randomly rotated) coordinates, so a vector finds all filters above the threshold by list
decoding: partial products that cannot reach it any more are left out. Vectors of one label meet in the filters they
share and are verified there by cosine in double precision.

The threshold follows the largest label: a filter holds about ``OCCUPANCY`` vectors that have nothing to do with one
another, and a vector is in about ``LISTS`` filters, at least in its best ones. How many these are grows with the label:
filters get sparser and products of codes depend on one another, so ``LEAST`` is doubled until ``PLANTED`` random pairs
at the linking cosine share a filter with a recall of ``RECALL``. The filters are random, so it is no certainty. No
vector and no filter is sampled or capped.

Equal vectors of a label are one class. Large groups of near copies would compare quadratically, so in a filter with
more than ``HOT`` classes those within half the linking angle of its smallest id form a core: any two of them link by
the triangle inequality, and are counted, never compared. What is left of a full filter is split in chunks.
A pair that meets in several filters counts in the smallest of them, so no set of pairs is ever built or sorted out.

Cases: vectors that are null, empty, zero or hold a null or non-finite component, and rows with a null label or id,
link with nothing; vectors of different length do not link; repeated rows count as vectors of their own; an empty
table gives an empty result; further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.llm import textops as T
from daymend.llm.frames import components, stored

COSINE = 0.93
OCCUPANCY, LISTS, LEAST = 3, 20, 10
PLANTED, RECALL = 1000, 0.996
HOT, CELL = 256, 1024
SEED = 20240229


def planted(dim: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors at the linking cosine."""
    rng = np.random.default_rng([seed, dim])
    one, aside = rng.standard_normal((n, dim)), rng.standard_normal((n, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    aside -= (aside * one).sum(axis=1, keepdims=True) * one
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    return one, COSINE * one + np.sqrt(1 - COSINE**2) * aside


class Codes:
    """The filters for vectors of ``dim`` numbers when a label has up to ``n`` classes."""

    def __init__(self, dim: int, n: int):
        share = min(0.05, OCCUPANCY / max(1, n))  # part of the sphere in a cap
        wanted = LISTS / share
        self.blocks = int(min(max(1, dim // 4), max(2, np.ceil(np.log(wanted) / np.log(400)))))
        self.codes = max(4, int(np.ceil(wanted ** (1 / self.blocks))))
        u = np.linspace(-1, 1, 200_001)
        density = np.maximum(0.0, 1 - u * u) ** max(0.0, (dim - 3) / 2)
        above = np.cumsum(density[::-1])[::-1] / density.sum()
        self.threshold = float(u[np.searchsorted(-above, -share)])
        rng = np.random.default_rng([SEED, dim, self.blocks, self.codes])
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.edges = np.linspace(0, dim, self.blocks + 1).astype(int)
        self.books = []
        for a, b in zip(self.edges, self.edges[1:], strict=False):
            book = rng.standard_normal((self.codes, b - a))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True) / np.sqrt(self.blocks))
        self.least = LEAST
        if dim > 1:
            one, other = planted(dim, PLANTED, SEED)
            while self.shared(one, other) < RECALL and self.least < self.codes**self.blocks:
                self.least *= 2

    def shared(self, one: np.ndarray, other: np.ndarray) -> float:
        """Share of the pairs of rows that have a filter in common."""
        (a, left), (b, right) = self.lists(one), self.lists(other)
        size = self.codes**self.blocks
        return len(np.unique(np.intersect1d(a * size + left, b * size + right, assume_unique=True) // size)) / len(one)

    def _decode(self, scores: list[np.ndarray], bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, filter, score) of all products with a score of ``bound`` or more for their row."""
        rest = np.cumsum([s.max(axis=1) for s in scores[::-1]], axis=0)[::-1]
        rows, found, total = np.arange(len(bound)), np.zeros(len(bound), np.int64), np.zeros(len(bound))
        for k, s in enumerate(scores):
            after = rest[k + 1] if k + 1 < len(scores) else np.zeros(len(bound))
            reach = total[:, None] + s[rows] + after[rows][:, None] >= bound[rows][:, None]
            at, code = np.nonzero(reach)
            total = total[at] + s[rows[at], code]
            rows, found = rows[at], found[at] * self.codes + code
        return rows, found, total

    def lists(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for unit vectors, sorted by both."""
        turned = vectors @ self.rotation
        rows, found = [], []
        for lo in range(0, len(turned), 64):
            part = turned[lo : lo + 64]
            scores = [part[:, a:b] @ book.T for a, b, book in zip(self.edges, self.edges[1:], self.books, strict=False)]
            bound = np.full(len(part), self.threshold)
            row, code, total = self._decode(scores, bound)
            few = np.bincount(row, minlength=len(part)) < self.least
            while few.any():  # lower the threshold for these until they have their best ones
                bound[few] -= 0.02
                row, code, total = self._decode(scores, bound)
                few = np.bincount(row, minlength=len(part)) < min(self.least, self.codes**self.blocks)
            keep = np.ones(len(row), bool)
            low = bound < self.threshold
            if low.any():
                order = np.lexsort((-total, row))
                place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
                keep[order] = ~low[row[order]] | (place < self.least)
            rows.append(row[keep] + lo)
            found.append(code[keep])
        rows, found = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort((found, rows))
        return rows[order], found[order]


#: Stands for no core; an id may be any other number.
NONE = np.iinfo(np.int64).min
_codes: dict[tuple[int, int], Codes] = {}


def codes_for(dim: int, n: int) -> Codes:
    if (dim, n) not in _codes:
        _codes[dim, n] = Codes(dim, n)
    return _codes[dim, n]


def unit_rows(blobs: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length, of ``kind`` <f4 or <f8, as unit vectors of doubles."""
    vectors = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)  # squares of very large or small numbers stay finite
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def post(n: int, kind: str):
    """(id, label, weight, embedding) to (id, label, weight, vector, filters): keys of the filters of the label."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(x, kind) for x in batch.column("embedding").to_pylist()]
            labels = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64).astype(np.uint64)
            lists: list[bytes] = [b""] * len(vectors)
            sizes = np.array([len(x) for x in vectors])
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                at, found = codes_for(dim, n).lists(unit_rows([vectors[k].tobytes() for k in rows], kind))
                keys = T.mix(T.mix(labels[rows[at]] ^ T.mix(np.array([dim], np.uint64))) + found.astype(np.uint64)).view(np.int64)
                for k, part in zip(rows.tolist(), np.split(keys, np.flatnonzero(np.diff(at)) + 1), strict=True):
                    lists[k] = np.sort(part).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("weight"), pa.array([x.tobytes() for x in vectors], pa.binary()),
                 pa.array([np.frombuffer(x, np.int64) for x in lists], pa.list_(pa.int64()))],
                ["id", "label", "weight", "vector", "filters"])

    return posted


def certify(kind: str):
    """(id, pivot) of the vectors within half the linking angle of their pivot."""

    def certified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.cos(np.arccos(COSINE) / 2 - 1e-6)
        for batch in batches:
            left, right = batch.column("vector").to_pylist(), batch.column("other").to_pylist()
            sizes = np.array([len(x) for x in left])
            near = np.zeros(len(left), bool)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size).tolist()
                a, b = unit_rows([left[k] for k in rows], kind), unit_rows([right[k] for k in rows], kind)
                near[rows] = np.einsum("ij,ij->i", a, b) >= most
            yield batch.select(["id", "pivot"]).filter(pa.array(near))

    return certified


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest place that each of n places reaches by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verify(kind: str):
    """(id, root, links) of the classes that link in the cells of a task: weight of their links, and one of them."""

    def verify_cells(table: pa.Table) -> pa.Table:
        cell, key, ids, label, weight, core, side, cross = (
            table.column(x).to_numpy() for x in ("cell", "key", "id", "label", "weight", "core", "side", "crossing"))
        blobs, lists = table.column("vector").to_pylist(), table.column("filters")
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        starts, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        order = np.lexsort((ids, cell))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for rows in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(order) else ():
            unit = unit_rows([blobs[k] for k in rows.tolist()], kind)
            a, b = np.nonzero(np.triu(unit @ unit.T >= COSINE, 1))
            use = (label[rows[a]] == label[rows[b]]) & ((core[rows[a]] != core[rows[b]]) | (core[rows[a]] == NONE))
            if cross[rows[0]]:
                use &= side[rows[a]] != side[rows[b]]
            a, b = a[use], b[use]
            own = key[rows[0]]
            first = np.array([own == np.intersect1d(  # counted in the smallest filter that both are in
                values[starts[x] : starts[x + 1]], values[starts[y] : starts[y + 1]], assume_unique=True)[0]
                for x, y in zip(rows[a].tolist(), rows[b].tolist(), strict=True)], bool)
            if not first.any():
                continue
            a, b = a[first], b[first]
            links = np.bincount(a, weight[rows[b]], len(rows)) + np.bincount(b, weight[rows[a]], len(rows))
            told = np.flatnonzero(links)
            out.append((ids[rows[told]], ids[rows[_roots(a, b, len(rows))[told]]], links[told].astype(np.int64)))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("id", "root", "links"), map(pa.array, cols), strict=True)))

    return verify_cells


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    kind = "<f4" if embeddings.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.expr("vec_id is not null and label is not null and size(embedding) > 0 and "
                  "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and "
                  "exists(embedding, x -> x <> 0)")
    valid = rows.where(fine)
    classes = stored(valid.groupBy("label", "embedding").agg(
        F.min("vec_id").cast("long").alias("id"), F.count("*").alias("weight")), "vectors")
    most = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    known = stored(classes.select("id", F.xxhash64("label").alias("label"), "weight", "embedding").mapInArrow(
        post(most, kind), "id long, label long, weight long, vector binary, filters array<long>"), "filters")

    posts = known.select("id", F.explode("filters").alias("key"))
    per_key = stored(posts.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("pivot")).where("m > 1"), "keys")
    hot = per_key.where(F.col("m") > HOT)
    near = (posts.join(hot, "key").select("id", "pivot").distinct()
            .join(known.select("id", "label", "vector"), "id")
            .join(known.select(F.col("id").alias("pivot"), "label", F.col("vector").alias("other")), ["pivot", "label"])
            .mapInArrow(certify(kind), "id long, pivot long"))
    cores = stored(near.groupBy("id").agg(F.min("pivot").alias("core")), "cores")
    core_of = known.select("id", "weight").join(cores, "id")
    core_weight = core_of.groupBy("core").agg(F.sum("weight").alias("core_weight"), F.min("id").alias("least"))

    posted = posts.join(per_key.select("key", "m"), "key").join(cores, "id", "left")
    full = F.col("m") > CELL
    sizes = (posted.where(full).groupBy("key", "core").agg(F.count("*").alias("n"))
             .groupBy("key").agg(F.max_by("core", F.when(F.col("core").isNotNull(), F.col("n"))).alias("main"),
                                 F.coalesce(F.max(F.when(F.col("core").isNotNull(), F.col("n"))), F.lit(0)).alias("in_main")))
    dealt = posted.join(sizes, "key", "left").withColumn(
        "in_core", full & F.coalesce(F.col("core") == F.col("main"), F.lit(False)))
    main = F.col("in_core")
    n_main = F.ceil(F.coalesce("in_main", F.lit(0)) / CELL)
    n_rest = F.ceil((F.col("m") - F.coalesce("in_main", F.lit(0))) / CELL)
    chunk = F.pmod(F.xxhash64("id"), F.greatest(F.when(main, n_main).otherwise(n_rest), F.lit(1)))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))
    place = lambda crossing, x, y: F.struct(crossing.alias("crossing"), x.alias("x"), y.alias("y"))
    no, yes = F.lit(False), F.lit(True)
    cells = F.when(~full, F.array(place(no, F.lit(0).cast("long"), F.lit(0).cast("long")))).when(
        main, F.transform(upto(n_rest), lambda k: place(yes, F.col("chunk"), -k - 1))).otherwise(F.concat(
            F.transform(upto(n_main), lambda k: place(yes, k, -F.col("chunk") - 1)),
            F.transform(upto(n_rest), lambda k: place(F.col("chunk") != k, F.least("chunk", k), F.greatest("chunk", k)))))
    spread = (dealt.withColumn("chunk", chunk)
              .withColumn("place", F.explode(cells))
              .select("id", "key", F.coalesce("core", F.lit(NONE)).alias("core"),
                      F.when(main, -1).otherwise(F.col("chunk")).cast("long").alias("side"),
                      F.col("place.crossing").alias("crossing"), F.xxhash64("key", "place").alias("cell")))
    tasks = max(8, (known.agg(F.sum(F.size("filters")).alias("n")).first()["n"] or 0) // 20_000)
    found = (spread.join(known, "id").withColumn("task", F.pmod(F.xxhash64("cell"), F.lit(tasks)))
             .groupBy("task").applyInArrow(verify(kind), "id long, root long, links long"))
    found = stored(found, "found")

    edges = found.select(F.col("id").alias("a"), F.col("root").alias("b")).union(
        core_of.join(core_weight, "core").select(F.col("id").alias("a"), F.col("least").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    of_class = (classes.join(links, "id", "left").join(cores, "id", "left").join(core_weight, "core", "left")
                .join(components(edges), "id", "left")
                .select("label", "embedding", F.coalesce("component_id", "id").alias("component"),
                        (F.coalesce("core_weight", "weight") - 1 + F.coalesce("links", F.lit(0))).alias("n")))
    linked = valid.join(of_class, ["label", "embedding"]).select(
        "vec_id", F.col("n").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(~F.coalesce(fine, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
