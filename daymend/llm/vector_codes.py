"""Vector code compression: product codes whose codebooks are found by ball k-means, exactly, in whole numbers.

Components become floor(scale * x); a vector is cut into consecutive parts, and each part is coded by the nearest entry of
its position's codebook. A round assigns all parts and replaces each entry by the floored mean of its parts. Rounds
after the first use the balls of the entries instead of comparing with all of them:

* the ball of an entry is the parts of a block that it held, around where it stands now; its radius is the largest distance;
* its neighbours are the entries within twice the radius. No other entry can be nearer to any part of the ball;
* a part within half the way to the nearest neighbour is in the stable core: it stays without a distance to any other entry;
* the others lie in rings between half the ways to one neighbour and the next, and have as candidates only the
  neighbours whose half way they passed. Rings are worked on in groups whose candidates double.

Bounds are inclusive, so an entry as near as the own one is a candidate and the lower index wins, as in a full search.
Radii of a block are at most those of all its parts, so a block needs no figure of others and a round is one pass.

A round writes the whole vectors (as the smallest integers that hold them) with their codes below the shared folder, and
for each block the sums and counts of its entries in a column of their own, which the update alone reads. To the
driver come the sums by entry: entries times components, whatever the number of vectors. Blocks are single
Arrow batches put together up to ``BLOCK`` rows, and no step deals vectors by key, so there is no hot group.
The join with the label sums broadcasts them up to ``SMALL`` labels and otherwise leaves a hot label to the adaptive skew join.

Cases: vectors that are null or hold null or non-finite components are dropped. All others must be of one length: of
several the most frequent one is coded (of equally frequent ones the longest) and rows of another length are dropped.
A length that the parts do not divide makes the first parts one longer; empty vectors have code 0 and error 0. Null
ids come after all others, rows with the same id are ordered by their vectors, and each counts. With fewer vectors
than entries a codebook is shorter. An empty table gives an empty result. Further columns are not read. Components
whose squared distances would not fit a long raise an error, as no error column could hold them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from daymend.llm.frames import stored

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors that are worked on together, about.
BLOCK = 50_000
#: Rows in one matrix of distances.
ROWS = 8192
#: Label sums that are broadcast.
SMALL = 500_000

Codebooks = list[np.ndarray]


def usable(vector: Column) -> Column:
    """Not null, all components numbers."""
    return vector.isNotNull() & F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf))), F.lit(False))


def cuts(dim: int, parts: int) -> list[slice]:
    """Places of the parts of a vector."""
    sizes = [dim // parts + (k < dim % parts) for k in range(parts)]
    return [slice(sum(sizes[:k]), sum(sizes[: k + 1])) for k in range(parts)]


def gaps(entries: np.ndarray) -> np.ndarray:
    """Squared distances between entries."""
    return ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of points to entries; exact as long as the numbers are."""
    return (points ** 2).sum(1)[:, None] + (entries ** 2).sum(1) - 2 * (points @ entries.T)


def search(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each point among all; the lowest of equally near ones."""
    return np.concatenate([np.zeros(0, np.int64)] + [
        squared(points[k : k + ROWS], entries).argmin(1) for k in range(0, len(points), ROWS)])


def reassign(points: np.ndarray, held: np.ndarray, entries: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, int]:
    """The nearest entry of each point, which ``held`` assigned before the entries moved, and distances computed."""
    own = ((points - entries[held]) ** 2).sum(1)
    out, computed = held.copy(), len(points)
    order = np.lexsort((own, held))
    first = np.flatnonzero(np.diff(held[order], prepend=-1))
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        entry, ball = int(held[order[lo]]), order[lo:hi]
        way = between[entry]
        radius = own[ball[-1]]
        neighbours = np.flatnonzero(way <= 4 * radius)
        neighbours = neighbours[np.argsort(way[neighbours], kind="stable")]
        ring = np.searchsorted(way[neighbours], 4 * own[ball], "right")  # candidates of each part, the own entry among them
        done = int(np.searchsorted(ring, 1, "right"))  # the stable core
        while done < len(ball):
            most = min(2 * int(ring[done]), len(neighbours))
            upto = int(np.searchsorted(ring, most, "right"))
            candidates = np.sort(neighbours[:most])
            for k in range(done, upto, ROWS):
                rows = ball[k : min(k + ROWS, upto)]
                far = squared(points[rows], entries[candidates])
                computed += int(ring[k : k + len(rows)].sum())
                far[way[candidates][None, :] > 4 * own[rows][:, None]] = far.max() + 1  # outside the ring
                out[rows] = candidates[far.argmin(1)]
            done = upto
    return out, computed


def add_up(points: np.ndarray, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of components and counts by entry."""
    sums, counts = np.zeros((entries, points.shape[1]), np.int64), np.bincount(code, minlength=entries)
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.diff(code[order], prepend=-1))
    if len(first):
        sums[code[order][first]] = np.add.reduceat(points[order].astype(np.int64), first, axis=0)
    return sums, counts


class Shape:
    """Length of the vectors and the number types that hold them."""

    def __init__(self, dim: int, largest: int, parts: int) -> None:
        self.dim, self.cuts = dim, cuts(dim, parts)
        widest = 4 * largest * largest * max(1, -(-dim // parts))
        if widest >= 1 << 61:
            raise ValueError(f"components up to {largest} have squared distances beyond a long")
        self.exact = np.float64 if widest < 1 << 50 else np.int64
        self.kept = next(kind for kind in (np.int8, np.int16, np.int32, np.int64) if largest <= np.iinfo(kind).max)

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held).combine_chunks()

    def integers(self, table: pa.Table, column: str) -> np.ndarray:
        """Vectors of a block, as they were stored."""
        raw = b"".join(table.column(column).to_pylist())
        return np.frombuffer(raw, self.kept).reshape(table.num_rows, self.dim)


def quantised(shape: Shape, scale: int) -> Callable:
    """Floored vectors as bytes; a mapInArrow function."""
    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            whole = np.floor(flat * float(scale)).astype(shape.kept).reshape(batch.num_rows, shape.dim)
            rows = pa.array([row.tobytes() for row in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), rows], ["vec_id", "label", "ints"])

    return floor


def assigned(shape: Shape, books: Codebooks, first: bool) -> Callable:
    """A round over blocks: codes, and in the first row of each block its sums; a mapInArrow function."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = [book.astype(shape.exact) for book in books]
        between = [gaps(book) for book in exact]
        for table in shape.blocks(batches):
            whole = shape.integers(table, "ints").astype(shape.exact)
            held = None if first else np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(-1, len(books))
            codes, totals = [], []
            for k, (place, book) in enumerate(zip(shape.cuts, exact, strict=True)):
                points = np.ascontiguousarray(whole[:, place])
                codes.append(search(points, book) if first else
                             reassign(points, held[:, k].astype(np.int64), book, between[k])[0])
                totals += [x.ravel() for x in add_up(points, codes[-1], len(book))]
            packed = np.stack(codes, 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [*(table.column(x).combine_chunks() for x in ("vec_id", "label", "ints")),
                 pa.array([row.tobytes() for row in packed], pa.binary()),
                 pa.array([np.concatenate(totals).tobytes(), *[None] * (table.num_rows - 1)], pa.binary())],
                ["vec_id", "label", "ints", "code", "totals"])

    return assign


def coded(shape: Shape, books: Codebooks) -> Callable:
    """The last assignment: codes and errors; a mapInArrow function."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = [book.astype(shape.exact) for book in books]
        between = [gaps(book) for book in exact]
        for table in shape.blocks(batches):
            whole = shape.integers(table, "ints").astype(shape.exact)
            held = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(-1, len(books)).astype(np.int64)
            codes, error = [], np.zeros(table.num_rows, np.int64)
            for k, (place, book) in enumerate(zip(shape.cuts, exact, strict=True)):
                points = np.ascontiguousarray(whole[:, place])
                codes.append(reassign(points, held[:, k], book, between[k])[0])
                error += ((points - book[codes[-1]]) ** 2).sum(1).astype(np.int64)
            packed = np.stack(codes, 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [table.column("vec_id").combine_chunks(), table.column("label").combine_chunks(),
                 pa.array([row.tobytes().hex() for row in packed], pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"])

    return code


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of all blocks of a task, one row per place."""
    total = None
    for batch in batches:
        for blob in batch.column("totals"):
            one = np.frombuffer(blob.as_buffer(), np.int64)
            total = one.copy() if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], ["place", "total"])


def moved(books: Codebooks, coded_rows: DataFrame) -> Codebooks:
    """Each entry replaced by the floored mean of its parts; unused entries stay."""
    sums = (coded_rows.select("totals").where("totals is not null").mapInArrow(folded, "place long, total long")
            .groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    total = {r["place"]: int(r["total"]) for r in sums.collect()}  # entries times components
    out, at = [], 0
    for book in books:
        n, d = book.shape
        counts = [total[at + n * d + e] for e in range(n)]
        out.append(np.array([[total[at + e * d + i] // counts[e] if counts[e] else int(book[e, i]) for i in range(d)]
                             for e in range(n)], np.int64).reshape(n, d))
        at += n * d + n
    return out


def compress(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """Rows (vec_id, label, code, error) of the columns vec_id, label and embedding, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte a part")
    kept = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    top = (kept.groupBy(F.size("vector").alias("dim"))
           .agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("vector", F.abs))).alias("largest"))
           .orderBy(F.desc("n"), F.desc("dim")).first())
    result = t.StructType([vectors.schema["vec_id"], vectors.schema["label"],
                           t.StructField("code", t.StringType()), t.StructField("error", t.LongType())])
    if top is None:
        return vectors.sparkSession.createDataFrame([], result), []
    kept = kept.where(F.size("vector") == top["dim"])
    shape = Shape(top["dim"], math.floor((top["largest"] or 0.0) * scale) + 1, parts)
    seeds = np.array([[math.floor(x * scale) for x in r["vector"]] for r in
                      kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()], np.int64)
    books = [seeds[:, place].copy() for place in shape.cuts]

    columns = t.StructType([vectors.schema["vec_id"], vectors.schema["label"], t.StructField("ints", t.BinaryType())])
    with_codes = t.StructType([*columns, t.StructField("code", t.BinaryType()), t.StructField("totals", t.BinaryType())])
    rows = kept.mapInArrow(quantised(shape, scale), columns)
    for k in range(rounds):
        rows = stored(rows.drop("totals").mapInArrow(assigned(shape, books, first=k == 0), with_codes), "codes")
        books = moved(books, rows)
    if not rounds:
        rows = rows.mapInArrow(assigned(shape, books, first=True), with_codes)
    return stored(rows.drop("totals").mapInArrow(coded(shape, books), result), "coded"), books


def written(books: Codebooks) -> str:
    """Hex sha256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame) -> DataFrame:
    """The columns of the contract: vec_id, code, error, label_error, codebooks_sha256."""
    rows, books = compress(vectors)
    sums = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    small = sums.count() <= SMALL
    both = rows.alias("r").join((F.broadcast(sums) if small else sums).alias("s"), F.expr("r.label <=> s.label"))
    return both.select("vec_id", "code", "error", "label_error", F.lit(written(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """The rounds written out as DuckDB SQL, every part against every entry."""
    steps = [f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
piece AS MATERIALIZED (
  SELECT vec_id, label, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS v
  FROM kept, (SELECT unnest(range({PARTS})) AS p)),
comp AS MATERIALIZED (SELECT vec_id, p, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM piece),
book0 AS MATERIALIZED (
  SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM piece) WHERE e < {ENTRIES})"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT vec_id, label, p, e, far FROM (
    SELECT vec_id, label, p, e, far, row_number() OVER (PARTITION BY vec_id, p ORDER BY far, e) AS place FROM (
      SELECT vec_id, label, a.p, e,
             list_inner_product(a.v, a.v) + list_inner_product(b.v, b.v) - 2 * list_inner_product(a.v, b.v) AS far
      FROM piece a JOIN book{k} b ON a.p = b.p))
  WHERE place = 1)""")
        if k < ROUNDS:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v
  FROM book{k} b LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS v FROM (
      SELECT c.p, n.e, c.i, floor(sum(c.x) / count(*)) AS x
      FROM comp c JOIN near{k} n ON c.vec_id = n.vec_id AND c.p = n.p GROUP BY c.p, n.e, c.i)
    GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)""")
    last = ROUNDS
    return ",".join(steps) + f""",
whole AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM near{last} GROUP BY vec_id, label),
digest AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS d
  FROM (SELECT p, e, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM book{last}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
FROM whole, digest
"""


ORACLE = _oracle()
