"""Best-fit packing by a plan over the histogram of lengths.

Documents are tokenised once and cut into pieces of at most ``size`` tokens; only longer ones are cut. The driver
sees the histogram (at most ``size`` rows) and plans on counts: longest lengths first, each into the open sequences
with the least room that still fits, many equal sequences at a time. The plan says which ranks of a length go
where; it has a few rows for each length, whatever the number of pieces, and goes to the tasks with the code. A piece takes its
slot by looking up (length, rank within its length) there.

Ranks are counted in two levels, by length and by hash chunk, so that a length which a third of all pieces share
is not sorted in one task. Pieces of a chunk are put in order by all their columns, so a task that runs again numbers them alike.

Cases: a null or empty text is the end id alone; repeated rows are packed one by one; an empty table gives an empty
result; further columns of the input are not read. Of equal pieces it does not matter which takes which slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from daymend.llm import textops as T
from daymend.llm import units
from daymend.llm.frames import stored, text_or_empty

#: Pieces of one length and chunk that are numbered in one sort, about.
CHUNK_ROWS = 100_000


def cut_pieces(tokenizer: str, size: int, end_id: int):
    """A mapInArrow function from (doc_id, text) to pieces (doc_id, piece, start, length, ids_crc32)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = units.opened(tokenizer)
        for batch in batches:
            text, offsets = T.buffers(batch.column("text"))
            for lo, hi in T.blocks(offsets):
                flat, bounds = known.ids(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                ids = np.insert(flat, bounds[1:], end_id).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                pieces = -(-np.diff(bounds) // size)
                rows = np.repeat(np.arange(hi - lo), pieces)
                piece = T.ranges(np.zeros(hi - lo, np.int64), pieces)
                start = piece * size
                first = bounds[rows] + start
                end = np.minimum(first + size, bounds[rows + 1])
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows + lo)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(end - first, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def plan_slots(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts of lengths.

    Rows (length, rank, items, per, sequence, offset): ``items`` pieces from ``rank`` on fill sequences from
    ``sequence`` on with ``per`` pieces in each, the first of them at ``offset``.
    """
    room = np.zeros(size + 1, np.int64)  # open sequences by what is left in them
    held: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
    plan, fresh = [], 0

    def leave(left: int, sequence: int, count: int) -> None:
        if left and count:
            held[left].append((sequence, count))
            room[left] += count

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            fits = np.flatnonzero(room[length:])
            if len(fits):
                left = int(fits[0]) + length
                sequence, count = held[left].pop()
                room[left] -= count
            else:
                left, sequence, count = size, fresh, -(-todo // (size // length))
                fresh += count
            per = left // length
            full = min(count, todo // per)
            if full:
                plan.append((length, rank, full * per, per, sequence, size - left))
                leave(left - per * length, sequence, full)
                rank, todo = rank + full * per, todo - full * per
            sequence, count = sequence + full, count - full
            if count and todo:  # fewer than a whole sequence takes
                plan.append((length, rank, todo, todo, sequence, size - left))
                leave(left - todo * length, sequence, 1)
                rank, todo, sequence, count = rank + todo, 0, sequence + 1, count - 1
            if left < size:
                leave(left, sequence, count)
    return plan


def placed(plan: list[tuple[int, int, int, int, int, int]]):
    """A mapInArrow function from ranked pieces to their places in sequences."""
    table = np.array(sorted(plan), np.int64).reshape(-1, 6).T

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, _, per, sequence, first = table
        known = (length << 40) | rank
        for batch in batches:
            own, at = (batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("length", "rank"))
            row = np.searchsorted(known, (own << 40) | at, "right") - 1
            step = at - rank[row]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence[row] + step // per[row]), pa.array(first[row] + step % per[row] * own)],
                [*batch.schema.names[:5], "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = stored(docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        cut_pieces(tokenizer, size, end_id),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"),
        "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_slots(histogram, size)

    chunks = max(64, sum(histogram.values()) // CHUNK_ROWS)
    dealt = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    bases = (dealt.groupBy("length", "chunk").agg(F.count("*").alias("n"))
             .withColumn("base", F.sum("n").over(
                 Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)))
             .select("length", "chunk", F.coalesce("base", F.lit(0)).alias("base")))
    within = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = (dealt.withColumn("own_rank", within).join(bases, ["length", "chunk"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own_rank") + F.col("base")).alias("rank")))
    columns = [pieces.schema[x] for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
    return ranked.mapInArrow(placed(plan), S.StructType([*columns, S.StructField("sequence_id", S.LongType()),
                                                         S.StructField("offset", S.LongType())]))
