"""Documents dealt into parts of bounded size, for operators that come back to the same texts more than once.

A part is a set of documents by hash of their id; rows without an id are dealt by their text. Texts travel as compressed Arrow batches, a fraction of what
shuffled rows would take, and each part is worked on in blocks by one task. What tasks tell one another (hashes,
counts, answers) travels as compressed arrays, one row for each pair of sender and receiver.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.llm.frames import text_or_empty, total_bytes

#: Bytes of text in a part, about.
PART = 8 << 20


def pack(**arrays: np.ndarray) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, protocol=5), 1)


def unpack(blob) -> dict[str, np.ndarray]:
    return pickle.loads(zstandard.decompress(memoryview(blob.as_buffer() if hasattr(blob, "as_buffer") else blob)))


def n_parts(docs: DataFrame) -> int:
    return max(2, -(-total_bytes(docs.select(text_or_empty().alias("text")), "text") // PART))


def packed_rows(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(rows)
    return sink.getvalue().to_pybytes()


def deal(docs: DataFrame, parts: int, waves: int = 1, wave: int = 0) -> DataFrame:
    """Rows (part, docs): all columns of ``docs``, null texts empty, as compressed batches; of each wave only every so many parts."""
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = docs.withColumn("text", text_or_empty()).withColumn("__part", F.pmod(key, F.lit(parts)).cast("int"))
    if waves > 1:
        dealt = dealt.where(F.col("__part") % waves == wave)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("__part").to_numpy(zero_copy_only=False)
            order = np.argsort(part, kind="stable")
            rows = pa.Table.from_batches([batch]).drop_columns(["__part"]).take(pa.array(order))
            keys, first = np.unique(part[order], return_index=True)
            out = []
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
                out.append(packed_rows(rows.slice(a, b - a)))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(out, pa.binary())], ["part", "docs"])

    return dealt.mapInArrow(packed, "part int, docs binary")


def rows_of(table: pa.Table) -> Iterator[pa.Table]:
    """The documents of a part, as they were packed."""
    for blob in table.column("docs"):
        yield pa.ipc.open_stream(blob.as_buffer()).read_all().combine_chunks()


def batch(schema: str, rows: list[tuple]) -> pa.Table:
    """A small table from rows; ``schema`` as Spark writes it, of int, long and binary columns."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({name: pa.array([r[k] for r in rows], kinds[kind]) for k, (name, kind) in enumerate(fields)})
