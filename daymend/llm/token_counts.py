"""Token counts by a digest cache.

The cache is a Parquet folder of (content_digest, version_digest, n_tokens). A text is looked up by the SHA-256 of
its normalised content together with the digest of the tokenizer file and library version; only distinct contents
that the cache lacks are encoded, and what was encoded is appended for the next run.

Normalised content means null read as the empty text and nothing else: a tokenizer may see any other difference.

Cases: null and empty texts have 0 bytes; repeated contents are encoded once; an empty table gives an empty result
and appends nothing; further columns of the input are dropped unless they are the id; rows with a null or repeated
id keep one result row each. Two runs that append at the same time may store a count twice; reads take one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymend.llm import textops as T
from daymend.llm import units
from daymend.llm.frames import text_or_empty
from daymend.session import fresh_root

CACHE = "content_digest binary, version_digest string, n_tokens long"


def version_digest(tokenizer: str) -> str:
    """Digest of the tokenizer's bytes and of the library that reads them."""
    library = "tokenizers" if tokenizer.endswith(".json") else "sentencepiece"
    with open(tokenizer, "rb") as file:
        return hashlib.sha256(file.read() + f"\n{library} {version(library)}".encode()).hexdigest()


def open_cache(spark: SparkSession, path: str, digest: str) -> DataFrame:
    """Stored counts of one tokenizer version; a cache that does not exist yet is empty."""
    try:
        rows = spark.read.schema(CACHE).parquet(path)
    except AnalysisException:
        rows = spark.createDataFrame([], CACHE)
    return rows.where(F.col("version_digest") == digest).select("content_digest", "n_tokens")


def count_texts(tokenizer: str):
    """A mapInArrow function from (content_digest, text) to (content_digest, n_tokens)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = units.opened(tokenizer)
        for batch in batches:
            text, offsets = T.buffers(batch.column("text"))
            counts = [known.counts(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                      for lo, hi in T.blocks(offsets)]
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("content_digest"), pa.array(n, pa.int64())],
                                             ["content_digest", "n_tokens"])

    return counted


def token_counts(docs: DataFrame, tokenizer: str, cache_path: str | None = None, limit: int = 4096,
                 id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit. Without ``cache_path`` the cache is a new one."""
    spark = docs.sparkSession
    cache_path = cache_path or fresh_root(spark, "token_cache")
    digest = version_digest(tokenizer)
    texts = docs.select(F.col(id_column), text_or_empty().alias("text")).withColumn(
        "content_digest", F.unhex(F.sha2("text", 256)))
    misses = (texts.select("content_digest", "text").dropDuplicates(["content_digest"])
              .join(open_cache(spark, cache_path, digest), "content_digest", "left_anti"))
    new = misses.mapInArrow(count_texts(tokenizer), "content_digest binary, n_tokens long")
    (new.select("content_digest", F.lit(digest).alias("version_digest"), "n_tokens")
     .write.mode("append").parquet(cache_path))
    counts = open_cache(spark, cache_path, digest).groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    return (texts.select(id_column, "content_digest", F.octet_length("text").cast("long").alias("n_bytes"))
            .join(counts, "content_digest")
            .select(id_column, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
