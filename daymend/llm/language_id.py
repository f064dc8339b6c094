"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that its code point seeds. A trigram is bound from its letters'
vectors, each permuted by its place, multiplied together; a text is the bundle (sum) of its trigrams and a language
the bundle of its texts at unit length. What all languages share is projected out of the prototypes, and a text goes
to the prototype with the largest cosine.

Learning is one pass: each task bundles its rows by language in whole numbers, so sums do not depend on the order,
and one vector for each language value reaches the driver. Prediction is a second pass without a shuffle.

Cases: a null text, a text without a letter, and any text when nothing could be learned are ``und`` with score 0;
ties go to the language that sorts first; rows with a null id count as held out; a null language is not learned;
empty tables give empty results; further columns are dropped. A document's trigrams are counted over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.llm import textops as T

DIM = 1024
#: Unit vectors are rounded to this many steps before they are summed.
STEPS = 1 << 20
#: Rows that are turned into vectors at once.
ROWS = 256
_letter: list[np.ndarray] = []


def letters() -> np.ndarray:
    """By code point: is it a letter? Made once in each worker."""
    if not _letter:
        _letter.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letter[0]


def letter_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """Random signs, the same for a code point wherever they are made."""
    words = np.arange(dim // 64, dtype=np.uint64)[None, :]
    seeds = T.mix(T.mix(codes.astype(np.uint64) + np.uint64(1))[:, None] + words * np.uint64(T.BASE))
    bits = np.unpackbits(seeds.view(np.uint8).reshape(len(codes), -1), axis=1)
    return bits.astype(np.int8) * 2 - 1


def bundles(texts: list[str], dim: int) -> np.ndarray:
    """A unit vector for each text; zeros for a text without letters."""
    lowered = [x.lower() for x in texts]
    codes = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(x) + 1 for x in lowered])])
    inside = letters()[codes]
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    kept[0] = True
    at = np.flatnonzero(kept)
    codes = np.where(inside[at], codes[at], 0)
    middle = np.flatnonzero(codes[1:-1]) + 1
    out = np.zeros((len(texts), dim), np.float32)
    if not len(middle):
        return out
    rows = np.searchsorted(bounds, at[middle], "left") - 1
    present = np.zeros(0x110000, bool)
    present[codes] = True
    alphabet = np.flatnonzero(present)
    place = np.zeros(0x110000, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    small, n = place[codes], len(alphabet)
    grams = (small[middle - 1] * n + small[middle]) * n + small[middle + 1]
    if n**3 <= 1 << 22:
        seen = np.zeros(n**3, bool)
        seen[grams] = True
        distinct = np.flatnonzero(seen)
        index = np.zeros(n**3, np.int64)
        index[distinct] = np.arange(len(distinct))
        which = index[grams]
    else:
        distinct, which = np.unique(grams, return_inverse=True)
    signs = letter_vectors(alphabet, dim)
    first, second = np.roll(signs, 2, axis=1), np.roll(signs, 1, axis=1)
    step = max(1, (1 << 21) // max(1, len(texts)))  # bounds both the counts and the trigram vectors held at once
    order = np.argsort(which, kind="stable") if len(distinct) > step else None
    for lo in range(0, len(distinct), step):
        part = distinct[lo : lo + step]
        vectors = (first[part // (n * n)] * second[part // n % n] * signs[part % n]).astype(np.float32)
        if order is None:
            r, w = rows, which
        else:
            a, b = np.searchsorted(which[order], [lo, lo + len(part)])
            r, w = rows[order[a:b]], which[order[a:b]] - lo
        counts = np.bincount(r * len(part) + w, minlength=len(texts) * len(part)).reshape(len(texts), len(part))
        out += counts.astype(np.float32) @ vectors
    lengths = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, lengths, out=out, where=lengths > 0)


def _vectors(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    text, offsets = T.buffers(batch.column("text"))
    raw = text.tobytes()
    for lo, hi in T.blocks(offsets):
        for a in range(lo, hi, ROWS):
            b = min(a + ROWS, hi)
            ends = offsets[a : b + 1].tolist()
            yield a, bundles([raw[x:y].decode("utf-8", "replace") for x, y in zip(ends, ends[1:], strict=False)], dim)


def learn(docs: DataFrame, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes from rows (text, lang); rows with a null in either are not used."""

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def rows() -> pa.RecordBatch:
            names = sorted(sums)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(names, object), dim), pa.string()),
                 pa.array(np.tile(np.arange(dim, dtype=np.int32), len(names))),
                 pa.array(np.concatenate([sums[x] for x in names]))], ["lang", "slot", "total"])

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for a, vectors in _vectors(batch, dim):
                steps = np.rint(vectors * STEPS).astype(np.int64)
                here = langs[a : a + len(vectors)]
                for lang in set(here.tolist()):
                    sums[lang] = sums.get(lang, 0) + steps[here == lang].sum(axis=0)
            if len(sums) > 500:
                yield rows()
                sums.clear()
        if sums:
            yield rows()

    total = (docs.where("text is not null and lang is not null").select("text", "lang")
             .mapInArrow(bundled, "lang string, slot int, total long")
             .groupBy("lang", "slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("double").alias("total"))
             .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("slot", "total"))).alias("slots"))
             .select("lang", "slots.total").orderBy("lang").collect())
    prototypes = np.array([r["total"] for r in total], np.float64).reshape(-1, dim)
    known = np.linalg.norm(prototypes, axis=1) > 0
    names = [r["lang"] for r, ok in zip(total, known, strict=True) if ok]
    prototypes = prototypes[known] / np.linalg.norm(prototypes[known], axis=1, keepdims=True)
    if len(names) > 1:
        shared = prototypes.mean(axis=0)
        apart = prototypes - np.outer(prototypes @ shared / (shared @ shared), shared)
        lengths = np.linalg.norm(apart, axis=1, keepdims=True)
        if lengths.min() > 1e-6:  # else languages are alike and nothing is left to tell them apart by
            prototypes = apart / lengths
    return names, prototypes.astype(np.float32)


def predict(docs: DataFrame, names: list[str], prototypes: np.ndarray, dim: int = DIM) -> DataFrame:
    """Adds lang_pred and score to rows that have a text column, which is dropped."""
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            for a, vectors in _vectors(batch, dim) if names else ():
                cosines = vectors @ prototypes.T
                best = cosines.argmax(axis=1)
                for k in np.flatnonzero(vectors.any(axis=1)).tolist():
                    pred[a + k] = names[best[k]]
                    score[a + k] = min(1.0, max(0.0, float(cosines[k, best[k]])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                [f.name for f in kept] + ["lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return (docs.withColumn("text", F.coalesce("text", F.lit("")))
            .mapInArrow(told, f"{schema}, lang_pred string, score double"))


def language_id(docs: DataFrame, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    rows = docs.select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_fold, F.lit(True)).alias("held_out"),
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    names, prototypes = learn(rows.where("not held_out"))
    return predict(rows.select("doc_id", "held_out", "text"), names, prototypes)
