"""Toxicity by a counterfactually regularised linear classifier.

Features are the distinct words of a text and the first 4 to 8 bytes of longer ones, as 64-bit hashes. All
features are kept that tell the labels apart by at least ``min_z`` standard deviations of chance, and a logistic regression
is fitted on them. (A fixed number of the best ones instead lets chance features in, which the fit then learns by heart.) In every labelled
sentence that names a group of people, the term is swapped for the others of its kind; the fit pays for each
difference between the scores of a sentence and of its swaps, so a mere mention cannot carry the score.

The fit uses at most about ``max_rows`` labelled rows, half of each label where there are enough; rows are taken by
a hash of their id, so a table within the bound is used whole. Only the labels of that sample (16 bytes a row) are
broadcast. Scoring is one pass over all whole texts without a shuffle.

Cases: null and empty texts get the score of a text without features; without labels of both kinds every score is
0 and nothing is predicted toxic; labels with a null id or toxic are not used, and a document labelled both ways
counts as toxic; labels of unknown documents do no harm; repeated rows are scored one by one; further columns are
dropped; rows with a null id count as held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.llm import textops as T
from daymend.llm.frames import stored, text_or_empty

#: Terms by kind and language; a term is swapped only for others of its group.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("black", "white", "asian", "latino", "arab", "african"),
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("mexican", "chinese", "indian", "german", "french", "russian", "turkish"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("schwarze", "weiße"), ("ausländer", "flüchtlinge"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs"), ("étrangers", "réfugiés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"), ("extranjeros", "refugiados"),
)
PREFIXES = (4, 5, 6, 7, 8)
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True
_SENTENCE = re.compile(r"[.!?\n]+")


def _lower(text: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and the accented letters of Latin-1."""
    out = T.LOWER[text]
    wide = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)) + 1
    out[wide] += 0x20
    return out


def features(text: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, rows) of words, then of their prefixes."""
    text = _lower(text)
    starts, ends, rows = T.runs(_WORD[text], offsets)
    sums = T.prefix_sums(text)
    yield T.range_hashes(sums, starts, ends), rows
    for size in PREFIXES:
        long = ends - starts > size
        yield T.range_hashes(sums, starts[long], starts[long] + size) ^ np.uint64(size), rows[long]


def distinct_features(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct feature hashes of a few texts."""
    text, offsets = T.buffers(pa.array(texts, pa.large_string()))
    parts = list(features(text, offsets))
    hashes, rows = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
    return [np.unique(hashes[rows == k]) for k in range(len(texts))]


def swaps(text: str, groups: tuple) -> Iterator[tuple[str, str]]:
    """Sentences that name a group, each with every swap of one kind of term."""
    for sentence in _SENTENCE.split(text.lower()):
        words = set(re.findall(r"\w+", sentence))
        for group in groups:
            for term in sorted(words.intersection(group)):
                for other in group:
                    if other != term:
                        yield sentence, re.sub(rf"\b{re.escape(term)}\b", other, sentence)


class Vocabulary:
    """Sorted feature hashes; a table of 2**20 marks spares most words the search."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes.astype(np.uint64))
        self.marks = np.zeros(1 << 20, bool)
        self.marks[(self.hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def found(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, index) pairs of the known features, sorted."""
        pairs = []
        for hashes, rows in features(text, offsets):
            near = np.flatnonzero(self.marks[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])
            at = np.searchsorted(self.hashes, hashes[near])
            at[at == len(self.hashes)] = 0
            hit = self.hashes[at] == hashes[near] if len(self.hashes) else np.zeros(len(near), bool)
            pairs.append(rows[near[hit]] * max(1, len(self.hashes)) + at[hit])
        pairs = np.unique(np.concatenate(pairs))
        return pairs // max(1, len(self.hashes)), pairs % max(1, len(self.hashes))


def fit(rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], size: int,
        penalty: float = 1e-4, swap_weight: float = 1.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of the regression; ``rows`` and ``pairs`` hold feature indices.

    Loss: mean log loss + swap_weight * mean squared score difference of the pairs + penalty * |weights|^2.
    """
    lengths = np.array([len(x) for x in rows])
    flat, owner = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(rows)), lengths)
    left = np.concatenate([*(a for a, _ in pairs), np.zeros(0, np.int64)]).astype(np.int64)
    right = np.concatenate([*(b for _, b in pairs), np.zeros(0, np.int64)]).astype(np.int64)
    in_left = np.repeat(np.arange(len(pairs)), [len(a) for a, _ in pairs]).astype(np.int64)
    in_right = np.repeat(np.arange(len(pairs)), [len(b) for _, b in pairs]).astype(np.int64)
    weights, bias = np.zeros(size), 0.0
    mean, square, mean_bias, square_bias = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        score = np.bincount(owner, weights[flat], len(rows)) + bias
        error = (1 / (1 + np.exp(-score)) - labels) / max(1, len(rows))
        slope = np.bincount(flat, error[owner], size) + 2 * penalty * weights
        if pairs:
            apart = np.bincount(in_left, weights[left], len(pairs)) - np.bincount(in_right, weights[right], len(pairs))
            pull = 2 * swap_weight * apart / len(pairs)
            slope += np.bincount(left, pull[in_left], size) - np.bincount(right, pull[in_right], size)
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        mean_bias, square_bias = 0.9 * mean_bias + 0.1 * error.sum(), 0.99 * square_bias + 0.01 * error.sum() ** 2
        rate = 0.05 * (1 - step / (steps + 1)) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights -= rate * mean / (np.sqrt(square) + 1e-9)
        bias -= rate * mean_bias / (np.sqrt(square_bias) + 1e-9)
    return weights, float(bias)


class Model:
    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray, bias: float):
        self.vocabulary, self.weights, self.bias = vocabulary, weights, bias

    def scores(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows, index = self.vocabulary.found(text, offsets)
        total = np.bincount(rows, self.weights[index], minlength=len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, min_z: float = 4.0, min_rows: int = 4,
          groups: tuple = IDENTITY_TERMS, swap_weight: float = 1.0) -> Model | None:
    """Fit on the labelled rows of ``docs(doc_id, text)``; None without labels of both kinds."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic in (0, 1)"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    share = {k: min(1.0, max_rows / 2 / v) for k, v in n.items()}
    point = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(point < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", text_or_empty().alias("text")), "toxic_sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, offsets = T.buffers(batch.column("text"))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in T.blocks(offsets):
                parts = list(features(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                hashes, owner = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
                order = np.lexsort((owner, hashes))
                hashes, owner = hashes[order], owner[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                keys, which = np.unique(hashes[new], return_inverse=True)
                positive = np.bincount(which, toxic[lo + owner[new]], minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(positive),
                     pa.array(np.bincount(which, minlength=len(keys)).astype(np.int64))], ["feature", "pos", "n"])

    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos")).first()
    if not size["pos"] or size["pos"] == size["n"]:
        return None
    prior = size["pos"] / size["n"]
    z = (F.col("pos") - F.col("n") * prior) / F.sqrt(F.col("n") * prior * (1 - prior))  # deviations from chance
    best = (rows.mapInArrow(counted, "feature long, pos long, n long").groupBy("feature")
            .agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).where((F.col("n") >= min_rows) & (F.abs(z) >= min_z))
            .select("feature").collect())
    vocabulary = Vocabulary(np.array([r["feature"] for r in best], np.int64).view(np.uint64))
    terms = tuple(x for group in groups for x in group)
    named = re.compile(r"\b(" + "|".join(map(re.escape, terms)) + r")\b", re.I) if terms else re.compile(r"(?!)")

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, offsets = T.buffers(batch.column("text"))
            out: list[tuple[int, int, bytes, bytes]] = []
            for lo, hi in T.blocks(offsets):
                owner, index = vocabulary.found(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                cut = np.searchsorted(owner, np.arange(hi - lo + 1))
                out += [(0, int(y), index[a:b].astype("<i4").tobytes(), b"") for y, a, b in
                        zip(batch.column("toxic")[lo:hi].to_pylist(), cut, cut[1:], strict=False)]
            for x in batch.column("text").to_pylist():
                for pair in swaps(x, groups) if named.search(x) else ():
                    sides = []
                    for side in pair:
                        t, o = T.buffers(pa.array([side], pa.large_string()))
                        sides.append(vocabulary.found(t, o)[1].astype("<i4").tobytes())
                    if sides[0] != sides[1]:
                        out.append((1, 0, *sides))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], kind) for k, kind in
                 enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["pair", "toxic", "a", "b"])

    held = rows.mapInArrow(indexed, "pair int, toxic int, a binary, b binary").orderBy("pair", "toxic", "a", "b").collect()
    ints = lambda x: np.frombuffer(bytes(x), "<i4")
    single = [r for r in held if not r["pair"]]
    weights, bias = fit([ints(r["a"]) for r in single], np.array([r["toxic"] for r in single], float),
                        [(ints(r["a"]), ints(r["b"])) for r in held if r["pair"]], len(vocabulary.hashes),
                        swap_weight=swap_weight)
    bias += np.log(n[1] / n[0]) - np.log(prior / (1 - prior))  # the sample has more toxic rows than the labels
    return Model(vocabulary, weights, bias)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Adds score and predicted to all columns of ``docs``, which has a text column."""
    fields = docs.schema.fields
    column = next(k for k, f in enumerate(fields) if f.name == "text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, offsets = T.buffers(batch.column(column).fill_null("").cast(pa.string()))
            each = [model.scores(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    for lo, hi in T.blocks(offsets)] if model else [np.zeros(batch.num_rows)]
            value = np.concatenate(each) if each else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(value, pa.float64()), pa.array((value >= 0.5).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.mapInArrow(scored, f"{schema}, score double, predicted int")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, all columns as they are."""
    column = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, offsets = T.buffers(batch.column(column).fill_null("").cast(pa.string()))
            for lo, hi in T.blocks(offsets) if model else ():
                value = model.scores(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield batch.slice(lo, hi - lo).filter(pa.array(value < 0.5))
            if not model:
                yield batch

    return docs.mapInArrow(kept, docs.schema)


def held_out(folds: int = 5, fold: int = 0):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(True))


def learnable(labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Labels of the rows that are not held out."""
    return labels.where(~held_out(folds, fold))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, text; held-out rows are never learned from."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model = learn(rows, learnable(labels, folds, fold), **options)
    return score(rows.select("doc_id", held_out(folds, fold).alias("held_out"), "text"), model)
