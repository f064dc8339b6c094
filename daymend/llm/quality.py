"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text.

The model has words (``word_grams``: three of them, in shards that grow with the trusted text) over characters: what
the words leave goes to the spelling of the word by a model of ``ORDER`` characters folded into ``SYMBOLS`` classes
(lower-cased; Latin letters apart, accented and other letters, digits, white space and signs in classes of their own).
That one has at most 64**4 entries and is broadcast; it only spells words that the shards do not know.

Training reads all trusted documents whole. Parts tell the counts of their grams; counts are summed by key,
continuation counts and context totals follow from them by grouping on suffixes and prefixes. Parts are then scored
with the answers of the shards; a part is scored by the words of the others, so a trusted document never by
its own words (its spelling stays in the character model). Perplexity is by character. A document is kept when it is
at most the ``quantile`` of the trusted documents of its language. Parts are scored in ``WAVES`` and tables of one
step are deleted after the next, which bounds the disk in use.

Cases: null and empty texts have no perplexity and are not kept; a language (or a null one) without trusted documents
takes the threshold over all languages; without any trusted text perplexities are null and every text that is not
empty is kept; documents labelled twice are trusted if one label says so; rows with a null id are scored, never
trusted; repeated rows count each; empty tables give empty results; further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.llm import textops as T
from daymend.llm import word_grams as W
from daymend.llm.dealing import batch, deal, n_parts, pack, packed_rows, rows_of, unpack
from daymend.llm.frames import brief_shuffles, dropped, stored, text_or_empty
from daymend.llm.language_id import letters

SYMBOLS, BITS, ORDER = 64, 6, 4
#: Least number of parts; a part is scored by the words of all others.
FOLDS = 16
#: Parts are scored in so many actions, so that what they ask and are answered is not on disk all at once.
WAVES = 4
_fold: list[np.ndarray] = []


def folding() -> np.ndarray:
    """Symbol of each code point; 0 is kept for the borders of a text."""
    if not _fold:
        code = np.arange(0x110000)
        table = 29 + code * 7 % 16  # signs
        table[letters()] = 45 + code[letters()] % 19
        table[[9, 10, 11, 12, 13, 32]] = 1
        table[48:58] = 2
        table[97:123] = np.arange(3, 29)
        _fold.append(table.astype(np.int32))
    return _fold[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(gram, row) for each symbol of each text and its end; a gram holds the symbols before it in the upper bits."""
    lowered = [x.lower() for x in texts]
    gap = "\0" * (ORDER - 1)
    codes = np.frombuffer((gap + gap.join(lowered) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = folding()[codes]
    lengths = np.array([len(x) for x in lowered], np.int64)
    ends = np.cumsum(lengths + ORDER - 1)  # where the border after each text begins
    kept = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        symbols[ends + k] = 0
        symbols[k : k + 1] = 0
        kept[k : k + 1] = False
        kept[ends + k] = k == 0
    if not len(texts):
        kept[:] = False
    gram = symbols.copy()
    for back in range(1, ORDER):
        gram[back:] |= symbols[:-back] << (BITS * back)
    return gram[kept], np.repeat(np.arange(len(texts)), lengths + 1)


def _strings(text: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw, ends = text.tobytes(), offsets.tolist()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]


def count_grams(docs: pa.Table) -> pa.Table:
    """(gram, n) over the documents of a part."""
    found = [np.unique(grams([x for x in texts if x])[0], return_counts=True) for _, texts in _block_texts(docs)]
    keys = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int32)
    n = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int64)
    keys, which = np.unique(keys, return_inverse=True)
    return pa.table({"gram": pa.array(keys.astype(np.int64)), "n": pa.array(np.bincount(which, n, len(keys)).astype(np.int64))})


def shares(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Discounted shares (gram, share) and what each context leaves to the lower order (context, rest)."""
    of = counts.agg(*(F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4))).first()
    d1, d2, d3 = W.discounts_of(*of)
    n = F.col("n")
    discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
    keyed = counts.withColumn("context", F.shiftright("gram", BITS)).withColumn("discount", discount)
    totals = keyed.groupBy("context").agg(F.sum("n").alias("total"), F.sum("discount").alias("lost"))
    share = (keyed.join(totals, "context")
             .select(F.lit(order).alias("order"), F.col("gram").alias("key"), ((n - F.col("discount")) / F.col("total")).alias("value")))
    rest = totals.select(F.lit(-order).alias("order"), F.col("context").alias("key"), (F.col("lost") / F.col("total")).alias("value"))
    return share, rest


class Model:
    """Tables of the interpolated model; ``values`` has rows (order, key, value), negative orders for contexts."""

    def __init__(self, values: dict[int, tuple[np.ndarray, np.ndarray]]):
        lower = np.full(1, 1 / SYMBOLS)
        for order in range(1, ORDER):
            left = np.repeat(self._rest(values, order), SYMBOLS)  # by context, the upper bits of a gram
            lower = self._dense(values, order, order) + left * np.tile(lower, SYMBOLS)  # by suffix, its lower bits
        self.lower = lower.astype(np.float32)
        self.rest = self._rest(values, ORDER).astype(np.float32)
        self.top = values.get(ORDER, (np.zeros(0, np.int64), np.zeros(0)))
        self.table: np.ndarray | None = None

    @staticmethod
    def _dense(values, which: int, order: int) -> np.ndarray:
        out = np.zeros(SYMBOLS**order)
        keys, found = values.get(which, (np.zeros(0, np.int64), np.zeros(0)))
        out[keys] = found
        return out

    @staticmethod
    def _rest(values, order: int) -> np.ndarray:
        out = np.ones(SYMBOLS ** (order - 1))  # a context that was never seen leaves all to the lower order
        keys, found = values.get(-order, (np.zeros(0, np.int64), np.zeros(0)))
        out[keys] = found
        return out

    def log_probabilities(self, gram: np.ndarray) -> np.ndarray:
        if self.table is None:  # made in the worker, once
            table = np.zeros(SYMBOLS**ORDER, np.float32)
            table[self.top[0]] = self.top[1]
            for own, rest in zip(table.reshape(SYMBOLS, -1), self.rest.reshape(SYMBOLS, -1), strict=True):  # by first symbol
                own += np.repeat(rest, SYMBOLS) * self.lower
                np.log(own, out=own)
            self.table = table
        return self.table[gram]


def trusted_ids(labels: DataFrame, parts: int) -> DataFrame:
    """(doc_id, part) of the documents that a label calls good."""
    return (labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
            .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")))


def count_parts(docs: DataFrame) -> int:
    return max(FOLDS, n_parts(docs))


def trusted_texts(docs: DataFrame, labels: DataFrame, parts: int) -> DataFrame:
    """Rows (part, docs) of the documents that a label calls good, without empty ones."""
    def picked(key: tuple, docs: pa.Table, trusted: pa.Table) -> pa.Table:
        ids = trusted.column("doc_id").to_numpy()
        own = [rows.filter(pa.array(_own(rows, ids))) for rows in (rows_of(docs) if len(ids) else ())]
        own = [rows.filter(pc.greater(pc.binary_length(rows.column("text")), 0)) for rows in own]
        return batch("part int, docs binary", [(key[0].as_py(), packed_rows(rows)) for rows in own if len(rows)])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(deal(texts, parts).groupBy("part").cogroup(trusted_ids(labels, parts).groupBy("part"))
                  .applyInArrow(picked, "part int, docs binary"), "trusted")


def train(docs: DataFrame, labels: DataFrame, own: DataFrame | None = None) -> Model | None:
    """The model of all documents that a label calls good; None where there are none."""
    if own is None:
        own = trusted_texts(docs, labels, count_parts(docs))
    counts = stored(own.groupBy("part").applyInArrow(count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    tables, size = [], ORDER
    while size:
        tables += shares(counts, size)
        size -= 1
        # in how many contexts of one symbol more each shorter gram continues
        counts = counts.groupBy(F.col("gram").bitwiseAND((1 << BITS * size) - 1).alias("gram")).agg(F.count("*").alias("n"))
    values = tables[0]
    for table in tables[1:]:
        values = values.union(table)
    found = values.toArrow()
    order, key, value = (found.column(x).to_numpy() for x in ("order", "key", "value"))
    if not len(order):
        return None
    return Model({int(k): (key[order == k], value[order == k]) for k in np.unique(order)})


def _own(rows: pa.Table, ids: np.ndarray) -> np.ndarray:
    """Rows with one of the ids."""
    column = rows.column("doc_id")
    return np.isin(column.fill_null(-1).to_numpy(), ids) & column.is_valid().to_numpy()


def _block_texts(table: pa.Table) -> Iterator[tuple[pa.Table, list[str]]]:
    for rows in rows_of(table):
        text, offsets = T.buffers(rows.column("text"))
        for lo, hi in T.blocks(offsets):
            yield rows.slice(lo, hi - lo), _strings(text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _tokens(docs: pa.Table) -> list[dict[str, np.ndarray]]:
    return [W.tokens(texts, symbols=False) for _, texts in _block_texts(docs)]


def packed_ids(key: tuple, trusted: pa.Table) -> pa.Table:
    """The trusted ids of a part as one row among its answers."""
    return batch(W.ASKED, [(key[0].as_py(), -1, pack(ids=trusted.column("doc_id").to_numpy()))])


def perplexities(docs: DataFrame, labels: DataFrame, model: Model | None, own: DataFrame | None = None, parts: int = 0) -> DataFrame:
    """(doc_id, lang, n_symbols, perplexity) of each document; an empty text has no perplexity.

    ``own`` are the trusted texts, if they are known already; they are deleted when they are counted.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = "doc_id long, lang string, n_symbols long, perplexity double"
    if model is None:
        return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.char_length(text_or_empty()).cast("long").alias("n_symbols"),
                           F.lit(None).cast("double").alias("perplexity"))
    parts = parts or count_parts(docs)
    buckets = max(FOLDS, parts // 2)
    trusted = trusted_ids(labels, parts)
    if own is None:
        own = trusted_texts(docs, labels, parts)
    words, stats = W.learn(own, _tokens, buckets)
    dropped(own)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def asked(key: tuple, docs: pa.Table) -> pa.Table:
        return batch(W.ASKED, W.ask(W.Part(_tokens(docs), buckets), key[0].as_py()))

    def answered(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
        return batch(W.ASKED, W.answer(asked, model))

    def scored(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        bodies = list(zip(answers.column("bucket").to_pylist(), answers.column("body"), strict=True))
        ids = np.concatenate([np.zeros(0, np.int64), *(unpack(x)["ids"] for bucket, x in bodies if bucket < 0)])
        kept, found, marks, spelled = [], [], [], []
        for rows, texts in _block_texts(docs):
            x = W.tokens(texts)
            spelled.append(np.bincount(x["symbol"], shared.value.log_probabilities(grams(texts)[0]), len(x["row"])))
            marks.append((_own(rows, ids) & (x["lengths"] > 0))[x["row"]])
            found.append({k: x[k] for k in ("row", "one", "two", "three")})
            kept.append(rows.select(["doc_id", "lang"]).append_column("n_symbols", pa.array(x["lengths"])))
        if not kept:
            return pa.table({"doc_id": pa.array([], pa.int64()), "lang": pa.array([], pa.string()),
                             "n_symbols": pa.array([], pa.int64()), "perplexity": pa.array([], pa.float64())})
        rows, part = pa.concat_tables(kept), W.Part(found, buckets)
        chances = W.PartModel(part, np.concatenate(marks), [(b, W.grown(x)) for b, x in bodies if b >= 0], stats).log_probabilities(
            np.concatenate(spelled))
        first = np.cumsum([0, *(len(x) for x in kept)])[:-1]
        n = rows.column("n_symbols").to_numpy()
        total = np.bincount(np.concatenate([x["row"] + a for x, a in zip(found, first, strict=True)]), chances, len(n))
        return rows.append_column("perplexity", pa.array(np.where(n > 0, np.exp(-total / (n + 1)), np.nan), mask=n == 0))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    out = []
    for wave in range(WAVES):
        dealt = deal(texts, parts, WAVES, wave)
        answers = (dealt.groupBy("part").applyInArrow(asked, W.ASKED).groupBy("bucket").cogroup(words.groupBy("bucket"))
                   .applyInArrow(answered, W.ASKED))
        mine = trusted.where(F.col("part") % WAVES == wave).groupBy("part").applyInArrow(packed_ids, W.ASKED)
        out.append(stored(dealt.groupBy("part").cogroup(answers.union(mine).groupBy("part")).applyInArrow(scored, schema), "perplexities"))
    dropped(words)
    every = out[0]
    for frame in out[1:]:
        every = every.union(frame)
    return every.withColumn("doc_id", F.col("doc_id").cast(kind))


def quality(docs: DataFrame, labels: DataFrame, quantile: float = 0.99) -> DataFrame:
    """One row per document: doc_id, lang, perplexity, threshold, kept."""
    with brief_shuffles(docs.sparkSession):
        parts = count_parts(docs)
        own = trusted_texts(docs, labels, parts)
        scored = perplexities(docs, labels, train(docs, labels, own), own, parts)
    trusted = labels.where("quality = 1").select("doc_id").distinct()
    of_trusted = scored.join(trusted, "doc_id", "left_semi").where("perplexity is not null")
    point = F.percentile_approx("perplexity", quantile, 10_000).alias("threshold")
    overall = of_trusted.agg(point).first()["threshold"]
    by_lang = of_trusted.where("lang is not null").groupBy("lang").agg(point)
    threshold = F.coalesce("threshold", F.lit(overall).cast("double"))
    return scored.join(by_lang, "lang", "left").select(
        "doc_id", "lang", "perplexity", threshold.alias("threshold"),
        F.when(F.col("n_symbols") == 0, False).otherwise(F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("kept"))
