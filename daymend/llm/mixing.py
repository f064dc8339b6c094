"""Sources mixed to target weights by Efraimidis-Spirakis sampling.

1. Sizes are summed by source. Sources get weights in turn by their order, and targets by filling: all share the
   whole size by weight, a target above ``most`` times its source stops there, and what is left is shared anew by weight
   among the others until none is above. Every round adds at least one stopped source, all above at once.
2. A target is whole epochs of its source first, every document as often, and then a fraction of one more epoch.
3. For the fraction a document draws u from a digest of its id and text and has the key -ln(u) / weight, so that the smallest keys are a
   sample without replacement by weight. Keys are sorted within the source and sizes summed up to the budget.

No source is sorted as a whole. Keys fall into bins of equal width of their logarithm, an order-preserving cut of which a bin
holds at most 0.26 / bins of an octave of a source's documents for any weights (the density of the logarithm of an
exponential key is at most 1/e). Sizes are summed by (source, bin), bins are summed up in order, and a bin is
either taken whole, left whole, or the one that the budget ends in; the documents of these alone are sorted, a bounded number for
each source, also where a third of all documents have one source. Rows of that bin that are equal in all of id, key and size
are counted before they are sorted, so repeated rows are not a hot group either.

The document that the budget ends in gives the words that are left, so the words taken of a source are its target, rounded.
With ``cut=False`` it is taken whole when that is nearer, and left out otherwise.

Sources are ordered in ranges that are sorted apart and counted up, so neither they nor their targets meet in one task; to the
driver come three sums a round. Sums by source are joined by a broadcast when they are few (``SMALL``), else by a
shuffled join, whose hot source the adaptive skew join splits.

Cases: a null text has size 0; a null source is a source of its own, the last; documents of size 0 take nothing; a source without
words has target 0; repeated rows each count and draw by their text, so equal rows have equal keys and share what is
left of a budget in any order; a missing or non-positive weight is 1; an empty table gives an empty result; further
columns are not read. The draw is a function of the row and the seed: reruns and retried tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymend.llm.frames import stored, text_or_empty

WEIGHTS = (5, 2, 1)
MOST = 3
#: Quality labels and what documents with them weigh; others weigh 1.
QUALITY = {0: 0.5, 1: 2.0}
WHITE = " \t\n\x0b\x0c\r"
#: Documents in a bin, about, in the fullest octave.
BIN_ROWS = 10_000
#: Sources in a range of their order.
RANGE_ROWS = 100_000
#: Rows by source that are broadcast.
SMALL = 200_000
_SPACE, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space: each run and what follows becomes one character."""
    return F.char_length(F.regexp_replace(F.btrim(text, F.lit(WHITE)), f"{_WORD}++{_SPACE}*+", "x")).cast("long")


def draw(seed: int) -> Column:
    """-ln(u) for 52 bits of a digest of the id and the text."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_or_empty())
    bits = F.conv(F.substring(F.sha2(told, 256), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 52)))


def sized(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Rows (doc_id, source, size, draw), the texts read once."""
    return stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), words(text_or_empty()).alias("size"),
                              draw(seed).alias("draw")), "sized")


def _product(a: Column, b: Column) -> Column:
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Rows (source, source_size, n_docs, target) for rows (source, size)."""
    by_source = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), "sources")
    ranges = 1 + by_source.count() // RANGE_ROWS
    order = F.col("source").asc_nulls_last()
    ranged = stored(by_source.repartitionByRange(ranges, order).withColumn("range", F.spark_partition_id()), "ranges")
    before = ranged.groupBy("range").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.orderBy("range")) - F.col("n")).select("range", "before")
    place = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    turn = F.pmod(F.col("place") + F.col("before"), F.lit(len(weights))).cast("int")
    share = F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long")
    weighed = stored(ranged.withColumn("place", place).join(F.broadcast(before), "range").select(
        "source", "source_size", "n_docs", share.alias("share")), "weighed")
    limit = F.col("source_size") * most
    held, left, among = None, 0, 0
    while True:
        # stopped: those whose part of what the last round left is above their limit
        stopped = F.lit(False) if held is None else _product(F.lit(left), F.col("share")) > _product(limit, F.lit(among))
        row = weighed.agg(F.sum("source_size").alias("whole"), F.sum(F.when(stopped, limit).otherwise(0)).alias("stopped"),
                          F.sum(F.when(~stopped, F.col("share")).otherwise(0)).alias("among"),
                          F.sum(stopped.cast("long")).alias("held")).first()
        if row["held"] == held or row["whole"] is None:
            break
        held, left, among = row["held"], row["whole"] - row["stopped"], row["among"]
    target = F.when(stopped, limit.cast("double")).otherwise(
        _product(F.lit(left), F.col("share")).cast("double") / F.lit(float(among or 1)))
    return weighed.select("source", "source_size", "n_docs", target.alias("target"))


def _with_sources(rows: DataFrame, by_source: DataFrame, few: bool, on: str) -> DataFrame:
    return rows.alias("r").join((F.broadcast(by_source) if few else by_source).alias("s"), F.expr(on))


def mixed(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
          seed: int = 1, cut: bool = True) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, epochs, taken): ``taken`` words, the first ``epochs`` times all of them.

    ``quality`` has rows (doc_id, weight), one for each document that does not weigh 1.
    """
    sizes = sized(docs, seed)
    plan = stored(targets(sizes, weights, most), "targets")
    budget = F.floor(F.col("target") + 0.5)
    plan = (plan.withColumn("budget", budget)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0))
            .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
            .withColumn("bins", F.ceil(F.col("n_docs") / F.lit(BIN_ROWS))))
    few = plan.count() <= SMALL
    if quality is not None:
        told = quality.select(F.col("doc_id").alias("__id"), F.col("weight").cast("double").alias("weight"))
        sizes = sizes.join(told, sizes["doc_id"] == told["__id"], "left").drop("__id")
    else:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    weight = F.when((F.col("weight") > 0) & (F.col("weight") < float("inf")), F.col("weight")).otherwise(1.0)
    keyed = _with_sources(sizes.withColumn("key", F.col("draw") / weight), plan, few, "r.source <=> s.source").select(
        "doc_id", "r.source", "size", "key", "source_size", "target", "epochs", "rest",
        F.floor(F.log2("key") * F.col("bins")).alias("bin"))
    keyed = stored(keyed, "keyed")
    bins = keyed.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin")) - F.col("words")
    # the one bin of a source that the budget ends in
    ends = stored(bins.withColumn("before", upto).where("before < rest and before + words >= rest")
                  .select("source", "bin", "before"), "ends")
    placed = _with_sources(keyed, ends.withColumnRenamed("bin", "last"), few, "r.source <=> s.source").select(
        "r.*", "last", "before")  # a source that has no such bin takes no fraction
    whole = F.col("epochs") * F.col("size")
    rounded = keyed.alias("r").join((F.broadcast(ends) if few else ends).alias("s"), F.expr("r.source <=> s.source"), "left")
    outside = (rounded.where("s.bin is null or r.bin <> s.bin")
               .select("doc_id", "r.source", "size", "source_size", "target", "epochs",
                       (whole + F.when(F.col("r.bin") < F.col("s.bin"), F.col("size")).otherwise(0)).alias("taken")))
    inside = (placed.where("bin = last").groupBy("doc_id", "source", "size", "key", "source_size", "target", "epochs", "rest", "before")
              .agg(F.count("*").alias("n")))
    ahead = F.sum(F.col("n") * F.col("size")).over(
        Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")) - F.col("n") * F.col("size")
    room = F.col("rest") - F.col("before") - F.col("ahead") - F.col("k") * F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), room))
    if not cut:
        part = F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(0)
    inside = (inside.withColumn("ahead", ahead).withColumn("k", F.explode(F.expr("sequence(0L, n - 1)")))
              .select("doc_id", "source", "size", "source_size", "target", "epochs", (whole + part).alias("taken")))
    return outside.union(inside)


def copies(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The texts of a mix, for documents whose ids are distinct: all columns, one row for each time a document is used, the last one cut to its words.

    Adds ``copy`` (from 0). Documents of which no word is taken have no row.
    """
    taken = mix.where("taken > 0").select(F.col("doc_id").alias("__id"), F.col("size").alias("__size"), F.col("taken").alias("__taken"))
    rows = docs.drop("copy").join(taken, docs["doc_id"] == taken["__id"])
    rows = rows.withColumn("copy", F.explode(F.expr("sequence(0L, (__taken - 1) div __size)")))
    left = F.col("__taken") - F.col("copy") * F.col("__size")
    pattern = F.format_string(f"(?s)^({_SPACE}*+(?:{_WORD}++{_SPACE}*+){{%d}}+).*+$", left)
    return rows.withColumn("text", F.when(left < F.col("__size"), F.regexp_replace("text", pattern, F.lit("$1"))).otherwise(
        F.col("text"))).drop("__id", "__size", "__taken")


def quality_weights(labels: DataFrame) -> DataFrame:
    """Rows (doc_id, weight) by the quality label of a document; the best one counts where there are several."""
    weight = F.create_map(*(F.lit(x) for pair in QUALITY.items() for x in pair))[F.col("quality").cast("int")]
    return (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
            .select("doc_id", weight.alias("weight")))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce("text", ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         -ln((CAST(CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce("text", '')), 1, 13)
                   AS BIGINT) AS DOUBLE) + 0.5) / {float(1 << 52)}) AS draw
  FROM documents),
q AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id),
k AS (
  SELECT d.doc_id, source, size, draw / CASE quality WHEN 0 THEN 0.5 WHEN 1 THEN 2.0 ELSE 1.0 END AS key
  FROM d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) - coalesce(CAST(3 * sum(source_size) OVER o AS BIGINT), 0) AS left_over,
         CAST(sum(w) OVER () AS BIGINT) - coalesce(CAST(sum(w) OVER o AS BIGINT), 0) AS among
  FROM s WINDOW o AS (ORDER BY source_size * 1.0 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (  -- the first source in that order whose share is within its limit sets the level
  SELECT left_over, among FROM f WHERE left_over * w <= 3 * source_size * among ORDER BY source_size * 1.0 / w, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN g.left_over * w > 3 * source_size * g.among THEN CAST(3 * source_size AS DOUBLE)
         ELSE CAST(g.left_over * w AS DOUBLE) / g.among END AS target
  FROM s, g),
b AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM t),
r AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
         CAST(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id NULLS LAST, k.size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - k.size AS ahead
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - ahead)) AS BIGINT) AS taken FROM r
"""
