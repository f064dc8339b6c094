"""Fill-in-the-middle by a counted-quantifier regular expression, with DataFrame functions only.

A text is a sequence of units, ``[A-Za-z]+|[^A-Za-z]``. ``regexp_count`` gives their number n, a digest of the id draws
two cut places a <= b among 0..n, and one match of a pattern made for the row, ``(unit{a})(unit{b-a})(rest)`` with
possessive quantifiers, captures prefix, middle and suffix at once; the replacement writes them in the order of the form.
A possessive quantifier walks the text once, keeps no places to return to and needs no stack, whatever its count.

``regexp_count`` holds all its matches as an array, so units are counted by matches of ``BLOCK`` units each, glued to
one another by ``\\G``, plus the units of the tail that is left: the array has a thousandth of the entries and long texts
are handled like short ones.

Forms: ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``, ``plain`` is the text as it is.
A text that holds a marker itself is plain, so each marker stands once in the output of the other forms and
``restored`` finds the text by them.

Cases: a null text is empty, an empty text plain; a null id draws as the empty string would; repeated rows draw alike; an
empty table gives an empty result; further columns stay, but for those that share a name with a result, which replaces
them. A row is worked on by itself: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymend.llm.frames import text_or_empty

UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units in one match of the count.
BLOCK = 1000


def units(text: Column) -> Column:
    """Number of units of a text."""
    block = F.lit(rf"\G(?:{UNIT}){{{BLOCK}}}+")
    tail = F.regexp_replace(text, block, F.lit(""))
    return (F.regexp_count(text, block) * BLOCK + F.regexp_count(tail, F.lit(UNIT))).cast("long")


def _draw(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_share: int = 10, spm_share: int = 20) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output; shares are percentages, the second one of the rest."""
    taken = {"n", "form", "prefix_chars", "middle_chars", "output"}
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    cut = (docs.drop(*taken).withColumn("text", text_or_empty())
           .withColumn("__d", digest).withColumn("n", units(F.col("text"))))
    text, first, second = F.col("text"), _draw(F.col("__d"), 0) % (F.col("n") + 1), _draw(F.col("__d"), 1) % (F.col("n") + 1)
    held = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = (F.when((text == "") | held | (_draw(F.col("__d"), 2) % 100 >= 100 - plain_share), "plain")
            .when(_draw(F.col("__d"), 3) % 100 < spm_share, "spm").otherwise("psm"))
    units_of = f"((?:{UNIT}){{%s}}+)"
    pattern = F.format_string(f"(?s)^{units_of % '%d'}{units_of % '%d'}(.*+)$",
                              F.least(first, second), F.abs(first - second))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    out = F.col("output")
    prefix = F.when(F.col("form") == "psm", F.substring_index(out, SUFFIX, 1)).when(
        F.col("form") == "spm", F.substring_index(F.substring_index(out, MIDDLE, 1), PREFIX, -1))
    marker = F.when(F.col("form") == "psm", len(PREFIX)).otherwise(0)
    return (cut.withColumn("form", form)
            .withColumn("output", F.when(F.col("form") == "plain", text)
                        .otherwise(F.regexp_replace(text, pattern, order)))
            .withColumn("prefix_chars", (F.char_length(prefix) - marker).cast("long"))
            .withColumn("middle_chars", F.when(F.col("form") != "plain", F.char_length(
                F.substring_index(out, MIDDLE, -1))).cast("long"))
            .drop("__d"))


def restored(output: Column, form: Column) -> Column:
    """The text, from an output and its form alone."""
    return F.when(form == "psm", F.regexp_replace(output, f"(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)$", "$1$3$2")).when(
        form == "spm", F.regexp_replace(output, f"(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)$", "$2$3$1")).otherwise(output)


def digests(formed: DataFrame) -> DataFrame:
    """The columns of the contract: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    return formed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


#: DuckDB lists the units instead: its regular expressions repeat a group a thousand times at most.
ORACLE = f"""
WITH u AS (
  SELECT doc_id, coalesce("text", '') AS body, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
         regexp_extract_all(coalesce("text", ''), '{UNIT}') AS units
  FROM documents),
h AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4
  FROM u),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, array_to_string(list_slice(units, 1, a), '') AS pre, array_to_string(list_slice(units, a + 1, b), '') AS mid,
         array_to_string(list_slice(units, b + 1, n), '') AS suf
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM p
"""
