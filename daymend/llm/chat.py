"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and the loss mask covers the
text of that reply and nothing else. A conversation that does not end with an assistant turn has one more example
without a loss, so that no turn is lost.

Template: ``<s>role\\ntext</s>`` for an assistant turn, ``[INST]role\\ntext[/INST]`` for any other. Inside roles and
texts ``&``, ``<`` and ``[`` are written ``&amp;``, ``&lt;`` and ``&#91;`` (and a line end in a role ``&#10;``), so
no text can hold a control string, and reading back gives every text as it was.

A row holds a whole prefix of its conversation, as the method asks; conversations are grouped once, and examples
leave that group one at a time. Nothing is grouped by anything but the conversation.

Cases: null roles and texts are read as empty; turns are ordered by turn, then role, then text, a null turn first;
repeated turns all count; a null conversation id is a conversation; a conversation without an assistant turn has
one example without a loss; an empty table gives an empty result; further columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGET = "assistant"
#: Matches one turn; group 1 is its body, which cannot hold a control string.
TURN = r"(?:\[INST\]|<s>)([^\[<]*)(?:\[/INST\]|</s>)"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&#91;"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("&#10;"), F.lit("\n")), F.lit("&#91;"), F.lit("["))
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _opening(turn: Column) -> Column:
    role = F.replace(escape(turn["role"]), F.lit("\n"), F.lit("&#10;"))
    return F.concat(F.when(turn["role"] == TARGET, F.lit("<s>")).otherwise(F.lit("[INST]")), role, F.lit("\n"))


def _formatted(turn: Column) -> Column:
    closing = F.when(turn["role"] == TARGET, F.lit("</s>")).otherwise(F.lit("[/INST]"))
    return F.concat(_opening(turn), escape(turn["text"]), closing)


def examples(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, target, is_last, formatted, loss_start, loss_length); ``target`` is the place of the last turn.

    ``loss_start`` counts characters from 0; ``is_last`` marks the example that holds the whole conversation.
    """
    conversations = turns.select(
        "conv_id", F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t")
    ).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda k: (
        F.element_at("turns", k)["role"] == TARGET) | (k == F.size("turns")))
    each = (conversations
            .select("conv_id", "turns", F.transform("turns", _formatted).alias("written"), places.alias("places"))
            .select("conv_id", "turns", "written", F.explode("places").alias("target")))
    turn = F.element_at("turns", F.col("target"))
    context = F.array_join(F.slice("written", F.lit(1), F.col("target") - 1), "")
    return (each.select("conv_id", "target", (F.col("target") == F.size("turns")).alias("is_last"),
                        context.alias("context"), F.element_at("written", F.col("target")).alias("reply"),
                        F.char_length(_opening(turn)).alias("opening"),
                        F.when(turn["role"] == TARGET, F.char_length(escape(turn["text"]))).otherwise(0)
                        .cast("long").alias("loss_length"))
            .select("conv_id", "target", "is_last", F.concat("context", "reply").alias("formatted"),
                    (F.char_length("context") + F.col("opening")).cast("long").alias("loss_start"), "loss_length"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example, as structs (role, text)."""
    def parsed(body: Column) -> Column:
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescape(role).alias("role"),
                        unescape(F.substr(body, F.char_length(role) + 2)).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1)), parsed)


def read_loss(formatted: Column, start: Column, length: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substr(formatted, (start + 1).cast("int"), length.cast("int")))


def digests(expanded: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted examples alone."""
    whole = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = (expanded
            .withColumn("lines", F.when(F.col("is_last"), whole))
            .select("conv_id", F.size("lines").cast("long").alias("n"),
                    F.when(F.col("is_last"), F.sha2(F.array_join("lines", ""), 256)).alias("digest"),
                    F.struct("target", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_length"))
                             .alias("loss")).alias("reply"),
                    F.char_length("formatted").cast("long").alias("chars")))
    return (read.groupBy("conv_id")
            .agg(F.max("n").alias("n_turns"), F.max("digest").alias("turns_sha256"),
                 F.array_join(F.array_sort(F.collect_list("reply"))["loss"], "").alias("loss"),
                 F.sum("chars").alias("formatted_chars"))
            .select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))
