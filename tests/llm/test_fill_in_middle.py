"""Fill-in-the-middle against a loop over units, and odd texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from daymend.llm import fill_in_middle as fim
from daymend.llm import queries

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, form string, n string, lang string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_hand(doc_id, text, seed=1):
    text = text or ""
    parts = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(parts) + 1) for x in h[:2])
    pre, mid, suf = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(parts), "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, len(parts), form, len(pre), len(mid), out


def odd_rows():
    rng = random.Random(3)
    signs = [*"ab Zé\n\t$1\\<>PSM\r \u0085", "word", "<P", "P>", "中", "😀", "́", "\x00", "$1", "\\"]
    rows = [(i, "".join(rng.choices(signs, k=rng.randint(0, 60)))) for i in range(400)]
    rows += [(400, None), (401, ""), (None, "some text, twice"), (None, None), (402, "x<S>y"), (403, "<P><S><M>"), (404, "a" * 100_000),
             (405, "é" * 5000), (406, "ab, " * 4000), (407, "\n" * 3001), (7, "again"), (7, "again"), (408, "x" * 999 + "." * 1000)]
    return rows


def test_forms(spark):
    rows = odd_rows()
    frame = spark.createDataFrame([(i, t, "clash", "clash", "en") for i, t in rows], DOC)
    got = fim.fill_in_middle(frame)
    assert set(frame.columns) | {"prefix_chars", "middle_chars", "output"} == set(got.columns)
    back = got.withColumn("back", fim.restored(F.col("output"), F.col("form")))
    key = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    ours = [tuple(r) for r in back.select(*key, "back").collect()]
    by_id = repr
    assert sorted((r[:6] for r in ours), key=by_id) == sorted((by_hand(i, t) for i, t in rows), key=by_id)
    assert sorted(r[6] for r in ours) == sorted(t or "" for _, t in rows)
    assert {r[2] for r in ours} == {"plain", "psm", "spm"}
    digests = fim.digests(got).collect()
    assert sorted((tuple(r) for r in digests), key=by_id) == sorted(
        ((*x[:5], sha(x[5]), sha(t or "")) for (i, t), x in ((r, by_hand(*r)) for r in rows)), key=by_id)


def test_shares_and_seed(spark):
    frame = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    share = {r.form: r["count"] for r in fim.fill_in_middle(frame, seed=9, plain_share=0, spm_share=50).groupBy("form").count().collect()}
    assert set(share) == {"psm", "spm"} and 900 < share["spm"] < 1100


def test_very_long_text(spark):
    frame = spark.range(1).select(F.lit(5).cast("long").alias("doc_id"), F.repeat(F.lit("a1 é,\n"), 2_000_000).alias("text"))
    row = fim.digests(fim.fill_in_middle(frame, plain_share=0)).first()
    assert row.n == 12_000_000 and row.form != "plain" and row.restored_sha256 == sha("a1 é,\n" * 2_000_000)


def test_empty_table_and_plan(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    got = fim.digests(fim.fill_in_middle(frame))
    assert got.count() == 0 and got.columns[:3] == ["doc_id", "n", "form"]
    plan = queries.op13_fill_in_middle(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_twin(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(queries.op13_fill_in_middle(spark, folder), duck(folder), queries.ORACLES["op13_fill_in_middle"]) == ""
