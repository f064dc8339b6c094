"""Mixing sources against a loop over sorted documents, and odd tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from daymend.llm import mixing, queries

DOC = "doc_id long, text string, source string, weight double, size string, key string, target int"


def n_words(text):
    return len(re.findall("[^\x20\x09-\x0D]+", text or ""))


def filled(sizes, most=3, weights=(5, 2, 1)):
    """Targets by sharing what is left until none is above its limit; exact."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    stopped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        among = sum(weight[s] for s in order if s not in stopped)
        above = {s for s in order if s not in stopped and Fraction(left * weight[s], among) > most * sizes[s]}
        if not above:
            return {s: Fraction(most * sizes[s]) if s in stopped else Fraction(left * weight[s], among or 1) for s in order}
        stopped |= above


def by_hand(rows, weight_of, most=3, cut=True):
    """(doc_id, source, size, source_size, target, taken) with every source sorted as a whole."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += n_words(text)
    target = filled(dict(sizes), most)
    by_source, out = defaultdict(list), []
    for i, text, source in rows:
        told = f"1:{'' if i is None else i}:{text or ''}"
        u = (int(hashlib.sha256(told.encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        by_source[source].append((-math.log(u) / weight_of.get(i, 1.0), i is None, i or 0, n_words(text), i))
    for source, held in by_source.items():
        budget = math.floor(target[source] + Fraction(1, 2))
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        for *_, size, i in sorted(held):
            part = max(0, min(size, rest))
            rest -= size
            if not cut:
                part = size if 2 * part >= size else 0
            out.append((i, source, size, sizes[source], float(target[source]), epochs * size + part))
    return out


def rows_of(rng, sources, n, longest=40):
    return [(i, " ".join("w" for _ in range(rng.randint(0, longest))), rng.choice(sources)) for i in range(n)]


def odd_rows():
    rng = random.Random(8)
    rows = rows_of(rng, ["a", "b", "é", "Z", "", None, "😀", "￿", *["hot"] * 12], 600)
    rows += [(None, "x y z", "hot"), (None, "x y z", "hot"), (None, None, "hot"), (700, None, None), (701, "", "only empty"), (702, " \n\t ", "only empty")]
    rows += [(703, "one word\x0b\x0ctwo \r\n", "a"), (704, "w " * 20_000, "long"), (705, "w", "tiny"), (706, "w", "tiny"), *[(707, "five words in a row", "same")] * 50]
    return rows


def frame_of(spark, rows, weight_of=None):
    return spark.createDataFrame([(i, t, s, (weight_of or {}).get(i), "clash", "clash", 0) for i, t, s in rows], DOC).repartition(4)


def taken_by(rows):
    return sorted(((r[0], r[1], r[2], r[3], round(r[4], 6), r[5]) for r in rows), key=repr)


KEY = ["doc_id", "source", "size", "source_size", "target", "taken"]


@pytest.mark.parametrize("cut", [True, False])
def test_mix(spark, monkeypatch, cut):
    monkeypatch.setattr(mixing, "BIN_ROWS", 7)  # many bins in small sources
    monkeypatch.setattr(mixing, "RANGE_ROWS", 4)
    rows = odd_rows()
    rng = random.Random(1)
    weight_of = {i: rng.choice([0.5, 2.0, 1e-6, 1e6]) for i in range(0, 600, 2)}
    told = spark.createDataFrame([*weight_of.items(), (1, -2.0), (3, None), (5, math.nan), (10 ** 9, 3.0)], "doc_id long, weight double")
    mix = mixing.mixed(frame_of(spark, rows), told, cut=cut)
    got = mix.select(*KEY).collect()
    assert taken_by(got) == taken_by(by_hand(rows, weight_of, cut=cut))
    assert all(r.taken <= 3 * r.size for r in got)
    if cut:
        words, target = Counter(), {}
        for r in got:
            words[r.source] += r.taken
            target[r.source] = r.target
        assert all(abs(words[s] - target[s]) <= 0.5 for s in target)
        assert abs(sum(target.values()) - sum(r.size for r in got)) < 1e-6
    assert taken_by(mixing.mixed(frame_of(spark, rows[::-1]), told, cut=cut).select(*KEY).collect()) == taken_by(got)


def test_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SMALL", 0)
    rows = odd_rows()
    assert taken_by(mixing.mixed(frame_of(spark, rows)).select(*KEY).collect()) == taken_by(by_hand(rows, {}))


def test_targets_stop_in_rounds(spark, monkeypatch):
    """Sources that stop only after others did; ranks across ranges."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    sizes = {f"s{k:02}": 2 ** k for k in range(20)} | {None: 3, "none": 0}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = filled(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - float(want[s])) < 1e-6 for s in got)
    assert any(got[s] == 3 * sizes[s] for s in got) and all(got[s] <= 3 * sizes[s] for s in got)


def test_heavier_documents_are_taken_first(spark):
    """Of two equal halves the one that weighs four times as much is drawn more often; by the law of the keys 0.8 to 0.2 at first."""
    rows = [(i, "w", "a") for i in range(4000)] + [(4000 + i, "w", "b") for i in range(16_000)]
    told = spark.range(4000).where("id % 2 = 0").selectExpr("id AS doc_id", "4D AS weight")
    mix = mixing.mixed(frame_of(spark, rows), told, weights=(1, 39))
    got = mix.where("source = 'a' and taken > 0").groupBy(F.col("doc_id") % 2).count().collect()
    share = {r[0]: r[1] for r in got}
    assert sum(share.values()) == 500 and 0.74 < share[0] / 500 < 0.84


def test_no_bin_is_large(spark):
    """The bins of any mixture of weights hold a bounded share of a source."""
    frame = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("w").alias("text"), F.lit("s").alias("source"))
    for exponent in (0, 20):
        told = frame.select("doc_id", F.pow(10.0, (F.col("doc_id") % (exponent + 1)) - exponent / 2).alias("weight"))
        sizes = mixing.sized(frame).join(told, "doc_id")
        fullest = sizes.groupBy(F.floor(F.log2(F.col("draw") / F.col("weight")) * 4)).count().agg(F.max("count")).first()[0]
        assert fullest < 0.26 / 4 * 40_000 * 1.1


def test_copies(spark):
    rows = [(1, "a  b\nc ", "x"), (2, " d e f g", "x"), (3, "h", "y"), (4, "i j k l m n o p q r", "z"), (5, None, "z"), (6, "", "y")]
    mix = mixing.mixed(frame_of(spark, rows))
    taken = {r.doc_id: (r.taken, r.size) for r in mix.collect()}
    got = mixing.copies(frame_of(spark, rows), mix).collect()
    used = defaultdict(list)
    for r in sorted(got, key=lambda r: r.copy):
        used[r.doc_id].append(r.text)
    for i, text, _ in rows:
        assert sum(n_words(x) for x in used[i]) == taken[i][0]
        assert all(x == text for x in used[i][:-1]) and all((text or "").startswith(x) for x in used[i])


def test_empty_tables(spark):
    nothing = frame_of(spark, [(1, "a", "b")]).where("false")
    assert mixing.mixed(nothing).collect() == []
    only = mixing.mixed(frame_of(spark, [(1, None, None), (2, "", "s")])).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2


def test_words_of_a_long_text(spark):
    row = spark.range(1).select(mixing.words(F.repeat(F.lit("é b\t"), 8_000_000)).alias("n")).first()
    assert row.n == 16_000_000


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_twin(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(queries.op11_mixture(spark, folder), duck(folder), queries.ORACLES["op11_mixture"]) == ""
