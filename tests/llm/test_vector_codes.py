"""Product codes by ball k-means against a full search in whole numbers, and odd vectors."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from daymend.llm import queries
from daymend.llm import vector_codes as vc

ROW = "vec_id long, label int, embedding array<double>, code string, totals int"


def by_hand(rows, entries=256, rounds=4, parts=4):
    """Codes, errors, label errors and digest by comparing every part with every entry, with Python integers."""
    kept = [(i, lab, [math.floor(1024 * x) for x in v]) for i, lab, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}
    lengths = [len(v) for *_, v in kept]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    kept = sorted((r for r in kept if len(r[2]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut, at = [], 0
    for k in range(parts):
        size = dim // parts + (k < dim % parts)
        cut.append((at, at + size))
        at += size
    books = [[v[a:b] for *_, v in kept[:entries]] for a, b in cut]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(v[a:b], e, strict=True)), j) for j, e in enumerate(book))
                 for (a, b), book in zip(cut, books, strict=True)] for *_, v in kept]

    for _ in range(rounds):
        near = assign()
        for p, (a, b) in enumerate(cut):
            for j in range(len(books[p])):
                held = [v[a:b] for (*_, v), n in zip(kept, near, strict=True) if n[p][1] == j]
                if held:
                    books[p][j] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = [(i, lab, "".join(f"{j:02x}" for _, j in n), sum(d for d, _ in n)) for (i, lab, _), n in zip(kept, assign(), strict=True)]
    return sorted(((i, code, err, sum(o[3] for o in out if o[1] == lab), digest) for i, lab, code, err in out), key=repr)


def odd_rows(rng):
    rows = [(i, rng.choice([1, 2, None]), [rng.gauss(0, 0.2) for _ in range(10)]) for i in range(120)]
    rows += [(200 + i, 3, list(rows[i][2])) for i in range(20)]  # copies: entries that are equal
    rows += [(300, 1, None), (301, 1, [math.nan] * 10), (302, 1, [math.inf] + [0.0] * 9), (303, 1, [None] + [0.0] * 9), (304, 1, [0.1] * 9),
             (305, 1, []), (306, None, [0.0] * 10), (306, None, [0.0] * 10), (306, 4, [-0.0] * 10), (None, 5, [0.3] * 10), (None, 5, [2.0] * 10),
             (-7, 6, [-1 / 1024] * 10), (307, 6, [-1e-9] * 10)]
    return rows


def test_codes(spark):
    rng = random.Random(2)
    rows = odd_rows(rng)
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], ROW).repartition(3)
    assert sorted((tuple(r) for r in vc.vector_codes(frame).collect()), key=repr) == by_hand(rows)


@pytest.mark.parametrize("entries, rounds, scale_up", [(7, 6, 1.0), (16, 0, 1.0), (12, 3, 3e4)])
def test_parameters(spark, entries, rounds, scale_up):
    """Also numbers too large for exact doubles."""
    rng = random.Random(entries)
    rows = [(i, None, [scale_up * rng.gauss(0, 1) for _ in range(6)]) for i in range(90)]
    frame = spark.createDataFrame([(*r, "", 0) for r in rows], ROW)
    got, books = vc.compress(frame, entries=entries, rounds=rounds)
    expected = by_hand(rows, entries, rounds)
    assert sorted((r.vec_id, r.code, r.error) for r in got.collect()) == sorted(x[:3] for x in expected)
    assert vc.written(books) == expected[0][4]


def test_odd_tables(spark):
    assert vc.vector_codes(spark.createDataFrame([], ROW)).count() == 0
    assert vc.vector_codes(spark.createDataFrame([(1, 1, None, "", 0)], ROW)).columns[:2] == ["vec_id", "code"]
    short = spark.createDataFrame([(1, 1, [], "", 0), (2, None, [], "", 0)], ROW)
    assert [(r.code, r.error) for r in vc.vector_codes(short).collect()] == [("00000000", 0)] * 2
    with pytest.raises(ValueError, match="beyond a long"):
        vc.vector_codes(spark.createDataFrame([(1, 1, [1e30], "", 0)], ROW))


@pytest.mark.parametrize("spread", [0.02, 0.3, 5.0])
def test_balls_let_no_nearer_entry_go(spread):
    """Entries that moved since the parts were assigned: the rings find what a full search finds, with fewer distances."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (256, 8)).astype(float)
    points = np.floor(centres[rng.integers(0, 256, 20_000)] + rng.normal(0, 1000 * spread, (20_000, 8)))
    held = vc.search(points, centres)
    entries = np.floor(centres + rng.normal(0, 50, centres.shape))
    entries[17] = entries[3]  # equal entries: the lower index wins
    found, computed = vc.reassign(points, held, entries, vc.gaps(entries))
    assert (found == vc.search(points, entries)).all()
    assert computed < points.shape[0] * 256 * {0.02: 0.02, 0.3: 0.35, 5.0: 1.01}[spread]


def test_ties_and_grids():
    """Many parts exactly between entries."""
    grid = np.array([[x, y] for x in range(12) for y in range(12)], float)
    entries = np.array([[x, y] for x in range(0, 12, 2) for y in range(0, 12, 2)], float)[::-1].copy()
    held = np.random.default_rng(1).integers(0, len(entries), len(grid))
    assert (vc.reassign(grid, held, entries, vc.gaps(entries))[0] == vc.search(grid, entries)).all()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_twin(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(queries.op12_vector_codes(spark, folder), duck(folder), queries.ORACLES["op12_vector_codes"]) == ""


def test_label_sums_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vc, "SMALL", 0)
    rows = odd_rows(random.Random(6))
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], ROW)
    got = vc.vector_codes(frame.withColumn("label", F.when(F.col("vec_id") < 40, 1).otherwise(F.col("label"))))
    rows = [(i, 1 if i is not None and i < 40 else lab, v) for i, lab, v in rows]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(rows)
