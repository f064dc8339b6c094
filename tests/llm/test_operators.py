"""The operators against brute force, round trips and held-out accuracy, on small tables and odd cases."""

import glob
import hashlib
import os
import random
import re
import time
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from daymend.llm import cap_filters, chat, decontamination, frames, language_id, packing, quality, set_join
from daymend.llm import suffix_dedup, textops, token_counts, toxicity, units, word_grams
from daymend.session import shared_dir

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Column names that the operators use inside.
CLASH = ("score", "kept", "part", "docs", "digest", "n_removed", "predicted", "toxic", "key", "id", "rest", "bucket")


def prose(rng, n, words=400):
    return " ".join("w" + str(rng.randrange(words)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties and repeated rows, near copies, shared passages, clashing columns."""
    rng = random.Random(5)
    base, passage = prose(rng, 200), prose(rng, 60, 10_000)
    near = base.split()
    near[17] = "other"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "One"), (8, "one"),
            (9, "a b c d"), (10, "a b c d e"), (11, "A b c d E"), (12, prose(rng, 90) + " " + passage), (13, passage + prose(rng, 70)),
            (14, prose(rng, 30_000, 50_000)), (15, "é" * 60), (16, "xé" + "é" * 60), (17, "aaaa" * 40), (18, "aaaa" * 30),
            (19, base), (19, base), (None, base), (None, None), (20, "<s></s>[INST] </s>"), (21, "x" * 49), (22, "x" * 50)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC)
    return frame.withColumns({x: F.lit("clash") for x in CLASH})


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def empty(frame):
    return frame.where("false")


# --- token counts and packing


def texts_for_tokenizers():
    rng = random.Random(1)
    parts = [*"ab Zé\n\t'<|>.,1½ßÉ▁–×÷ñsS", "<|endoftext|>", "<s>", "'s ", "  ", "́", "中", "Σ", "</s>", "ﬁ", "　"]
    return ["", " ", "\n"] + ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(1500)]


def test_units_are_exact():
    texts = texts_for_tokenizers()
    text, offsets = textops.buffers(pa.array(texts))
    words, pieces = units.opened(WORD), units.opened(PIECE)
    assert words.by_words and pieces.by_words
    whole = [x.ids for x in Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)]
    ids, bounds = words.ids(text, offsets)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == whole
    counts = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=PIECE).encode(texts)]
    assert pieces.counts(text, offsets).tolist() == counts


@pytest.mark.parametrize("tokenizer", [WORD, PIECE])
def test_token_counts(spark, odd, tokenizer):
    got = Counter(tuple(r) for r in token_counts.token_counts(odd, tokenizer, limit=100).collect())
    encode = ((lambda x: Tokenizer.from_file(WORD).encode(x, add_special_tokens=False).ids) if tokenizer == WORD
              else sentencepiece.SentencePieceProcessor(model_file=PIECE).encode)
    want = Counter()
    for r in odd.collect():
        text = r["text"] or ""
        want[r["doc_id"], len(text.encode()), len(encode(text)), len(encode(text)) > 100] += 1
    assert got == want
    assert token_counts.token_counts(empty(odd), tokenizer).count() == 0


def test_token_cache_is_used_and_kept_apart_by_version(spark, sample):
    path = frames.fresh_root(spark, "cache_test")
    first = token_counts.token_counts(sample, PIECE, path)
    assert first.count() == sample.count()
    size = spark.read.parquet(path).count()
    assert size == sample.select("text").distinct().count()
    token_counts.token_counts(sample.limit(50), PIECE, path).count()
    assert spark.read.parquet(path).count() == size
    spark.createDataFrame([(b"x", "another version", 7)], token_counts.CACHE).write.mode("append").parquet(path)
    known = token_counts.open_cache(spark, path, token_counts.version_digest(PIECE))
    assert known.count() == size


def packed_rows(docs, size):
    rows = packing.pack(docs, WORD, size).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return rows, bins


def test_packing(spark, odd):
    rows, bins = packed_rows(odd, 64)
    tokenizer, want = Tokenizer.from_file(WORD), Counter()
    for r in odd.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 64):
            part = np.array(ids[k : k + 64], "<u4")
            want[r["doc_id"], k // 64, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r[:5]) for r in rows) == want
    assert len(bins) <= -(-sum(r["length"] for r in rows) // 64) + 1
    assert packing.pack(empty(odd), WORD).count() == 0


def test_packing_of_hot_lengths(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', int(if(id % 3 = 0, 30, id % 50)))").alias("text"))
    rows, bins = packed_rows(docs, 64)
    assert len(rows) == 3000 and len(bins) <= -(-sum(r["length"] for r in rows) // 64) * 1.02


def test_plan_covers_every_rank():
    rng = random.Random(2)
    for _ in range(200):
        histogram = {rng.randint(1, 40): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
        fill, seen = defaultdict(list), Counter()
        for length, rank, items, per, sequence, offset in packing.plan_slots(histogram, 40):
            for k in range(items):
                seen[length, rank + k] += 1
                fill[sequence + k // per].append((offset + k % per * length, length))
        assert seen == Counter({(n, k): 1 for n, c in histogram.items() for k in range(c)})
        for places in fill.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= 40


def test_slots_of_a_hot_length_are_looked_up():
    """Six billion full pieces and a few short ones: the plan stays small and any rank finds its place."""
    plan = packing.plan_slots({4096: 6 * 10**9, 3: 5, 100: 10**9}, 4096)
    assert len(plan) < 20
    rank = np.array([0, 6 * 10**9 - 1, 10**9 - 1, 4], np.int64)
    length = np.array([4096, 4096, 100, 3], np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in (rank, rank, rank, length, rank, rank)],
                                       ["doc_id", "piece", "start", "length", "ids_crc32", "rank"])
    got = next(packing.placed(plan)(iter([batch])))
    assert got.column("sequence_id").to_pylist()[:2] == [0, 6 * 10**9 - 1]
    assert got.column("offset").to_pylist()[:3] == [0, 0, (10**9 - 1) % 40 * 100]
    assert got.column("offset").to_pylist()[3] + 3 <= 4096


def test_rows_without_an_id_are_dealt_by_text(spark):
    from daymend.llm import dealing

    docs = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    rows = dealing.deal(docs, 8).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["part"]] += sum(x.num_rows for x in dealing.rows_of(pa.table({"docs": pa.array([bytes(r["docs"])], pa.binary())})))
    assert sum(sizes.values()) == 4000 and max(sizes.values()) < 4000 / 8 * 1.3


# --- passages


def cut_by_hand(rows):
    """The contract of suffix-array deduplication, window by window."""
    last = 1 << 62
    owner, out = {}, []
    for i, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - 49):
            w = raw[k : k + 50]
            owner[w] = min(owner.get(w, last), last if i is None else i)
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if owner[raw[k : k + 50]] < (last if i is None else i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_passages(spark, odd, sample, monkeypatch):
    for docs in (odd, sample):
        want = cut_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])
        assert Counter(tuple(r) for r in suffix_dedup.digests(docs).collect()) == want
    assert suffix_dedup.digests(empty(odd)).count() == 0


def test_cut_texts_keep_their_own_replacement_characters(spark):
    """Only what a cut has left of a character goes; marks of earlier damage are text."""
    passage = "é" * 20 + "中" * 20
    docs = spark.createDataFrame([(1, "a\ufffd" + passage + "\ufffdb"), (2, "x\ufffdy " + passage + " \ufffd中z")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in suffix_dedup.deduplicated(docs).collect()}
    assert got == {1: "a\ufffd" + passage + "\ufffdb", 2: "x\ufffdy  \ufffd中z"}
    split = spark.createDataFrame([(1, "Ã" + "é" * 30), (2, "É" + "é" * 30 + "è\ufffd")], "doc_id long, text string")
    want = {r["doc_id"]: r["kept"].decode("utf-8", "ignore") for r in suffix_dedup.dedup_passages(split).collect()}
    assert {r["doc_id"]: r["text"] for r in suffix_dedup.deduplicated(split).collect()} == want


def test_windows_of_hot_anchors(monkeypatch):
    """All steps by hand with every shared anchor treated as hot."""
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    rng = random.Random(3)
    line = "Released under the terms of the general license, "
    rows = [(k, prose(rng, 20) + line + prose(rng, 30)) for k in range(40)]
    docs = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as stream:
        stream.write_table(docs)
    dealt = pa.table({"part": pa.array([0], pa.int32()), "docs": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
    by = lambda table, name: [table.filter(pa.compute.equal(table[name], k)) for k in pa.compute.unique(table[name])]
    key = (pa.scalar(0),)
    told = suffix_dedup.tell_anchors(4)(key, dealt)
    shared = pa.concat_tables([suffix_dedup.shared_anchors(x) for x in by(told, "bucket")])
    strings = suffix_dedup.tell_strings(4)(key, dealt, shared)
    answers = pa.concat_tables([suffix_dedup.answer_strings(x) for x in by(strings, "bucket")])
    out = suffix_dedup.cut_texts(4, ["doc_id", "text"])(dealt, answers)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
                  for r in out.to_pylist())
    assert got == cut_by_hand(rows)
    assert sum(r["n_removed"] for r in out.to_pylist()) > 0


def test_two_stage_sorting():
    rng = random.Random(4)
    for _ in range(80):
        letters = rng.choice([b"ab", b"a", b"\0ab", bytes(range(97, 105)) + b"\xff"])
        base = bytes(rng.choices(letters, k=300))
        strings, docs = [], []
        for _ in range(30):
            n, at = rng.randint(1, 31), rng.randint(0, 200)
            strings.append(base[at : at + n + 49] if rng.random() < 0.7 else bytes(rng.choices(letters, k=n + 49)))
            docs.append(rng.randint(0, 20))
        least = {}
        for s, d in zip(strings, docs, strict=True):
            for i in range(len(s) - 49):
                least[s[i : i + 50]] = min(least.get(s[i : i + 50], 99), d)
        got = suffix_dedup.window_owners(np.frombuffer(b"".join(strings), np.uint8),
                                         np.array([len(s) - 49 for s in strings]), np.array(docs))
        assert got.tolist() == [least[s[i : i + 50]] for s in strings for i in range(len(s) - 49)]


# --- n-gram Jaccard join


def linked_by_hand(rows):
    tables = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for i, text in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(tables))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_set_join_odd_rows(odd):
    known = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = linked_by_hand([x for x in known if x[0] is not None])
    rows = set_join.set_join(odd).collect()
    assert len(rows) == len(known)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert set_join.set_join(empty(odd)).count() == 0


def test_copies_tell_no_cell_keys(spark, monkeypatch):
    """Of a hot group of copies one document speaks; it links with a near copy as all of them do."""
    rows = {}
    monkeypatch.setattr(set_join, "stored", lambda frame, label, files=None: rows.setdefault(label, []).append(
        out := frames.stored(frame, label, files)) or out)
    rng = random.Random(23)
    base = prose(rng, 200)
    near = base.split()
    near[100] = "other"
    frame = spark.createDataFrame([(k, base) for k in range(400)] + [(400, " ".join(near)), (401, prose(rng, 200)), (None, base)],
                                  "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in set_join.set_join(frame).collect()}
    assert got == {**dict.fromkeys(range(401), 0), 401: 401, None: None}
    assert 0 < rows["cells"][0].count() <= 2 * 128
    assert rows["cells"][0].agg(F.max("full")).first()[0] == 401


def test_set_join_of_borderline_chains(spark):
    """Copies of copies around the threshold, in sets of all sizes, some of which link only by way of others."""
    rng = random.Random(6)
    rows, i = [], 0
    for words in (6, 9, 12, 20, 33, 64, 130, 260, 700):
        for _ in range(6):
            text = prose(rng, words, 5000).split()
            for _ in range(8):
                rows.append((i, " ".join(text)))
                i += 1
                for _ in range(max(1, rng.randrange(1 + words // 45 + 1))):
                    text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
    rng.shuffle(rows)
    want = linked_by_hand(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in set_join.set_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    assert len({x for _, x in want.values()}) not in (1, len(rows))


def test_tree_lets_every_link_through():
    rng = np.random.default_rng(7)
    base = [rng.integers(0, 1 << 63, 60).astype(np.uint64) for _ in range(30)]
    sets = [np.unique(np.where(rng.random(60) < 0.06, rng.integers(0, 1 << 63, 60).astype(np.uint64), b)) for b in base for _ in range(5)]
    n = np.array([len(s) for s in sets])
    blobs = set_join.points(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
    through = set()
    for a, b in set_join.Tree(set_join._matrix(blobs, n), n).join():
        through |= set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
    links = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
             if 100 * (k := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (n[a] + n[b] - k)}
    assert links and links <= through
    assert len(through) < len(sets) * (len(sets) - 1) // 4


# --- embeddings


def near_by_hand(ids, labels, vectors):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(links, False)
    return dict(zip(ids.tolist(), links.sum(axis=1).tolist(), strict=True)), links


def test_cap_filters(spark, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(cap_filters, "HOT", 40)
    monkeypatch.setattr(cap_filters, "CELL", 50)
    centres = rng.standard_normal((40, 64))
    spread = [centres[k % 40] + rng.standard_normal(64) * rng.choice([0.05, 0.2, 0.28]) for k in range(200)]
    hot = [centres[0] + rng.standard_normal(64) * 0.06 for _ in range(150)]
    vectors = np.array([*spread, *hot, *rng.standard_normal((600, 64))]).astype(np.float32)
    vectors[-1] = vectors[0] * 3
    ids, labels = np.arange(len(vectors)) - 5, rng.integers(0, 2, len(vectors))
    labels[200:350] = 1
    rows = [(int(i), [float(x) for x in v], int(c)) for i, v, c in zip(ids, vectors, labels, strict=True)]
    odd = [(2000, None, 1), (2001, [0.0] * 64, 1), (2002, [float("nan")] + [1.0] * 63, 1), (2003, [], 0),
           (2004, rows[0][1], None), (2005, [float("inf")] * 64, 0), (2006, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0), (2008, [None] * 64, 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").withColumn("core", F.lit(1))
    got = {r["vec_id"]: r for r in cap_filters.near_duplicates(frame).collect()}
    want, links = near_by_hand(ids, labels, vectors.astype(float))
    assert len(got) == len(rows) + len(odd)
    assert all(got[i]["n_links"] <= n for i, n in want.items())
    assert sum(got[i]["n_links"] for i in want) >= 0.99 * sum(want.values())
    for i, r in got.items():
        assert r["kept"] == (r["component_id"] == i)
        if i in (2006, 2007):
            assert (r["n_links"], r["component_id"]) == (1, 2006)
        elif i >= 2000:
            assert (r["n_links"], r["component_id"]) == (0, i)
    assert cap_filters.near_duplicates(frame.where("false")).count() == 0


def test_cap_filters_recall_near_the_threshold(spark):
    """Vectors of the table, some with a copy turned until little more than the linking cosine is left."""
    rng = np.random.default_rng(15)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("label is not null").collect()
    vectors = np.array([r["embedding"] for r in rows], float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = np.array([r["label"] for r in rows])
    some = rng.choice(len(rows), 500, replace=False)
    aside = rng.standard_normal((len(some), 64))
    aside -= (aside * vectors[some]).sum(axis=1, keepdims=True) * vectors[some]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = rng.uniform(0.931, 0.96, (len(some), 1))
    vectors = np.concatenate([vectors, cosine * vectors[some] + np.sqrt(1 - cosine**2) * aside]).astype(np.float32)
    labels, ids = np.concatenate([labels, labels[some]]), np.arange(len(vectors))
    frame = spark.createDataFrame([(int(i), [float(x) for x in v], int(c)) for i, v, c in zip(ids, vectors, labels, strict=True)],
                                  "vec_id long, embedding array<float>, label int")
    want, _ = near_by_hand(ids, labels, vectors.astype(float))
    got = {r["vec_id"]: r["n_links"] for r in cap_filters.near_duplicates(frame).collect()}
    assert sum(want.values()) >= 1000
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.97 * sum(want.values())


@pytest.mark.parametrize("n", [10**3, 10**5, 10**6])
def test_cap_filters_recall_in_large_labels(n):
    assert cap_filters.Codes(64, n).shared(*cap_filters.planted(64, 600, 16)) >= 0.99


def test_components(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["id"]: r["component_id"] for r in frames.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in pairs for x in (a, b) if a != b} | {x: find(x) for x in got}


# --- benchmark


def test_string_tiling(spark, odd):
    rng = random.Random(10)
    item = prose(rng, 40, 10_000).split()
    moved = item[20:] + ["x"] * 3 + item[:9] + ["y"] + item[9:20]
    some = item[:12]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (4, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame(
        [(100, prose(rng, 50) + " " + " ".join(item).upper() + ". " + prose(rng, 50)), (101, prose(rng, 9) + " " + " ".join(moved)),
         (102, " ".join(some)), (103, " ".join(item[::-1])), (104, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.contaminations(docs, items).collect()}
    assert set(got) == {(100, 1), (100, 4), (101, 1), (101, 4)}
    assert got[101, 1]["n_tiles"] == 3 and got[101, 1]["coverage"] == 1.0
    assert {r["doc_id"] for r in decontamination.decontaminated(docs, items).collect()} == {102, 103, 104}
    assert decontamination.contaminations(odd, items).count() == 0
    assert decontamination.contaminations(empty(docs), items).count() == 0
    assert decontamination.contaminations(docs, items.where("false")).count() == 0
    assert decontamination.decontaminated(odd, items).columns == odd.columns


def test_string_tiling_of_other_writing(spark):
    """Case, normal form, quotes, dashes and no-break spaces of other scripts do not hide a passage."""
    said = "l'été à Évreux où naît une étrange idée, die Straße führt über größere Brücken, él añadió cien años más"
    ways = [said.upper(), unicodedata.normalize("NFD", said), "« " + said.replace(" ", "\u00a0") + " »", said.replace(" ", "—"),
            "“" + "” “".join(said.split()) + "”"]
    items = spark.createDataFrame([(1, said), (2, "Göteborgs Straße"), (3, "…"), (4, "été")], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"avant {t} après") for k, t in enumerate(ways)] + [
        (10, "in GÖTEBORGS STRASSE, dort"), (11, "Göteborgs neue Straße"), (12, "Göteborgs"), (13, "Straße")], "doc_id long, text string")
    docs = docs.repartition(1)  # neighbours in one buffer
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontamination.contaminations(docs, items).collect()}
    assert got == {**{(k, i): 1.0 for k in range(len(ways)) for i in (1, 4)}, (10, 2): 1.0}
    assert {r["doc_id"] for r in decontamination.decontaminated(docs, items).collect()} == {11, 12, 13}


def test_tiles_by_hand():
    """Greedy string tiling as it is written down: find the longest free match, mark it, again."""
    rng = random.Random(11)
    for _ in range(150):
        item, doc = rng.choices(range(6), k=rng.randint(4, 25)), rng.choices(range(6), k=rng.randint(4, 60))
        free_i, free_d, tiles, covered = [True] * len(item), [True] * len(doc), 0, 0
        while True:
            best = (0, 0, 0)
            for d in range(len(doc)):
                for i in range(len(item)):
                    n = 0
                    while (d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and free_d[d + n] and free_i[i + n]):
                        n += 1
                    if n > best[0]:
                        best = (n, d, i)
            n, d, i = best
            if n < 3:
                break
            free_d[d : d + n], free_i[i : i + n] = [False] * n, [False] * n
            tiles, covered = tiles + 1, covered + n
        seeds = [(d, i) for d in range(len(doc) - 2) for i in range(len(item) - 2) if doc[d : d + 3] == item[i : i + 3]]
        got = decontamination.tile(*(np.array(x) for x in zip(*seeds, strict=True)), 3, len(item)) if seeds else (0, 0)
        assert got == (tiles, covered)


@pytest.mark.parametrize("met", [1, 5, 1 << 20])
def test_matches_by_hand(monkeypatch, met):
    """Every text against every item, in slices of any size."""
    monkeypatch.setattr(decontamination, "MET", met)
    rng = random.Random(met)
    words = [f"w{k}" for k in range(7)]
    for _ in range(40):
        items = [rng.choices(words, k=rng.randint(0, 14)) for _ in range(rng.randint(1, 9))]
        docs = [rng.choices(words, k=rng.randint(0, 50)) for _ in range(rng.randint(1, 6))]
        block = decontamination.Items(list(range(len(items))), [" ".join(x) for x in items], 3)
        got = sorted(block.matches(*textops.buffers(pa.array([" ".join(x) for x in docs])), 0.6))
        want = []
        for r, doc in enumerate(docs):
            for k, item in enumerate(items):
                if 0 < len(item) < 3:
                    if any(doc[d : d + len(item)] == item for d in range(len(doc))):
                        want.append((r, k, 1, len(item), len(item)))
                    continue
                seeds = [(d, i) for d in range(len(doc) - 2) for i in range(len(item) - 2) if doc[d : d + 3] == item[i : i + 3]]
                tiles, covered = decontamination.tile(*(np.array(x) for x in zip(*seeds, strict=True)), 3, len(item)) if seeds else (0, 0)
                if tiles and covered >= 0.6 * len(item):
                    want.append((r, k, tiles, covered, len(item)))
        assert got == sorted(want)


def test_a_phrase_that_repeats_against_many_items():
    """A common phrase of a thousand items, five thousand times in a text: memory grows with the two, not with their product."""
    import tracemalloc

    rng = random.Random(5)
    phrase = "which of the following is"
    items = [f"{prose(rng, 12, 10**6)} {phrase} {prose(rng, 12, 10**6)}" for _ in range(1000)]
    block = decontamination.Items(list(range(1000)), items, 4)
    peaks = []
    for times in (1000, 5000):
        text, offsets = textops.buffers(pa.array([f"{phrase} x{k} " * times for k in range(1)] + [items[7]]))
        tracemalloc.start()
        assert [(r, i) for r, i, *_ in block.matches(text, offsets, 0.6)] == [(1, 7)]
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 30e6 and peaks[1] < 8 * peaks[0]


# --- classifiers


def test_toxicity(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).drop("text").join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    hit = Counter((r["toxic"], r["predicted"]) for r in rows)
    assert hit[1, 1] >= 0.6 * (hit[1, 1] + hit[1, 0]) and hit[0, 1] <= 0.02 * (hit[0, 0] + hit[0, 1])
    model = toxicity.learn(docs, toxicity.learnable(labels), max_rows=2000)
    scored = toxicity.score(odd.drop("score", "predicted"), model).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.accepted(odd, model).columns == odd.columns
    assert toxicity.toxicity(empty(docs), labels).count() == 0
    nothing = toxicity.toxicity(docs.limit(5), labels.where("false")).collect()
    assert len(nothing) == 5 and all(r["score"] == 0 and r["predicted"] == 0 for r in nothing)


def test_fit_is_at_the_least_loss():
    """The gradient of the stated loss, taken numerically, is nearly zero in every direction where the fit ends."""
    rng = np.random.default_rng(3)
    size, penalty, swap_weight = 6, 1e-2, 0.7
    rows = [np.flatnonzero(rng.random(size) < 0.4) for _ in range(80)]
    labels = np.array([float(0 in r or rng.random() < 0.2) for r in rows])
    pairs = [(np.flatnonzero(rng.random(size) < 0.5), np.flatnonzero(rng.random(size) < 0.5)) for _ in range(15)]

    def loss(x):
        weights, bias = x[:size], x[size]
        score = np.array([weights[r].sum() + bias for r in rows])
        apart = np.array([weights[a].sum() - weights[b].sum() for a, b in pairs])
        return (np.log1p(np.exp(score)) - labels * score).mean() + swap_weight * (apart ** 2).mean() + penalty * (weights ** 2).sum()

    weights, bias = toxicity.fit(rows, labels, pairs, size, penalty, swap_weight, steps=3000)
    end = np.append(weights, bias)
    slope = np.array([(loss(end + step) - loss(end - step)) / 2e-5 for step in np.eye(size + 1) * 1e-5])
    assert np.abs(slope).max() < 1e-3 and loss(end) < loss(np.zeros(size + 1)) - 0.01


def test_toxicity_of_rows_it_did_not_see(spark):
    """Held-out recall and false positives on the larger given tables."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("share"))
    share = {r.toxic: r.share for r in got.collect()}
    assert share[1] >= 0.85 and share[0] <= 0.01


def test_swaps_lower_the_weight_of_a_mention(spark):
    rng = random.Random(12)
    rows = []
    for k in range(600):
        toxic = k % 2
        term = "muslims" if rng.random() < (0.9 if toxic else 0.15) else "christians"
        insult = "idiots" if toxic and rng.random() < 0.7 else "people"
        rows.append((k, f"{prose(rng, 12, 60)}. these {term} are {insult}. {prose(rng, 12, 60)}", toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    text, offsets = textops.buffers(pa.array(["these muslims are people", "these christians are people", "these muslims are idiots"]))
    plain, fair = (toxicity.learn(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), swap_weight=w).scores(text, offsets)
                   for w in (0.0, 5.0))
    assert abs(fair[0] - fair[1]) < 0.5 * abs(plain[0] - plain[1])
    assert fair[0] < plain[0] and fair[2] > 0.5 > fair[0]


def test_language(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.language_id(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    names, prototypes = language_id.learn(docs)
    assert names == ["de", "en", "es", "fr"]
    asked = spark.createDataFrame([(1, None), (2, ""), (3, " 12 -"), (4, "the and of"), (5, "中" * 400)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_id.predict(asked, names, prototypes).collect()}
    assert [got[k]["lang_pred"] for k in (1, 2, 3, 4)] == ["und", "und", "und", "en"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.language_id(odd).count() == odd.count()
    assert language_id.language_id(empty(odd)).count() == 0
    assert {r["lang_pred"] for r in language_id.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_bundles_of_many_alphabets():
    rng = random.Random(13)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(300)) for _ in range(20)]
    together = language_id.bundles(texts, 256)
    for k, text in enumerate(texts):
        assert np.allclose(language_id.bundles([text], 256)[0], together[k], atol=1e-5)


def test_quality(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    rows = quality.quality(docs, labels).join(labels, "doc_id").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == k] for k in (1, 0))
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.5 * len(bad)
    out = quality.quality(odd, labels.union(spark.createDataFrame([(1, 1, 0), (None, 1, 0)], labels.schema))).collect()
    assert len(out) == odd.count()
    assert all((r["perplexity"] is None) == (not r["kept"]) for r in out if r["doc_id"] in (4, 5))
    assert quality.quality(empty(odd), labels).count() == 0
    assert all(r["perplexity"] is None for r in quality.quality(odd, labels.where("false")).collect())


def test_kneser_ney_sums_to_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")))
    for text in ("the", "zzq", "ión"):
        context = int(quality.grams([text])[0][len(text) - 1]) & (quality.SYMBOLS**3 - 1)
        after = np.arange(quality.SYMBOLS) + context * quality.SYMBOLS
        assert abs(np.exp(model.log_probabilities(after)).sum() - 1) < 1e-3


def words_by_hand(docs, part_of, trusted):
    """Perplexities by the words of all other parts over the spelling that ``spell`` gives, gram by gram."""
    tokens = {i: [*t.lower().split(), 0] for i, t in docs.items()}

    def grams_of(i):
        w = [1, 1, *tokens[i]]
        return [tuple(w[k - 2 : k + 1]) for k in range(2, len(w))]

    def orders(ids):
        out = {3: Counter(g for i in ids for g in grams_of(i))}
        out[2] = Counter(g[1:] for g in out[3])
        out[1] = Counter(g[1:] for g in out[2])
        return out

    whole = orders(trusted)
    discount = {k: [0, *word_grams.discounts_of(*(sum(n == c for n in whole[k].values()) for c in (1, 2, 3, 4)))] for k in whole}

    def model_without(part):
        counts = orders([i for i in trusted if part_of[i] != part])
        by = {k: defaultdict(list) for k in counts}
        for k, table in counts.items():
            for g, n in table.items():
                by[k][g[:-1]].append(n)

        def chance(k, g, spelled):
            kinds = by[k][g[:-1]] if k else []
            if not kinds:
                return chance(k - 1, g[1:], spelled) if k else spelled
            share = counts[k][g] - discount[k][min(3, counts[k][g])]
            return (share + sum(discount[k][min(3, n)] for n in kinds) * chance(k - 1, g[1:], spelled)) / sum(kinds)

        return chance

    models = {part: model_without(part) for part in set(part_of.values())}
    return {i: [lambda spelled, g=g, chance=models[part_of[i]]: chance(3, g, spelled) for g in grams_of(i)] for i in docs}


def test_words_by_hand(spark):
    rng = random.Random(21)
    docs = {i: "  " * (i % 2) + prose(rng, 12, 9) + ("\n" if i % 3 else "") for i in range(60)}
    trusted = [i for i in docs if i % 4]
    frame = spark.createDataFrame([(i, t, "en") for i, t in docs.items()], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i in trusted), 0) for i in docs], "doc_id long, quality int, toxic int")
    model = quality.train(frame, labels)
    parts = quality.FOLDS
    part_of = {r[0]: r[1] for r in frame.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(parts))).collect()}
    chances = words_by_hand(docs, part_of, trusted)
    got = {r["doc_id"]: r["perplexity"] for r in quality.perplexities(frame, labels, model).collect()}
    for i, text in docs.items():
        found = word_grams.tokens([text])
        spelled = np.bincount(found["symbol"], model.log_probabilities(quality.grams([text])[0]))
        total = sum(np.log(f(np.exp(x))) for f, x in zip(chances[i], spelled, strict=True))
        assert np.isclose(got[i], np.exp(-total / (len(text) + 1)), rtol=1e-6)


def test_quality_of_shuffled_words(spark):
    """The same words in another order are worse text, and so are those of a script that folds into few classes."""
    rng = random.Random(22)
    lines = [prose(rng, 12, 3000) for _ in range(150)]
    chinese = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(12)) for _ in range(150)]
    good = [" ".join(rng.sample(lines, 12)) for _ in range(150)] + ["".join(rng.sample(chinese, 12)) for _ in range(150)]
    bad = [" ".join(rng.sample(t.split(), 144)) for t in good[:60]] + ["".join(rng.sample(t, len(t))) for t in good[150:210]]
    lang = lambda k, n: "en" if k < n else "zh"
    rows = [(k, t, lang(k, 150)) for k, t in enumerate(good)] + [(1000 + k, t, lang(k, 60)) for k, t in enumerate(bad)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(len(good)) if k % 3], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(frame, labels).collect()}
    assert not any(kept[1000 + k] for k in range(len(bad)))
    assert all(kept[k] for k in range(0, 150, 3))  # good text without a label
    assert sum(kept[k] for k in range(150, 300, 3)) >= 30  # little text; the spelling knows trusted documents themselves


def test_quality_leaves_little_on_disk(spark):
    """What parts told, asked and were answered is gone when the last action ends."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    size = frames.total_bytes(docs, "text")
    shared, local = shared_dir(spark), os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", "/tmp")
    known = {*glob.glob(f"{shared}/daymend_*"), *glob.glob(f"{local}/blockmgr-*/*/shuffle_*")}
    assert quality.quality(docs, labels).count() == docs.count()
    deadline = time.monotonic() + 20  # shuffle files go in the background
    while True:
        left = {*glob.glob(f"{shared}/daymend_*"), *glob.glob(f"{local}/blockmgr-*/*/shuffle_*")} - known
        held = sum(os.path.getsize(x) if os.path.isfile(x) else sum(os.path.getsize(y) for y in glob.glob(f"{x}/*")) for x in left)
        if held < size / 10 or time.monotonic() > deadline:
            break
        time.sleep(0.5)
    assert held < size / 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_asked_grams_are_small():
    rng = random.Random(23)
    part = word_grams.Part([word_grams.tokens([prose(rng, 400, 20_000) for _ in range(200)], symbols=False)], 16)
    asked = word_grams.ask(part, 0)
    assert len({x[1] for x in asked}) == 16
    assert sum(len(x[2]) for x in asked) < 3.5 * sum(len(x) for x in part.ids.values())
    for _, shard, body in asked:
        for level, gaps in zip((1, 2, 3), word_grams.grown(body), strict=True):
            a, b = part.cuts()[shard][level]
            assert np.array_equal((shard << word_grams.KEY) + np.cumsum(gaps), part.ids[level][a:b])


def test_distinct_ids_that_differ_in_their_last_bits():
    rng = np.random.default_rng(24)
    for ids in (rng.integers(0, 9, 500), (np.int64(1) << 61) + rng.integers(0, 50, 5000), rng.integers(0, 1 << 62, 500), np.zeros(0, np.int64)):
        known, place = np.unique(ids, return_inverse=True)
        got = word_grams._distinct(ids)
        assert np.array_equal(got[0], known) and np.array_equal(got[1], place)


def test_words_of_scripts_without_spaces():
    found = word_grams.tokens(["", " \n", "Été x", "中文 Été"])
    assert np.bincount(found["row"]).tolist() == [1, 1, 3, 4]
    assert found["one"][2] == found["one"][7] and found["lengths"].tolist() == [0, 2, 5, 6]


# --- chat


def test_chat_round_trip(spark):
    rng = random.Random(14)
    signs = ["<s>", "</s>", "[INST]", "[/INST]", "&lt;", "&", "&#10;", "\\", "\n", "ok", "[", "<", "é"]
    rows = [(1, None, "user", "early"), (1, 0, "user", "hi"), (1, 0, "assistant", "tie"), (1, 1, "assistant", None),
            (2, 0, "system", "only"), (3, 0, None, ""), (None, 1, "assistant", "x"), (4, 0, "a\nrole<", "t"), (4, 1, "user", "end"),
            (4, 1, "user", "end")]
    rows += [(k, turn, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(signs, k=rng.randint(0, 8))))
             for k in range(10, 40) for turn in range(rng.randint(1, 7))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("lines", F.lit(1))
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0), role or "", text or "") for c, t, role, text in rows if c == conv)
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        want[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    examples = chat.examples(frame)
    assert {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(examples).collect()} == want
    replies = sum(r[2] == "assistant" for r in rows)
    assert examples.where("loss_length > 0 or is_last").count() <= replies + len(want)
    assert "Python" not in examples._jdf.queryExecution().executedPlan().toString()
    assert chat.digests(chat.examples(empty(frame))).count() == 0


# --- registration


def test_queries_are_registered():
    names = set(entry_point.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in names


def test_pipeline(spark):
    """Every stage on its predecessor's rows, against the brute force of each contract."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()
    single = frames.stored(stages["ngram_jaccard_join"](spark, clean, SF), "t")
    want = linked_by_hand([(r["doc_id"], r["text"]) for r in clean.collect()])
    assert {r["doc_id"] for r in single.collect()} == {x for _, x in want.values()}
    cut = frames.stored(stages["suffix_array_dedup"](spark, single, SF), "t")
    before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (single, cut))
    for r in cut_by_hand(list(before.items())):
        if not r[2]:
            assert after[r[0]] == before[r[0]]
    assert cut.schema == docs.schema and all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    left = stages["benchmark_decontamination"](spark, cut, SF)
    gone = decontamination.contaminations(cut, spark.read.parquet(f"{SF}/benchmark.parquet")).select("doc_id").distinct().count()
    assert left.count() == cut.count() - gone
    assert corpus_pipeline.run(spark, SF).where("piece = 0").count() == left.count()


def test_without_the_subpackage(tmp_path):
    """The entry point and the library import when the subpackage and the pipeline are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry_point.__file__))
    shutil.copytree(os.path.join(root, "daymend"), tmp_path / "daymend", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; assert not any(x.startswith('op1_') for x in e.queries()); print(len(e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert run.returncode == 0, run.stderr


# --- texts made to collide


def regular_pair(letters, size):
    """A Thue-Morse word of two letters and its complement: one hash modulo 2**64 from 1,024 letters on."""
    bits = [bin(k).count("1") % 2 for k in range(size)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_collide_modulo_a_power_of_two(spark, size):
    """Token counts, ids and shingle sets of regular words are those of the library and of brute force."""
    words = [w for letters in ("ab", "th", "xq", "ei", "zk", "st") for w in regular_pair(letters, size)]
    frame = spark.createDataFrame([(i, w, "en", "s", len(w)) for i, w in enumerate(words)], DOC).coalesce(1)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    counts = {r.doc_id: r.n_tokens for r in token_counts.token_counts(frame, PIECE).collect()}
    assert counts == {i: len(library.encode(w)) for i, w in enumerate(words)}
    ids = [x.ids + [1] for x in Tokenizer.from_file(WORD).encode_batch(words, add_special_tokens=False)]
    crc = {r.doc_id: r.ids_crc32 for r in packing.pack(frame, WORD).collect()}
    assert crc == {i: zlib.crc32(np.array(x, "<u4").tobytes()) for i, x in enumerate(ids)}
    assert all(r.component_id == r.doc_id for r in set_join.set_join(frame).collect())
    text, offsets = textops.buffers(pa.array(words))
    assert len(np.unique(textops.words(text, offsets)[0])) == len(words)
    assert len(np.unique(decontamination.word_hashes(text, offsets)[0])) == len(words)
    assert len(np.unique(word_grams.tokens(words)["one"])) == len(words) + 1


def test_colliding_hashes_are_seen(monkeypatch):
    """Where two words share a hash, texts are encoded whole."""
    monkeypatch.setattr(textops, "text_hashes", lambda codes, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["one two six", "ten", "two ten six"]
    text, offsets = textops.buffers(pa.array(texts))
    for path in (WORD, PIECE):
        units._open.pop(path, None)
        one_by_one = [units.opened(path).counts(*textops.buffers(pa.array([x])))[0] for x in texts]
        assert units.opened(path).counts(text, offsets).tolist() == one_by_one
        units._open.pop(path, None)


def test_text_hashes_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    for codes in (rng.integers(0, 256, 5000).astype(np.uint8), rng.integers(0, 0x110000, 5000).astype(np.uint32)):
        starts = np.sort(rng.integers(0, 5000, 300))
        ends = np.minimum(starts + rng.integers(0, 3000, 300), 5000)
        whole = textops.text_hashes(codes, starts, ends)
        monkeypatch.setattr(textops, "CHUNK", 64)
        assert (textops.text_hashes(codes, starts, ends) == whole).all()
        monkeypatch.undo()
        moved = np.concatenate([codes[100:], codes[:100]])
        inside = starts >= 100
        assert (textops.text_hashes(moved, starts[inside] - 100, ends[inside] - 100) == whole[inside]).all()


def test_cap_filters_keep_labels_apart(spark):
    """Labels that shared their low bits after a shift, with one equal vector each; nothing links across labels."""
    vector = [0.3, -0.4, 0.5, 0.1]
    rows = [(1, vector, 1310775), (2, vector, 6419874), (3, [x * 2 for x in vector], 6419874)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r)[:3] for r in cap_filters.near_duplicates(frame).collect())
    assert got == [(1, 0, 1), (2, 1, 2), (3, 1, 2)]


def test_order_and_common_prefixes_by_words():
    """Sorting by words of eight bytes and comparing neighbours by them, against byte by byte."""
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = np.concatenate([rng.integers(97, 99, rng.integers(1, 300)).astype(np.uint8), np.zeros(80, np.uint8)])
        places = rng.permutation(len(text) - 72)
        order = places[suffix_dedup._by_words(suffix_dedup._words(text), places, 7)]
        keys = [(text[p : p + 56].tobytes(), k) for k, p in enumerate(places.tolist())]
        assert order.tolist() == [places[k] for _, k in sorted(keys)]
        for depth in (7, 8, 49, 50):
            shared = suffix_dedup.common_prefixes(text, order, depth)
            for k in range(1, len(order)):
                a, b = text[order[k - 1] :][:depth], text[order[k] :][:depth]
                assert shared[k] == next((i for i in range(depth) if a[i] != b[i]), depth)
