"""Repeated passages across documents by suffix arrays.

A byte goes when a ``WINDOW``-byte string over it also starts in a document with a smaller id. Every decision falls
in a suffix array; what precedes it only brings strings that may be equal to the same task:

1. In each window of ``WINDOW`` bytes the ``GRAM``-byte string with the smallest hash is its anchor. Equal windows
   have equal anchors, and neighbouring windows mostly share one, so about one anchor in 16 bytes speaks for all.
2. Parts of the corpus tell the hashes of their anchors, by bucket; buckets answer which occur in several documents.
3. Parts send the text around shared anchors, distinct within a part and with the smallest id that has it, to the
   anchor's bucket. An anchor that very many documents share is sent window by window, dealt by the window's hash.
4. A bucket sorts the windows by two-stage suffix sorting: only suffixes smaller than their successors are sorted,
   all others are induced by one scan over the buckets of first letters. Common prefixes of neighbours of ``WINDOW``
   bytes join equal strings; their smallest id is the answer.
5. Parts take the answers and cut the texts.

A task holds a part or a bucket, both of bounded size; a passage that a third of all documents share is one string
for each part. Only distinct strings meet, so copies never multiply.

Cases: a null text is empty; rows with a null id count as after all others, and lose bytes only to rows with an id;
rows with the same id do not take bytes from one another; texts shorter than ``WINDOW`` stay; cut bytes may split a
character, so ``kept`` is binary; an empty table gives an empty result; all other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from daymend.llm import textops as T
from daymend.llm.dealing import batch, deal, n_parts, pack, rows_of, unpack
from daymend.llm.frames import text_or_empty

WINDOW, GRAM = 50, 20
#: An anchor in more documents than this is dealt window by window.
HOT = 2000
LAST = np.iinfo(np.int64).max
MESSAGE = "bucket int, part int, kind int, body binary"


def anchors(text: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: first window, number of windows, row and hash of the anchor."""
    n_grams, width = len(text) - GRAM + 1, WINDOW - GRAM + 1
    empty = np.zeros(0, np.int64)
    if len(text) < WINDOW:
        return {"start": empty, "count": empty, "row": empty, "key": empty.view(np.uint64), "sums": None}
    sums = T.prefix_sums(text)
    hashes = T.window_hashes(sums, GRAM)
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n_grams, dtype=np.uint64)
    step = 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    where = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # anchor of the window that starts at each place
    inside = np.zeros(len(text) + 1, np.int64)
    whole = np.diff(offsets) >= WINDOW
    np.add.at(inside, offsets[:-1][whole], 1)
    np.add.at(inside, offsets[1:][whole] - WINDOW + 1, -1)
    valid = np.cumsum(inside)[: len(where)] > 0
    new = valid.copy()
    new[1:] &= (where[1:] != where[:-1]) | ~valid[:-1]
    start = np.flatnonzero(new)
    last = valid.copy()
    last[:-1] &= (where[1:] != where[:-1]) | ~valid[1:]
    row = np.searchsorted(offsets, start, "right") - 1
    return {"start": start, "count": np.flatnonzero(last) - start + 1, "row": row,
            "key": T.mix(hashes[where[start]] ^ np.uint64(0xA5A5A5A5A5A5A5A5)), "sums": sums}


def _blocks(table: pa.Table) -> Iterator[tuple[pa.Table, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, from, to, bytes, offsets, ids) block by block; a null id is the last of all."""
    for rows in rows_of(table):
        text, offsets = T.buffers(rows.column("text"))
        ids = rows.column("doc_id").cast(pa.int64()).combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False)
        for lo, hi in T.blocks(offsets):
            yield rows, lo, hi, text[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ids[lo:hi]


def _distinct_docs(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and in how many documents each is."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    return np.unique(keys[new], return_counts=True)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    for k, rows in zip(found.tolist(), np.split(order, first[1:]), strict=True) if len(order) else ():
        yield k, rows


def tell_anchors(buckets: int):
    """Hashes of a part's anchors with their numbers of documents, a message for each bucket."""

    def told(key: tuple, table: pa.Table) -> pa.Table:
        keys, docs = [], []
        for _, _, _, text, offsets, ids in _blocks(table):
            found = anchors(text, offsets)
            keys.append(found["key"])
            docs.append(ids[found["row"]])
        keys, n = _distinct_docs(np.concatenate(keys), np.concatenate(docs))
        return batch(MESSAGE, [
            (k, key[0].as_py(), 0, pack(high=(keys[rows] >> np.uint64(32)).astype(np.uint32), n=n[rows].astype(np.uint32)))
            for k, rows in _by_bucket(((keys & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64))])

    return told


def shared_anchors(table: pa.Table) -> pa.Table:
    """Answers which anchors of a bucket are in several documents, and which of them in very many."""
    told = [unpack(x) for x in table.column("body")]
    high, n = np.concatenate([x["high"] for x in told]), np.concatenate([x["n"] for x in told])
    keys, which = np.unique(high, return_inverse=True)
    total = np.bincount(which, n, minlength=len(keys))
    out, at = [], 0
    for part, x in zip(table.column("part").to_pylist(), told, strict=True):
        own = total[which[at : at + len(x["high"])]]
        at += len(x["high"])
        bucket = table.column("bucket")[0].as_py()
        out.append((bucket, part, 0, pack(high=x["high"][own > 1], hot=own[own > 1] > HOT)))
    return batch(MESSAGE, out)


def _known(table: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (bucket, high half) of the shared anchors of a part, and which are hot."""
    both, hot = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for bucket, body in zip(table.column("bucket").to_pylist(), table.column("body"), strict=True):
        x = unpack(body)
        both.append((np.uint64(bucket) << np.uint64(32)) | x["high"].astype(np.uint64))
        hot.append(x["hot"])
    both, hot = np.concatenate(both), np.concatenate(hot)
    order = np.argsort(both)
    return both[order], hot[order]


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == keys, at, -1)


def _strings(found: dict, buckets: int, hot_keys: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, windows, row, hash and bucket of the strings that stand for the kept anchors.

    The string of an anchor holds all its windows; for a hot one each window is a string by itself.
    """
    start, count, row, key = (found[x][kept] for x in ("start", "count", "row", "key"))
    bucket = (key & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
    hot = _lookup(hot_keys, key) >= 0
    if hot.any():
        single = T.ranges(start[hot], count[hot])
        row = np.concatenate([row[~hot], np.repeat(row[hot], count[hot])])
        start, count = np.concatenate([start[~hot], single]), np.concatenate([count[~hot], np.ones(len(single), np.int64)])
        bucket = bucket[~hot]
    hashes = T.range_hashes(found["sums"], start, start + count + WINDOW - 1)
    if hot.any():
        bucket = np.concatenate([bucket, (hashes[len(bucket) :] >> np.uint64(20)) % np.uint64(buckets)])
    return start, count, row, hashes, bucket.astype(np.int64)


def tell_strings(buckets: int):
    """Distinct strings around a part's shared anchors, each with the smallest id that has it."""

    def told(key: tuple, docs: pa.Table, shared: pa.Table) -> pa.Table:
        known, is_hot = _known(shared, buckets)
        parts, bytes_of, hot_found = [], [], [np.zeros(0, np.uint64)]
        for _, _, _, text, offsets, ids in _blocks(docs):
            found = anchors(text, offsets)
            if not len(found["key"]):
                continue
            bucket = (found["key"] & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
            at = _lookup(known, (bucket << np.uint64(32)) | (found["key"] >> np.uint64(32)))
            kept = np.flatnonzero(at >= 0)
            hot_keys = np.unique(found["key"][kept][is_hot[at[kept]]])
            hot_found.append(hot_keys)
            start, count, row, hashes, bucket = _strings(found, buckets, hot_keys, kept)
            doc = ids[row]
            order = np.lexsort((doc, hashes))
            new = np.ones(len(order), bool)
            new[1:] = hashes[order][1:] != hashes[order][:-1]
            first = order[new]
            ends = np.append(np.flatnonzero(new)[1:], len(order)) - 1
            many = doc[order[ends]] != doc[first] if len(order) else np.zeros(0, bool)
            length = count[first] + WINDOW - 1
            parts.append((hashes[first], bucket[first], count[first], doc[first], many))
            bytes_of.append((text[T.ranges(start[first], length)], length))
        if not parts:
            return batch(MESSAGE, [])
        hashes, bucket, count, doc, many = (np.concatenate(x) for x in zip(*parts, strict=True))
        text = np.concatenate([x[0] for x in bytes_of])
        length = np.concatenate([x[1] for x in bytes_of])
        first = np.concatenate([[0], np.cumsum(length)[:-1]])
        # the same string in several blocks of the part
        order = np.lexsort((doc, hashes))
        new = np.ones(len(order), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        group = np.cumsum(new) - 1
        several = np.bincount(group, many[order] | (doc[order] != doc[order[new]][group])) > 0
        pick = order[new]
        out = []
        for k, rows in _by_bucket(bucket[pick]):
            one = pick[rows]
            out.append((k, key[0].as_py(), 1, pack(
                hash=hashes[one], count=count[one].astype(np.uint8), doc=doc[one], many=several[rows],
                text=text[T.ranges(first[one], length[one])])))
        out.append((key[0].as_py() % buckets, key[0].as_py(), 2, pack(hot=np.unique(np.concatenate(hot_found)))))
        return batch(MESSAGE, out)

    return told


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that compares as they do."""
    return np.ndarray(len(text) - 7, ">u8", np.ascontiguousarray(text), strides=1)


def _by_words(view: np.ndarray, places: np.ndarray, count: int) -> np.ndarray:
    """The order of the texts of ``count`` words at the places: by the first word, those that tie by all others."""
    first = view[places].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    same = first[order[1:]] == first[order[:-1]]
    tied = np.append(same, False) | np.insert(same, 0, False) if len(order) else same
    rows = np.flatnonzero(tied)
    if len(rows):
        own = order[rows]
        group = np.cumsum(~np.insert(same, 0, False)[rows])
        rest = [view[places[own] + 8 * k].astype(np.uint64) for k in range(count - 1, 0, -1)]
        order[rows] = own[np.lexsort((*rest, group))]
    return order


def two_stage_order(text: np.ndarray, smaller: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted suffixes in order of their first bytes.

    ``smaller`` marks suffixes that are smaller than their successors. Those are sorted; every other one follows
    from its successor: scanning the order so far, the suffix one place to the left goes to the end of the list of
    its first letter. A suffix that is wanted and not smaller must have a wanted successor.
    """
    direct = np.flatnonzero(wanted & smaller)
    direct = direct[_by_words(_words(text), direct, 7)]
    letter = text[direct]
    cuts = np.searchsorted(letter, np.arange(257))
    larger = wanted & ~smaller
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        level = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        induced[c] = []
        own = [level]
        while len(level):  # runs of the letter c
            left = level[level > 0] - 1
            level = left[larger[left] & (text[left] == c)]
            own.append(level)
        bucket = np.concatenate([*own, direct[cuts[c] : cuts[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        left = bucket[bucket > 0] - 1
        left = left[larger[left] & (text[left] > c)]
        letters = text[left]
        order = np.argsort(letters, kind="stable")
        left, letters = left[order], letters[order]
        found, first = np.unique(letters, return_index=True)
        for d, part in zip(found.tolist(), np.split(left, first[1:]), strict=True) if len(left) else ():
            induced[d].append(part)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of what each suffix shares with the one before it in the order, ``depth`` at most."""
    view, out = _words(text), np.full(len(order), depth)
    out[:1] = 0
    rows = np.arange(1, len(order))  # those that share all words so far
    for k in range(0, depth, 8):
        differ = view[order[rows] + k].astype(np.uint64) ^ view[order[rows - 1] + k].astype(np.uint64)
        here = differ != 0
        equal = np.full(int(here.sum()), k)
        for bits in range(8, 64, 8):
            equal += differ[here] < np.uint64(1 << bits)
        out[rows[here]] = np.minimum(equal, depth)
        rows = rows[~here]
    return out


def window_owners(text: np.ndarray, count: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each window of the strings, one string after the other, the smallest id of any equal window."""
    length = count + WINDOW - 1
    first = np.concatenate([[0], np.cumsum(length)])
    moved = first[:-1] + 56 * np.arange(len(count))  # 56 zero bytes after each string
    wide = np.zeros(int(first[-1]) + 56 * len(count) + 8, np.uint8)
    wide[T.ranges(moved, length)] = text
    # a suffix is smaller than its successor when the first byte that differs from its own is larger
    change = np.append(np.flatnonzero(wide[1:] != wide[:-1]), len(wide) - 1).astype(np.int32)
    grows = np.append(wide[change[:-1]] < wide[change[:-1] + 1], False)
    smaller = np.repeat(grows, np.diff(change, prepend=-1))
    smaller[moved + length] = True  # where a string ends
    marks = np.flatnonzero(smaller)
    until = marks[np.searchsorted(marks, moved + count - 1)]
    wanted = np.zeros(len(wide), bool)
    wanted[T.ranges(moved, until - moved + 1)] = True
    order = two_stage_order(wide, smaller, wanted)
    string = np.searchsorted(moved, order, "right") - 1
    place = order - moved[string]
    window = place < count[string]
    order, string, place = order[window], string[window], place[window]
    group = np.cumsum(common_prefixes(wide, order, WINDOW) < WINDOW) - 1 if len(order) else order
    least = np.full(int(group[-1]) + 1 if len(group) else 0, LAST)
    np.minimum.at(least, group, doc[string])
    owners = np.empty(int(count.sum()), np.int64)
    owners[(np.cumsum(count) - count)[string] + place] = least[group]
    return owners


def answer_strings(table: pa.Table) -> pa.Table:
    """Sorts the windows of a bucket and answers each part with the owners of its strings' windows."""
    out, told, parts = [], [], []
    for bucket, part, kind, body in zip(*(table.column(x).to_pylist() for x in ("bucket", "part", "kind", "body")), strict=True):
        if kind == 2:
            out.append((bucket, part, 2, body))
        else:
            told.append(unpack(body))
            parts.append(part)
    if not told:
        return batch(MESSAGE, out)
    hashes, count, doc = (np.concatenate([x[k] for x in told]) for k in ("hash", "count", "doc"))
    count = count.astype(np.int64)
    text = np.concatenate([x["text"] for x in told])
    first = np.cumsum(count + WINDOW - 1) - (count + WINDOW - 1)
    order = np.lexsort((doc, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    pick = order[new]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    owners = window_owners(text[T.ranges(first[pick], count[pick] + WINDOW - 1)], count[pick], doc[pick])
    at = np.cumsum(count[pick]) - count[pick]
    begin = 0
    bucket = table.column("bucket")[0].as_py()
    for part, x in zip(parts, told, strict=True):
        own = which[begin : begin + len(x["hash"])]
        n = count[begin : begin + len(x["hash"])]
        begin += len(x["hash"])
        values = owners[T.ranges(at[own], n)]
        string = np.repeat(np.arange(len(own)), n)
        use = x["many"] | (np.bincount(string, values < x["doc"][string], minlength=len(own)) > 0)
        if use.any():
            out.append((bucket, part, 1, pack(hash=x["hash"][use], count=n[use].astype(np.uint8), owner=values[use[string]])))
    return batch(MESSAGE, out)


def whole_characters(removed: np.ndarray, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``removed`` with the bytes that a cut has left of split characters."""
    begins = (text & 0xC0) != 0x80
    begins[offsets[:-1][offsets[:-1] < len(text)]] = True
    character = np.cumsum(begins) - 1
    return (np.bincount(character, removed) > 0)[character] if len(text) else removed


def cut_texts(buckets: int, names: list[str], whole: bool = False):
    """Cuts a part's documents by the answers of the buckets; ``whole`` cuts no character in two."""

    def cut(docs: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes, counts, owners, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(0, np.uint64)
        for kind, body in zip(answers.column("kind").to_pylist(), answers.column("body"), strict=True):
            x = unpack(body)
            if kind == 2:
                hot = x["hot"]
            else:
                hashes.append(x["hash"])
                counts.append(x["count"].astype(np.int64))
                owners.append(x["owner"])
        hashes, counts, owners = np.concatenate(hashes), np.concatenate(counts), np.concatenate(owners)
        first = np.cumsum(counts) - counts
        order = np.argsort(hashes)
        hashes, counts, first = hashes[order], counts[order], first[order]
        for rows, lo, hi, text, offsets, ids in _blocks(docs):
            removed = np.zeros(len(text), bool)
            found = anchors(text, offsets)
            if len(found["key"]) and len(hashes):
                start, count, row, key, _ = _strings(found, buckets, hot, np.arange(len(found["key"])))
                at = _lookup(hashes, key)
                hit = np.flatnonzero(at >= 0)
                hit = hit[counts[at[hit]] == count[hit]]
                owner = owners[T.ranges(first[at[hit]], count[hit])]
                window = T.ranges(start[hit], count[hit])
                window = window[owner < np.repeat(ids[row[hit]], count[hit])]
                begun = np.cumsum(np.bincount(window, minlength=len(text)))
                removed = begun > 0
                removed[WINDOW:] = begun[WINDOW:] > begun[:-WINDOW]
            spans = removed.copy()
            spans[1:] &= ~removed[:-1]
            inner = offsets[1:-1]
            inner = inner[(inner > 0) & (inner < len(text))]
            spans[inner] = removed[inner]
            sums = np.concatenate([[0], np.cumsum(removed)])
            span_sums = np.concatenate([[0], np.cumsum(spans)])
            gone = whole_characters(removed, text, offsets) if whole else removed
            raw = text[~gone].tobytes()
            ends = (offsets - np.concatenate([[0], np.cumsum(gone)])[offsets]).tolist()
            kept = [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            part = rows.slice(lo, hi - lo).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [part.column(x).combine_chunks() if x != "text" else pa.array(kept, pa.binary()) for x in names]
                + [pa.array(np.diff(offsets)), pa.array(np.diff(sums[offsets]).astype(np.int64)),
                   pa.array(np.diff(span_sums[offsets]).astype(np.int64))],
                [x if x != "text" else "kept" for x in names] + ["n_bytes", "n_removed", "n_spans"])

    def table_of(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = pa.Table.from_batches(list(cut(docs, answers)))
        pa.default_memory_pool().release_unused()
        return out

    return table_of


def dedup_passages(docs: DataFrame, whole: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``text`` replaced by ``kept`` (binary), and n_bytes, n_removed, n_spans.

    With ``whole``, what is left of a character that a cut has split is not in ``kept``; the numbers do not count it.
    """
    names = docs.columns
    parts = n_parts(docs)
    buckets = 2 * parts
    dealt = deal(docs, parts)
    by_part = lambda frame: frame.groupBy("part")
    shared = (by_part(dealt).applyInArrow(tell_anchors(buckets), MESSAGE)
              .groupBy("bucket").applyInArrow(shared_anchors, MESSAGE))
    answers = (by_part(dealt).cogroup(by_part(shared)).applyInArrow(tell_strings(buckets), MESSAGE)
               .groupBy("bucket").applyInArrow(answer_strings, MESSAGE))
    fields = [f if f.name != "text" else S.StructField("kept", S.BinaryType()) for f in docs.schema.fields]
    schema = S.StructType([*fields, *(S.StructField(x, S.LongType()) for x in ("n_bytes", "n_removed", "n_spans"))])
    return by_part(dealt).cogroup(by_part(answers)).applyInArrow(cut_texts(buckets, names, whole), schema)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated passages; what is left of a character that a cut has split goes too."""
    others = [x for x in docs.columns if x not in ("doc_id", "text")]
    out = dedup_passages(docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("rest")), whole=True)
    text = F.col("kept").cast("string")
    return out.select(*(text.alias(x) if x == "text" else F.col(x) if x == "doc_id" else F.col("rest")[x].alias(x)
                        for x in docs.columns))


def digests(docs: DataFrame) -> DataFrame:
    return dedup_passages(docs.select("doc_id", text_or_empty().alias("text"))).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
