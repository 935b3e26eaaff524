"""Passages of benchmark items in documents, by a prefix-filtered set join.

A window is ``span`` consecutive words of an item (all words of a shorter one).  A document holds a
window only if it holds all shingles of it, so it is enough to look for one: the shingles of a
window are ordered by rarity in the documents, and the rarest is its prefix.  A document's shingle
that equals a prefix proposes one aligned place for the window; the place must lie inside the
document (length and positional bounds) and its words must be the window's words, one by one.

The items are a query set and may be many: their windows are written as a table, and blocks of at
most ``BLOCK`` windows are broadcast in turn, each against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.frames import unused
from tidemark.workspace import durable

_U = np.uint64
SPAN = 13
K = 5
#: Windows, counted once for each item that has them, in one broadcast; about 200 bytes each.
BLOCK = 200_000


def _windows(k: int, span: int):
    """(hash of the window, its words, shingles) of each distinct window of an item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                w = words.words(piece.column("text"), words.ALNUM)
                hashes = w.hashes()
                rows = {"item": [], "window": [], "shingles": []}
                for i, item in enumerate(piece.column("item").to_pylist()):
                    lo, hi = int(w.first[i]), int(w.first[i + 1])
                    n = min(span, hi - lo)
                    kk = min(k, n)
                    for a in range(lo, hi - n + 1) if n else ():
                        rows["item"].append(item)
                        rows["window"].append(b" ".join(w.word(j) for j in range(a, a + n)))
                        rows["shingles"].append([_join(hashes[b:b + kk])
                                                 for b in range(a, a + n - kk + 1)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["item"], pa.string()), pa.array(rows["window"], pa.binary()),
                     pa.array(rows["shingles"], pa.list_(pa.int64()))],
                    ["item", "window", "shingles"])
    return run


def _join(hashes: np.ndarray) -> int:
    s = np.sum(hashes * words._PLACE[:len(hashes)], keepdims=True, dtype=np.uint64)
    return int(words.mix(s + _U(len(hashes))).view(np.int64)[0])


def _runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """The shingle hashes of ``length`` words at every place where so many follow."""
    m = len(hashes) - length + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = hashes[:m] * words._PLACE[0]
    for j in range(1, length):
        h = h + hashes[j:j + m] * words._PLACE[j]
    return words.mix(h + _U(length))


def _matches(listed: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places in ``h`` whose value is in the sorted ``listed``."""
    if not len(listed) or not len(h):
        return np.zeros(0, np.int64)
    # a bitmap of hashes first: most shingles are in no item
    near = np.flatnonzero(listed_bits(listed)[(h >> _U(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(listed, h[near]), len(listed) - 1)
    return near[listed[at] == h[near]]


_BITS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def listed_bits(listed: np.ndarray) -> np.ndarray:
    """Which leading 20 bits occur in ``listed``; kept, with the array itself, for the last one."""
    if id(listed) not in _BITS:
        _BITS.clear()
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(listed >> _U(44)).astype(np.int64)] = True
        _BITS[id(listed)] = listed, bits
    return _BITS[id(listed)][1]


def _rarity(listed, lengths, text_col: str):
    """How often the documents hold each listed shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = listed.value
        counts = np.zeros(len(values), dtype=np.int64)
        for batch in batches:
            for piece in words.pieces(batch, text_col):
                hashes = words.words(piece.column(text_col), words.ALNUM).hashes()
                for n in lengths:
                    h = _runs(hashes, n)
                    h = h[_matches(values, h)]
                    counts += np.bincount(np.searchsorted(values, h), minlength=len(values))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(values[some].view(np.int64)),
                                          pa.array(counts[some])], ["h", "n"])
    return run


_FOUND = "struct<n_words: long, starts: array<long>, ends: array<long>, items: array<string>>"


def _search(prefixes, text_col: str, out_col: str):
    """Adds the occurrences of a block's windows to ``out_col`` of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, cut, offset, length, window, lengths, texts, items = prefixes.value
        for batch in batches:
            for piece in words.pieces(batch, text_col):
                w = words.words(piece.column(text_col), words.ALNUM)
                hashes = w.hashes()
                found: dict[int, set] = {}
                for n in lengths:
                    h = _runs(hashes, n)
                    for at in _matches(keys, h).tolist():
                        key = int(np.searchsorted(keys, h[at]))
                        for c in range(cut[key], cut[key + 1]):
                            a, size = at - int(offset[c]), int(length[c])
                            if a < 0 or a + size > len(hashes):
                                continue
                            doc = int(np.searchsorted(w.first, a, "right")) - 1
                            if a + size > w.first[doc + 1]:
                                continue
                            if b" ".join(w.word(j) for j in range(a, a + size)) == texts[window[c]]:
                                begin = a - int(w.first[doc])
                                found.setdefault(doc, set()).add(
                                    (begin, begin + size, int(window[c])))
                hits = [sorted(found.get(i, ())) for i in range(piece.num_rows)]
                starts, ends = ([[x[j] for x in h] for h in hits] for j in (0, 1))
                names = [{i for x in h for i in items[x[2]]} for h in hits]
                for i, old in enumerate(piece.column(out_col).to_pylist()):
                    if old is not None:
                        starts[i] += old["starts"]
                        ends[i] += old["ends"]
                        names[i].update(old["items"])
                longs = pa.list_(pa.int64())
                out = pa.StructArray.from_arrays(
                    [pa.array(w.counts(), pa.int64()), pa.array(starts, longs),
                     pa.array(ends, longs), pa.array(map(sorted, names), pa.list_(pa.string()))],
                    ["n_words", "starts", "ends", "items"])
                yield pa.RecordBatch.from_arrays(
                    [out if c == out_col else piece.column(c) for c in piece.schema.names],
                    piece.schema.names)
    return run


def _block(rows: list, counts: dict[int, int]):
    """The broadcast form of some windows: each is kept under its rarest shingle."""
    entries = []
    for i, r in enumerate(rows):
        offset, least = min(enumerate(r["shingles"]), key=lambda x: (counts.get(x[1], 0), x[1]))
        entries.append((least & (1 << 64) - 1, offset, i))
    entries.sort()
    key = np.array([e[0] for e in entries], np.uint64)
    keys, first = np.unique(key, return_index=True)
    texts = [bytes(r["window"]) for r in rows]
    sizes = [t.count(b" ") + 1 for t in texts]
    lengths = sorted({min(K, n) for n in sizes})
    return (keys, np.append(first, len(key)), np.array([e[1] for e in entries]),
            np.array([sizes[e[2]] for e in entries]), np.array([e[2] for e in entries]), lengths,
            texts, [r["items"] for r in rows])


def occurrences(docs: DataFrame, items: DataFrame, out_col: str, text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text",
                span: int = SPAN) -> DataFrame:
    """The join itself: every row of ``docs`` as it is, with the new column ``out_col``.

    It holds ``n_words``, the word spans ``starts, ends`` of each occurrence of a window, and the
    distinct ``items`` whose windows occur.  A null or wordless text has no words; an item without
    words has no window; a null item id counts as the empty string.
    """
    spark = docs.sparkSession
    pool = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                        F.col(item_text_col).alias("text"))
    windows = durable(
        pool.mapInArrow(_windows(K, span), "item string, window binary, shingles array<long>")
        .groupBy("window").agg(F.first("shingles").alias("shingles"),
                               F.collect_set("item").alias("items")), "windows")
    total = windows.agg(F.sum(F.size("items"))).first()[0] or 0
    parts = -(-total // BLOCK) or 1
    found = docs.withColumn(out_col, F.lit(None).cast(_FOUND))
    for p in range(parts):
        some = windows.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == p).collect()
        listed = np.unique(np.array([x & (1 << 64) - 1 for r in some for x in r["shingles"]],
                                    np.uint64))
        lengths = sorted({min(K, bytes(r["window"]).count(b" ") + 1) for r in some})
        counts = {}
        if some:
            shared = spark.sparkContext.broadcast(listed)
            counts = {r["h"]: r["n"] for r in durable(
                docs.select(text_col).mapInArrow(_rarity(shared, lengths, text_col),
                                                 "h long, n long")
                .groupBy("h").agg(F.sum("n").alias("n")), "rarity").collect()}
        block = spark.sparkContext.broadcast(_block(some, counts))
        found = found.mapInArrow(_search(block, text_col, out_col), found.schema)
    return found


def _n_hit(found: str) -> Column:
    spans = F.array_sort(F.arrays_zip(F.col(f"{found}.starts"), F.col(f"{found}.ends")))
    zero = F.lit(0).cast("long")
    return F.aggregate(
        spans, F.struct(zero.alias("n"), zero.alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["ends"] - F.greatest(x["starts"], acc["to"]), zero))
            .alias("n"), F.greatest(acc["to"], x["ends"]).alias("to")))["n"]


def _contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **columns) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``.

    A word inside any occurrence is hit; a document is contaminated if at least one word in twenty
    is hit, and at least one.
    """
    text_col = columns.get("text_col", "text")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (occurrences(narrow, items, "found", **columns | {"text_col": "text"})
            .select("doc_id", F.col("found.n_words").alias("n_words"),
                    _n_hit("found").alias("n_hit"),
                    F.size("found.items").cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.array_sort("found.items"), ","), 256)
                    .alias("items_sha256"))
            .withColumn("contaminated", _contaminated(F.col("n_hit"), F.col("n_words"))))


def clean(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    out = unused(docs, "found")
    return (occurrences(docs, items, out, **columns)
            .filter(~_contaminated(_n_hit(out), F.col(f"{out}.n_words"))).select(*docs.columns))
