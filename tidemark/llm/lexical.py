"""Ranked lexical search by hashed max-sketches.

A document's sketch has ``1 << BITS`` coordinates.  A term belongs to one coordinate by its hash; the
coordinate keeps the greatest occurrence count among the document's terms that share it.  The impact
of a term grows with its count for a given document length, so the impact of the coordinate bounds
the impact of each of its terms, and the sum over a query's coordinates bounds the document's score.
Sketches need no statistics of the corpus: adding documents leaves the others as they are.

Search goes over the sketches in batches for all queries at once.  The best documents by bound are
scored exactly; the k-th exact score is a threshold, and in a second round every document whose
bound reaches it is scored exactly as well.  No document with a greater or equal score is missed.

Scores are integers.  With N documents that have a term, L terms in them, n terms in a document,
df documents with a term and tf its count in the document:

    w = floor(1000 ln((2N + 2) / (2 df + 1)))      m = 10 + 90 n N div L
    score = sum over the query's terms, once each, of w (10^9 tf div (1000 tf + 8 m))
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.frames import small_batches
from tidemark.operators.joins import lookup_join
from tidemark.operators.ranking import top_per_group
from tidemark.workspace import durable

#: 16,384 coordinates: a document of 200 terms shares few of them with a query by chance.
BITS = 14
#: Terms of all queries that one round over the sketches takes; more queries take more rounds.
ROUND_TERMS = 200_000
#: The first round scores this many times k documents a query, to find a high threshold.
AHEAD = 4
_FULL = 255
_SPAN = 1000
_SKETCH = "doc_id long, n long, places binary, counts binary"


@dataclass
class Index:
    """Sketches (doc_id, n, places, counts) of the documents with a term, N and L."""

    sketches: DataFrame
    documents: int
    terms: int


@dataclass
class _Queries:
    """A round of queries: sorted term hashes, and the terms of each query as places in them."""

    vocabulary: np.ndarray
    terms: list[np.ndarray]
    weights: np.ndarray | None = None


def _counts(column: pa.Array) -> tuple[words.Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts, and (text, 44 bits of a term's hash, count), in this order.

    Two terms of a text with one such hash count as one; that can only raise a bound.
    """
    w = words.words(column, words.ALNUM)
    h = w.hashes() >> np.uint64(20)
    key, count = np.unique(w.text_of().astype(np.uint64) << np.uint64(44) | h, return_counts=True)
    return w, (key >> np.uint64(44)).astype(np.int64), key & np.uint64((1 << 44) - 1), count


def sketch(column: pa.Array, bits: int = BITS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of terms, places, greatest counts) of each text; counts end at 255, which means more."""
    # text numbers take 20 bits of a key
    assert len(column) < 1 << 20
    w, text, term, count = _counts(column)
    place = (term >> np.uint64(44 - bits)).astype(np.uint16)
    first = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (place[1:] != place[:-1])]
                           if len(text) else np.zeros(0, bool))
    top = np.minimum(np.maximum.reduceat(count, first), _FULL) if len(first) else count
    text, place, top = text[first], place[first], top.astype(np.uint8)
    cut = np.searchsorted(text, np.arange(w.n + 1))
    for i, n in enumerate(w.counts().tolist()):
        yield n, place[cut[i]:cut[i + 1]], top[cut[i]:cut[i + 1]]


def build(docs: DataFrame, bits: int = BITS) -> Index:
    """The index of all rows of ``docs`` that have a term.

    Texts are read whole, very long ones alone; a null or empty text has no term.  A row repeated is
    indexed twice.  Only doc_id and text are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text"):
                rows = [(i, n, p.tobytes(), c.tobytes()) for i, (n, p, c) in zip(
                    part.column("doc_id").to_pylist(), sketch(part.column("text"), bits)) if n]
                ids, sizes, places, counts = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(places, pa.binary()), pa.array(counts, pa.binary())],
                    ["doc_id", "n", "places", "counts"])

    with small_batches(docs.sparkSession):
        sketches = durable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                           .mapInArrow(run, _SKETCH), "sketches")
    total = sketches.agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    return Index(sketches, total["N"], total["L"] or 0)


def _impact(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * count // (1000 * count + 8 * m)


def _length(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    return 10 + 90 * n * documents // terms


def _rounds(items: DataFrame, most: int) -> Iterator[tuple[list, _Queries]]:
    """The items' ids and queries, as many at once as have ``most`` terms; items come one partition
    at a time, so the driver never holds more than a round and a partition of them."""
    ids, found, size = [], [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        w = words.words(pa.array([row["text"]], pa.string()), words.ALNUM)
        terms = np.unique(w.hashes())
        if ids and size + len(terms) > most:
            yield ids, _joined(found)
            ids, found, size = [], [], 0
        ids.append(row["item_id"])
        found.append(terms)
        size += len(terms)
    if ids:
        yield ids, _joined(found)


def _joined(found: list[np.ndarray]) -> _Queries:
    vocabulary = np.unique(np.concatenate(found))
    return _Queries(vocabulary, [np.searchsorted(vocabulary, t) for t in found])


def _hits(column: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the vocabulary) of each occurrence of its terms, and the texts' term counts."""
    w = words.words(column, words.ALNUM)
    h = w.hashes()
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[at] == h)
    return w.text_of()[hit], at[hit], w.counts()


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each term of a round of queries occurs; counted in tasks, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in words.pieces(batch, "text"):
                text, at, _ = _hits(part.column("text"), vocabulary)
                seen = np.unique(text * len(vocabulary) + at)
                total += np.bincount(seen % len(vocabulary), minlength=len(vocabulary))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "df"])

    found = np.zeros(len(vocabulary), np.int64)
    if len(vocabulary):
        with small_batches(docs.sparkSession):
            # one row a term of the round
            for row in (docs.select("text").mapInArrow(run, "at long, df long").groupBy("at")
                        .agg(F.sum("df").alias("df")).collect()):
                found[row["at"]] = row["df"]
    return found


def _bounds(index: Index, queries: _Queries, bits: int, k: int,
            floors: np.ndarray | None) -> DataFrame:
    """(q, doc_id, bound): without ``floors`` the k greatest of each task, else all at or above them."""
    place = (queries.vocabulary >> np.uint64(64 - bits)).astype(np.int64)
    q = np.repeat(np.arange(len(queries.terms)), [len(t) for t in queries.terms])
    term = np.concatenate(queries.terms) if queries.terms else np.zeros(0, np.int64)
    # of each coordinate, the queries with a term there and the sum of those terms' weights
    pair, inverse = np.unique(place[term] * len(queries.terms) + q, return_inverse=True)
    weight = np.bincount(inverse, queries.weights[term], len(pair))
    whose = pair % max(1, len(queries.terms))
    start = np.searchsorted(pair // max(1, len(queries.terms)), np.arange((1 << bits) + 1))
    wide, documents, terms = len(queries.terms), index.documents, index.terms

    def bounds(part: pa.RecordBatch) -> np.ndarray:
        flat, at = _flat(part.column("places"), np.uint16)
        counts, _ = _flat(part.column("counts"), np.uint8)
        doc = np.repeat(np.arange(part.num_rows), np.diff(at))
        keep = np.flatnonzero(start[flat + 1] > start[flat])
        flat, counts, doc = flat[keep], counts[keep].astype(np.int64), doc[keep]
        m = _length(part.column("n").to_numpy(), documents, terms)[doc]
        impact = np.where(counts == _FULL, 1_000_000, _impact(counts, m))
        many = start[flat + 1] - start[flat]
        entry = np.repeat(np.arange(len(flat)), many)
        inside = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many) + start[flat][entry]
        return np.bincount(doc[entry] * wide + whose[inside], weight[inside] * impact[entry],
                           part.num_rows * wide).reshape(-1, wide)

    def rows(which: np.ndarray, ids: np.ndarray, null: np.ndarray, bound: np.ndarray):
        return pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int32()), pa.array(ids, pa.int64(), mask=null), pa.array(bound)],
            ["q", "doc_id", "bound"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros((0, wide)), np.zeros((0, wide), np.int64), np.zeros((0, wide), bool))
        for batch in batches:
            for a in range(0, batch.num_rows, _SPAN):
                part = batch.slice(a, _SPAN)
                found = bounds(part)
                ids = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                null = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                if floors is not None:
                    d, which = np.nonzero(found >= floors)
                    yield rows(which, ids[d], null[d], found[d, which])
                    continue
                shape = found.shape
                joined = [np.concatenate(x) for x in zip(best, (
                    found, np.broadcast_to(ids[:, None], shape), np.broadcast_to(null[:, None], shape)))]
                top = np.argsort(-joined[0], axis=0, kind="stable")[:k]
                best = tuple(np.take_along_axis(x, top, 0) for x in joined)
        if floors is None:
            d, which = np.nonzero(best[0] > 0)
            yield rows(which, best[1][d, which], best[2][d, which], best[0][d, which])

    return index.sketches.mapInArrow(run, "q int, doc_id long, bound double")


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """A binary column as one array of numbers and the offsets of its rows in it."""
    _, offsets, data = column.buffers()
    wide = 8 if pa.types.is_large_binary(column.type) else 4
    at = np.frombuffer(offsets, np.int64 if wide == 8 else np.int32, len(column) + 1,
                       column.offset * wide).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    size = np.dtype(kind).itemsize
    return raw.copy().view(kind).astype(np.int64), (at - at[0]) // size


def _exact(docs: DataFrame, index: Index, queries: _Queries, wanted: DataFrame) -> DataFrame:
    """(q, doc_id, score) of the pairs ``wanted`` (q, doc_id), for every row of such an id."""
    asked = durable(wanted.groupBy("doc_id").agg(F.collect_set("q").alias("qs")), "asked")
    texts = lookup_join(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), asked,
                        ["doc_id"])
    vocabulary, documents, terms = queries.vocabulary, index.documents, index.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text"):
                text, at, sizes = _hits(part.column("text"), vocabulary)
                m = _length(sizes, documents, terms)
                cut = np.searchsorted(text, np.arange(part.num_rows + 1))
                which, ids, scores = [], [], []
                for i, (key, asked) in enumerate(zip(part.column("doc_id").to_pylist(),
                                                     part.column("qs").to_pylist())):
                    here, tf = np.unique(at[cut[i]:cut[i + 1]], return_counts=True)
                    gain = queries.weights[here].astype(np.int64) * _impact(tf, m[i])
                    for q in asked:
                        score = int(gain[np.isin(here, queries.terms[q])].sum())
                        if score > 0:
                            which.append(q)
                            ids.append(key)
                            scores.append(score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which, pa.int32()), pa.array(ids, pa.int64()),
                     pa.array(scores, pa.int64())], ["q", "doc_id", "score"])

    return texts.mapInArrow(run, "q int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, index: Index | None = None,
           bits: int = BITS, most: int = ROUND_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of each row of ``items``.

    Documents with score 0 are not listed; equal scores rank by ascending doc_id (null first).  A
    document row repeated is ranked twice; an item row repeated is answered twice.  Null and empty
    texts have no terms, neither as documents nor as items; empty tables give no rows.  Very long
    texts are read whole.  Queries are taken in rounds of bounded size.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], f"item_id {dict(items.dtypes)['item_id']}, rank int, "
                                    "doc_id long, score long")
    index = index or build(docs, bits)
    if not index.documents:
        return out
    for ids, queries in _rounds(items, most):
        df = document_frequencies(docs, queries.vocabulary)
        queries.weights = np.array([math.floor(1000 * math.log(
            (2 * index.documents + 2) / (2 * int(d) + 1))) for d in df], np.float64)
        names = spark.createDataFrame(list(enumerate(ids)),
                                      f"q int, item_id {dict(items.dtypes)['item_id']}")
        best = [F.desc("score"), F.asc("doc_id")]
        with small_batches(spark):
            ahead = top_per_group(_bounds(index, queries, bits, AHEAD * k, None), ["q"],
                                  [F.desc("bound"), F.asc("doc_id")], AHEAD * k)
            first = top_per_group(_exact(docs, index, queries, durable(
                ahead.select("q", "doc_id"), "ahead")), ["q"], best, k)
            floors = np.ones(len(ids))
            # one row a query of the round
            for row in (first.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("s"))
                        .filter(F.col("n") >= k).collect()):
                floors[row["q"]] = row["s"]
            reached = durable(_bounds(index, queries, bits, k, floors).select("q", "doc_id"),
                              "reached")
            found = durable(top_per_group(_exact(docs, index, queries, reached), ["q"], best, k),
                            "found")
        out = out.unionByName(found.join(F.broadcast(names), "q")
                              .select("item_id", "rank", "doc_id", "score"))
    return out
