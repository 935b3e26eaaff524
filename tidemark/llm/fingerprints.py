"""Threshold-scaled document sketches.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so it grows with its
document: the sketches of a page and of a book can be compared, and a shingle kept from one is
kept from the other if it is there.  The union of two sketches, thinned by the same rule, is the
sketch of the joined documents.  So that short documents can be compared too, the ``floor``
smallest hashes are kept whatever their size; below that many shingles a sketch is the whole set.

Estimates use only hashes below the point to which both sketches are complete.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.frames import block_of, buckets_for, key_edges

_U = np.uint64
#: One shingle hash in this many is kept.
SCALE = 8
#: The smallest hashes that are kept in any case.
FLOOR = 16


def sketch(h: np.ndarray, scale: int = SCALE, floor: int = FLOOR) -> np.ndarray:
    """The kept ones of the sorted distinct hashes ``h``."""
    below = int(np.searchsorted(h, _U((1 << 64) // scale)))
    return h[:max(below, min(floor, len(h)))]


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE, floor: int = FLOOR) -> np.ndarray:
    """The sketch of the two documents together."""
    return sketch(np.union1d(a, b), scale, floor)


def _complete_to(a: np.ndarray, scale: int, floor: int) -> int:
    """All hashes of the document below this value are in its sketch."""
    if len(a) < floor:
        return 1 << 64
    return max((1 << 64) // scale, int(a[-1]) + 1)


def compare(a: np.ndarray, b: np.ndarray, scale: int = SCALE,
            floor: int = FLOOR) -> tuple[float, float, float]:
    """Estimated Jaccard similarity, part of ``a`` in ``b`` and part of ``b`` in ``a``.

    Two empty sketches are equal (all 1); an empty one and another share nothing (all 0).
    """
    to = min(_complete_to(a, scale, floor), _complete_to(b, scale, floor))
    if to < 1 << 64:
        a, b = (x[:int(np.searchsorted(x, _U(to)))] for x in (a, b))
    if not len(a) and not len(b):
        return 1.0, 1.0, 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return (both / (len(a) + len(b) - both), both / len(a) if len(a) else 0.0,
            both / len(b) if len(b) else 0.0)


def as_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                k: int = 5, scale: int = SCALE, floor: int = FLOOR) -> DataFrame:
    """(id_col, sketch) of every row of ``docs``, the sketch as text for storing and joining.

    A null text is the empty text, whose sketch is the empty string.  Rows are never dropped.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, text_col):
                found = [as_text(sketch(h, scale, floor))
                         for h in words.shingle_sets(piece.column(text_col), k)]
                yield pa.RecordBatch.from_arrays([piece.column(id_col), pa.array(found)],
                                                 ["id", "sketch"])
    kind = dict(docs.dtypes)[id_col]
    return (docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, sketch string")
            .withColumnRenamed("id", id_col))


_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double, "
           "contained_in_edited double, edited_in_document double")
_SPAN = 256


def _neighbours(rows: Iterator[dict]) -> Iterator[tuple[int | None, str, str]]:
    """(id, text, next text) of a block's own rows, in their order."""
    before = None
    for row in rows:
        text = row["text"] or ""
        if before is not None:
            yield before[0], before[1], text
        before = (row["id"], text) if row["own"] else None


def edited_against_next(docs: DataFrame, k: int = 5, scale: int = SCALE,
                        floor: int = FLOOR) -> DataFrame:
    """Fingerprints of each document, of its edited text and of the next document, compared.

    Next is by descending id (nulls last, equal ids by text), after the last comes the first.
    The edited text is the document with its last ``n // 2`` code points replaced by as many of
    the next document's first (all, if it has fewer).  A null text is the empty text.

    Rows are cut into id ranges; the first row of each range also goes to the range before it, as
    the neighbour of that one's last row.  So the texts move once, and a range is read as a
    sorted stream.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    blocks = buckets_for(rows)
    edges = key_edges(rows, "id", blocks)
    by_block = rows.select("id", (F.lit(len(edges)) - block_of(F.col("id"), edges)).alias("block"))
    tops = {r["block"]: (r["top"], r["some"]) for r in by_block.groupBy("block").agg(
        F.max("id").alias("top"), F.count("*").alias("some")).collect()}
    used = sorted(tops)
    if not used:
        return docs.sparkSession.createDataFrame([], _EDITED)
    earlier = {b: used[i - 1] for i, b in enumerate(used)}
    block = F.lit(len(edges)) - block_of(F.col("id"), edges)
    # equal top ids: the one with the least text is first, the others are dealt as neighbours too
    # and ignored by the stream, which uses the first row after its own
    heads = F.create_map(*(F.lit(x) for b in used for x in (b, tops[b][0])))
    back = F.create_map(*(F.lit(x) for b in used for x in (b, earlier[b])))
    dealt = rows.withColumn("home", block)
    dealt = dealt.withColumn("to", F.when(
        F.col("id").eqNullSafe(F.element_at(heads, F.col("home"))),
        F.array(F.struct(F.col("home").alias("at"), F.lit(True).alias("own")),
                F.struct(F.element_at(back, F.col("home")).alias("at"), F.lit(False).alias("own")))
    ).otherwise(F.array(F.struct(F.col("home").alias("at"), F.lit(True).alias("own")))))
    dealt = (dealt.select("id", "text", F.explode("to").alias("to"))
             .select(F.col("to.at").alias("block"), F.col("to.own").alias("own"), "id", "text")
             .repartitionById(len(edges) + 1, F.col("block"))
             .sortWithinPartitions(F.col("own").desc(), F.col("id").desc_nulls_last(), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream() -> Iterator[dict]:
            done = False
            for batch in batches:
                for a in range(0, batch.num_rows, _SPAN):
                    for row in batch.slice(a, _SPAN).to_pylist():
                        if not row["own"]:
                            if done:
                                continue
                            done = True
                        yield row

        def flush(group: list[tuple]) -> pa.RecordBatch:
            texts, edits = [], []
            for _, text, after in group:
                half = len(text) // 2
                texts.append(text)
                edits.append(text[:len(text) - half] + after[:half])
            texts.append(group[-1][2])
            sketches = [sketch(h, scale, floor)
                        for h in words.shingle_sets(pa.array(texts, pa.large_string()), k)]
            edited = [sketch(h, scale, floor)
                      for h in words.shingle_sets(pa.array(edits, pa.large_string()), k)]
            to_edit = [compare(a, b, scale, floor) for a, b in zip(sketches, edited)]
            to_next = [compare(a, b, scale, floor) for a, b in zip(sketches, sketches[1:])]
            return pa.RecordBatch.from_arrays([
                pa.array([g[0] for g in group], pa.int64()),
                pa.array([len(g[1]) for g in group], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits]),
                pa.array([as_text(x) for x in sketches[:-1]]),
                pa.array([as_text(x) for x in edited]),
                pa.array([x[0] for x in to_edit], pa.float64()),
                pa.array([x[0] for x in to_next], pa.float64()),
                pa.array([x[1] for x in to_edit], pa.float64()),
                pa.array([x[2] for x in to_edit], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                 "near_edited", "near_next", "contained_in_edited", "edited_in_document"])

        group, size = [], 0
        for item in _neighbours(stream()):
            group.append(item)
            size += len(item[1])
            if len(group) >= _SPAN or size >= 2_000_000:
                yield flush(group)
                group, size = [], 0
        if group:
            yield flush(group)

    return dealt.mapInArrow(run, _EDITED)
