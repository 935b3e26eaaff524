"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams.

Features are the presence of words, of pairs of neighbouring words, of pairs with one word skipped,
and of the words' first four and five bytes (so that unseen inflections of a learned word count),
each hashed to one of ``2**BITS`` places.  FTRL keeps a learning rate per coordinate and an L1
penalty that leaves most weights at zero, so the model is a short table of places and weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.frames import crc_of_id, unit_hash
from tidemark.workspace import durable

_U = np.uint64
BITS = 20
#: At most about this many labelled rows of each class are learned from.
PER_CLASS = 5000
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1.5, 0.5
EPOCHS = 3
_TAGS = np.random.default_rng(7).integers(1, 1 << 62, 8, dtype=np.uint64)


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct places of each text's features."""
    w = words.words(column, words.ALNUM)
    h = w.hashes()
    text = w.text_of()
    shift = _U(64 - BITS)
    kinds = [(words.mix(h ^ _TAGS[0]) >> shift, text)]
    for gap, tag in ((1, 1), (2, 2)):
        if len(h) > gap:
            same = text[gap:] == text[:-gap]
            pair = words.mix(h[:-gap] * _U(3) + h[gap:] * _U(7) + _TAGS[tag]) >> shift
            kinds.append((pair[same], text[gap:][same]))
    for size, tag in ((4, 3), (5, 4)):
        long = np.flatnonzero(w.ends - w.starts > size)
        head = np.zeros(len(long), np.uint64)
        for j in range(size):
            head = head * _U(257) + w.data[w.starts[long] + j].astype(np.uint64)
        kinds.append((words.mix(head ^ _TAGS[tag]) >> shift, text[long]))
    key = np.unique(np.concatenate([t.astype(np.uint64) << _U(BITS) | f for f, t in kinds]))
    cut = np.searchsorted(key, np.arange(w.n + 1, dtype=np.uint64) << _U(BITS))
    places = (key & _U((1 << BITS) - 1)).astype(np.int64)
    for i in range(w.n):
        yield places[cut[i]:cut[i + 1]]


def train(texts: list[str], labels: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Places, weights and bias, learned in the given order; ``prior`` is the share of ones among
    all labelled rows, to which the bias is moved from the share among the given ones."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = bias_n = 0.0
    rows = [f for a in range(0, len(texts), 200)
            for f in features(pa.array(texts[a:a + 200], pa.large_string()))]

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for at, y in zip(rows, labels):
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            before = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - before) / ALPHA * w
            bias_n += g * g
            bias -= ALPHA / (BETA + np.sqrt(bias_n)) * g
    share = min(max(labels.mean() if len(labels) else 0.5, 1e-6), 1 - 1e-6)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    bias += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    w = weights(np.arange(1 << BITS))
    kept = np.flatnonzero(w)
    return kept, w[kept], float(bias)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", learn=lambda i: crc_of_id(i) % 4 != 2, per_class: int = PER_CLASS):
    """The model of the labelled rows that ``learn`` admits: (places, weights, bias).

    A row is drawn if the hash of its id is below ``per_class`` divided by the number of its class,
    so each class gives about ``per_class`` rows, or all.  They are learned from in one task, in
    hash order.  Null labels and ids are left out; of an id labelled twice the greater label counts.
    Without rows the model is the bias 0.
    """
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .filter(learn(F.col(id_col)))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    draw = unit_hash(F.col("id"), F.lit("toxicity"))
    limit = F.create_map(*(F.lit(x) for y, n in totals.items() for x in (y, per_class / n)))
    drawn = durable(known.withColumn("draw", draw).filter(
        F.col("draw") < F.element_at(limit, F.col("y"))), "drawn")
    prior = totals.get(1, 0) / sum(totals.values())
    sample = (docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
              .join(F.broadcast(drawn), "id").select("id", "draw", "y", "text"))

    def learned(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["draw", "id", "text"])
        at, w, bias = train(pdf["text"].tolist(), pdf["y"].to_numpy(float), prior)
        return pd.DataFrame({"place": np.append(at, -1), "weight": np.append(w, bias)})

    model = durable(sample.groupBy(F.lit(0).alias("all")).applyInPandas(
        learned, "place long, weight double"), "toxicity").collect()
    at = np.array([r["place"] for r in model], np.int64)
    w = np.array([r["weight"] for r in model])
    return at[at >= 0], w[at >= 0], float(w[at < 0].sum())


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) of every row of ``docs``; a null text is the empty text."""
    at, w, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((at, w, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = shared.value
        table = np.zeros(1 << BITS)
        table[at] = w
        for batch in batches:
            for piece in words.pieces(batch, text_col):
                total = np.array([table[f].sum() for f in features(piece.column(text_col))])
                p = 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(id_col), pa.array(p, pa.float64())], ["id", "score"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, score double")
            .withColumnRenamed("id", id_col))
