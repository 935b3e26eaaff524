"""Language identification by the nearest of several centroids per language.

A text is a vector of TF-IDF weights of the byte pairs and triples of its lower-cased letters
(everything else reads as a blank), hashed to ``DIMS`` places and scaled to length one.  The vectors
of each language are clustered on the sphere into a few centroids, as one language is written in
several ways.  A text has the language of the centroid of greatest cosine; if even that one is
farther than nearly all texts it was learned from, the text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.frames import crc_of_id, unit_hash
from tidemark.workspace import durable

_U = np.uint64
DIMS = 4096
CENTROIDS = 4
#: At most about this many texts of each language are learned from.
PER_LANGUAGE = 1000
#: A text is rejected if its cosine is below this part of a low quantile of those seen in learning,
#: taken over texts of some length: a few odd or very short ones do not move it.
SLACK, QUANTILE, LONG = 0.6, 0.01, 100
UNKNOWN = "und"
_BLANK = np.full(256, 0x20, dtype=np.uint8)
_BLANK[0x61:0x7B] = np.arange(0x61, 0x7B)
_BLANK[0x80:] = np.arange(0x80, 0x100)


def has_letter(text: str | None) -> bool:
    """Whether some character is of the general category L; number forms such as a half are not."""
    return text is not None and any(map(str.isalpha, text))


def counts(column: pa.Array) -> np.ndarray:
    """How often each place's byte pairs and triples occur in each text, as logarithms."""
    column = column.cast(pa.large_string())
    data, at = words.text_bytes(pc.utf8_lower(column.fill_null("")))
    data = _BLANK[data].astype(np.uint32)
    n = len(at) - 1
    text = np.repeat(np.arange(n), np.diff(at))
    out = np.zeros(n * DIMS)
    for size in (2, 3):
        if len(data) < size:
            continue
        m = len(data) - size + 1
        gram = np.full(m, size, dtype=np.uint32)
        blank = np.ones(m, dtype=bool)
        for j in range(size):
            gram = gram << np.uint32(8) | data[j:j + m]
            blank &= data[j:j + m] == 0x20
        gram = (gram * np.uint32(0x9E3779B1) >> np.uint32(20)).astype(np.int64)
        keep = ~blank & (text[:m] == text[size - 1:])
        out += np.bincount(text[:m][keep] * DIMS + gram[keep], minlength=n * DIMS)
    return np.log1p(out.reshape(n, DIMS))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from centres chosen one by one, each farthest from those before."""
    centres = [_unit(x.mean(axis=0, keepdims=True))[0]]
    while len(centres) < min(k, len(x)):
        centres.append(x[int(np.argmin((x @ np.array(centres).T).max(axis=1)))])
    c = np.array(centres)
    for _ in range(rounds):
        nearest = (x @ c.T).argmax(axis=1)
        c = _unit(np.array([x[nearest == i].mean(axis=0) if (nearest == i).any() else c[i]
                            for i in range(len(c))]))
    return c


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        learn=lambda i: crc_of_id(i) % 3 != 1, per_language: int = PER_LANGUAGE):
    """The model: (languages, one per centroid; centroids; IDF weights; least cosine allowed).

    A row with a known language and a letter is drawn if the hash of its id is below
    ``per_language`` divided by the number of rows of its language.  Document frequencies are those
    of the drawn rows.  Each language is clustered in a task of its own.  Without rows the model
    is empty and knows no language.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & learn(F.col(id_col)))
    totals = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).alias("lang"))
              .agg(F.count("*").alias("n")).collect()}
    if not totals:
        return [], np.zeros((0, DIMS)), np.ones(DIMS), np.zeros(0)
    limit = F.create_map(*(F.lit(x) for c, n in totals.items() for x in (c, per_language / n)))
    drawn = durable(known.filter(unit_hash(F.col(id_col), F.lit("language"))
                                 < F.element_at(limit, F.col(lang_col)))
                    .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
                    .filter(F.col("text").isNotNull()), "drawn")

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for piece in words.pieces(batch, "text", 1 << 20):
                total += (counts(piece.column("text")) > 0).sum(axis=0)
                n += piece.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIMS), -1)),
                                          pa.array(np.append(total, n))], ["place", "n"])

    df = np.zeros(DIMS + 1)
    for r in drawn.mapInArrow(frequency, "place long, n long").groupBy("place").agg(
            F.sum("n").alias("n")).collect():
        df[r["place"]] = r["n"]
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in sorted(pdf["text"]) if has_letter(t)]
        if not texts:
            return pd.DataFrame({c: pd.Series([], dtype=object)
                                 for c in ("lang", "centroid", "least")})
        x = np.concatenate([_unit(counts(pa.array(texts[a:a + 50], pa.large_string())) * idf)
                            for a in range(0, len(texts), 50)]).astype(np.float32)
        c = cluster(x, CENTROIDS)
        near = (x @ c.T).max(axis=1)
        long = np.array([len(t) >= LONG for t in texts])
        least = float(np.quantile(near[long] if long.any() else near, QUANTILE))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]] * len(c),
                             "centroid": [v.astype(float).tolist() for v in c],
                             "least": [least] * len(c)})

    rows = durable(drawn.groupBy("lang").applyInPandas(
        centroids, "lang string, centroid array<double>, least double"), "centroids").orderBy(
        "lang", "centroid").collect()
    if not rows:
        return [], np.zeros((0, DIMS)), idf, np.zeros(0)
    return ([r["lang"] for r in rows], np.array([r["centroid"] for r in rows]), idf,
            np.array([r["least"] for r in rows]) * SLACK)


_PREDICTED = "struct<lang: string, score: double, rejected: boolean>"


def predict(docs: DataFrame, model, out_col: str, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``out_col``: the language, the cosine and whether it is rejected.

    A null text, one without a letter, and any text for a model without languages are ``und``,
    score 0, rejected.
    """
    langs = model[0]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, centroids, idf, least = shared.value
        for batch in batches:
            for piece in words.pieces(batch, text_col, 1 << 20):
                names, scores, rejected = [], [], []
                for a in range(0, piece.num_rows, 100):
                    column = piece.column(text_col).slice(a, 100)
                    if not langs:
                        near = np.zeros((len(column), 1))
                    else:
                        near = _unit(counts(column) * idf) @ centroids.T
                    best = near.argmax(axis=1)
                    for row, (text, b) in enumerate(zip(column.to_pylist(), best)):
                        known = bool(langs) and has_letter(text)
                        value = float(min(max(near[row, b], 0.0), 1.0)) if known else 0.0
                        names.append(langs[b] if known else UNKNOWN)
                        scores.append(value)
                        rejected.append(not known or value < least[b])
                out = pa.StructArray.from_arrays(
                    [pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                     pa.array(rejected, pa.bool_())], ["lang", "score", "rejected"])
                yield pa.RecordBatch.from_arrays(
                    [out if c == out_col else piece.column(c) for c in piece.schema.names],
                    piece.schema.names)

    ready = docs.withColumn(out_col, F.lit(None).cast(_PREDICTED))
    return ready.mapInArrow(run, ready.schema)
