"""A quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad texts.  A text is cut into
chunks and each chunk is compressed with either; the difference of the two sizes, divided by their
sum, tells which kind it resembles.  (The saving itself enters too: text that repeats itself is
small with either.)  Chunks are compressed on their own, so a long text's later
part is judged by the dictionaries too and not by its own beginning.  Logistic regression on labelled
texts that no dictionary was built from turns both into a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.frames import crc_of_id, unit_hash
from tidemark.workspace import durable

CHUNK = 1024
DICTIONARY = 64 * 1024
LEVEL = 3
#: About this many texts of each label build its dictionary, and as many more calibrate the score.
PER_LABEL = 2000


class Compressors:
    def __init__(self, good: bytes, bad: bytes) -> None:
        self.pair = [self._one(d) for d in (good, bad)]

    @staticmethod
    def _one(content: bytes) -> zstandard.ZstdCompressor:
        options = dict(level=LEVEL, write_content_size=False, write_checksum=False)
        if not content:
            return zstandard.ZstdCompressor(**options)
        d = zstandard.ZstdCompressionDict(content)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=d, write_dict_id=False, **options)

    def measure(self, text: bytes) -> tuple[float, float]:
        """The difference, over 0 if the good dictionary serves better, and the saving by the good
        one as a part of the text; both 0 for the empty text."""
        good = bad = 0
        for a in range(0, len(text), CHUNK):
            part = text[a:a + CHUNK]
            good += len(self.pair[0].compress(part))
            bad += len(self.pair[1].compress(part))
        if not text:
            return 0.0, 0.0
        return (bad - good) / (bad + good), max(0.0, 1 - good / len(text))


def build(texts: list[bytes]) -> bytes:
    """A dictionary of the texts' chunks; their plain beginning where there are too few."""
    chunks = [t[a:a + CHUNK] for t in texts for a in range(0, len(t), CHUNK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, chunks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[:DICTIONARY]


def _design(x: np.ndarray) -> np.ndarray:
    """The difference, the saving and its square, and one: little saving is usual for short texts
    and much for repeated ones."""
    x = x.reshape(-1, 2)
    return np.column_stack([x, x[:, 1] ** 2, np.ones(len(x))])


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of a weighted logistic regression with a small penalty, by Newton's method."""
    design = _design(x)
    beta, penalty = np.zeros(4), np.diag([1e-3, 1e-2, 1e-2, 1e-6])
    if not len(x):
        return beta
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        h = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(h, design.T @ (weight * (y - p)) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", learn=lambda i: crc_of_id(i) % 5 != 0,
        per_label: int = PER_LABEL):
    """The model of the labelled rows that ``learn`` admits: (good, bad, coefficients).

    A row is drawn if the hash of its id is below twice ``per_label`` divided by the number of its
    label; the half of lower hashes builds a dictionary, in one task for each label, the other half
    calibrates, weighted to the labels' true shares.  Null labels and ids are left out; of an id
    labelled twice the greater label counts.  A missing label has an empty dictionary.
    """
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .filter(learn(F.col(id_col)))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return b"", b"", np.zeros(4)
    part = F.create_map(*(F.lit(x) for y, n in totals.items()
                          for x in (y, min(1.0, 2 * per_label / n) / 2)))
    drawn = durable(
        known.withColumn("draw", unit_hash(F.col("id"), F.lit("quality")))
        .withColumn("part", F.floor(F.col("draw") / F.element_at(part, F.col("y"))).cast("int"))
        .filter("part < 2").select("id", "y", "part"), "drawn")
    sample = durable(
        docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
        .join(F.broadcast(drawn), "id").select("id", "y", "part", "text"), "sample")

    def dictionary(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = [t.encode() for t in pdf.sort_values(["id", "text"])["text"]]
        return pd.DataFrame({"y": [int(pdf["y"].iloc[0])], "content": [build(texts)]})

    built = {r["y"]: bytes(r["content"]) for r in durable(
        sample.filter("part = 0").groupBy("y").applyInPandas(dictionary, "y int, content binary"),
        "dictionaries").collect()}
    good, bad = built.get(1, b""), built.get(0, b"")

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Compressors(good, bad)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([both.measure(t.encode()) for t in
                                              batch.column("text").to_pylist()],
                                             pa.list_(pa.float64()))], ["y", "x"])

    points = durable(sample.filter("part = 1").select("y", "text").mapInArrow(
        differences, "y int, x array<double>"), "points").orderBy("y", "x").collect()
    x, y = np.array([r["x"] for r in points]), np.array([r["y"] for r in points], float)
    number = {v: max(1, int((y == v).sum())) for v in (0, 1)}
    weight = np.array([totals.get(int(v), 0) / number[int(v)] for v in y])
    return good, bad, calibrate(x, y, weight / weight.mean() if len(weight) else weight)


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, difference) of every row of ``docs``; a null text is the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad, beta = shared.value
        both = Compressors(good, bad)
        for batch in batches:
            for piece in words.pieces(batch, text_col):
                data, at = words.text_bytes(piece.column(text_col))
                x = np.array([both.measure(data[at[i]:at[i + 1]].tobytes())
                              for i in range(piece.num_rows)])
                p = 1 / (1 + np.exp(-np.clip(_design(x) @ beta, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(id_col), pa.array(p, pa.float64()), pa.array(x[:, 0], pa.float64())],
                    ["id", "score", "difference"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(id_col, text_col)
            .mapInArrow(run, f"id {kind}, score double, difference double")
            .withColumnRenamed("id", id_col))
