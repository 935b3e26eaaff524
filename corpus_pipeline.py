"""A training-data pipeline over ``documents``; each stage calls one operator of the library.

Stages take and return documents (doc_id, text, lang, source, n_chars), the last one the digest of
the token files it has written.  Rows with null ids or texts pass through every stage whose operator
does not reject them; repeated rows are judged alike, but for the near duplicates.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, language, mixing, token_files
from tidemark.llm.frames import read, small
from tidemark.operators.joins import lookup_join
from tidemark.workspace import durable, new_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The id that closes each document in the token files.
END = 1


def _bounded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs``; from here on tasks get at most 1,000 whole texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return docs


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a null ``lang`` becomes the predicted one.

    Texts without a letter and texts far from every centroid go.
    """
    docs = _own(_bounded(spark, docs))
    found = language.predict(docs, language.fit(docs), "_found")
    return (found.filter("not _found.rejected").withColumn("lang", F.coalesce("lang", "_found.lang"))
            .select(*COLUMNS))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row stays: that of least id, null ids last.

    Rows are told apart by their place in the table and not by their ids, so an id with several texts
    keeps each text that nothing else equals, and of a row repeated, or a group of null ids, one stays.
    Rows without words are linked with nothing and stay.
    """
    docs = _own(_bounded(spark, docs)).withColumn("_row", F.monotonically_increasing_id())
    linked = durable(jaccard.link(docs, id_col="_row"), "linked").select("_row", "component_id")
    members = durable(linked.join(docs.select("_row", "doc_id"), "_row"), "members")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row")
    stays = (members.groupBy("component_id").agg(F.min(first).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("component_id", F.col("first._row").alias("stays")))
    goes = durable(lookup_join(members, durable(stays, "stays"), ["component_id"], unique=["_row"])
                   .filter("_row <> stays").select("_row"), "goes")
    return docs.join(small(goes), "_row", "left_anti").select(*COLUMNS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by passages of the benchmark."""
    return decontaminate.clean(_own(_bounded(spark, docs)), read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources; a document taken more than once is as many rows."""
    return mixing.mix(_own(docs))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: doc_id, start, n_tokens, ids_crc32."""
    root = new_path(spark, "token-files")
    manifest = token_files.write(docs, root, public_tokenizers.path("word_bpe_49k.json"), END)
    return token_files.read(manifest, root, with_ids=False)


STAGES = [("language", known_language), ("near_duplicates", one_of_each_group),
          ("decontamination", uncontaminated), ("mixing", mixed), ("token_files", token_output)]
#: Trained centroids, 64-bit set joins and a tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
