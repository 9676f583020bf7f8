"""A training corpus from raw documents: quality, near-duplicates, personal data, mixture, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm import bpe, minhash, mixing, pii, quality
from roadstream.llm.common import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of those that are there.

    Null and empty texts are scored as texts without features. Rows that repeat an id are scored each by its own text, so they may
    part; rows without an id are scored too and teach nothing. Without labels every score is the same. Columns keep their values.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score(docs, quality.train(docs, labels)).filter("predicted = 1").select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8). Rows that share an id count as one document.

    Documents without an id can't be told apart by a decision and stay.
    """
    decided = written(minhash.near_duplicates(docs.select("doc_id", "text")).filter("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")), "decided")
    gone = decided.filter("not kept").select("doc_id")
    # Only rows that may go are moved to be joined; the others stay where they are read. Packed, their columns clash with none.
    rows = minhash.marked(docs.select(F.struct("*").alias("row"), "doc_id"), gone.withColumnRenamed("doc_id", "least"))
    left = rows.filter("not likely").unionByName(rows.filter("likely").join(gone, "doc_id", "left_anti")).select("row.*")
    if not decided.filter("kept and times > 1").isEmpty():
        left = left.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(left.filter("doc_id is null"))
    return left.select(docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, in whole texts of any length; a null text stays null, an empty one empty.

    Each row is decided by its own text alone, so repeated rows agree and rows without an id are treated alike.
    """
    found = pii.detect(docs).withColumn("text", F.col("redacted"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """The columns of the documents as ``row``, and where each row is stored, which names it in every reading."""
    place = (F.xxhash64("_metadata.file_path").alias("file"), "_metadata.row_index")
    try:
        return docs.select(F.struct("*").alias("row"), *place)
    except AnalysisException:
        # Rows that are not read from files are stored first.
        return written(docs, "numbered").select(F.struct("*").alias("row"), *place)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row once for each pass of the mixture that takes at least half of it, each copy at its own place in training.

    The mixture decides on rows: rows that share an id, or have none, get places of their own. A null source is the last
    source. Texts that are null or have no word have nothing to train on and are left out. Rows are sorted by place, so a very
    long text is one row in one place; an empty table gives no rows.
    """
    turns = range(mixing.turns(mixing.MOST_TIMES))
    rows = numbered(docs)
    plan = mixing.mix(rows.select("file", "row_index", "row.doc_id", "row.source", "row.text"), carry=("file", "row_index"))
    taken = [
        F.when(2 * F.col("passes")[t]["part"] >= F.col("size"), F.struct(F.col("passes")[t]["position"].alias("position"), F.lit(t).alias("turn")))
        for t in turns
    ]
    copies = plan.filter("size > 0").select("file", "row_index", F.explode(F.array_compact(F.array(*taken))).alias("place"))
    mixed = rows.join(copies, ["file", "row_index"])
    return mixed.sort("place.position", "row.doc_id", "place.turn").select("row.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text; null and empty texts have no ids. Rows that repeat stay."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), ranks, pattern)
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "intact")


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", keep_one_of_each),
    ("pii", redact),
    ("mixture", mix_sources),
    ("tokens", tokenise),
]

# The classifier, the random field and the token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
