"""Token counts through a cache keyed by the digests of content and tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import slices, written

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Another file or another release of the library makes another tokenizer."""
    import importlib.metadata

    release = importlib.metadata.version("sentencepiece" if path.endswith(".model") else "tokenizers")
    return hashlib.sha256(release.encode() + b"\0" + Path(path).read_bytes()).hexdigest()


def _counter(path: str):
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def encoded_counts(texts: DataFrame, path: str) -> DataFrame:
    """(digest, text) to (digest, n_tokens) by the tokenizer's own library."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                counts = pa.array(count(part.column(1).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), counts], names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def token_counts(docs: DataFrame, path: str, cache: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document; new counts are appended to the table at ``cache``.

    Content is the text with null as the empty text. Only the digests of all rows are grouped; one row of each digest that
    the cache lacks is encoded (and rows that repeat it with its id). Rows that repeat, or repeat an id or none, all get their count. Other columns are left out.
    ``cache`` is a Parquet folder that may not exist yet; two writers may both add a digest, which is read as one.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    content = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", content.alias("text")).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    rows = written(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    # Creates the table when there is none.
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    wanted = rows.groupBy("digest").agg(F.min("doc_id").alias("chosen")).join(stored.select("digest"), "digest", "left_anti")
    texts = keyed.join(wanted.withColumnRenamed("digest", "d").hint("shuffle_hash"), (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("chosen")))
    encoded_counts(texts, path).dropDuplicates(["digest"]).select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
