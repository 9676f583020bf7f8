"""Shared folder, written tables, and word arrays for the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The separators of words, as a set for regular expressions; other Unicode spaces belong to words.
SPACE = r"[\x20\x09-\x0D]+"
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_fallback: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own, once."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _fallback:
        _fallback.append(tempfile.mkdtemp(prefix="roadstream-llm-"))
    return _fallback[0]


def new_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/llm-{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, purpose)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20, most_rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part has more rows than ``most_rows`` or much more text than ``most_bytes``; one text is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, min(start + most_rows, int(np.searchsorted(ends, before + most_bytes, side="right"))))
        yield batch.slice(start, stop - start)
        start = stop


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX_1
    values ^= values >> np.uint64(27)
    values *= _MIX_2
    values ^= values >> np.uint64(31)
    return values


def plain(texts: pa.Array) -> pa.Array:
    """The texts as a fresh large-string array, nulls empty. Some kernels misread the offsets of a slice once it is cast."""
    filled = pc.fill_null(texts, "")
    return filled.take(pa.array(np.arange(len(filled)))).cast(pa.large_string())


def gathered_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and the length of each."""
    data = plain(texts).cast(pa.large_binary()).to_pylist()
    return np.frombuffer(b"".join(data), np.uint8), np.array([len(x) for x in data], np.int64)


def words_of(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The words of each text and the offsets at which each text's words begin."""
    texts = plain(texts)
    if lower:
        texts = pc.ascii_lower(texts)
    texts = pc.ascii_trim(pc.replace_substring_regex(texts, pattern=SPACE, replacement=" "), characters=" ")
    lists = pc.split_pattern(texts, pattern=" ")
    # Splitting "" gives one empty word.
    filled = pc.greater(pc.binary_length(texts), 0)
    counts = pc.if_else(filled, pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    words = pc.list_flatten(pc.filter(lists, filled))
    return words, np.concatenate([[0], np.cumsum(counts.astype(np.int64))])


def string_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit polynomial hash of each distinct string, computed over columns of bytes."""
    data = words.cast(pa.large_binary())
    if isinstance(data, pa.ChunkedArray):
        data = data.combine_chunks()
    count = len(data)
    if not count:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + count + 1]
    blob = data.buffers()[2]
    raw = np.frombuffer(blob, np.uint8) if blob is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = offsets[:-1][order], lengths[order]
    state = np.full(count, _GOLDEN, np.uint64)
    alive = count
    for at in range(int(sizes[0])):
        if at >= 64:
            break
        alive = int(np.searchsorted(-sizes[:alive], -at, side="left")) if at else int((sizes > 0).sum())
        state[:alive] = (state[:alive] ^ raw[starts[:alive] + at]) * _MIX_1
        state[:alive] ^= state[:alive] >> np.uint64(29)
    # Very long words are rare: their rest is hashed one by one.
    import hashlib

    for i in range(int(np.searchsorted(-sizes, -64, side="left"))):
        rest = raw[starts[i] + 64 : starts[i] + sizes[i]].tobytes()
        state[i] ^= np.frombuffer(hashlib.blake2b(rest, digest_size=8).digest(), np.uint64)[0]
    out = np.empty(count, np.uint64)
    out[order] = mix(state ^ sizes.astype(np.uint64))
    return out


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of each text, with the texts' offsets."""
    words, offsets = words_of(texts, lower)
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return string_hashes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)], offsets


def shingles_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed word shingles of each text, ascending within it, with offsets.

    A text with fewer words than ``width`` has its whole sequence as one; a text without words has none.
    Hashes have 50 bits, so that a text's number fits beside them; at most 16,384 texts a call.
    """
    hashes, offsets = word_hashes(texts)
    counts = np.diff(offsets)
    rows = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    position = np.arange(len(hashes)) - np.repeat(offsets[:-1], counts)
    length = np.repeat(counts, counts)
    rolled = np.full(len(hashes), _GOLDEN, np.uint64)
    used = np.minimum(length, width)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for step in range(width):
        part = padded[step : step + len(hashes)]
        inside = step < used
        rolled = np.where(inside, mix(rolled + part), rolled)
    first = position <= np.maximum(length - width, 0)
    short = (length < width)[first]
    values = rolled[first] ^ (short * np.uint64(0x5851F42D4C957F2D)) * used[first].astype(np.uint64)
    keys = (rows[first].astype(np.uint64) << np.uint64(50)) | (values >> np.uint64(14))
    keys.sort()
    keep = np.ones(len(keys), bool)
    keep[1:] = keys[1:] != keys[:-1]
    keys = keys[keep]
    owner = (keys >> np.uint64(50)).astype(np.int64)
    ends = np.searchsorted(owner, np.arange(len(counts) + 1), side="left")
    return keys & np.uint64((1 << 50) - 1), ends
