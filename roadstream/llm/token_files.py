"""Token ids in files: frequency-ranked ids, coded in one to four bytes with the lengths in control bytes apart.

A folder of token files holds two Parquet tables. ``ranks`` numbers the ids by falling frequency, so that the most
frequent 256 take one byte. ``blocks`` holds whole documents in ascending order of doc_id; a block names its part and
place, the number of ids before it in its part, its documents with their numbers of ids, a control byte for every four
ids (two bits each: bytes less one), and the bytes themselves. A part is what one task wrote after the range sort.

Rows without an id come first; rows that share an id are ordered by a digest of their ids, and equal rows can be told
apart by nothing. A null text is empty and has the end id alone. Other columns are left out; no rows give no rows.
"""

from __future__ import annotations

import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from roadstream.llm.common import gathered_bytes, plain, slices, written
from roadstream.llm.runs import ASCII_LETTER, binaries, values_of

END = 0
BLOCK_IDS = 1 << 20
# Pieces of text whose ids a task remembers, and the ids of one remembered piece.
CACHED_PIECES = 1 << 19
CACHED_IDS = 1 << 23

_CODES = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
# For each control byte, which bytes of four little-endian words are stored.
STORED = np.arange(4) <= _CODES[:, :, None]


_BYTES = np.arange(256)
_LETTER, _PRINTED, _BLANK, _ASCII = 1, 2, 4, 8
_KIND = (
    _LETTER * ASCII_LETTER
    + _PRINTED * ((_BYTES > 0x20) & (_BYTES < 0x7F))
    + _BLANK * ((_BYTES == 0x20) | ((_BYTES >= 9) & (_BYTES <= 13)))
    + _ASCII * (_BYTES < 0x80)
).astype(np.uint8)


_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# Byte-level models name bytes by characters: shown ones by themselves, the rest by the characters from 256 on.
VISIBLE = np.arange(256, dtype="<u4")
VISIBLE[[b for b in range(256) if b not in _SHOWN]] = np.arange(256, 512 - len(_SHOWN))


def visible(pieces: list[str]) -> list[str]:
    """The pieces as byte-level models spell them, one character a byte."""
    data = [x.encode() for x in pieces]
    spelled = VISIBLE[np.frombuffer(b"".join(data), np.uint8)].tobytes().decode("utf-32-le")
    ends = list(itertools.accumulate(map(len, data), initial=0))
    return [spelled[a:b] for a, b in itertools.pairwise(ends)]


def pieces_of(texts: pa.Array, specials: list[str] = []) -> tuple[pa.Array, np.ndarray]:
    """Pieces that byte-level pre-tokenisation never joins, and the number of pieces up to each text's end.

    A cut comes between a letter and an ASCII character that is none, between a printed character and white space,
    before a space with a printed character behind it, as that space belongs to the word, and behind other single
    white space between printed characters. Elsewhere a piece may hold several pre-tokens. A text with a special string stays whole.
    """
    raw, sizes = gathered_bytes(texts)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    cut = np.zeros(len(raw) + 1, bool)
    if len(raw):
        kind = _KIND[raw]
        letter = (kind & _LETTER) > 0
        # Letters of Latin-1; the two signs among them are none.
        letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        printed, blank = (kind & _PRINTED) > 0, (kind & _BLANK) > 0
        here = letter[:-1] & ((kind[1:] & (_ASCII | _LETTER)) == _ASCII)
        here |= printed[:-1] & blank[1:]
        cut[1:-1] = here
        cut[: len(raw) - 1] |= (raw[:-1] == 0x20) & printed[1:]
        cut[2:-1] |= printed[:-2] & blank[1:-1] & (raw[1:-1] != 0x20) & printed[2:]
        # What the end of a text has before it is decided without the text behind it.
        last = ends[sizes > 1] - 1
        cut[last] = here[last - 1]
        for special in specials:
            for i in np.flatnonzero(pc.match_substring(plain(texts), special).to_numpy(zero_copy_only=False)):
                cut[starts[i] : ends[i]] = False
        cut[starts[sizes > 0]] = True
    cut[len(raw)] = False
    firsts = np.flatnonzero(cut)
    offsets = np.append(firsts, len(raw)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(firsts), pa.py_buffer(offsets), pa.py_buffer(raw))
    return pieces, np.searchsorted(firsts, ends, side="left")


def whole_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return plain(texts), np.arange(1, len(texts) + 1)


class Encoder:
    """The tokenizers library, asked once for each distinct piece."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        added = self.model.get_added_tokens_decoder().values()
        self.added = [x.content for x in added]
        form = json.loads(self.model.to_str())
        words = form["pre_tokenizer"] or {}
        plain_words = words.get("type") == "ByteLevel" and words["use_regex"] and not words["add_prefix_space"]
        reaching = any(x.lstrip or x.rstrip or x.single_word for x in added)
        # Texts may be cut only where the tokenizer cuts them; others go to it whole.
        self.cuts = plain_words and form["normalizer"] is None and form["model"]["type"] == "BPE" and not reaching
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        # Slot 0 is the end of a document.
        self.flat, self.starts, self.used = np.array([END], np.uint32), np.array([0, 1], np.int64), 1

    def _learn(self, pieces: list[str]) -> None:
        # A piece of letters is one pre-token, for which the model alone can be asked.
        single = [x for x in pieces if (x[1:] if x[0] == " " else x).isalpha()] if self.cuts else []
        lists = [[t.id for t in x] for x in map(self.model.model.tokenize, visible(single))]
        known = set(single)
        others = [x for x in pieces if x not in known]
        lists += [x.ids for x in self.model.encode_batch_fast(others, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        fresh = np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(counts.sum()))
        self.slots.update(zip(itertools.chain(single, others), range(len(self.starts) - 1, len(self.starts) - 1 + len(pieces))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        self.flat = np.concatenate([self.flat, fresh])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, and how many each text has."""
        if len(self.slots) > CACHED_PIECES or len(self.flat) > CACHED_IDS:
            self._forget()
        pieces, ends = pieces_of(texts, self.added) if self.cuts else whole_texts(texts)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        missing = list(itertools.filterfalse(self.slots.__contains__, distinct))
        if missing:
            self._learn(missing)
        slots = np.fromiter(map(self.slots.__getitem__, distinct), np.int64, len(distinct))
        sequence = np.insert(slots[coded.indices.to_numpy(zero_copy_only=False)], ends, 0)
        begins = self.starts[sequence]
        counts = self.starts[sequence + 1] - begins
        until = np.cumsum(counts)
        ids = self.flat[np.repeat(begins - until + counts, counts) + np.arange(int(until[-1]) if len(until) else 0)]
        last = ends + np.arange(len(ends))
        return ids, np.diff(until[last], prepend=0)


def width_of(path: str) -> str:
    """Two bytes an id where the tokenizer's vocabulary allows it, else four, little-endian."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, path: str, width: str) -> DataFrame:
    """doc_id and the ids of each document as unsigned integers of that width, the end id included."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = encoder.encode(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), binaries(ids.astype(width), counts)], names=["doc_id", "ids"])

    schema = StructType([StructField("doc_id", id_type)]).add("ids", "binary")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def ranks_of(ids: DataFrame, width: str) -> DataFrame:
    """rank, id and count of each id that occurs, the most frequent first, ties by id: one row an id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "ids"):
                found = np.bincount(values_of(part.column(0), width)[0])
                if len(found) > len(counts):
                    counts, found = found, counts
                counts[: len(found)] += found
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["id", "n"])

    counts = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row an id of the vocabulary, so one task can number them.
    return counts.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).cast("long").alias("rank"), "id", "n")


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    stored = STORED[control].reshape(-1, 4)[: len(values)]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[stored].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values again: each control byte looks up where its bytes go."""
    stored = STORED[np.frombuffer(control, np.uint8)].reshape(-1, 4)[:count]
    out = np.zeros((count, 4), np.uint8)
    out[stored] = np.frombuffer(data, np.uint8)
    return out.view("<u4").ravel()


def _block_schema(id_type) -> StructType:
    ids = StructType([StructField("doc_id", id_type)]).simpleString()[len("struct<doc_id:") : -1]
    return f"part int, block int, before long, n_ids long, doc_ids array<{ids}>, counts array<long>, control binary, data binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizers library and write token files below ``path``."""
    spark = docs.sparkSession
    width = width_of(tokenizer)
    ids = written(encoded(docs, tokenizer, width), "ids")
    ranks_of(ids, width).coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = _rank_table(spark, path)[1]
    # Equal rows are told apart by where they are stored, so that many of them are no one task's.
    keyed = ids.withColumn("digest", F.xxhash64("ids")).withColumn("at", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange("doc_id", "digest", "at").sortWithinPartitions("doc_id", "digest", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        kept: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            counts = np.concatenate([x[1] for x in kept])
            values = np.concatenate([x[2] for x in kept])
            control, data = pack(rank_of[values])
            doc_ids = pa.concat_arrays([x[0] for x in kept])
            lists = [pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), x) for x in (doc_ids, pa.array(counts))]
            row = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before]), pa.array([len(values)]), *lists, pa.array([control]), pa.array([data])]
            return pa.RecordBatch.from_arrays(row, names=["part", "block", "before", "n_ids", "doc_ids", "counts", "control", "data"])

        for batch in batches:
            for cut in slices(batch, "ids"):
                values, counts = values_of(cut.column(1), width)
                kept.append((cut.column(0), counts, values))
                if sum(len(x[2]) for x in kept) >= BLOCK_IDS:
                    yield flush()
                    block, before = block + 1, before + sum(len(x[2]) for x in kept)
                    kept = []
        if kept:
            yield flush()

    ordered.select("doc_id", "ids").mapInArrow(run, _block_schema(docs.schema["doc_id"].dataType)).write.parquet(f"{path}/blocks")


def _rank_table(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    """id by rank, and rank by id; no longer than the vocabulary."""
    stored = spark.read.parquet(f"{path}/ranks").toPandas()
    ids = np.zeros(len(stored), np.uint32)
    ids[stored["rank"].to_numpy()] = stored["id"].to_numpy()
    ranks = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    ranks[ids] = np.arange(len(ids), dtype=np.uint32)
    return ids, ranks


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian 32-bit) of each stored document."""
    id_of = _rank_table(spark, path)[0]
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, before, n_ids, _, _, control, data = (batch.column(i)[row].as_py() if i not in (3, 4) else None for i in range(7))
                counts = batch.column(4)[row].values.to_numpy(zero_copy_only=False)
                ids = id_of[unpack(control, data, n_ids)]
                start = before + np.cumsum(counts) - counts
                columns = [pa.array(np.full(len(counts), part), pa.int32()), batch.column(3)[row].values, pa.array(start), pa.array(counts), binaries(ids.astype("<u4", copy=False), counts)]
                whole = pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "start", "n_tokens", "ids"])
                yield from slices(whole, "ids")

    schema = StructType().add("part", "integer").add(StructField("doc_id", id_type)).add("start", "long").add("n_tokens", "long").add("ids", "binary")
    rows = blocks.select("part", "before", "n_ids", "doc_ids", "counts", "control", "data").mapInArrow(run, schema)
    # One row a part, which is one a task of the sort.
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    firsts = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(firsts), "part").select("doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of each document's ids."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
