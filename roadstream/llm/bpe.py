"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import mix, slices, string_hashes

KEYS_A_BUCKET = 4
# Encodings of pre-tokens that the vocabulary lacks are remembered within a task, up to so many.
MEMO = 1 << 17


@dataclass
class Vocabulary:
    """Token bytes by id, and the minimal perfect hash over them: bucket displacements and ids by slot."""

    pattern: str
    blob: np.ndarray
    starts: np.ndarray
    displacement: np.ndarray
    slot_id: np.ndarray
    slot_hash: np.ndarray

    def tokens(self) -> list[bytes]:
        raw, at = self.blob.tobytes(), self.starts.tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]


def _slots(hashes: np.ndarray, displacement: np.ndarray, size: int) -> np.ndarray:
    return (mix(hashes + displacement * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and displace: for each bucket, the first displacement that sends its keys to free slots."""
    size = len(hashes)
    buckets = max(1, size // KEYS_A_BUCKET)
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    displacement, slot_of = np.zeros(buckets, np.uint64), np.full(size, -1, np.int64)
    free = np.ones(size, bool)
    for b in np.argsort(-np.diff(ends), kind="stable"):
        keys = order[ends[b] : ends[b + 1]]
        if not len(keys):
            break
        base = 1
        while True:
            tries = np.arange(base, base + 64, dtype=np.uint64)
            if len(keys) == 1 and base > 64:
                tries = np.arange(base, base + 16384, dtype=np.uint64)
            slots = _slots(hashes[keys][None, :], tries[:, None], size)
            good = free[slots].all(1)
            if len(keys) > 1:
                ordered = np.sort(slots, 1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
            hit = np.flatnonzero(good)
            if len(hit):
                displacement[b], slot_of[keys] = tries[hit[0]], slots[hit[0]]
                free[slots[hit[0]]] = False
                break
            base = int(tries[-1]) + 1
    return displacement, slot_of


def load_vocabulary(ranks_path: str, pattern: str) -> Vocabulary:
    """Read a file of base64 tokens and ranks; ranks must be 0, 1, 2, ..."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be without gaps")
    hashes = string_hashes(pa.array(tokens, pa.large_binary()))
    if len(np.unique(hashes)) != len(tokens):
        raise ValueError("two tokens share a 64-bit hash")
    displacement, slot_of = perfect_hash(hashes)
    slot_id = np.empty(len(tokens), np.uint32)
    slot_id[slot_of] = np.arange(len(tokens), dtype=np.uint32)
    slot_hash = np.empty(len(tokens), np.uint64)
    slot_hash[slot_of] = hashes
    starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    return Vocabulary(pattern, np.frombuffer(b"".join(tokens), np.uint8), starts, displacement, slot_id, slot_hash)


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbours of lowest rank, leftmost first, until none is in the vocabulary."""
    size = len(word)
    end, after, before = list(range(1, size + 1)), list(range(1, size + 1)), list(range(-1, size - 1))
    heap = []
    get = ranks.get
    for i in range(size - 1):
        rank = get(word[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        rank, i, stop = heapq.heappop(heap)
        j = after[i]
        # A stale entry: its left part is gone, or one of its parts has grown.
        if j >= size or end[i] < 0 or end[j] != stop or end[i] != j:
            continue
        end[i], end[j] = stop, -1
        after[i] = k = after[j]
        if k < size:
            before[k] = i
            rank = get(word[i : end[k]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[k]))
        h = before[i]
        if h >= 0:
            rank = get(word[h:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, h, stop))
    out, i = [], 0
    while i < size:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.tokens = vocabulary.tokens()
        self.ranks = {t: i for i, t in enumerate(self.tokens)}
        self.token_array = pa.array(self.tokens, pa.large_binary())
        self.find = regex.compile(vocabulary.pattern).findall
        self.memo: dict[bytes, list[int]] = {}

    def whole(self, words: pa.Array) -> np.ndarray:
        """The id of each word that is one token, else -1: two reads of the hash and one comparison of bytes."""
        hashes = string_hashes(words)
        displacement = self.v.displacement[(hashes % np.uint64(len(self.v.displacement))).astype(np.int64)]
        slots = _slots(hashes, displacement, len(self.v.slot_id))
        ids = np.where(self.v.slot_hash[slots] == hashes, self.v.slot_id[slots].astype(np.int64), -1)
        hit = np.flatnonzero(ids >= 0)
        same = pc.equal(words.take(pa.array(hit)), self.token_array.take(pa.array(ids[hit])))
        ids[hit[~same.to_numpy(zero_copy_only=False)]] = -1
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of the texts among them."""
        flat: list[str] = []
        counts = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = len(flat)
            flat += self.find(text)
            counts[i] = len(flat) - before
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = pa.array(flat, pa.large_string()).dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary())
        ids = self.whole(words)
        lengths = np.ones(len(ids), np.int64)
        missing = np.flatnonzero(ids < 0)
        pieces = []
        for at, word in zip(missing.tolist(), words.take(pa.array(missing)).to_pylist()):
            piece = self.memo.get(word)
            if piece is None:
                piece = merge_bytes(word, self.ranks)
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[word] = piece
            lengths[at] = len(piece)
            pieces.append(piece)
        starts = np.cumsum(lengths) - lengths
        store = np.empty(int(lengths.sum()), np.uint32)
        known = ids >= 0
        store[starts[known]] = ids[known]
        if pieces:
            at = np.repeat(starts[missing] - (np.cumsum(lengths[missing]) - lengths[missing]), lengths[missing])
            store[at + np.arange(len(at))] = np.concatenate([np.asarray(p, np.uint32) for p in pieces]) if len(pieces) < 8 else np.fromiter((i for p in pieces for i in p), np.uint32, len(at))
        place = coded.indices.to_numpy(zero_copy_only=False)
        out = gathered(store, starts[place], lengths[place])
        per_word = np.concatenate([[0], np.cumsum(lengths[place])])
        return out, per_word[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: np.ndarray) -> bytes:
        at = self.v.starts
        picked = ids.astype(np.int64)
        return gathered(self.v.blob, at[picked], at[picked + 1] - at[picked]).tobytes()


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """All given columns, ``ids`` array<int> and ``intact``: each match of the pattern encoded by itself, without special tokens.

    ``intact`` says that the ids decode to the text. Null and empty texts have no ids and are intact; rows that repeat are
    encoded alike. Given columns of these names are replaced. The vocabulary (its size is that of the file) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(ranks_path, pattern))
    kept = docs.drop("ids", "intact")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = pc.fill_null(part.column(part.schema.get_field_index("text")), "").to_pylist()
                ids, offsets = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
                at = offsets.tolist()
                same = [encoder.decode(ids[a:b]) == text.encode() for text, a, b in zip(texts, at, at[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(same, pa.bool_())], names=[*names, "ids", "intact"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, ids array<int>, intact boolean")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """All given columns, and ``decoded`` binary from ``ids``; null ids decode to no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(ranks_path, pattern))
    kept = encoded.drop("decoded")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            texts = [encoder.decode(np.asarray(x.values) if x.is_valid else np.zeros(0, np.int64)) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, decoded binary")


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, as ``encode`` and ``decode`` give them.

    The digests are taken where the ids are made, so neither ids nor bytes leave the task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(ranks_path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encoder.encode(pc.fill_null(part.column(1), "").to_pylist())
                wire, at = ids.astype("<u4").tobytes(), (offsets * 4).tolist()
                decoded = encoder.decode(ids)
                width = np.concatenate([[0], np.cumsum(np.diff(encoder.v.starts)[ids.astype(np.int64)])])[offsets].tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(offsets)),
                        pa.array([hashlib.sha256(wire[a:b]).hexdigest() for a, b in zip(at, at[1:])]),
                        pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(width, width[1:])]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
