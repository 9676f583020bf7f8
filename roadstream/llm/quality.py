"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import crc_of_id, mix, slices, string_hashes, words_of

BITS = 18
# About so many labelled rows are learnt from, drawn by a digest of the id.
TRAIN_ROWS = 8000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
KEEP_FROM = 0.3
FAMILIES = 4
_SCALE = 4.0


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of every text: indices, values, and offsets.

    The n-grams are words, pairs of words, and one to three *forms* of words: letters by their case, digits, other signs as
    they stand, and a mark for a word that repeats the one before. The values of a family sum to a constant in each text.
    """
    words, offsets = words_of(texts, lower=False)
    counts = np.diff(offsets)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(len(counts) + 1, np.int64)
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    place = coded.indices.to_numpy(zero_copy_only=False)
    form = pc.replace_substring_regex(coded.dictionary, r"\p{Lu}\p{Lu}+", "AA")
    form = pc.replace_substring_regex(form, r"[\p{Ll}\p{Lo}]+", "a")
    form = pc.replace_substring_regex(form, r"\p{Nd}+", "0")
    surface, shape = string_hashes(pc.utf8_lower(coded.dictionary))[place], string_hashes(form)[place]
    first = np.zeros(len(place), bool)
    first[offsets[:-1][counts > 0]] = True
    repeats = np.zeros(len(place), bool)
    repeats[1:] = (surface[1:] == surface[:-1]) & ~first[1:]
    shape = shape + repeats * np.uint64(0x51ED270B)
    before = lambda h, n: np.concatenate([np.zeros(n, np.uint64), h[:-n]]) if n < len(h) else np.zeros(len(h), np.uint64)
    pair = mix(surface * np.uint64(3) + np.where(first, np.uint64(0), before(surface, 1)))
    second = np.concatenate([[False], first[:-1]]) | first
    shape_2 = np.where(first, np.uint64(0), before(shape, 1))
    shape_3 = np.where(second, np.uint64(0), before(shape, 2))
    families = [surface, pair, mix(shape + np.uint64(7)), mix(mix(shape * np.uint64(5) + shape_2) + shape_3)]
    hashed = np.stack([(mix(f + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64) for k, f in enumerate(families)], 1)
    row = np.repeat(np.arange(len(counts)), counts)
    values = np.repeat((_SCALE / counts[row]).astype(np.float32), FAMILIES)
    return hashed.ravel(), values, offsets * FAMILIES


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal with a rate of its own for each weight; the last weight is the bias."""
    z, n, w = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = bias_n = 0.0
    for _ in range(epochs):
        for index, value, label in rows:
            zi, ni = z[index], n[index]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1.0 / (1.0 + np.exp(-np.clip(wi @ value + bias, -35, 35)))
            g = (p - label) * value
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[index] = zi + g - sigma * wi
            n[index] = ni + g * g
            bias_n += (p - label) ** 2
            bias -= 0.3 * (p - label) / np.sqrt(1.0 + bias_n)
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return np.append(w, bias)


def _merged(index: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(index, return_inverse=True)
    return distinct.astype(np.int32), np.bincount(inverse, value, len(distinct)).astype(np.float32)


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """About ``most`` labelled documents as sparse vectors; an id that bears both labels is not learnt from."""
    known = labels.filter("doc_id is not null and quality in (0, 1)").filter(F.pmod(crc_of_id(), F.lit(5)) != 0)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality")), F.lit(1 << 20))
    share = min(1.0, most / max(1, known.count()))
    drawn = (
        known.filter(draw < int(share * (1 << 20))).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other").select(F.col("doc_id").alias("labelled"), "quality")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                index, value, at = features(part.column(1))
                both = [_merged(index[a:b], value[a:b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([i for i, _ in both], pa.list_(pa.int32())), pa.array([v for _, v in both], pa.list_(pa.float32())), part.column(2)],
                    names=["doc_id", "index", "value", "quality"],
                )

    # The drawn rows are few; the documents are filtered by them before any text moves.
    chosen = docs.select("doc_id", "text").filter(draw < int(share * (1 << 20))).join(drawn, F.col("doc_id") == F.col("labelled")).select("doc_id", "text", F.col("quality").cast("int"))
    vectors = chosen.mapInArrow(run, "doc_id long, index array<int>, value array<float>, quality int")
    rows = []
    # The rows are views of what was received; nothing is copied.
    for batch in vectors.toArrow().to_batches():
        ids, index, value, label = batch.columns
        at = index.offsets.to_numpy()
        words, weights = index.values.to_numpy(), value.values.to_numpy()
        rows += [(d, words[x:y], weights[x:y], q) for d, q, x, y in zip(ids.to_pylist(), label.to_pylist(), at, at[1:])]
    rows.sort(key=lambda r: r[0])
    return [rows[i][1:] for i in np.random.default_rng(5).permutation(len(rows))]


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    return fit(training_rows(docs, labels, train_rows))


def scores_of(weights: np.ndarray, texts: pa.Array) -> np.ndarray:
    index, value, at = features(texts)
    total = np.zeros(len(texts))
    filled = np.flatnonzero(np.diff(at))
    if len(filled):
        total[filled] = np.add.reduceat(weights[index] * value, at[:-1][filled])
    return 1.0 / (1.0 + np.exp(-np.clip(total + weights[-1], -35, 35)))


def score(docs: DataFrame, weights: np.ndarray, keep_from: float = KEEP_FROM) -> DataFrame:
    """All given columns, and score (0 to 1) and predicted (1 from ``keep_from`` on) of every whole text.

    Null and empty texts get the score of the bias alone; repeated rows score alike. Given columns of these names go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.drop("score", "predicted")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                found = scores_of(shared.value, part.column(part.schema.get_field_index("text")))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found), pa.array((found >= keep_from).astype(np.int32))], names=[*names, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learnt from about ``train_rows`` labelled ones.

    Rows whose id has a CRC divisible by 5 are held out. Rows without an id are scored and not held out; without labels
    every score is 0.5. Other columns are left out.
    """
    held = F.coalesce(F.pmod(crc_of_id(), F.lit(5)) == 0, F.lit(False)).alias("held_out")
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text"), train(docs, labels, train_rows))
    return scored.select("doc_id", "held_out", "score", "predicted")
