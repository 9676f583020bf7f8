"""Language identification by a blended-spectrum string kernel with Nystroem landmarks and ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import crc_of_id, gathered_bytes, plain, slices

# n-grams of 1 to 3 bytes, hashed to so many presence features.
LONGEST_GRAM = 3
FEATURES = 4096
# The fit uses about so many labelled rows of each language, and so many of them as landmarks.
ROWS_A_LANGUAGE = 800
LANDMARKS_A_LANGUAGE = 64
RIDGE = 1e-2
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_BLOCK = 512


@dataclass
class KernelModel:
    languages: list[str]
    landmarks: np.ndarray  # landmarks x FEATURES, presence over the root of its size
    weights: np.ndarray  # landmarks x languages


def presence(texts: pa.Array) -> np.ndarray:
    """One row of n-gram presence for each text; n-grams are taken over the whole text's bytes, A-Z in lower case."""
    raw, lengths = gathered_bytes(pc.ascii_lower(plain(texts)))
    row = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    out = np.zeros((len(texts), FEATURES), bool)
    code = np.zeros(len(raw), np.uint32)
    for n in range(1, LONGEST_GRAM + 1):
        count = len(raw) - n + 1
        if count <= 0:
            break
        code = (code[:count] << np.uint32(8)) | raw[n - 1 :]
        whole = row[:count] == row[n - 1 :]
        bucket = ((code ^ np.uint32(n << 28)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - (FEATURES - 1).bit_length())
        out[row[:count][whole], bucket[whole]] = True
    return out


def _scaled(grams: np.ndarray) -> np.ndarray:
    wide = grams.astype(np.float32)
    return wide / np.sqrt(np.maximum(wide.sum(1, keepdims=True), 1))


def fit(grams: np.ndarray, names: list[str]) -> KernelModel:
    """Kernel ridge regression, one language against the rest, in the span of the landmarks."""
    languages = sorted(set(names))
    known = np.array([languages.index(x) for x in names])
    x = _scaled(grams)
    chosen = np.concatenate([np.flatnonzero(known == c)[:LANDMARKS_A_LANGUAGE] for c in range(len(languages))])
    landmarks = x[chosen]
    among, cross = (landmarks @ landmarks.T).astype(np.float64), (x @ landmarks.T).astype(np.float64)
    target = np.where(known[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Languages count alike, whatever their number of rows.
    weight = (1.0 / np.bincount(known))[known][:, None]
    weights = np.linalg.solve(cross.T @ (cross * weight) + RIDGE * among + 1e-8 * np.eye(len(chosen)), cross.T @ (target * weight))
    return KernelModel(languages, landmarks, weights.astype(np.float32))


def predict(model: KernelModel, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    texts = pc.fill_null(texts, "")
    names, scores = [], np.zeros(len(texts))
    for start in range(0, len(texts), _BLOCK):
        part = texts.slice(start, _BLOCK)
        lettered = np.array([_LETTER.search(t) is not None for t in part.to_pylist()], bool)
        values = (_scaled(presence(part)) @ model.landmarks.T) @ model.weights
        best = values.argmax(1)
        names += [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)]
        top = np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)
        scores[start : start + len(part)] = np.where(lettered, top, 0.0)
    return names, scores


def training_rows(labelled: DataFrame, rows_a_language: int) -> tuple[np.ndarray, list[str]]:
    """n-grams and languages of about ``rows_a_language`` rows each, by a digest of the id; texts stay on the executors."""
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for name, count in counts.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, rows_a_language / count))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                grams = np.packbits(presence(part.column(0)), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([g.tobytes() for g in grams], pa.binary()), part.column(1), part.column(2)], names=["grams", "lang", "turn"])

    drawn = labelled.filter(draw < share).select("text", "lang", draw.alias("turn")).mapInArrow(run, "grams binary, lang string, turn double")
    rows = sorted(drawn.collect(), key=lambda r: (r["turn"], r["grams"]))
    grams = np.unpackbits(np.array([np.frombuffer(r["grams"], np.uint8) for r in rows], np.uint8), axis=1) if rows else np.zeros((0, FEATURES))
    return grams.astype(bool), [r["lang"] for r in rows]


def identify(docs: DataFrame, rows_a_language: int = ROWS_A_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; about ``rows_a_language`` rows of each language are learnt from.

    Rows whose id has a CRC of remainder 1 by 3 are held out; so are none without an id (they are not learnt from either).
    A null text, or one without a letter, gets ``und`` and score 0, as does every text if nothing could be learnt.
    Rows that repeat are scored alike; other columns are left out.
    """
    rest = F.pmod(crc_of_id(), F.lit(3))
    labelled = docs.select("doc_id", "text", "lang").filter("doc_id is not null and lang is not null and text is not null").filter(rest != 1).filter(F.col("text").rlike(r"\p{L}"))
    grams, names = training_rows(labelled, rows_a_language)
    model = fit(grams, names) if names else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                if shared.value is None:
                    names, scores = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows)
                else:
                    names, scores = predict(shared.value, part.column(2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(rest == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held, "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
