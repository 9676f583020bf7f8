"""Exact ranked lexical search by blocks of similar documents within each term's posting list.

Documents are kept as vectors of term frequencies and searched shard by shard. Within a shard each posting list that may
matter is clustered: its documents go to the nearest of some documents of the list, by the cosine of random projections,
and each cluster is a block with the coordinatewise maximum of its documents as summary. An item visits its lists from
the heaviest term on. A document counts in the first of them that holds it, so the bound of a block takes this list's
term and the later ones only. A block is skipped when its bound, an integer like the scores, is below the score that
the item's last place has already; all documents of other blocks are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from roadstream.llm.common import slices, written
from roadstream.llm.runs import ASCII_DIGIT, ASCII_LETTER, binaries, runs_of, strings, values_of

# Terms of items that are searched at a time; more items are searched in several rounds.
ROUND_TERMS = 16_384
# Documents scored first, to begin with a threshold. It only decides what can be skipped.
FIRST_DOCS = 16_384
# Cells (documents times terms) of a shard in memory.
SHARD_CELLS = 1 << 24
BLOCK_DOCS = 16
PROJECTIONS = 32

_TERM_BYTE = ASCII_LETTER | ASCII_DIGIT | (np.arange(256) >= 0x80)


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts in order, and the text of each."""
    raw, starts, ends, owner = runs_of(texts, lambda x: _TERM_BYTE[x])
    return strings(raw, starts, ends), owner


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and term, once each. Rows that share an item_id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                terms, owner = _terms(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), terms.cast(pa.string())], names=["item_id", "term"])

    schema = StructType([StructField("item_id", items.schema["item_id"].dataType)]).add("term", "string")
    return items.select("item_id", "text").mapInArrow(run, schema).distinct()


def vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Each document with a term: its number of terms, and the numbers and frequencies of those in ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_string())
        for batch in batches:
            for part in slices(batch, "text"):
                terms, owner = _terms(part.column(1))
                n = np.bincount(owner, minlength=part.num_rows)
                coded = terms.dictionary_encode()
                number = pc.fill_null(pc.index_in(coded.dictionary, known), -1).to_numpy()
                at = number[coded.indices.to_numpy()]
                keys = (owner[at >= 0] * (len(vocabulary) + 1)) + at[at >= 0]
                keys, tf = np.unique(keys, return_counts=True)
                row, term = np.divmod(keys, len(vocabulary) + 1)
                counts = np.bincount(row, minlength=part.num_rows)
                columns = [part.column(0), pa.array(n), binaries(term.astype("<u4"), counts), binaries(tf.astype("<u4"), counts)]
                whole = pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])
                yield whole.filter(pa.array(n > 0))

    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType)]).add("n", "long").add("terms", "binary").add("tfs", "binary")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of ``size`` terms occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, "terms"):
                counts += np.bincount(values_of(part.column(0))[0], minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["term", "df"])

    found = rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(size, np.int64)
    df[found["term"].to_numpy(np.int64)] = found["df"].to_numpy(np.int64)
    return df


@dataclass
class Items:
    """A round of items: their ids, their terms from the heaviest on, and what the corpus says of the terms."""

    ids: pa.Array
    terms: list[np.ndarray]
    weights: np.ndarray
    documents: int
    occurrences: int
    k: int

    def impacts(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        if 50 * int(n.max(initial=0)) * self.documents >= 1 << 63:
            n = n.astype(object)
        m = (50 + 50 * n * self.documents // self.occurrences).astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 20 * m)


@dataclass
class PostingList:
    """The documents of one term, block by block, and each block's maxima over the terms that its items may ask for."""

    docs: np.ndarray
    starts: np.ndarray
    column_of: dict[int, int]
    summary: np.ndarray


class Shard:
    """Some documents in memory, with posting lists that are clustered when an item first needs them."""

    def __init__(self, items: Items, ids: pa.Array, n: np.ndarray, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        self.items = items
        self.ids = ids
        # Ties go to the smaller id; rows without one come first.
        self.place = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy().astype(np.int64)
        rows = np.repeat(np.arange(len(n)), counts)
        self.impact = np.zeros((len(n), len(items.weights)), np.int32)
        self.impact[rows, terms] = items.impacts(np.repeat(n, counts), tfs.astype(np.int64))
        order = np.argsort(terms, kind="stable")
        self.list_docs = rows[order]
        self.list_ends = np.searchsorted(terms[order], np.arange(len(items.weights) + 1), side="left")
        self.highest = self.impact.max(axis=0).astype(np.int64) * items.weights if len(n) else np.zeros(len(items.weights), np.int64)
        self.lists: dict[int, PostingList] = {}
        self.scored_docs = self.scored_blocks = self.met_blocks = 0
        asked: dict[int, set[int]] = {}
        for own in items.terms:
            for i, term in enumerate(own.tolist()):
                asked.setdefault(term, set()).update(own[i:].tolist())
        self.asked = asked
        self._directions: np.ndarray | None = None

    def directions(self) -> np.ndarray:
        if self._directions is None:
            weighed = self.impact.astype(np.float32) * self.items.weights.astype(np.float32)
            signs = np.random.default_rng(11).choice(np.array([-1, 1], np.float32), (weighed.shape[1], PROJECTIONS))
            turned = weighed @ signs
            self._directions = turned / np.maximum(np.linalg.norm(turned, axis=1, keepdims=True), 1e-9)
        return self._directions

    def posting_list(self, term: int) -> PostingList:
        if term not in self.lists:
            docs = self.list_docs[self.list_ends[term] : self.list_ends[term + 1]]
            pivots = docs[:: BLOCK_DOCS]
            if len(pivots) > 1:
                directions = self.directions()
                nearest = np.argmax(directions[docs] @ directions[pivots].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                docs, nearest = docs[order], nearest[order]
                starts = np.flatnonzero(np.diff(nearest, prepend=-1))
            else:
                starts = np.zeros(1, np.int64)
            columns = np.array(sorted(self.asked[term]))
            summary = np.maximum.reduceat(self.impact[np.ix_(docs, columns)], starts, axis=0)
            self.lists[term] = PostingList(docs, np.append(starts, len(docs)), {t: i for i, t in enumerate(columns.tolist())}, summary)
        return self.lists[term]

    def search(self, item: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """The best documents of an item with at least the threshold as score, and above 0: places in the shard and scores."""
        own = self.items.terms[item]
        weights = self.items.weights[own]
        # What documents can have that none of the heavier terms occurs in.
        rest = np.cumsum(self.highest[own][::-1])[::-1]
        seen = np.zeros(len(self.impact), bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        threshold = max(threshold, 1)
        for i, term in enumerate(own.tolist()):
            if rest[i] < threshold:
                break
            if self.list_ends[term] == self.list_ends[term + 1]:
                continue
            found = self.posting_list(term)
            columns = [found.column_of[t] for t in own[i:].tolist()]
            bounds = found.summary[:, columns].astype(np.int64) @ weights[i:]
            kept = np.flatnonzero(bounds >= threshold)
            self.met_blocks += len(bounds)
            self.scored_blocks += len(kept)
            if not len(kept):
                continue
            sizes = found.starts[kept + 1] - found.starts[kept]
            at = np.repeat(found.starts[kept] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            fresh = found.docs[at]
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            self.scored_docs += len(fresh)
            exact = self.impact[np.ix_(fresh, own)].astype(np.int64) @ weights
            good = exact >= threshold
            docs, scores = np.concatenate([docs, fresh[good]]), np.concatenate([scores, exact[good]])
            if len(docs) > self.items.k:
                best = np.lexsort((self.place[docs], -scores))[: self.items.k]
                docs, scores = docs[best], scores[best]
            if len(docs) >= self.items.k:
                threshold = max(threshold, int(scores.min()))
        return docs, scores


def _search_rows(rows: DataFrame, items: Items, thresholds: np.ndarray) -> DataFrame:
    """The candidates of every shard: ``item`` (its number), doc_id and score."""
    id_type = rows.schema["doc_id"].dataType
    shard_docs = max(64, SHARD_CELLS // (len(items.weights) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def results() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            ids, n = table.column("doc_id").combine_chunks(), table.column("n").to_numpy()
            terms, counts = values_of(table.column("terms"))
            tfs, _ = values_of(table.column("tfs"))
            shard = Shard(items, ids, n, counts, terms, tfs)
            item, docs, scores = [], [], []
            for i in range(len(items.terms)):
                found, score = shard.search(i, int(thresholds[i]))
                item.append(np.full(len(found), i))
                docs.append(found)
                scores.append(score)
            columns = [pa.array(np.concatenate(item)), ids.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))]
            return pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

        for batch in batches:
            for start in range(0, batch.num_rows, shard_docs):
                held.append(batch.slice(start, shard_docs))
                if sum(x.num_rows for x in held) >= shard_docs:
                    yield results()
                    held = []
        if held:
            yield results()

    schema = StructType().add("item", "long").add(StructField("doc_id", id_type)).add("score", "long")
    return rows.select("doc_id", "n", "terms", "tfs").mapInArrow(run, schema)


def _best(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _round(docs: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    coded = asked.column("term").combine_chunks().dictionary_encode()
    vocabulary, term = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    ids = asked.column("item_id").combine_chunks()
    names = ids.dictionary_encode(null_encoding="encode")
    item = names.indices.to_numpy()
    rows = written(vectors(docs, vocabulary), "vectors")
    documents, occurrences = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(rows, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    own = [np.array(sorted(x, key=lambda t: (-weights[t], t)), np.int64) for x in _split(term, item, len(names.dictionary))]
    items = Items(names.dictionary, own, weights, documents, max(1, occurrences), k)
    # Any documents give a threshold that is right; some that are chosen by hash give one to begin with.
    every = max(1, documents // FIRST_DOCS)
    some = rows.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(every)) == 0)
    first = _best(_search_rows(some, items, np.zeros(len(own), np.int64)), k).filter(F.col("rank") == k).select("item", "score").toPandas()
    thresholds = np.zeros(len(own), np.int64)
    thresholds[first["item"].to_numpy(np.int64)] = first["score"].to_numpy(np.int64)
    numbers = pa.Table.from_arrays([pa.array(range(len(own)), pa.int64()), items.ids], names=["item", "item_id"])
    found = _best(_search_rows(rows, items, thresholds), k)
    return found.join(F.broadcast(docs.sparkSession.createDataFrame(numbers)), "item").select("item_id", "rank", "doc_id", "score")


def _split(values: np.ndarray, owner: np.ndarray, count: int) -> list[list[int]]:
    order = np.argsort(owner, kind="stable")
    return [x.tolist() for x in np.split(values[order], np.cumsum(np.bincount(owner, minlength=count))[:-1])] if count else []


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` highest-scoring documents of each item with a score above 0: item_id, rank, doc_id, score.

    A text that is null or has no term finds nothing and is not found. Items may share an item_id (their terms are
    united) or have none. Documents that share an id are documents of their own; those without one come first in a tie. Rows
    that repeat are found repeatedly. Other columns are left out; without items or documents there are no rows. Whatever the
    number of items, a round holds about ROUND_TERMS of their terms on the driver.
    """
    asked = written(item_terms(items), "item-terms")
    rounds = math.ceil(asked.count() / ROUND_TERMS)
    schema = StructType([StructField("item_id", items.schema["item_id"].dataType)]).add("rank", "integer")
    result = docs.sparkSession.createDataFrame([], schema.add(StructField("doc_id", docs.schema["doc_id"].dataType)).add("score", "long"))
    for i in range(rounds):
        part = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == i).sort("item_id", "term").toArrow()
        if part.num_rows:
            result = result.unionByName(_round(docs, part, k))
    return result
