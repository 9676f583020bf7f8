"""Grouping of spelling variants: words one inserted, deleted or replaced code point apart, by a bit-sliced index.

The vocabulary is counted over whole texts. Two near words agree in the first or in the last half of the shorter one,
so words that share such a half are compared, and no others. A task compares blocks of whole groups: for each position
and letter one bit per word of the block says whether the word has it there, and each word runs through its letters
once, holding for all others at a time (64 a machine word) which are still equal, which differ by one replaced letter,
and which are one letter shorter or longer, the last two with positions shifted by one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import slices, written
from roadstream.llm.runs import ASCII_LETTER, runs_of, strings

SHORTEST = 7
DELETE_EVERY = 31
# Words of a group beyond this are dealt to blocks that meet in pairs; fewer where words are very long.
GROUP_WORDS = 1024
GROUP_LETTERS = 1 << 21
# A task gathers whole groups to about so many words before it compares them.
BLOCK_WORDS = 1024
COUNTED_WORDS = 1 << 18

def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def latin(raw: np.ndarray) -> np.ndarray:
    """Which bytes belong to A-Z, a-z or U+00C0 to U+00FF; the latter are the two-byte characters that begin with 0xC3."""
    letter = ASCII_LETTER[raw]
    lead = raw == 0xC3
    letter |= lead
    letter[1:] |= lead[:-1]
    return letter


def crcs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each stretch of ``raw``, going on from the crc32 of what comes before it."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    starts, falling = starts[order], -sizes[order]
    state = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    for at in range(min(64, int(-falling[0])) if len(order) else 0):
        alive = int(np.searchsorted(falling, -at, side="left"))
        state[:alive] = _CRC[(state[:alive] ^ raw[starts[:alive] + at]) & 0xFF] ^ (state[:alive] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    # The rest of very long runs, one by one.
    for i in range(int(np.searchsorted(falling, -64, side="left"))):
        state[i] = zlib.crc32(raw[starts[i] + 64 : starts[i] - falling[i]].tobytes(), int(state[i]))
    out = np.empty(len(order), np.uint32)
    out[order] = state
    return out


def words_of(ids: list, texts: pa.Array) -> pa.Array:
    """All words of some documents, repeats included, after the deletions that the ids and runs decide."""
    raw, starts, ends, owner = runs_of(texts, latin)
    points = np.cumsum((raw & 0xC0) != 0x80)
    lengths = points[ends - 1] - points[starts] + 1
    keep = lengths >= SHORTEST
    starts, ends, owner, lengths = starts[keep], ends[keep], owner[keep], lengths[keep]
    heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    hashes = crcs(raw, starts, ends, heads[owner]) if len(starts) else np.zeros(0, np.uint32)
    cut = hashes % DELETE_EVERY == 0
    shorter = []
    for i in np.flatnonzero(cut & (lengths > SHORTEST)).tolist():
        word = raw[starts[i] : ends[i]].tobytes().decode()
        at = int(hashes[i]) % len(word)
        shorter.append(word[:at] + word[at + 1 :])
    return pa.concat_arrays([strings(raw, starts[~cut], ends[~cut]), pa.array(shorter, pa.large_string())])


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of every word of at least seven code points that occurs at least twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                coded = words_of(part.column(0).to_pylist(), part.column(1)).dictionary_encode()
                found = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
                for word, n in zip(coded.dictionary.to_pylist(), found.tolist()):
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > COUNTED_WORDS:
                    yield rows()
                    counts = {}
        if counts:
            yield rows()

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n >= 2")


def _halves(length: Column) -> Column:
    """The groups of a word, for pairs with a shorter word of ``m`` code points: it may be that one or one longer."""
    parts = []
    for m in (length, length - 1):
        half = F.floor(m / 2).cast("int")
        rest = m - half
        parts += [
            F.struct(m.alias("m"), F.lit(0).alias("side"), F.substring("word", F.lit(1), half).alias("half")),
            F.struct(m.alias("m"), F.lit(1).alias("side"), F.substring("word", length - rest + 1, rest).alias("half")),
        ]
    return F.filter(F.array(*parts), lambda x: x["m"] >= SHORTEST)


def cells(words: DataFrame) -> DataFrame:
    """Each word in the cells where it meets the words that share one of its halves: ``cell, m, side, own, pair, word, n``."""
    rows = written(words.select("word", "n", F.explode(_halves(F.char_length("word"))).alias("g")).select("word", "n", "g.*"), "halves")
    key = ["m", "side", "half"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter("size >= 2")
    most = F.greatest(F.lit(8), F.least(F.lit(GROUP_WORDS), F.floor(F.lit(GROUP_LETTERS) / F.col("m"))))
    blocks = F.ceil(F.col("size") / most)
    # In a group of several blocks each two of them meet in a cell, and so does each block with itself.
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    other = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    met = rows.join(sizes.select(*key, blocks.alias("blocks")), key).withColumn("own", own)
    met = met.select("*", F.explode(F.transform(other, lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))).alias("c"))
    return met.select(F.concat_ws("/", "m", "side", "half", "c.i", "c.j").alias("cell"), "m", "side", "own", (F.col("c.i") != F.col("c.j")).alias("pair"), "word", "n")


def _bits(table: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(table, axis=1, bitorder="little")
    out = np.zeros((len(table), -(-packed.shape[1] // 8) * 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def near_pairs(words: list[str], group: np.ndarray, own: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both directions of all pairs of words of one group that are one edit apart.

    ``own`` is the block of a word within its group; in a group marked ``pair`` only words of different blocks meet.
    """
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    words, sizes, group, own, pair = [words[i] for i in order], sizes[order], group[order], own[order], pair[order]
    count, longest = len(words), int(sizes[-1])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    begins = np.cumsum(sizes) - sizes
    # The words each word may meet: of its own group, and of the other block where two blocks meet.
    _, group = np.unique(group, return_inverse=True)
    low = np.full(group.max() + 1, own.max())
    np.minimum.at(low, group, own)
    lower = low[group] == own
    side = group * 3 + np.where(pair, np.where(lower, 1, 2), 0)
    wanted = group * 3 + np.where(pair, np.where(lower, 2, 1), 0)
    kinds = np.unique(side)
    masks = np.vstack([_bits(kinds[:, None] == side[None, :]), np.zeros((1, -(-count // 64)), np.uint64)])
    at = np.searchsorted(kinds, wanted)
    at[(at >= len(kinds)) | (kinds[np.minimum(at, len(kinds) - 1)] != wanted)] = len(kinds)
    equal = masks[at]
    replaced, shorter, longer = np.zeros_like(equal), np.zeros_like(equal), np.zeros_like(equal)
    lengths = np.unique(sizes)
    of_length = dict(zip(lengths.tolist(), _bits(lengths[:, None] == sizes[None, :])))
    nothing = np.zeros(equal.shape[1], np.uint64)

    def slice_at(position: int) -> tuple[np.ndarray, np.ndarray]:
        """The letters that words have at a position, and for each which words; the last row is for letters none has."""
        first = int(np.searchsorted(sizes, position, side="right"))
        held = flat[begins[first:] + position]
        letters = np.unique(held)
        table = np.zeros((len(letters) + 1, count), bool)
        table[np.searchsorted(letters, held), np.arange(first, count)] = True
        return letters, _bits(table)

    empty = (np.zeros(0, np.uint32), np.zeros((1, equal.shape[1]), np.uint64))
    before, here = empty, slice_at(0)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    done = 0
    for i in range(longest + 1):
        ended = int(np.searchsorted(sizes, i, side="right"))
        if ended > done:
            hits = replaced[done:ended] & of_length[i]
            hits |= shorter[done:ended] & of_length.get(i - 1, nothing)
            hits |= (longer[done:ended] | equal[done:ended]) & of_length.get(i + 1, nothing)
            row, word = np.nonzero(hits)
            bits = np.unpackbits(hits[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pick, bit = np.nonzero(bits)
            found.append((row[pick] + done, word[pick] * 64 + bit))
            done = ended
        if done == count:
            break
        after = slice_at(i + 1) if i + 1 < longest else empty
        query = flat[begins[done:] + i]

        def having(one: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
            letters, bits = one
            place = np.searchsorted(letters, query)
            known = place < len(letters)
            known[known] = letters[place[known]] == query[known]
            return bits[np.where(known, place, len(letters))]

        same, left, right = having(here), having(before), having(after)
        e, r, s, l = equal[done:], replaced[done:], shorter[done:], longer[done:]
        # One error: a replaced letter at one position, the word's own letter left out, or a letter of the other skipped.
        r &= same
        r |= e & ~same
        s &= left
        s |= e
        l |= e
        l &= right
        e &= same
        before, here = here, after
    a = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int64)
    return order[a], order[b]


PAIR = "word string, n long, near string, near_n long"


def pairs(words: DataFrame) -> DataFrame:
    """Every near word of every word, once: ``word, n, near, near_n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compared(rows: pa.Table) -> pa.RecordBatch:
            names = ["cell", "m", "side", "own", "pair", "word", "n"]
            cell, m, side, own, pair, word, n = (rows.column(x) for x in names)
            texts = word.to_pylist()
            coded = cell.combine_chunks().dictionary_encode()
            m, side, own, n = (x.to_numpy() for x in (m, side, own, n))
            a, b = near_pairs(texts, coded.indices.to_numpy(), own, pair.to_numpy())
            sizes = np.array([len(w) for w in texts])
            right = np.minimum(sizes[a], sizes[b]) == m[a]
            a, b = a[right], b[right]
            # A pair with equal first halves is found there; with equal last halves it is not taken again.
            fresh = [not s or texts[x][: k // 2] != texts[y][: k // 2] for x, y, s, k in zip(a.tolist(), b.tolist(), side[a].tolist(), m[a].tolist())]
            a, b = a[np.array(fresh, bool)], b[np.array(fresh, bool)]
            out = pa.array(texts, pa.string())
            return pa.RecordBatch.from_arrays([out.take(pa.array(a)), pa.array(n[a]), out.take(pa.array(b)), pa.array(n[b])], names=["word", "n", "near", "near_n"])

        def ready(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            """Compare whole cells, about BLOCK_WORDS at a time, and hold back the last, which may go on."""
            nonlocal held
            cell = rows.column("cell").combine_chunks()
            change = np.flatnonzero(np.array(cell.slice(1).to_pylist(), object) != np.array(cell.slice(0, len(cell) - 1).to_pylist(), object)) + 1
            ends = np.append(change, rows.num_rows) if last else change
            letters = np.concatenate([[0], np.cumsum(rows.column("m").to_numpy().astype(np.int64) + 1)])
            start = 0
            for k, end in enumerate(ends.tolist()):
                after = ends[k + 1] if k + 1 < len(ends) else None
                if after is None or after - start > BLOCK_WORDS or letters[after] - letters[start] > GROUP_LETTERS:
                    yield compared(rows.slice(start, end - start))
                    start = end
            held = rows.slice(start).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= 8 * BLOCK_WORDS:
                yield from ready(pa.Table.from_batches(held), last=False)
        if held:
            yield from ready(pa.Table.from_batches(held), last=True)

    dealt = cells(words).repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, PAIR)


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts of ``docs`` (doc_id, text).

    Words are runs of Latin letters of whole texts, A-Z lower-cased; of a run whose crc32 with its document's id
    says so, one code point is left out. A null text has no words; a row without an id counts as one with an empty id;
    rows that repeat count again. Ties between near words go to the first in code-point order. No rows give no rows;
    other columns are left out.
    """
    words = written(vocabulary(docs), "words")
    found = written(pairs(words), "near")
    # The near word of largest n, then the first: Spark compares texts by their bytes, which is code-point order.
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form")))
    by_word = found.groupBy(F.col("word").alias("w")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = F.expr("-best.n >= 10 * n")
    chosen = words.join(by_word, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    chosen = written(chosen, "forms")
    roots = _roots(chosen.filter("form is not null").select("word", F.col("form").alias("root")))
    result = chosen.join(roots.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left")
    return result.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """Follow steps to their last word; each round doubles the steps, and n grows tenfold a step, so rounds are few."""
    steps = written(steps, "roots")
    while True:
        further = steps.select(F.col("word").alias("w"), F.col("root").alias("next"))
        joined = steps.join(further, F.col("root") == F.col("w"), "left")
        if joined.filter("next is not null").isEmpty():
            return steps
        steps = written(joined.select("word", F.coalesce("next", "root").alias("root")), "roots")
