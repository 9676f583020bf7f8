"""Near-duplicate documents by a chosen-path set similarity join.

Documents with equal shingle sets are one node. Each of several independent trees branches a set by the two tokens (shingles)
that are smallest under a hash of the path so far, so a path depends on the set alone; two sets of similarity s share each of
the two branches with a chance of about s, and with s above 1/2 some common path survives at any depth. Sets that share a leaf
are compared there, small leaves exhaustively by a sketch of minwise values, and the pairs that pass are confirmed on the
full sets. Crowded leaves branch further by tokens, each along several independent paths. Links that would only repeat a known component are not looked for.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import mix, shingles_of, slices, written
from roadstream.llm.graph import components
from roadstream.llm.lattice import pairs_within

# Trees are added until a pair at the threshold is missed by all of them with a chance below this.
MISSED = 1 / 65536
DEPTH = 3
# A leaf with more rows than a block outside of its main component branches further, up to so many times, by independent paths
# of the smallest token alone, STEPS long. A pair at the threshold loses all of them with a chance below MISSED_DEEPER a time.
DEEPER = 3
STEPS = 4
MISSED_DEEPER = 0.015
BLOCK = 512
# Rows outside of a leaf's main component meet the rows inside in blocks of so many, and are dealt to blocks themselves.
MAIN_BLOCK = 8192
ODD_BLOCK = 2048
# Numbers that a call computes with at a time where a set is very long.
NUMBERS = 1 << 18
# A row that may be linked with some member of a larger component is compared with all of its members, in blocks.
LARGE = 32
MEMBERS_A_BLOCK = 1024
ROWS_A_BUCKET = 16384
BINS = 256
# Pairs that the sketch finds so many deviations below the threshold, or nearer, are confirmed on the sets. Those so many above
# it are likely links, of which a row's smallest partner is as good as any.
BELOW, ABOVE = 5.2, 1.6
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def trees_for(percent: int) -> int:
    """How many trees miss a pair at the threshold with a chance below MISSED, for sets of many tokens.

    A level keeps both branches of a pair in common where its union's two smallest tokens are, and none where neither set's
    second choice makes up for the first.
    """
    s = percent / 100
    none, both = 1 - s * (1 + (1 - s) + (1 - s) ** 2 / 2), s * s
    lost = 0.0
    for _ in range(DEPTH):
        lost = none + (1 - none - both) * lost + both * lost * lost
    return max(1, math.ceil(math.log(MISSED) / math.log(lost))) if lost > 0 else 1


def ways_for(percent: int) -> int:
    """How many independent paths a crowded leaf grows."""
    kept = (percent / 100) ** STEPS
    return max(1, math.ceil(math.log(MISSED_DEEPER) / math.log1p(-kept))) if kept < 1 else 1


def sketch_bounds(percent: int) -> tuple[float, float]:
    """From which similarity by the sketch a pair is confirmed, and from which it is a likely link."""
    s = percent / 100
    deviation = math.sqrt(max(s * (1 - s), 0.04) / BINS)
    return s - BELOW * deviation, s + ABOVE * deviation


def _two_smallest(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.minimum.reduceat(values, starts)
    second = np.minimum.reduceat(np.where(values == np.repeat(first, lengths), _TOP, values), starts)
    return first, np.where(lengths == 1, first, second)


def leaves_of(tokens: np.ndarray, offsets: np.ndarray, trees: int) -> np.ndarray:
    """sets x leaves names of the paths that each non-empty set takes; a name tells the tree and all tokens chosen."""
    starts, lengths = offsets[:-1], np.diff(offsets)
    found = []
    for tree in range(trees):
        paths = [np.full(len(starts), mix(np.array([tree + 1], np.uint64))[0])]
        for _ in range(DEPTH):
            below = []
            for path in paths:
                for chosen in _two_smallest(mix(tokens ^ np.repeat(path, lengths)), starts, lengths):
                    below.append(mix(path * np.uint64(0x9E3779B97F4A7C15) ^ chosen))
            paths = below
        found += paths
    return np.stack(found, 1)


def deeper_leaves(leaves: np.ndarray, tokens: np.ndarray, ways: int) -> np.ndarray:
    """leaves x ways names of the leaves that one set takes below each of its ``leaves``."""
    paths = mix(leaves.astype(np.uint64)[:, None] + mix(np.arange(1, ways + 1, dtype=np.uint64))).ravel()
    at_once = max(1, NUMBERS // len(tokens))
    for start in range(0, len(paths), at_once):
        path = paths[start : start + at_once]
        for _ in range(STEPS):
            path = mix(path * np.uint64(0x9E3779B97F4A7C15) ^ mix(tokens ^ path[:, None]).min(1))
        paths[start : start + at_once] = path
    return paths.reshape(len(leaves), ways)


def sketches_of(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """sets x BINS bytes: of each bin's tokens, eight bits of the smallest hash, and 0 for an empty bin."""
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(offsets))
    keys = (owner << np.uint64(50)) | (mix(tokens + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(14))
    keys.sort()
    place = keys >> np.uint64(50 - (BINS - 1).bit_length())
    first = np.ones(len(keys), bool)
    first[1:] = place[1:] != place[:-1]
    out = np.zeros((len(offsets) - 1) * BINS, np.uint8)
    out[place[first].astype(np.int64)] = (keys[first] & np.uint64(0xFF)).astype(np.uint8) % 255 + 1
    return out.reshape(-1, BINS)


def _set_keys(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    mixed = mix(tokens + np.uint64(0x1D8E4E27C47D124F))
    total, other = np.add.reduceat(mixed, offsets[:-1]), np.bitwise_xor.reduceat(mix(mixed), offsets[:-1])
    return mix(total ^ mix(other + np.diff(offsets).astype(np.uint64))).astype(np.int64)


def placed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, key of the set (null if empty), sketch and leaves of every document."""
    trees = trees_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                tokens, ends = shingles_of(part.column(1), width)
                lengths = np.diff(ends)
                some = np.flatnonzero(lengths)
                keys, sketch, leaves = np.zeros(part.num_rows, np.int64), [None] * part.num_rows, [None] * part.num_rows
                if len(some):
                    offsets = np.concatenate([[0], np.cumsum(lengths[some])])
                    keys[some] = _set_keys(tokens, offsets)
                    rows, names = sketches_of(tokens, offsets), leaves_of(tokens, offsets, trees).astype(np.int64)
                    for i, at in enumerate(some.tolist()):
                        sketch[at], leaves[at] = rows[i].tobytes(), np.unique(names[i])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths), pa.array(keys, mask=lengths == 0), pa.array(sketch, pa.binary()), pa.array(leaves, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "key", "sketch", "leaves"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, key long, sketch binary, leaves array<long>")


def _passing(sketch: np.ndarray, size: np.ndarray, groups: np.ndarray, percent: int, active: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of pairs of one group (rows come sorted by it) that may be similar enough, and the sketch's similarity."""
    least, _ = sketch_bounds(percent)
    ends = np.flatnonzero(np.append(groups[1:] != groups[:-1], True)) + 1
    for a, b in pairs_within(np.diff(ends, prepend=0), 1 << 15, active):
        small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
        keep = np.flatnonzero(100 * small >= percent * large)
        a, b = a[keep], b[keep]
        x, y = sketch[a], sketch[b]
        similar = ((x == y) & (x != 0)).sum(1) / np.maximum(((x | y) != 0).sum(1), 1)
        keep = np.flatnonzero(similar >= least)
        yield a[keep], b[keep], similar[keep]


def _arrays(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sketch = np.frombuffer(b"".join(batch["sketch"]), np.uint8).reshape(-1, BINS)
    return batch["key"].to_numpy(), batch["size"].to_numpy(), sketch


def _bucketed(rows: DataFrame, *group: str) -> DataFrame:
    """Whole groups dealt to buckets of about so many rows, which are handled at a time."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*group), F.lit(max(1, -(-rows.count() // ROWS_A_BUCKET)))))


def stars(leaves: DataFrame, percent: int) -> DataFrame:
    """(a, b, c, leaf, n, led): every row of a block of a leaf with its smallest likely partner and its most similar one.

    Both are null where it has none. ``led`` says that the row has no smaller likely partner, so that it stands for its block
    in the next sweep.
    """
    blocked = leaves.withColumn("block", F.pmod(F.xxhash64("key", F.lit(3)), F.ceil(F.col("n") / BLOCK)))
    _, sure_from = sketch_bounds(percent)

    def sweep(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["leaf", "block", "key"], ignore_index=True)
        key, size, sketch = _arrays(batch)
        none = np.iinfo(np.int64).max
        likely, closest, best = np.full(len(key), none), np.zeros(len(key), np.int64), np.zeros(len(key))
        for a, b, similar in _passing(sketch, size, batch.groupby(["leaf", "block"], sort=False).ngroup().to_numpy(), percent):
            sure = similar >= sure_from
            np.minimum.at(likely, b[sure], key[a[sure]])
            np.minimum.at(likely, a[sure], key[b[sure]])
            one, other, value = np.append(a, b), np.append(b, a), np.append(similar, similar)
            # Of a row's pairs, which come by rising similarity, the last one stays.
            order = np.argsort(value, kind="stable")
            order = order[value[order] > best[one[order]]]
            closest[one[order]], best[one[order]] = key[other[order]], value[order]
        has = best > 0
        # Keys have all 64 bits, so they must not pass through floats on their way to nulls.
        out = batch.assign(a=key, b=pd.arrays.IntegerArray(likely, likely == none), c=pd.arrays.IntegerArray(closest, ~has), led=likely > key)
        # A row without a partner in a leaf of one block has nothing more to tell.
        return out.loc[has | (batch["n"] > BLOCK), ["a", "b", "c", "leaf", "n", "led"]]

    return _bucketed(blocked, "leaf", "block").groupBy("bucket").applyInPandas(sweep, "a long, b long, c long, leaf long, n long, led boolean")


def _edges(swept: DataFrame) -> DataFrame:
    return swept.select("a", F.explode(F.array_distinct(F.array_compact(F.array("b", "c")))).alias("b"))


def crossings(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, whole): pairs of a group (leaf, block) from different components that pass the sketch, one of them ``odd``.

    Where one of the components is large, b names it (whole) and a is the row of the smaller one.
    """

    def sweep(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["leaf", "block", "odd", "key"], ascending=[True, True, False, True], ignore_index=True)
        key, size, sketch = _arrays(batch)
        part, odd, weight = batch["component"].to_numpy(), batch["odd"].to_numpy(), batch["weight"].to_numpy()
        found = [pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "whole": np.zeros(0, bool)})]
        for a, b, _ in _passing(sketch, size, batch.groupby(["leaf", "block"], sort=False).ngroup().to_numpy(), percent, odd):
            keep = np.flatnonzero(part[a] != part[b])
            swap = weight[a[keep]] > weight[b[keep]]
            low, high = np.where(swap, b[keep], a[keep]), np.where(swap, a[keep], b[keep])
            whole = weight[high] > LARGE
            x, y = key[low], key[high]
            found.append(pd.DataFrame({"a": np.where(whole, x, np.maximum(x, y)), "b": np.where(whole, part[high], np.minimum(x, y)), "whole": whole}).drop_duplicates())
        return pd.concat(found).drop_duplicates()

    return _bucketed(rows, "leaf", "block").groupBy("bucket").applyInPandas(sweep, "a long, b long, whole boolean")


def marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows and ``likely``: true where the id is among ``ids`` (column least), and for some other ids whose hash meets a set bit.

    The bits are 2**24 at most, so 2 MB are broadcast whatever the number of ids; texts that no one asks for don't move. With
    very many ids most bits are set, and then most rows are likely. Rows without an id may be marked either way.
    """
    place = lambda name: F.pmod(F.xxhash64(name), F.lit(1 << 24))
    bits = ids.select(place("least").alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    found = docs.withColumn("p", place("doc_id")).join(F.broadcast(bits), F.bitmap_bucket_number("p") == F.col("bucket"), "left")
    at = F.bitmap_bit_position("p")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bitmap_bit_position(p) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    likely = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return found.select(*docs.columns, likely.alias("likely"))


def sets_of(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """(key, tokens) of the sets named by ``chosen`` (key, least): read from one document of each."""
    texts = marked(docs.select("doc_id", "text"), chosen).filter("likely").join(chosen, F.col("doc_id").eqNullSafe(F.col("least"))).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                tokens, ends = shingles_of(part.column(1), width)
                some = np.flatnonzero(np.diff(ends))
                if not len(some):
                    continue
                wanted = part.column(0).to_numpy(zero_copy_only=False)
                same = some[_set_keys(tokens, np.concatenate([[0], np.cumsum(np.diff(ends)[some])])) == wanted[some]]
                yield pa.RecordBatch.from_arrays([pa.array(wanted[same]), pa.array([tokens[ends[i] : ends[i + 1]].tobytes() for i in same], pa.binary())], names=["key", "tokens"])

    # Rows that repeat give their set more than once.
    return texts.mapInArrow(run, "key long, tokens binary").dropDuplicates(["key"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets have 100 * intersection >= percent * union."""
    full = pairs.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(u) + len(v) - len(np.union1d(u, v))
                keep[i] = 100 * common >= percent * (len(u) + len(v) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return full.mapInArrow(run, "a long, b long")


def against_members(rows: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of rows (a, component, tokens) with members (key, component, weight, tokens): one for each row that has any.

    A component's members and its rows are dealt to blocks, and each pair of blocks meets once.
    """
    many = rows.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_A_BLOCK).cast("int").alias("js")).withColumnRenamed("component", "c")
    shape = members.select("component", "weight").distinct().join(many, F.col("component") == F.col("c")).select("c", F.ceil(F.col("weight") / MEMBERS_A_BLOCK).cast("int").alias("is"), "js")
    deal = lambda key, n: F.pmod(F.xxhash64(key, F.lit(9)), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = members.join(shape, F.col("component") == F.col("c")).withColumn("i", deal("key", F.col("is"))).withColumn("j", each(F.col("js"))).select("component", "i", "j", "key", "tokens", F.lit(True).alias("member"))
    right = rows.join(shape, F.col("component") == F.col("c")).withColumn("j", deal("a", F.col("js"))).withColumn("i", each(F.col("is"))).select("component", "i", "j", F.col("a").alias("key"), "tokens", F.lit(False).alias("member"))

    def search(batch: pd.DataFrame) -> pd.DataFrame:
        own, others, found = batch[batch["member"]], batch[~batch["member"]], []
        if len(own) and len(others):
            sets = [np.frombuffer(t, np.uint64) for t in own["tokens"]]
            sizes = np.array([len(t) for t in sets])
            tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            for a, text in zip(others["key"], others["tokens"]):
                own_tokens = np.frombuffer(text, np.uint64)
                start, stop = np.searchsorted(tokens, own_tokens, "left"), np.searchsorted(tokens, own_tokens, "right")
                n = stop - start
                at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                common = np.bincount(owner[at], minlength=len(sets))
                hit = np.flatnonzero(100 * common >= percent * (sizes + len(own_tokens) - common))
                if len(hit):
                    found.append((a, own["key"].iloc[hit[0]]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return left.unionByName(right).groupBy("component", "i", "j").applyInPandas(search, "a long, b long")


def _several(leaves: DataFrame) -> DataFrame:
    """The leaves that hold more than one component, with their most frequent one."""
    counts = leaves.groupBy("leaf", "component").agg(F.count(F.lit(1)).alias("rows"))
    # ``others`` counts the rows outside of the leaf's most frequent component.
    main = counts.groupBy("leaf").agg(F.max(F.struct("rows", "component")).alias("m"), F.sum("rows").alias("n"), F.count(F.lit(1)).alias("parts"))
    return main.filter("parts > 1").select(F.col("leaf").alias("l"), F.col("m.component").alias("main"), F.col("n"), (F.col("n") - F.col("m.rows")).alias("others"))


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of leaves (with n, others and main) in the blocks in which they meet, and whether they are ``odd``.

    Odd rows are those outside of the leaf's main component. They meet all rows of the leaf; the others need not meet each other.
    Both kinds are dealt to blocks; each block of odd rows meets each block of others, and each pair of odd blocks meets.
    """
    odd = F.col("component") != F.col("main")
    blocks = lambda n, most: F.greatest(F.ceil(n / most), F.lit(1)).cast("int")
    i, j = blocks(F.col("others"), ODD_BLOCK), blocks(F.col("n") - F.col("others"), MAIN_BLOCK)
    own = lambda n: F.pmod(F.xxhash64("key", F.lit(5)), n).cast("long")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
    with_main = F.transform(upto(j), lambda at: own(i) * j + at)
    # Names below zero are those of pairs of odd blocks; a single odd block meets itself beside any of the others.
    with_odd = F.when(i > 1, F.transform(upto(i), lambda at: -1 - (F.greatest(own(i), at) * i + F.least(own(i), at)))).otherwise(F.array().cast("array<long>"))
    places = F.when(odd, F.concat(with_main, with_odd)).otherwise(F.transform(upto(i), lambda at: at * j + own(j)))
    return rows.select("leaf", F.explode(places).alias("block"), "key", "size", "sketch", "component", "weight", odd.alias("odd"))


def branched(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows (leaf, key, ...) in their deeper leaves, which the tokens of their sets choose."""
    ways = ways_for(percent)
    # A key is in a bounded number of leaves.
    asked = rows.groupBy("key").agg(F.collect_set("leaf").alias("leaves")).join(sets, "key").select("key", "leaves", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, leaves, tokens in zip(batch.column(0), batch.column(1), batch.column(2)):
                names = deeper_leaves(leaves.values.to_numpy(), np.frombuffer(tokens.as_buffer(), np.uint64), ways).astype(np.int64).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), key.as_py(), np.int64)), pa.array(names)], names=["key", "leaf"])

    alone = rows.select("key", "size", "sketch", "component", "weight").dropDuplicates(["key"])
    return written(asked.mapInArrow(run, "key long, leaf long"), "branched").join(alone, "key").select("leaf", "key", "size", "sketch", "component", "weight")


def remaining(leaves: DataFrame, more_sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Candidates (a, b, whole) between components that share a leaf: leaf, key, size, sketch, component, weight.

    ``more_sets`` gives the token sets of the keys of a table.
    """
    found = None
    live = leaves
    for level in range(DEEPER + 1):
        mixed = written(live.join(_several(live), F.col("leaf") == F.col("l")).drop("l"), "mixed")
        wide = (F.col("others") > BLOCK) & F.lit(level < DEEPER)
        pairs = crossings(dealt(mixed.filter(~wide)), percent)
        found = pairs if found is None else found.unionByName(pairs)
        deeper = mixed.filter(wide)
        if level == DEEPER or deeper.isEmpty():
            break
        live = branched(deeper, more_sets(deeper.select("key").distinct()), percent)
    return found


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Shingles are of ``width`` words, A-Z in lower case; a text with fewer words is one shingle. Documents of similarity
    percent / 100 or more are linked, all but a few by chance (``MISSED`` and the sketch); sets are held as hashes of 50 bits, and equal ones told by 64; component_id is the smallest doc_id reachable, and kept says that it is the row's own.
    Null texts and texts without words have no shingles and no links. Rows that repeat are linked; a row without an id takes
    part but names no component (its component_id is null if it is alone). Other columns are left out.
    """
    rows = written(placed(docs, width, percent), "placed")
    least = rows.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    sets_known = rows.filter("key is not null").select("key", F.col("n_shingles").alias("size"), "sketch", "leaves").dropDuplicates(["key"])
    nodes = written(sets_known, "sets")
    listed = nodes.select("key", F.explode("leaves").alias("leaf"))
    crowded = listed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumnRenamed("leaf", "l")
    shared = listed.join(crowded, F.col("leaf") == F.col("l")).select("leaf", "n", "key")
    leaves = written(shared.join(nodes.select("key", "size", "sketch"), "key"), "leaves")

    swept = written(stars(leaves, percent), "stars")
    pairs = _edges(swept)
    # Rows that stand for their blocks in leaves of several blocks meet once more.
    standing = swept.filter(F.col("led") & (F.col("n") > BLOCK)).select("leaf", F.col("a").alias("key"))
    size = standing.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumnRenamed("leaf", "l")
    again = standing.join(size, F.col("leaf") == F.col("l")).select("leaf", "n", "key").join(nodes.select("key", "size", "sketch"), "key")
    pairs = pairs.unionByName(_edges(stars(again, percent)))
    pairs = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = written(sets_of(docs, wanted.join(least, "key"), width), "tokens")
    links = written(confirmed(pairs, sets, percent), "links")
    parts = components(links)

    weights = parts.groupBy("component").agg(F.count(F.lit(1)).alias("weight"))
    grouped = written(parts.join(weights, "component").select(F.col("node").alias("key"), "component", "weight"), "grouped")
    known = (
        leaves.select("leaf", "key", "size", "sketch").join(grouped, "key", "left")
        .withColumn("component", F.coalesce("component", "key")).withColumn("weight", F.coalesce("weight", F.lit(1)))
    )

    def more_sets(keys: DataFrame) -> DataFrame:
        """The sets read so far, with those of the keys among them."""
        nonlocal sets
        unread = written(keys.join(sets.select("key"), "key", "left_anti"), "unread")
        if not unread.isEmpty():
            sets = sets.unionByName(written(sets_of(docs, unread.join(least, "key"), width), "tokens"))
        return sets

    rest = written(remaining(known, more_sets, percent).distinct(), "rest")
    single = rest.filter("not whole").select("a", "b").join(pairs, ["a", "b"], "left_anti")
    whole = rest.filter("whole").select("a", F.col("b").alias("component"))
    if not rest.isEmpty():
        asked = single.select(F.explode(F.array("a", "b")).alias("key")).unionByName(whole.select(F.col("a").alias("key"))).distinct()
        sets = more_sets(asked)
        members = grouped.filter(F.col("weight") > LARGE).join(sets, "key")
        rows_asked = whole.join(sets.withColumnRenamed("key", "a"), "a").select("a", "component", "tokens")
        more = written(confirmed(single, sets, percent).unionByName(against_members(rows_asked, members, percent)), "links")
        links = links.unionByName(more)
        parts = components(links)

    classes = least.join(parts.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    named = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = written(classes.join(named, "component").select("key", F.col("component_id").alias("found")), "classes")
    component = F.coalesce("found", "doc_id")
    return rows.join(by_key, "key", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
