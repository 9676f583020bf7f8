from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import prose

from roadstream.llm import search, spelling, token_files

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Ranked search


def searched(rows, items, k=50):
    """item_id, rank, doc_id, score by scoring every document for every item."""
    docs = [(i, [t.translate(CAPITALS) for t in TERM.findall(text or "")]) for i, text in rows]
    docs = [(i, terms) for i, terms in docs if terms]
    count, total = len(docs), sum(len(terms) for _, terms in docs)
    df = {}
    for _, terms in docs:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(t.translate(CAPITALS) for t in TERM.findall(text or ""))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, own in docs:
            m = 50 + (50 * len(own) * count) // total
            score = 0
            for t in terms & set(own):
                tf = own.count(t)
                score += math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_search_equals_scoring_everything_on_edges(spark, edge_docs, edge_rows):
    texts = [r[1] for r in edge_rows]
    items = [(1, texts[5]), (2, "one WORDS 7777"), (3, None), (4, ""), (5, "nowhere-to-be-found"), (6, "é" * 3000), (7, "one"), (7, "two"), (None, "one words"), (8, texts[21])]
    table = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in items], "item_id long, text string, term string, score long, rank long")
    got = found(search.search(edge_docs, table, k=7))
    assert got == searched([r[:2] for r in edge_rows], items, k=7)


def test_search_in_small_shards_and_rounds(spark, monkeypatch):
    """Many copies and ties, a threshold from a few documents, and several rounds of items."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 40)) for _ in range(300)]
    rows = [(i, texts[min(i, 299) if i < 300 else 7]) for i in range(600)]
    items = [(i, prose(rng, 12)) for i in range(12)] + [(99, texts[7])]
    monkeypatch.setattr(search, "SHARD_CELLS", 64 * 20)
    monkeypatch.setattr(search, "FIRST_DOCS", 100)
    monkeypatch.setattr(search, "ROUND_TERMS", 40)
    monkeypatch.setattr(search, "BLOCK_DOCS", 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(search.search(docs, spark.createDataFrame(items, "item_id long, text string"), k=10)) == searched(rows, items, k=10)


def test_search_without_documents_or_items(spark, no_docs, edge_docs):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert search.search(no_docs, items).count() == 0
    empty = search.search(edge_docs, items.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_summaries_skip_most_blocks_of_clustered_documents():
    """Documents of many subjects; an item asks for words of one. Blocks of the others are skipped unscored."""
    rng = random.Random(8)
    subjects = [[f"s{s}w{w}" for w in range(30)] for s in range(40)]
    common = [f"common{w}" for w in range(12)]
    docs = [[*rng.choices(subjects[d % 40], k=12), *rng.choices(common, k=3)] for d in range(4000)]
    vocabulary = sorted({w for s in subjects for w in s} | set(common))
    number = {w: i for i, w in enumerate(vocabulary)}
    df = np.zeros(len(vocabulary), np.int64)
    for d in docs:
        df[[number[w] for w in set(d)]] += 1
    weights = np.array([math.floor(1000 * math.log((2 * 4000 + 2) / (2 * x + 1))) for x in df], np.int64)
    asked = [np.array(sorted({number[w] for w in [*rng.sample(subjects[s], 6), *common[:4]]}, key=lambda t: -weights[t])) for s in range(10)]
    items = search.Items(pa.array(range(10)), asked, weights, 4000, 4000 * 15, 10)
    terms, tfs, counts = [], [], []
    for d in docs:
        own = sorted({number[w] for w in d})
        terms += own
        tfs += [d.count(vocabulary[t]) for t in own]
        counts.append(len(own))
    shard = search.Shard(items, pa.array(range(4000)), np.full(4000, 15), np.array(counts), np.array(terms), np.array(tfs))
    for i in range(10):
        places, scores = shard.search(i, 0)
        exact = shard.impact[:, asked[i]].astype(np.int64) @ weights[asked[i]]
        best = np.lexsort((np.arange(4000), -exact))[:10]
        assert sorted(zip(places.tolist(), scores.tolist())) == sorted(zip(best.tolist(), exact[best].tolist()))
    # All documents with any of an item's terms are some 4,000 of 4,000, as common words are everywhere.
    assert shard.scored_docs < 0.05 * 10 * 4000
    assert 0 < shard.scored_blocks < shard.met_blocks


# Spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows):
    counts = {}
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            counts[word] = counts.get(word, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    forms, near_counts = {}, {}
    for w in words:
        near = [v for v in words if abs(len(v) - len(w)) < 2 and v != w and one_edit(v, w)]
        near_counts[w] = len(near)
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, near_counts[w], words.get(forms[w])))
    return sorted(out)


def grouped(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("group_words, block_words", [(1024, 1024), (8, 16)])
def test_variants_equal_comparing_all_words(spark, monkeypatch, edge_rows, group_words, block_words):
    """Edges, words of a few letters that crowd their groups, chains of forms, and very long words."""
    monkeypatch.setattr(spelling, "GROUP_WORDS", group_words)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block_words)
    rng = random.Random(9)
    rows = [r[:2] for r in edge_rows]
    crowd = ["aaaaaa" + "".join(rng.choices("abé", k=rng.randint(1, 5))) for _ in range(200)]
    rows += [(1000 + i, " ".join(rng.choices(crowd, k=30))) for i in range(40)]
    chain = ["spelling"] * 1200 + ["speling"] * 0 + ["spellings"] * 110 + ["spellingss"] * 10 + ["Éspellingss"] * 2
    rows += [(2000 + i, w) for i, w in enumerate(chain)]
    long = "x" * 3000
    rows += [(5000 + i, w) for i, w in enumerate([long, long, long + "y", long + "y", "z" + long, "z" + long])]
    docs = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in rows], "doc_id long, text string, word string, form string, n long")
    assert grouped(spelling.group_variants(docs)) == variants(rows)


def test_variants_without_rows(spark, no_docs):
    assert spelling.group_variants(no_docs).count() == 0


def test_crc_of_many_runs():
    rng = random.Random(2)
    runs = [bytes(rng.choices(range(256), k=rng.choice([0, 1, 7, 63, 64, 65, 500]))) for _ in range(300)]
    heads = [f"{rng.randint(0, 10**9)}:".encode() for _ in runs]
    raw, ends = np.frombuffer(b"".join(runs), np.uint8), np.cumsum([len(r) for r in runs])
    got = spelling.crcs(raw, ends - [len(r) for r in runs], ends, np.array([zlib.crc32(h) for h in heads], np.uint32))
    assert got.tolist() == [zlib.crc32(h + r) for h, r in zip(heads, runs)]


# Token files


def library(path, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return [x.ids for x in model.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(name):
    path = public_tokenizers.path(name)
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "é", "1", "'s", "'", "!", "<|endoftext|>", "漢", "　", "Z9", "\x7f", "\0", "×", "ö", ".", "\r\n", "I'll", "́", "ñ,"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(20000)] + [None, "", " ", "word " * 5000, "é" * 5000]
    ids, counts = token_files.Encoder(path).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [x + [0] for x in library(path, texts)]


def test_a_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_PIECES", 5)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_files.Encoder(path)
    for text in ("one two three four five six seven", "one two", "eight nine ten"):
        assert encoder.encode(pa.array([text]))[0].tolist() == [*library(path, [text])[0], 0]


@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 1003])
def test_coded_values_come_back(count):
    rng = np.random.default_rng(count)
    values = rng.integers(0, 2**32, count, dtype=np.uint32) >> rng.integers(0, 32, count, dtype=np.uint32)
    control, data = token_files.pack(values)
    assert len(control) == -(-count // 4)
    assert len(data) == sum(1 if v < 256 else 2 if v < 65536 else 3 if v < 2**24 else 4 for v in values.tolist())
    assert token_files.unpack(control, data, count).tolist() == values.tolist()


@pytest.mark.parametrize("block_ids", [1 << 20, 50])
def test_token_files_on_edges(spark, edge_docs, edge_rows, tmp_path, monkeypatch, block_ids):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block_ids)
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(edge_docs.repartition(4), str(tmp_path), path)
    tokens = token_files.read_tokens(spark, str(tmp_path))
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.start, bytes(r.ids), r.n_tokens) for r in tokens.collect())
    expected = [np.array([*x, 0], "<u4").tobytes() for x in library(path, [r[1] for r in edge_rows])]
    assert sorted((r[0], r[2]) for r in rows) == sorted(((r[0] is not None, r[0] or 0), x) for r, x in zip(edge_rows, expected))
    # In the order of ids, each document starts where the one before ends.
    start = 0
    for _, begin, ids, n in rows:
        assert begin == start and n == len(ids) // 4
        start += n
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.checksums(tokens).collect()}
    assert all(sums[key if present else None, begin] == zlib.crc32(ids) for (present, key), begin, ids, _ in rows)
    ranks = spark.read.parquet(f"{tmp_path}/ranks").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)


def test_equal_rows_are_dealt_to_several_parts(spark, tmp_path):
    docs = spark.range(20000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    token_files.write_tokens(docs, str(tmp_path), public_tokenizers.path("byte_bpe_50k.json"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{tmp_path}/blocks").select("part").distinct().count() > 1
    starts = [r.start for r in token_files.read_tokens(spark, str(tmp_path)).orderBy("start").collect()]
    assert starts == list(range(0, 80000, 4))


def test_token_files_without_rows(spark, no_docs, tmp_path):
    token_files.write_tokens(no_docs, str(tmp_path), public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read_tokens(spark, str(tmp_path)).count() == 0
