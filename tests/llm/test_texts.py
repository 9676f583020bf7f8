"""Near-duplicates, language, quality, counts, personal data, byte pairs and scores on edge cases and by brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from tests.llm.conftest import prose

import public_tokenizers as tokenizers_at
from roadstream.llm import bpe, common, context_tree, graph, language, minhash, mixing, pii, quality, token_counts

RANKS, PATTERN = tokenizers_at.path("byte_bpe_50k.tiktoken"), tokenizers_at.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lowered(text))


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(rows, width, percent=80):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    out = [least.get(root(i)) if sets[i] else d for i, (d, _) in enumerate(rows)]
    return sorted(((d, len(s), c, d is not None and d == c) for (d, _), s, c in zip(rows, sets, out)), key=str)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, edge_docs, edge_rows, width):
    got = sorted((tuple(r) for r in minhash.near_duplicates(edge_docs, width).collect()), key=str)
    assert got == brute_components([r[:2] for r in edge_rows], width)


@pytest.mark.parametrize("percent", [70, 80])
def test_near_copies_of_many_kinds(spark, monkeypatch, percent):
    """Chains of edits, with leaves and blocks so small that every way of comparing is taken."""
    for name, value in {"BLOCK": 8, "MAIN_BLOCK": 16, "ODD_BLOCK": 4, "NUMBERS": 200, "LARGE": 4, "MEMBERS_A_BLOCK": 8, "ROWS_A_BUCKET": 64}.items():
        monkeypatch.setattr(minhash, name, value)
    rng = random.Random(7)
    rows = []
    for _ in range(4):
        text = prose(rng, 60).split()
        for _ in range(30):
            rows.append((len(rows), " ".join(text)))
            copy = list(text)
            for at in rng.sample(range(60), rng.choice([1, 2, 4, 7])):
                copy[at] = prose(rng, 1)
            if rng.random() < 0.6:
                text = copy
            rows.append((len(rows), " ".join(copy)))
    got = sorted((tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, percent).collect()), key=str)
    assert got == brute_components(rows, 2, percent)


def test_a_crowded_leaf_is_dealt_to_blocks_that_all_meet(spark, monkeypatch):
    """Every odd row meets every other row of its leaf, and no block holds more than its share."""
    monkeypatch.setattr(minhash, "ODD_BLOCK", 10)
    monkeypatch.setattr(minhash, "MAIN_BLOCK", 20)
    for main, others in ((90, 70), (90, 5), (15, 40), (1, 30)):
        rows = [(1, k, 5, b"", 0 if k < main else k, 1, 0, main + others, others) for k in range(main + others)]
        table = spark.createDataFrame(rows, "leaf long, key long, size long, sketch binary, component long, weight long, main long, n long, others long")
        blocks = {}
        for r in minhash.dealt(table).collect():
            blocks.setdefault(r["block"], []).append((r["key"], r["odd"]))
        met = {frozenset((a, b)) for rows in blocks.values() for a, odd in rows for b, _ in rows if odd and a != b}
        assert met == {frozenset((a, b)) for a in range(main, main + others) for b in range(main + others) if a != b}
        assert max(len(rows) for rows in blocks.values()) < 3 * (10 + 20)


def test_texts_of_one_template_part_below_a_crowded_leaf():
    """Eight of fourteen shingles in common: no links, but most texts choose the same tokens at first."""
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 1 << 50, 8, dtype=np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 50, 6, dtype=np.uint64)])) for _ in range(4000)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    leaves = minhash.leaves_of(np.concatenate(sets), offsets, minhash.trees_for(80))
    names, counts = np.unique(leaves, return_counts=True)
    crowded = names[counts.argmax()]
    assert counts.max() > 2000
    live = [(crowded, x) for x, own in zip(sets, leaves) if crowded in own]
    widest = [len(live)]
    # As ``remaining`` does, only crowded leaves go on.
    for _ in range(minhash.DEEPER):
        below = {}
        for leaf, x in live:
            for name in minhash.deeper_leaves(np.array([leaf]), x, minhash.ways_for(80)).ravel().tolist():
                below.setdefault(name, []).append(x)
        widest.append(max(map(len, below.values())))
        live = [(np.uint64(name), x) for name, inside in below.items() if len(inside) > minhash.BLOCK for x in inside]
        if not live:
            break
    assert widest[1] < widest[0] / 3
    assert widest[-1] <= minhash.BLOCK


@pytest.mark.parametrize(("percent", "union"), [(80, 50), (80, 1000), (70, 200)])
def test_pairs_at_the_threshold_meet(percent, union):
    """They share a leaf and pass the sketch; below a crowded leaf they still share one of the paths nearly always."""
    rng = np.random.default_rng(percent + union)
    common, left = union * percent // 100, union * (100 - percent) // 200
    pairs = 600
    met = passed = deeper = 0
    least, _ = minhash.sketch_bounds(percent)
    for _ in range(pairs):
        tokens = rng.integers(0, 1 << 50, union, dtype=np.uint64)
        x, y = np.sort(tokens[: common + left]), np.sort(np.delete(tokens, slice(common, common + left)))
        both, ends = np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])
        a, b = minhash.leaves_of(both, ends, minhash.trees_for(percent))
        met += len(np.intersect1d(a, b)) > 0
        p, q = minhash.sketches_of(both, ends)
        passed += ((p == q) & (p != 0)).sum() >= least * ((p | q) != 0).sum()
        top = np.array([7])
        deeper += len(np.intersect1d(minhash.deeper_leaves(top, x, minhash.ways_for(percent)), minhash.deeper_leaves(top, y, minhash.ways_for(percent)))) > 0
    assert (met, passed) == (pairs, pairs)
    assert deeper >= 0.96 * pairs


def test_no_documents(spark, no_docs, tmp_path):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert language.identify(no_docs).count() == 0
    assert quality.classify(no_docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    assert token_counts.token_counts(no_docs, tokenizers_at.path("byte_bpe_50k.json"), str(tmp_path / "c")).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert pii.detect(no_docs).count() == 0
    assert bpe.round_trip_digests(no_docs, RANKS, PATTERN).count() == 0
    assert context_tree.score(no_docs).count() == 0


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (200, 201), (201, 202), (200, 202)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 200 for i in (200, 201, 202)}}


def test_words_of_a_slice():
    texts = pa.array(["skipped", "A b\tc", None, " \n", "d"]).slice(1)
    found, offsets = common.words_of(texts)
    assert found.to_pylist() == ["a", "b", "c", "d"] and offsets.tolist() == [0, 3, 3, 3, 4]


def test_language_on_edges(edge_docs, edge_rows):
    got = language.identify(edge_docs).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "und")
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    named = {r["doc_id"]: r["lang_pred"] for r in got}
    assert [named[i] for i in (0, 1, 2, 11)] == ["und"] * 4 and named[10] == "en"


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (both["lang"] == both["lang_pred"]).mean() > 0.97


def test_quality_on_edges_and_held_out(spark, edge_docs, edge_rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (4, 7), (5, 0), (5, 1)], "doc_id long, quality int")
    got = quality.classify(edge_docs, labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    at = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    both = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (both["predicted"] == both["quality"]).mean() > 0.95


def test_token_counts_and_cache(spark, edge_docs, edge_rows, tmp_path):
    from tokenizers import Tokenizer

    path, cache = tokenizers_at.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    model = Tokenizer.from_file(path)
    count = {t: len(model.encode(t or "", add_special_tokens=False)) for t in {r[1] for r in edge_rows}}
    expected = sorted(((r[0], len((r[1] or "").encode()), count[r[1]], count[r[1]] > 512) for r in edge_rows), key=str)
    for _ in range(2):
        assert sorted((tuple(r) for r in token_counts.token_counts(edge_docs, path, cache).collect()), key=str) == expected
        # The second call finds everything in the cache and adds nothing.
        assert spark.read.parquet(cache).count() == len({r[1] or "" for r in edge_rows})
    token_counts.token_counts(edge_docs, tokenizers_at.path("piece_bpe_32k.model"), cache).count()
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_pairs_equal_the_library(edge_docs, edge_rows):
    own = encoding()
    expected = []
    for r in edge_rows:
        ids = own.encode_ordinary(r[1] or "")
        expected.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in bpe.round_trip_digests(edge_docs, RANKS, PATTERN).collect()), key=str) == sorted(expected, key=str)
    encoded = bpe.encode(edge_docs, RANKS, PATTERN)
    assert encoded.columns == [*edge_docs.columns, "ids", "intact"] and encoded.filter("not intact").isEmpty()
    back = bpe.decode(encoded, RANKS, PATTERN).select("text", "decoded").collect()
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back)


def test_byte_pairs_of_random_texts():
    rng, own = random.Random(1), encoding()
    encoder = bpe.Encoder(bpe.load_vocabulary(RANKS, PATTERN))
    texts = ["".join(rng.choices("ab e\n\t\x1c\x85  'sté1٣!🙂中\x00", k=rng.randint(0, 50))) for _ in range(3000)]
    ids, at = encoder.encode(texts)
    assert all(ids[at[i] : at[i + 1]].tolist() == own.encode_ordinary(t) for i, t in enumerate(texts))
    # The hash is minimal and perfect.
    assert sorted(encoder.v.slot_id.tolist()) == list(range(len(encoder.tokens)))


def brute_base(text):
    """The patterns as they are stated."""
    found = []
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (True, k == 1 and all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15)[k]
            if good:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_base_patterns_equal_the_stated_ones():
    rng = random.Random(2)
    for _ in range(20000):
        text = "".join(rng.choices("a1.@_-+ %()é", k=rng.randint(1, 40)))
        assert pii.base_spans(text) == brute_base(text)


def test_pii_on_edges(edge_docs, edge_rows):
    got = pii.detect(edge_docs).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        base = brute_base(r["text"] or "")
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        assert (r["redacted"] is None) == (r["text"] is None)
    assert {r["redacted"] for r in got if r["doc_id"] == 12} == {"<email> <ip> <phone>"}


def test_the_field_adds_what_the_patterns_miss():
    field = pii.train()
    texts = ['the token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" and', "call (212) 555-0147 now", "Version 2.0 of 2019, page 12", "plain words only"]
    found = pii.added_spans(field, texts, [pii.base_spans(t) for t in texts])
    assert [[(pii.KINDS[k], t[s:e]) for s, k, e in f] for t, f in zip(texts, found)] == [
        [("secret", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b")], [("phone", "(212) 555-0147")], [], []
    ]


def test_a_long_table_beside_many_islands(monkeypatch):
    """Memory follows the words, not islands times the longest one; block borders change nothing."""
    field, rng = pii.train(), random.Random(3)
    line = lambda: [rng.choice(["call", "(212)", "555-0147", "10.0.0.1", "token", "=", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "at", "7"]) for _ in range(rng.randint(1, 9))]
    rows = [line() for _ in range(3000)] + [[str(i % 977) for i in range(20000)], sum((line() for _ in range(200)), [])]
    tracemalloc.start()
    whole = pii.viterbi(field, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
    assert [len(p) for p in whole] == [len(w) for w in rows]
    monkeypatch.setattr(pii, "WORDS_A_BATCH", 7)
    monkeypatch.setattr(pii, "MOST_KNOWN", 5)
    some = [*rows[:300], rows[-1]]
    assert all((a == b).all() for a, b in zip(pii.viterbi(field, some), [*whole[:300], whole[-1]]))


def test_lm_scores(spark, edge_docs, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows]
    training = [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    c = Counter(w for t in training for w in words(t))
    n, v, ends = sum(c.values()) + len(training), len(c) + 1, len(training)
    got = context_tree.score(edge_docs).collect()
    assert len(got) == len(rows)
    key = lambda x: str(x[:4])
    expected = sorted(((d, len(words(t)) + 1, sum(c[w] > 0 for w in words(t)) + 1, n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)) + math.log10((ends + 1) / (n + v + 1))) for d, t in rows), key=key)
    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    for a, b in zip(found, expected):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    assert all(r["score"] < 0 for r in got)


def test_rare_words_are_counted_by_the_join(spark, edge_docs, monkeypatch):
    plain = {(r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in context_tree.score(edge_docs).collect()}
    monkeypatch.setattr(context_tree, "FREQUENT", 50)
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in context_tree.score(edge_docs).collect()} == plain


def test_the_tree_is_a_distribution(spark):
    docs = spark.createDataFrame([(i, "abracadabra " * (i % 5 + 1)) for i in range(50)], "doc_id long, text string")
    tree = context_tree.fit(docs)
    assert np.abs((10 ** tree.log10.astype(float)).sum(1) - 1).max() < 1e-5
    likely, odd = context_tree.log10_of(tree, pa.array(["abracadabra abracadabra ", "xqzxqzxqzxqz xqzxqzxqzxq "]))
    assert likely > odd / 3


def test_scores_equal_the_whole_tree(spark, monkeypatch):
    """The tree in buckets gives what one tree of all contexts seen twice gives; rare contexts are kept beside many others."""
    monkeypatch.setattr(context_tree, "GRAMS_A_BUCKET", 300)
    monkeypatch.setattr(context_tree, "SLICE_BYTES", 4000)
    rng = random.Random(8)
    texts = [prose(rng, rng.randint(0, 40)) for _ in range(300)] + ["", "é" * 50, "zq9#k zq9#k", "zq9#k"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["score"] for r in context_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    training = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    tree = context_tree.fit(spark.createDataFrame(training, "doc_id long, text string"), 2)
    assert got == pytest.approx(dict(enumerate(context_tree.log10_of(tree, pa.array(texts)).tolist())), rel=1e-3, abs=1e-3)


def test_scores_without_training_are_uniform(spark):
    rows = [(i, "abc") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = context_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["score"] for r in got] == pytest.approx([-4 * math.log10(256)] * len(rows), abs=1e-3)


def test_rare_contexts_are_kept_in_a_large_corpus(spark):
    """A context seen twenty times counts, however many positions there are."""
    rng = random.Random(9)
    base = [prose(rng, 400) for _ in range(1200)]
    rows = [(i, t) for i, t in enumerate(base)] + [(5000 + i, "zq9#kvxj") for i in range(24)]
    got = [r["score"] for r in context_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id >= 5000").collect()]
    assert min(got) > -7


def test_kt_estimate_by_product():
    def product(a, b):
        out, zeros, ones = 0.0, 0, 0
        for bit in [0] * a + [1] * b:
            out += math.log(((ones if bit else zeros) + 0.5) / (zeros + ones + 1))
            zeros, ones = zeros + (not bit), ones + bit
        return out

    pairs = [(0, 0), (1, 0), (3, 5), (40, 2), (0, 17)]
    got = context_tree._log_kt(*(np.array(x, float) for x in zip(*pairs)))
    assert got == pytest.approx([product(a, b) for a, b in pairs], abs=1e-7)


def test_an_unbounded_dotted_part_is_no_address():
    """The field may take a word of thousands of digits for an address; its parts are never read as numbers."""
    text = "ping 192.168.1." + "7" * 5000 + " from here"
    field = pii.train()
    base = [pii.base_spans(text)]
    assert pii.added_spans(field, [text], base)[0] == []
    assert not pii._plausible("ip", "192.168.1." + "7" * 5000) and pii._plausible("ip", "010.0.0.255")


def test_what_stands_late_in_a_long_word_is_found():
    field = pii.train()
    alone = "call 212-555-0193 now"
    found = pii.added_spans(field, [alone], [pii.base_spans(alone)])[0]
    assert [alone[a:b] for a, _, b in found] == ["212-555-0193"]
    line = '{"name":"' + "n" * 80 + '","call":' + alone.split()[1] + ',"note":"' + "m" * 80 + '"}'
    late = pii.added_spans(field, [line], [pii.base_spans(line)])[0]
    assert [line[a:b] for a, _, b in late] == ["212-555-0193"]


def test_more_rows_a_batch_than_a_shingle_holds(spark):
    """Rows are numbered within fourteen bits; larger batches are cut."""
    docs = pa.RecordBatch.from_arrays([pa.array([f"a{i} b{i} c{i}" for i in range(20000)])], names=["text"])
    parts = list(common.slices(docs, "text"))
    assert [p.num_rows for p in parts] == [16384, 3616]
    for part in parts:
        assert set(np.diff(common.shingles_of(part.column(0), 2)[1])) == {2}


def test_scores_follow_the_recursive_definition(spark):
    """Context-tree weighting as defined, decision by decision, on a corpus of some hundred bytes."""
    texts = ["abracadabra", "abra cab", "", "cadabra abracad", "é", "abracadabra"]
    training = [t.encode() for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    positions = []
    for t in training:
        padded = bytes(context_tree.DEPTH) + t + b"\0"
        positions += [(padded[at - context_tree.DEPTH : at][::-1], padded[at]) for at in range(context_tree.DEPTH, len(padded))]

    def seen(context):
        return [b for c, b in positions if c.startswith(context)]

    def children(context):
        longer = {c[: len(context) + 1] for c, _ in positions if c.startswith(context)}
        return [c for c in longer if len(seen(c)) >= 2]

    def counted(some, bits):
        under = [b for b in some if format(b, "08b").startswith(bits)]
        ones = sum(format(b, "08b")[len(bits)] == "1" for b in under)
        return len(under) - ones, ones

    def kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def left(context, bits):
        zeros, ones = counted(seen(context), bits)
        below = [counted(seen(c), bits) for c in children(context)]
        return zeros - sum(z for z, _ in below), ones - sum(o for _, o in below)

    def lower(context, bits):
        return sum(weighted(c, bits) for c in children(context)) + kt(*left(context, bits))

    def weighted(context, bits):
        own = kt(*counted(seen(context), bits))
        return own if len(context) == context_tree.DEPTH else math.log(0.5) + np.logaddexp(own, lower(context, bits))

    def chance(context, history, bits):
        zeros, ones = counted(seen(context), bits)
        own = (ones + 0.5) / (zeros + ones + 1)
        if len(context) == context_tree.DEPTH:
            return own
        share = 1 / (1 + math.exp(lower(context, bits) - kt(zeros, ones)))
        longer = history[: len(context) + 1]
        if longer in children(context):
            return share * own + (1 - share) * chance(longer, history, bits)
        zeros, ones = left(context, bits)
        return share * own + (1 - share) * (ones + 0.5) / (zeros + ones + 1)

    def expected(text):
        padded, total = bytes(context_tree.DEPTH) + text.encode() + b"\0", 0.0
        for at in range(context_tree.DEPTH, len(padded)):
            bits = format(padded[at], "08b")
            for k, bit in enumerate(bits):
                one = chance(b"", padded[at - context_tree.DEPTH : at][::-1], bits[:k])
                total += math.log10(one if bit == "1" else 1 - one)
        return total

    got = {r["doc_id"]: r["score"] for r in context_tree.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == pytest.approx({i: expected(t) for i, t in enumerate(texts)}, rel=1e-4, abs=1e-4)


def test_many_slices_are_merged_in_steps(spark, monkeypatch):
    """Buckets merge a few slices at a time and hand their values to several groups of slices; the scores stay the same."""
    rng = random.Random(12)
    docs = spark.createDataFrame([(i, prose(rng, rng.randint(0, 30))) for i in range(400)], "doc_id long, text string")
    whole = {r["doc_id"]: r["score"] for r in context_tree.score(docs).collect()}
    for name, value in {"SLICE_BYTES": 900, "GRAMS_A_BUCKET": 4000, "MERGED": 3, "ASKED": 200, "BROADCAST_BUCKETS": 2}.items():
        monkeypatch.setattr(context_tree, name, value)
    assert {r["doc_id"]: r["score"] for r in context_tree.score(docs).collect()} == pytest.approx(whole, rel=1e-5)
