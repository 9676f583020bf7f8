"""The registered queries of this package, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm import bpe, context_tree, language, lattice, minhash, mixing, pii, quality, search, spelling, token_counts, token_files, topk
from roadstream.llm.common import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), width=2)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), new_path(spark, "token-cache"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    # For each pass what it takes and when it comes in training.
    passes = [F.col("passes")[t][x].alias(f"{x}_{t + 1}") for t in range(mixing.turns(mixing.MOST_TIMES)) for x in ("part", "position")]
    mixed = mixed.select("doc_id", "size", "source_size", "target", "taken", *passes)
    return mixed.withColumns({c: F.round(c, 9) for c in mixed.columns if c.startswith("position")})


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.checksums(token_files.read_tokens(spark, path))


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_language_id,
        op3_quality_classifier,
        op4_token_counts,
        op5_exact_top_k,
        op6_embedding_near_dedup,
        op7_mix_sources,
        op8_pii,
        op9_byte_bpe,
        op10_lm_score,
        op11_ranked_search,
        op12_spelling_variants,
        op13_token_files,
    )
}

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op1_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END)) AS s FROM words
), firsts AS (
  SELECT s, min(doc_id) AS a, len(s) AS n, row_number() OVER (ORDER BY min(doc_id)) AS k FROM sets WHERE len(s) > 0 GROUP BY s
), frequency AS (SELECT t, count(*) AS f FROM (SELECT unnest(s) AS t FROM firsts) GROUP BY t),
ranked AS (
  SELECT a, n, x.t AS t, row_number() OVER (PARTITION BY a ORDER BY f.f, x.t) AS r
  FROM (SELECT a, n, unnest(s) AS t FROM firsts) x JOIN frequency f ON f.t = x.t
), prefix AS (SELECT a, n, t FROM ranked WHERE r <= n - ceil(0.8 * n) + 1),
candidates AS (
  SELECT DISTINCT p.a AS a, q.a AS b FROM prefix p JOIN prefix q ON p.t = q.t AND p.a < q.a AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
), pairs AS (
  SELECT c.a, c.b FROM candidates c JOIN firsts x ON x.a = c.a JOIN firsts y ON y.a = c.b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (
  SELECT a, a AS b FROM firsts
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least_of AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id,
  coalesce(l.component_id, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN firsts f ON f.s = s.s LEFT JOIN least_of l ON l.a = f.a
""",
    "op5_exact_top_k": """
WITH cut AS (
  SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM cut q JOIN cut c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op6_embedding_near_dedup": """
WITH RECURSIVE links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.a AS vec_id, CAST(coalesce(any_value(c.n), 0) AS BIGINT) AS n_links, min(r.b) AS component_id, min(r.b) = r.a AS kept
FROM reach r LEFT JOIN counts c ON c.a = r.a GROUP BY r.a
""",
    "op7_mix_sources": f"""
WITH sized AS (
  SELECT row_number() OVER () AS row, doc_id, source, CAST({WORDS} AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
    2.0::DOUBLE * source_size AS most FROM sources
), levels AS (SELECT *, most / weight AS level FROM weighed
), waters AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM weighed)
    - coalesce(sum(most) OVER (ORDER BY level, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY level, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS water FROM levels
), final AS (SELECT water FROM waters WHERE water <= level ORDER BY level, place LIMIT 1
), targets AS (
  SELECT source, place, source_size, coalesce(least(most, weight * (SELECT water FROM final)), most) AS target FROM waters
), placed AS (
  SELECT s.*, t.source_size, t.target, CASE t.place % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS w0,
    CASE t.place % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS w1, coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.turn, s.doc_id, s.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
, passes AS (
  SELECT *, unnest([0, 1]) AS pass FROM placed
), asked AS (
  SELECT *, CAST(greatest(0, least(size, floor(target) - pass * source_size - start)) AS BIGINT) AS part,
    CASE WHEN target > 0 THEN least((pass * source_size + start)::DOUBLE / target, 1.0::DOUBLE) ELSE 1.0::DOUBLE END AS demand FROM passes
), timed AS (
  SELECT *, CASE WHEN w0 = w1 THEN demand ELSE least(((w0 + w1) * demand)
    / (w0 + sqrt(greatest(w0 * w0 + (w1 - w0) * (w0 + w1) * demand, 0.0::DOUBLE))), 1.0::DOUBLE) END AS position FROM asked
)
SELECT a.doc_id, a.size, a.source_size, a.target, a.part + b.part AS taken, a.part AS part_1, round(a.position, 9) AS position_1,
  b.part AS part_2, round(b.position, 9) AS position_2
FROM timed a JOIN timed b ON a.pass = 0 AND b.pass = 1 AND a.row = b.row
""",
    "op11_ranked_search": f"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS d, regexp_extract_all({LOWERED}, '{TERM}') AS w FROM documents
), sized AS (SELECT d, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS N, CAST(sum(n) AS BIGINT) AS L FROM sized),
terms AS (SELECT d, doc_id, n, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, doc_id, n, unnest(w) AS t FROM sized) GROUP BY d, doc_id, n, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM (SELECT t, count(*) AS df FROM terms GROUP BY t), total
), asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWERED}, '{TERM}')) AS t FROM benchmark),
scored AS (
  SELECT a.item_id, x.d, x.doc_id,
    CAST(sum(w.weight * ((1000000000 * x.tf) // (1000 * x.tf + 20 * (50 + (50 * x.n * s.N) // s.L)))) AS BIGINT) AS score
  FROM asked a JOIN terms x ON x.t = a.t JOIN weights w ON w.t = a.t, total s GROUP BY a.item_id, x.d, x.doc_id
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWERED}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
), counted AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (
  SELECT run, c, xor(list_reduce([4294967295] || flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) AS BIGINT) - 64] END)),
    lambda h, b: xor(crc[(xor(h, b) & 255) + 1], h >> 8)), 4294967295) AS h FROM counted, crc_table
), results AS (
  SELECT c, CASE WHEN h % 31 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word FROM hashed
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), parts AS (
  SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM parts a JOIN parts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM parts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM parts a JOIN words b ON a.rest = b.word
), ranked AS (
  SELECT word, other, other_n, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other COLLATE "C") AS r, count(*) OVER (PARTITION BY word) AS n_near FROM near
), forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 10 * w.n THEN r.other END AS form,
    CASE WHEN r.other_n >= 10 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE r = 1) r ON r.word = w.word
), steps AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.next
)
SELECT f.word, f.form, s.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN steps s ON s.word = f.word AND s.next IS NULL
""",
}
