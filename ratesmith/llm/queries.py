"""The registered queries of the corpus operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesmith.llm import (
    embedding_index, exact_dedup, language_id, mixing, ngram_join, packing, pii, prefix_trie, quality, repeats,
    spelling, toxicity, url_filter,
)
from ratesmith.sources.workspace import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_language_ppm(spark, folder):
    return language_id.language_report(documents(spark, folder))


def packed_pieces(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = packing.pack(docs, tokenizer_path(), ranks, public_tokenizers.PATTERN)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op2_pack_powers_of_two(spark, folder):
    return packed_pieces(documents(spark, folder))


@query
def op3_personal_data(spark, folder):
    return pii.pii_report(documents(spark, folder))


@query
def op4_toxicity_nnpu(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.toxicity_report(documents(spark, folder), labels)


@query
def op5_line_frequency(spark, folder):
    return quality.quality_report(documents(spark, folder))


# Dated list rows the given pages yield; the text is valid in Spark and in the check engine.
LIST_ROWS = """
WITH u AS (SELECT DISTINCT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS host,
  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS segment FROM {pages}),
h AS (SELECT DISTINCT host, length(host) * 7 + ascii(host) AS n FROM u WHERE host <> ''),
p AS (SELECT concat(host, '/', segment) AS path, length(host) * 5 + ascii(segment) * 3 AS n FROM u WHERE host <> '' AND segment <> ''),
e AS (SELECT host AS key, CASE WHEN n % 5 = 0 THEN 'allow' ELSE 'block' END AS action, 'add' AS change, n % 300 AS later FROM h WHERE n % 3 < 2
UNION ALL SELECT host, CASE WHEN n % 5 = 0 THEN 'allow' ELSE 'block' END, 'remove', n % 300 + 120 FROM h WHERE n % 3 < 2
UNION ALL SELECT host, 'block', 'add', n % 300 + 300 FROM h WHERE n % 3 = 1
UNION ALL SELECT path, CASE WHEN n % 2 = 0 THEN 'allow' ELSE 'block' END, 'add', n % 400 FROM p WHERE n % 4 < 2
UNION ALL SELECT DISTINCT regexp_extract(host, '([^.]+[.][^.]+)$', 1), 'block', 'add', 100 FROM h
UNION ALL SELECT DISTINCT regexp_extract(host, '([^.]+[.][^.]+)$', 1), 'block', 'remove', 160 FROM h)
SELECT key, action, change, CAST(DATE '2024-01-01' + CAST(later AS INT) AS DATE) AS day FROM e"""


@query
def op6_temporal_lists(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    fetch_day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(600)).cast("int"))
    entries = staged(spark.sql(LIST_ROWS, pages=pages), "list_rows")
    return url_filter.judge(
        pages.withColumn("fetch_day", fetch_day), entries, "page_id", "url", "fetch_day")


@query
def op7_exact_copies(spark, folder):
    return exact_dedup.exact_copies(documents(spark, folder))


@query
def op8_repeated_passages(spark, folder):
    report = repeats.without_repeats(documents(spark, folder))
    # what stays of the text; a cut inside a code point leaves U+FFFD
    return report.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept", "spans")


@query
def op9_near_copies(spark, folder):
    return ngram_join.near_copies(documents(spark, folder), words=3, percent=90)


@query
def op10_mix_sources(spark, folder):
    return mixing.mix_report(documents(spark, folder))


@query
def op11_prefix_trie(spark, folder):
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(conversations)).drop("a", "b")


@query
def op12_near_vectors(spark, folder):
    return embedding_index.linked_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query
def op13_spelling_variants(spark, folder):
    return spelling.variant_groups(spelling.word_counts(documents(spark, folder), shorten_every=97))


# crc32 of a list of bytes in the check engine: each byte is followed by eight shifts (-1)
CRC32 = """xor(list_reduce(flatten(list_transform({bytes}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))::BIGINT[],
  lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END,
  CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""
DIGITS = "list_transform(range(1, length(s) + 1), lambda k: ascii(substr(s, CAST(k AS INT), 1)))"
BYTES = """list_transform(range(1, CAST(octet_length(encode(s)) AS BIGINT) + 1), lambda k:
  16 * (instr('0123456789ABCDEF', substr(hex(encode(s)), CAST(2 * k - 1 AS INT), 1)) - 1)
  + instr('0123456789ABCDEF', substr(hex(encode(s)), CAST(2 * k AS INT), 1)) - 1)"""

CHECKS = {
    "op9_near_copies": """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
  ELSE array_to_string(list_slice(w, i, i + 2), ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
k AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM t a JOIN t b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM k JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT r.x AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x""",
    "op6_temporal_lists": """
WITH l AS (""" + LIST_ROWS.replace("{pages}", "pages") + """),
d AS (SELECT DISTINCT * FROM l),
i AS (SELECT key, action, change, day AS first, lead(day) OVER (PARTITION BY key, action
  ORDER BY day, CASE WHEN change = 'remove' THEN 0 ELSE 1 END) AS last FROM d),
c AS (SELECT row_number() OVER () AS r, page_id, url, DATE '2024-01-01' + CAST(page_id % 600 AS INT) AS fetch_day,
  nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)), '') AS host,
  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS segment FROM pages),
m AS (SELECT r, i.key, i.action, row_number() OVER (PARTITION BY r ORDER BY length(i.key) DESC, i.action) AS place
  FROM c JOIN i ON i.change = 'add' AND i.first <= c.fetch_day AND (i.last IS NULL OR i.last > c.fetch_day)
  AND (i.key = c.host OR i.key = c.host || '/' || c.segment OR ends_with(c.host, '.' || i.key)))
SELECT page_id, url, CAST(fetch_day AS DATE) AS fetch_day, host, m.key AS matched_key, m.action,
 coalesce(m.action, 'allow') <> 'block' AS kept FROM c LEFT JOIN m ON c.r = m.r AND place = 1""",
    "op7_exact_copies": """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS size,
  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST) AS place,
  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r""",
    "op5_line_frequency": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
lines AS (SELECT r, source, t, unnest(string_split(t, chr(10))) AS line,
  unnest(range(len(string_split(t, chr(10))))) AS place FROM d),
plain AS (SELECT r, source, t, line, place, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words,
  regexp_replace(translate(array_to_string(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), ' '),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS folded
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM plain GROUP BY r),
often AS (SELECT source, folded FROM plain GROUP BY 1, 2 HAVING count(DISTINCT t) > 20),
gone AS (SELECT r, sum(p.words) AS n FROM plain p JOIN often o ON p.source IS NOT DISTINCT FROM o.source
  AND p.folded = o.folded GROUP BY r),
wins AS (SELECT r, i, array_to_string(list_slice(words, i, i + 4), ' ') AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
twice AS (SELECT r, win FROM wins GROUP BY 1, 2 HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT a.r, unnest(range(a.i, a.i + 5)) AS p
  FROM wins a JOIN twice b ON a.r = b.r AND a.win = b.win) GROUP BY r),
f AS (SELECT w.doc_id, len(words) AS n_words,
  coalesce(length(array_to_string(words, '')), 0) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  len(words) - coalesce(gone.n, 0) AS words_left
  FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, CAST(words_left AS BIGINT) AS words_left,
 n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
 NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND words_left >= 10 AND words_left >= 0.2 * n_words AS kept
FROM f""",
    "op11_prefix_trie": """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t),
h AS (SELECT c, """ + CRC32.replace("{bytes}", DIGITS) + """ % 6 AS h FROM i),
g AS (SELECT h.c, t.p, role, text FROM h JOIN t ON t.c = h.c - h.c % 100 AND t.p <= h.h
  UNION ALL SELECT h.c, t.p + 10, role, text FROM h JOIN t ON t.c = h.c AND t.p > h.h),
r AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS d, text, sha256(length(role) || ':' || role || text) AS k FROM g),
n AS (SELECT c, d, length(text) AS chars, string_agg(k, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d) AS name FROM r
  UNION ALL SELECT c, 0, 0, '' FROM h),
l AS (SELECT c, max(d) AS last FROM n GROUP BY c),
v AS (SELECT name, d AS depth, min(n.c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS w,
  sha256(coalesce(string_agg(CASE WHEN d = last THEN CAST(n.c AS VARCHAR) END, ',' ORDER BY n.c), '')) AS ends_sha256
  FROM n JOIN l ON n.c = l.c GROUP BY name, d),
k AS (SELECT substr(name, 1, 64 * (depth - 1)) AS name, count(*) AS n FROM v WHERE depth > 0 GROUP BY 1),
s AS (SELECT a.name, sum(b.w) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves FROM v b LEFT JOIN k ON k.name = b.name,
  unnest(range(0, b.depth + 1)) AS u(e) JOIN v a ON a.name = substr(b.name, 1, 64 * e) GROUP BY a.name)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children,
 CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN s ON s.name = v.name LEFT JOIN k ON k.name = v.name
LEFT JOIN v p ON v.depth > 0 AND p.name = substr(v.name, 1, 64 * (v.depth - 1))""",
    "op12_near_vectors": """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
g AS (SELECT r, v FROM e WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.r AS x, b.r AS y FROM g a JOIN g b ON a.r <> b.r AND list_cosine_similarity(a.v, b.v) >= 0.95),
k AS (SELECT x, count(*) AS n FROM l GROUP BY x),
c AS (SELECT r AS x, r AS y FROM e UNION SELECT c.x, l.y FROM c JOIN l ON l.x = c.y),
m AS (SELECT c.x, min(e.vec_id) AS least FROM c JOIN e ON e.r = c.y GROUP BY c.x)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, m.least AS component_id, e.vec_id IS NOT DISTINCT FROM m.least AS kept
FROM e JOIN m ON m.x = e.r LEFT JOIN k ON k.x = e.r""",
    "op13_spelling_variants": """
WITH RECURSIVE d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS w FROM documents),
o AS (SELECT id, w, id || ':' || w AS s, count(*) AS n FROM d GROUP BY id, w),
h AS (SELECT w, n, """ + CRC32.replace("{bytes}", BYTES) + """ AS h FROM o),
t AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2)
  ELSE w END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
v AS (SELECT word, k, substr(word, 1, CAST(k AS INT) - 1) || substr(word, CAST(k AS INT) + 1) AS rest
  FROM w, unnest(range(1, length(word) + 1)) AS u(k)),
p AS (SELECT a.word AS word, b.word AS near FROM v a JOIN v b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT v.word, w.word FROM v JOIN w ON w.word = v.rest UNION SELECT w.word, v.word FROM v JOIN w ON w.word = v.rest),
c AS (SELECT p.word, p.near, w.n AS near_n, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place,
  count(*) OVER (PARTITION BY p.word) AS n_near FROM p JOIN w ON w.word = p.near),
f AS (SELECT w.word, w.n, coalesce(c.n_near, 0) AS n_near, CASE WHEN c.near_n >= 2 * w.n THEN c.near END AS form,
  CASE WHEN c.near_n >= 2 * w.n THEN c.near_n END AS form_n FROM w LEFT JOIN c ON c.word = w.word AND place = 1),
r AS (SELECT word, word AS here, 0 AS step FROM f UNION ALL
  SELECT r.word, f.form, r.step + 1 FROM r JOIN f ON f.word = r.here WHERE f.form IS NOT NULL),
e AS (SELECT word, arg_max(here, step) AS root FROM r GROUP BY word)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, e.root FROM f JOIN e ON e.word = f.word""",
}
