"""The operators applied to the shared tables: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import (bpe, conversation_trie, mixing, phrases, quality_model, quality_rules, sharding, simhash, substring_dedup, token_store,
                          topk, url_filter, warc)
from tripflow.llm.common import materialize, small_frame, table
from tripflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    sizes = mixing.document_sizes(spark, table(spark, sf_dir, "documents"))
    return mixing.mix(spark, sizes).select("doc_id", "size", "source_size", "target", "taken", "source")


#: Fixed values of the query: entries of the url list (host, path, verdict).
URL_RULES = [
    {"host": "com", "path": "/", "verdict": "allow"},
    {"host": "example.com", "path": "/en/", "verdict": "block"},
    {"host": "www.example.com", "path": "/en/", "verdict": "allow"},
    {"host": "net", "path": "/es/", "verdict": "block"},
    {"host": "net", "path": "/fr/", "verdict": "block"},
]


@register
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("verdict", pa.string())])
    listed = small_frame(spark, URL_RULES, schema)
    return url_filter.filter_urls(spark, table(spark, sf_dir, "pages"), listed, keep=("page_id",))


@register
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, rule bits and verdict of every document, from the stored ledger; with the rule that alone rejects it,
    the documents that the policy would keep without that rule (its ablation)."""
    policy = quality_rules.POLICIES["v3"]
    ledger = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    stored = materialize(spark, ledger, "quality-ledger")
    judged = quality_rules.apply_policy(stored, policy).withColumn("sole_rule", quality_rules.sole_rule(policy))
    ablated = quality_rules.ablations(stored, policy).select(F.col("rule").alias("sole_rule"), "kept_without")
    judged = judged.join(F.broadcast(ablated), "sole_rule", "left")  # one row a rule of the policy
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         quality_rules.failed(quality_rules.POLICIES["base"].rules).alias("base_failed"), "kept", "fail_bits",
                         "sole_rule", "kept_without")


@register
def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the ``rows`` law."""
    text = F.col("text")
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"))
    return (sharding.shard_rows(spark, narrow, ["doc_id", "size", "text_crc32"], shards=8)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def vocabulary() -> str:
    """Path of the tokenizer's vocabulary (a parameter of the operators)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.codec(spark, docs, vocabulary())
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(spark, docs, ["doc_id"], shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@register
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest scores of every 50th vector among all others."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), topk.quantized(F.col("embedding")).alias("vec"))
    found = topk.search(spark, vectors, F.col("id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLES["op1_topk_search"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rnk FROM s
)
SELECT query_id, CAST(rnk AS INTEGER) AS rank, vec_id, score FROM r WHERE rnk <= 5
"""


@register
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the token store, as read back."""
    rows = token_store.tokenized(spark, table(spark, sf_dir, "documents"), vocabulary())
    path = scratch_path(spark, "llm", "token-store")
    token_store.write_store(spark, rows, path)
    docs = token_store.read_store(spark, path, with_ids=False)
    return docs.select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


@register
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the archives."""
    path = scratch_path(spark, "llm", "warc")
    warc.write_archive(spark, table(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    records = warc.read_archive(spark, path)
    page = F.regexp_extract(F.col("record_id"), r"^<urn:page:(-?\d+):", 1)
    target = F.regexp_extract(F.col("refers_to"), r"^<urn:page:(-?\d+):", 1)
    return records.select(F.nullif(page, F.lit("")).cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.nullif(target, F.lit("")).cast("long").alias("refers_to"))


ORACLES["op5_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), o AS (
  SELECT hex, max(page_id) AS owner FROM p GROUP BY hex
), bits AS (
  SELECT hex, owner, string_agg(CAST((CAST(('0x' || substr(hex, i, 1)) AS INTEGER) >> b) & 1 AS VARCHAR), '' ORDER BY i, b DESC) AS bin
  FROM o, range(1, 41) t(i), (VALUES (3), (2), (1), (0)) u(b) GROUP BY hex, owner
), coded AS (
  SELECT hex, owner, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * CAST(substr(bin, k, 1) AS INTEGER) + 8 * CAST(substr(bin, k + 1, 1) AS INTEGER)
             + 4 * CAST(substr(bin, k + 2, 1) AS INTEGER) + 2 * CAST(substr(bin, k + 3, 1) AS INTEGER)
             + CAST(substr(bin, k + 4, 1) AS INTEGER), 1), '' ORDER BY k) AS payload_digest
  FROM bits, (SELECT 5 * n + 1 AS k FROM range(32) t(n)) GROUP BY hex, owner
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < owner THEN owner END AS refers_to
FROM p JOIN coded USING (hex)
"""

ORACLES["op7_url_filter"] = r"""
WITH rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                               ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
)
SELECT page_id, host, path,
       (SELECT arg_max(h || p, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce((SELECT arg_max(v, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM u
"""

ORACLES["op8_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) x(k) GROUP BY r
), lines AS (
  SELECT r, count(*) AS n, count(DISTINCT l) AS u
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(l.n, 0) AS n_lines, coalesce(l.n - l.u, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r)
), f AS (
  SELECT *, n_words < 50 AS f0, 100 * n_repeat_words > 50 * n_words AS f1, n_words > 1000000 AS f2, word_chars < 2 * n_words AS f3,
         word_chars > 15 * n_words AS f4, 10 * n_symbols > n_words AS f5, n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines AS f6
  FROM m
), s AS (
  SELECT *, CASE WHEN f0::INT + f1::INT + f3::INT + f4::INT + f5::INT + f6::INT <> 1 THEN NULL WHEN f0 THEN 'few_words' WHEN f1 THEN 'repeated_words'
                 WHEN f3 THEN 'short_words' WHEN f4 THEN 'long_words' WHEN f5 THEN 'symbols' ELSE 'dup_lines' END AS sole_rule
  FROM f
), alone AS (
  SELECT sole_rule, count(*) + (SELECT count(*) FROM f WHERE NOT (f0 OR f1 OR f3 OR f4 OR f5 OR f6)) AS kept_without
  FROM s WHERE sole_rule IS NOT NULL GROUP BY sole_rule
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, f0 OR f1 AS base_failed,
       NOT (f0 OR f1 OR f3 OR f4 OR f5 OR f6) AS kept,
       CAST(f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT + 64 * f6::INT AS BIGINT) AS fail_bits,
       sole_rule, CAST(kept_without AS BIGINT) AS kept_without
FROM s LEFT JOIN alone USING (sole_rule)
"""

ORACLES["op3_mix_sources"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('3/' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM s WINDOW before AS (ORDER BY source_size * 12 // weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size,
         least(2.0 * source_size, (SELECT max(level) FROM l WHERE level * weight <= 2 * source_size) * weight)::DOUBLE AS target
  FROM l
), p AS (
  SELECT d.*, source_size, target, least(2 * source_size, CAST(floor(target + 0.5) AS BIGINT)) AS take,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, size, r ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source,
       greatest(0, least(size, take - start)) + greatest(0, least(size, take - source_size - start)) AS taken
FROM p
"""


#: Grades of the labels: toxic texts, poor texts, good texts.
N_GRADES, GOOD = 3, 2


def label_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and grade of every labelled document."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, GOOD)
    return table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))


@register
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and probability of the good grade of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.classify(spark, docs, label_grades(spark, sf_dir), N_GRADES, GOOD)


@register
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    turns, sizes = conversation_trie.rebuilt(spark, table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(spark, turns, sizes)


@register
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language."""
    return phrases.collocations(spark, table(spark, sf_dir, "documents"), top=2000)


@register
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat an earlier one's windows of 13 words, and a digest of the rest."""
    kept = substring_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"), window=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op11_conversation_trie"] = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT c, list(turn ORDER BY pos) AS turns FROM t GROUP BY c
), crc AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(CAST(c AS VARCHAR), '')]),
                lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS h
  FROM l
), r AS (
  SELECT l.c, list_concat(coalesce(b.turns[1:h], []), l.turns[h + 1:]) AS turns
  FROM l JOIN crc USING (c) LEFT JOIN l b ON b.c = l.c - l.c % 20
), p AS (
  SELECT c, CAST(unnest(range(0, len(turns) + 1)) AS BIGINT) AS depth, turns FROM r
), m AS (
  SELECT c, depth, turns[1:depth] AS path, turns[1:depth - 1] AS above, len(turns) = depth AS ends FROM p
), n AS (
  SELECT path, any_value(above) AS above, depth, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
         CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(any_value(path[depth]).text, '[^ 	-
]+')) END AS saved
  FROM m GROUP BY path, depth
), k AS (
  SELECT above, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), u AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.above = n.path AND k.depth = n.depth
), s AS (
  -- a node's ancestors are the prefixes of its path
  SELECT path[1:d] AS path, d AS depth, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT path, n_children, saved, unnest(range(0, depth + 1)) AS d FROM u) GROUP BY ALL
)
SELECT u.conv_id, u.depth, CASE WHEN u.depth > 0 THEN q.conv_id END AS parent_conv_id, u.n_convs, u.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, u.ends_sha256
FROM u JOIN s ON s.path = u.path AND s.depth = u.depth LEFT JOIN n q ON q.path = u.above AND q.depth = u.depth - 1
"""

ORACLES["op12_collocations"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) x(k))
), f AS (
  SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, a, array_to_string(words[:k - 1], ' ') AS phrase FROM c UNION ALL SELECT lang, a, array_to_string(words[2:], ' ') FROM c)
  GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.a, n, cut, x.f AS l, y.f AS r, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN totals USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(words[:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(words[cut + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rnk
  FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.a IS NULL OR 100 * o.a < 100 * b.a
)
SELECT lang, rnk AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rnk <= 2000
"""

ORACLES["op13_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
), g AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d)
), seen AS (
  SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY win) AS least FROM g) WHERE least < doc_id
), gone AS (
  SELECT r, list(DISTINCT i + k) AS places FROM seen, range(0, 13) x(k) GROUP BY r
), kept AS (
  SELECT d.r, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (word IS NOT NULL), '') AS text
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) d
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT r, unnest(places) AS i FROM gone) x WHERE x.r = d.r AND x.i = d.i) GROUP BY d.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""
