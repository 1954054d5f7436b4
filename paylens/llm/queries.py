"""The registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm import bottomk, bpe, dialogue, license_scan, line_hash, line_join, permuterm, phrase_index, quality_rules, secret_scan, simhash, tokenfile, url_filter
from paylens.llm.common import table
from paylens.llm.registry import REGISTRY, query
from paylens.session import scratch_path


def load() -> dict:
    return REGISTRY


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary)


@query("op9_token_file")
def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as spec:
        path = scratch_path(spark, "tokens")
        tokenfile.write_tokens(table(spark, sf_dir, "documents"), spec.read(), path, end_id=0)
    return tokenfile.read_checksums(spark, path)


_PHRASES_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w] ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS x
  FROM item_words),
places AS (
  SELECT doc_id, n, i, w[i:i + n - 1] AS x FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT len(x) AS n FROM windows))),
hits AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (x)),
marks AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN marks USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op3_decontamination", _PHRASES_SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_QUALITY_SQL = r"""
WITH parts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (SELECT doc_id, i, w[i:i + 7] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM parts)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
c AS (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', ''))::BIGINT AS chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM parts LEFT JOIN covered USING (doc_id)),
grid AS (
  SELECT unnest(['symbols', 'repeated_lines', 'repeated_words', 'short_words', 'long_words']) AS rule,
         unnest([[0.05, 0.1, 0.2, 0.3, 0.5, 1.0], [0.05, 0.1, 0.2, 0.3, 0.5], [0.02, 0.05, 0.1, 0.2], [4.5, 4.0, 3.5, 3.0, 2.5, 2.0],
                 [8.0, 9.0, 10.0, 12.0, 15.0]]::DOUBLE[][]) AS cutoffs),
tests AS (SELECT rule, unnest(cutoffs) AS cutoff, generate_subscripts(cutoffs, 1) AS ord FROM grid),
tried AS (
  SELECT c.*, rule, cutoff, ord, coalesce(CASE rule WHEN 'symbols' THEN n_words > 0 AND n_symbols > cutoff * n_words
    WHEN 'repeated_lines' THEN n_lines > 0 AND n_dup_lines > cutoff * n_lines WHEN 'repeated_words' THEN n_words > 0 AND n_repeat_words > cutoff * n_words
    WHEN 'short_words' THEN n_words > 0 AND chars < cutoff * n_words ELSE n_words > 0 AND chars > cutoff * n_words END, false) AS rejected
  FROM c, tests),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT lang, rule, cutoff, ord, count(*) AS n, count(*) FILTER (WHERE rejected) AS k FROM tried JOIN good USING (doc_id) GROUP BY ALL),
tails AS (
  SELECT lang, rule, cutoff, ord, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
         + i * ln(0.004) + (n - i) * ln(0.996)))) AS p FROM held),
chosen AS (
  SELECT lang, rule, arg_min(cutoff, ord) AS cutoff FROM tails WHERE p <= 0.05 / (26 * (SELECT count(DISTINCT coalesce(lang, '')) FROM held)) GROUP BY ALL)
SELECT doc_id, n_words, coalesce(chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT EXISTS (
         SELECT 1 FROM tried t JOIN chosen h ON t.lang IS NOT DISTINCT FROM h.lang AND t.rule = h.rule AND t.cutoff = h.cutoff
         WHERE t.doc_id = c.doc_id AND t.rejected) AS kept
FROM c
"""


@query("op8_quality_rules", _QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *[f"counts.{c}" for c in counts], "base_failed", "kept")


@query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def written_out(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(written_out(base), 256).alias("base_sha256"), written_out(F.col("spans")).alias("spans"))


_URL_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parts),
rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'),
         ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, host, path, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) AS n
  FROM hosts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN regexp_matches(
    host, '(^|\.)(adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.example\.(com|net|org)$') THEN 'block' ELSE 'allow' END) AS verdict
FROM fits WHERE n = 1
"""


@query("op7_url_filter", _URL_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


#: A passage that many documents share has at least so many words; runs of shared sentences that are shorter stay.
PASSAGE_WORDS = 30

_UNITS_SQL = rf"""
WITH pieces AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM
    (SELECT doc_id, regexp_extract_all(text, '[^\n]*?(?:[.!?。！？]+[ \t\x0b\x0c\r]+|\n|$)') AS p FROM documents)),
placed AS (
  SELECT doc_id, i, piece, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         length(regexp_replace(piece, '(?:([.!?。！？])[ \t\x0b\x0c\r]+|\n)$', '\1'))::BIGINT AS n,
         regexp_extract_all(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM pieces WHERE piece <> ''),
sized AS (SELECT *, greatest(len(w), length(list_aggregate(w, 'string_agg', '')) // {line_hash.WORD_CHARS}) AS size FROM placed),
worded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place, count(*) OVER (PARTITION BY w) AS times FROM sized WHERE len(w) > 0),
runs AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM worded WHERE times > 1),
passages AS (SELECT *, sum(size) OVER (PARTITION BY doc_id, run) AS words FROM runs QUALIFY words >= {PASSAGE_WORDS}),
ranked AS (SELECT doc_id, i, row_number() OVER k AS rank, first_value(doc_id) OVER k AS kept_in FROM passages WINDOW k AS (PARTITION BY w ORDER BY doc_id, start))
SELECT d.doc_id, CASE WHEN any_value(d.text) IS NULL THEN NULL ELSE coalesce(string_agg(piece, '' ORDER BY p.i) FILTER (WHERE coalesce(rank, 1) = 1), '') END AS text,
       count(*) FILTER (WHERE len(w) > 0) AS n_units, count(rank) AS n_repeated, count(*) FILTER (WHERE rank > 1) AS n_removed,
       coalesce(string_agg(start || ':' || (start + n) || ':' || kept_in, ',' ORDER BY p.i) FILTER (WHERE rank > 1), '') AS removed
FROM documents d LEFT JOIN sized p ON p.doc_id = d.doc_id LEFT JOIN ranked r ON r.doc_id = p.doc_id AND r.i = p.i GROUP BY d.doc_id
"""


@query("op2_substring_dedup", _UNITS_SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_hash.deduplicate(table(spark, sf_dir, "documents"), least_words=1, by="sentences", least_passage=PASSAGE_WORDS, with_kept=False)
    spans = F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["end"], r["kept_in"]))
    return found.select(
        "doc_id", "text", "n_units", F.col("repeated").cast("long").alias("n_repeated"), F.size("removed").cast("long").alias("n_removed"),
        F.array_join(spans, ",").alias("removed"),
    )


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n, unnest(string_split(text, chr(10))) AS line FROM documents),
sets AS (SELECT doc_id, n, list_sort(list_distinct(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+'))) AS tk FROM lines),
classes AS (SELECT tk, len(tk) AS s, min((doc_id, n)) AS place FROM sets WHERE len(tk) > 0 GROUP BY tk),
numbered AS (SELECT row_number() OVER (ORDER BY place, tk) AS id, * FROM classes),
tokens AS (SELECT id, s, unnest(tk) AS t FROM numbered),
ranked AS (
  SELECT id, s, t, row_number() OVER (PARTITION BY id ORDER BY f, t) AS r FROM tokens JOIN (SELECT t, count(*) AS f FROM tokens GROUP BY t) USING (t)),
prefix AS (SELECT id, s, t FROM ranked WHERE r <= s - (4 * s + 4) // 5 + 1),
met AS (SELECT DISTINCT x.id AS a, y.id AS b FROM prefix x JOIN prefix y USING (t) WHERE x.id < y.id AND 5 * x.s >= 4 * y.s AND 5 * y.s >= 4 * x.s),
gone AS (
  SELECT DISTINCT b AS id FROM met JOIN numbered x ON x.id = a JOIN numbered y ON y.id = b WHERE 9 * len(list_intersect(x.tk, y.tk)) >= 4 * (x.s + y.s)),
judged AS (
  SELECT doc_id, n, len(sets.tk) > 0 AS counts, (doc_id, n) <> place OR id IN (SELECT id FROM gone) AS lost
  FROM sets LEFT JOIN numbered ON numbered.tk = sets.tk)
SELECT doc_id, count(*) FILTER (WHERE counts) AS n_lines, count(*) FILTER (WHERE counts AND lost) AS n_removed,
       coalesce(string_agg(n::VARCHAR, ',' ORDER BY n) FILTER (WHERE counts AND lost), '') AS removed
FROM judged GROUP BY doc_id
"""


@query("op1_line_dedup", _LINES_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_join.decisions(table(spark, sf_dir, "documents"))


@query("op11_minhash")
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bottomk.near_duplicates(table(spark, sf_dir, "documents"), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = permuterm.count_words(table(spark, sf_dir, "documents"), least_length=7, least_count=2, drop=31)
    return permuterm.variants(words, times=10)


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return dialogue.repair(dialogue.damage(conversations), conversations)
