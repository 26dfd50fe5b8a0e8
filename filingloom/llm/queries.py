"""The registered queries of these operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, decontaminate, filter_audit, jaccard_join, language_id, lexical_search, lm_score, media, mixing, quality, substring_dedup, toxicity, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_words").cast("binary"), 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = common.crc_bucket(F.col("doc_id"), 3) == 1
    model = language_id.fit(docs, ~held_out)
    found = language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_key", "group_key")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs)).select("doc_id", "quality", "keep")


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.store(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return media.facts(stored)  # the digests, and the tensor itself


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tenth = common.crc_bucket(F.col("doc_id"), 10)
    return lm_score.score(docs, training=tenth != 0, tuning=tenth == 1)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "rate")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_audit.audit(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), _table(spark, sf_dir, "labels"))
    return found.select("part", "filter_order", "step", *filter_audit.COUNTS, "shapley")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(lexical_search.index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # vocabulary files; nothing else here needs them

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return bpe.decode(ids, path).select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_lm_score": op3_lm_score,
    "op4_mixing": op4_mixing,
    "op5_language_id": op5_language_id,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality": op7_quality,
    "op8_media": op8_media,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_filter_audit": op11_filter_audit,
    "op12_lexical_search": op12_lexical_search,
    "op13_bpe": op13_bpe,
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s FROM d, unnest(range(1, len(ws) - 18)) t(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, k FROM dup, unnest(range(i, i + 20)) t(k)),
w AS (SELECT doc_id, k, ws[k] AS word FROM d, unnest(range(1, len(ws) + 1)) t(k)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS s FROM w ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op2_url_filter": r"""
WITH rules(verdict, host, path) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest, row_number() OVER () AS k FROM pages),
a AS (SELECT page_id, k, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
f AS (SELECT k, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY k ORDER BY length(r.host || r.path) DESC, r.host || r.path) AS rn
      FROM a JOIN rules r ON (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path))
SELECT page_id, a.host, a.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM a LEFT JOIN f ON f.k = a.k AND rn = 1
""",
    "op6_jaccard_join": r"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(ws) - 3, 2))) t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, low AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = d.doc_id
""",
    "op10_decontamination": r"""
WITH d AS (SELECT doc_id, k, ws[k] AS word, len(ws) AS n FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents), unnest(range(1, len(ws) + 1)) t(k)),
i AS (SELECT item_id, k, ws[k] AS word, len(ws) AS n FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM benchmark), unnest(range(1, len(ws) + 1)) t(k)),
eq AS (SELECT doc_id, item_id, d.k - i.k AS shift, i.k AS q, d.n AS dn, i.n AS size, least(13, i.n) AS w, CASE WHEN i.n < 13 THEN 0 ELSE 2 END AS miss FROM d JOIN i USING (word)),
diag AS (SELECT doc_id, item_id, shift, any_value(dn) AS dn, any_value(size) AS size, any_value(w) AS w, any_value(miss) AS miss FROM eq GROUP BY doc_id, item_id, shift HAVING count(*) >= any_value(w - miss)),
near AS (SELECT eq.doc_id, eq.item_id, eq.shift, eq.q FROM eq JOIN diag USING (doc_id, item_id, shift)),
win AS (SELECT doc_id, item_id, shift, s, w, miss FROM diag, unnest(range(1, size - w + 2)) t(s) WHERE s + shift >= 1 AND s + shift + w - 1 <= dn),
good AS (SELECT doc_id, item_id, shift, s, w FROM win JOIN near USING (doc_id, item_id, shift) WHERE q BETWEEN s AND s + w - 1 GROUP BY doc_id, item_id, shift, s, w, miss HAVING count(*) >= w - miss),
span AS (SELECT doc_id, item_id, shift, min(s) AS a, max(s + w) AS b FROM good GROUP BY doc_id, item_id, shift),
leak AS (SELECT doc_id, item_id, any_value(a + shift - 1) AS first, any_value(b - a) AS words, count(*) AS matched FROM span JOIN near USING (doc_id, item_id, shift) WHERE q >= a AND q < b GROUP BY doc_id, item_id, shift)
SELECT doc_id, item_id, CAST(first AS INTEGER) AS first, CAST(words AS INTEGER) AS words, CAST(matched AS INTEGER) AS matched FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, first, words) AS k FROM leak) WHERE k = 1
""",
    "op11_filter_audit": r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
low AS (SELECT text, min(doc_id) AS low FROM t GROUP BY text),
l AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT t.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, [
        len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 3 * length(t.text), regexp_matches(t.text, '[#$%&*|]'), coalesce(low.low < t.doc_id, low.low IS NOT NULL)] AS fails
      FROM t JOIN low USING (text) LEFT JOIN l ON l.doc_id = t.doc_id),
x(k) AS (VALUES (1), (2), (3), (4), (5)),
o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS ks, array_to_string(list_transform([a.k, b.k, c.k, d.k, e.k], lambda v: substr('ABCDE', v, 1)), '') AS filter_order
      FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
g AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
r AS (SELECT g.*, filter_order, ks, coalesce(list_position(list_transform(ks, lambda v: fails[v]), true), 6) AS first FROM g, o),
z AS (SELECT part, filter_order, CAST(s AS INT) AS step, ks[s] AS k, sum(n) FILTER (first > s) AS kept, sum(n) FILTER (first = s) AS removed, sum(n) FILTER (fails[ks[s]] AND first < s) AS redundant,
        sum(n) FILTER (fails[ks[s]] AND len(list_filter(fails, lambda v: v)) = 1) AS unique_fails, sum(n) FILTER (first = s AND good = 1) AS good_lost, sum(n) FILTER (first = s AND toxic = 1) AS toxic_lost
      FROM r, unnest(range(1, 6)) u(s) GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(coalesce(sum(removed) OVER (PARTITION BY part, k), 0) AS BIGINT) AS shapley FROM z
""",
    "op12_lexical_search": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, row_number() OVER () AS q, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
s AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(ws)) AS BIGINT) AS l FROM d WHERE len(ws) > 0),
m AS (SELECT doc_id, r, 100 - 90 + (90 * len(ws) * nd) // l AS m FROM d, s WHERE len(ws) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
x AS (SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM i JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q, r)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0) WHERE rank <= 10
""",
}
