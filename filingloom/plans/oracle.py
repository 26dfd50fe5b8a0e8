"""DuckDB SQL for the registered queries, over the same views."""

from __future__ import annotations

from ..functions import rules as R
from .queries import WORDS
from .views import AS_OF, view_sql


def _text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(map(_text, words)) + "]"


def _hits(s: str, words: list[str]) -> str:
    return f"len(list_filter({_list(words)}, lambda w: contains({s}, w)))"


def _any(s: str, words: list[str]) -> str:
    return f"({_hits(s, words)} > 0)"


def _matched(s: str, words: list[str], label: str = "") -> str:
    return f"list_transform(list_filter({_list(words)}, lambda w: contains({s}, w)), lambda w: {_text(label)} || w)"


def _weight(s: str, weights: list[tuple[str, int]]) -> str:
    listed = "[" + ", ".join(f"{{'p': {_text(p)}, 'w': {w}}}" for p, w in weights) + "]"
    return f"coalesce(list_sum(list_transform(list_filter({listed}, lambda x: contains({s}, x.p)), lambda x: x.w)), 0)"


def _class(s: str, classes: list[tuple[str, list[str]]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {_any(s, words)} THEN {_text(name)}" for name, words in classes) + f" ELSE {other} END"


def _with(body: str, *views: str) -> str:
    return "WITH " + ", ".join(f"{v} AS ({view_sql(v)})" for v in views) + (" " if body.lstrip().startswith("SELECT") else ", ") + body


def _first(s: str, patterns: list[str], group: int = 0) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({s}, {_text(p)}, {group}, 'i'), '')" for p in patterns) + ")"


_CLEAN = r"regexp_replace(regexp_replace({t}, '[a-f0-9]{{8}}-[a-f0-9]{{4}}-[a-f0-9]{{4}}-[a-f0-9]{{4}}-[a-f0-9]{{12}}', '', 'gi'), '\b[a-f0-9]{{8,}}\b', '', 'gi')"
_HOST = r"lower(regexp_extract({u}, '^[^:/?#]+://([^/?#]*)', 1))"
_PATH = r"regexp_extract({u}, '^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)', 1)"
_BARE = r"regexp_extract({u}, 'https?://(?:www\.)?([^/]+)', 1)"
_QUARTER = r"TRY_CAST(regexp_extract({t}, '[q\-]([1-4])(?:\s|q|$)', 1, 'i') AS INTEGER)"


def _root(s: str) -> str:
    return f"array_to_string(string_split({s}, '.')[-2:], '.')"


def _year(source: str, keep: str, text: str) -> str:
    """A chain of tables that ends in `dated` (keep, year)."""
    return rf"""
y1 AS (SELECT {keep}, {_CLEAN.format(t=text)} AS clean FROM {source}),
y2 AS (SELECT {keep}, clean, regexp_extract(clean, '20[12]\d') AS hit, regexp_extract(clean, 'fy\s*(\d{{2,4}})', 1, 'i') AS fy FROM y1),
y3 AS (SELECT *, TRY_CAST(hit AS INTEGER) AS n, strpos(clean, hit) AS p FROM y2),
y4 AS (SELECT *, substr(clean, greatest(p - 10, 1), p + 14 - greatest(p - 10, 1)) AS ctx,
       CASE length(fy) WHEN 2 THEN 2000 + TRY_CAST(fy AS INTEGER) WHEN 4 THEN TRY_CAST(fy AS INTEGER) END AS f FROM y3),
dated AS (SELECT {keep}, clean, CASE WHEN n BETWEEN 2015 AND {AS_OF} AND length(regexp_replace(ctx, '[^a-f]', '', 'gi')) <= 0.4 * length(ctx) THEN n
       WHEN f BETWEEN 2020 AND {AS_OF + 2} THEN f END AS year FROM y4)"""


_TYPE = _class("lower(url || ' ' || title || ' ')", R.DOCUMENT_TYPES, "CASE WHEN contains(url, '.pdf') THEN 'PDF Document' ELSE 'Financial Document' END")
_EXT = "CASE " + " ".join(f"WHEN contains(lower(url), '{e}') THEN '{e}'" for e in R.FILE_EXTENSIONS) + " ELSE '.unknown' END"
_FEATURED = _year("v_docs", "ord, ticker, title, url, relevance_score", "title") + f""",
featured AS (SELECT ord, ticker, title, url, relevance_score, {_TYPE} AS document_type, year AS extracted_year, {_QUARTER.format(t='title')} AS extracted_quarter, {_EXT} AS file_extension FROM dated)
"""
_RANK = "row_number() OVER (PARTITION BY {keys} ORDER BY relevance_score DESC, ord)"
_LINK_TEXT = "lower(url || ' ' || text || ' ' || title)"
_DOC_TEXT = "lower(url || ' ' || title)"
_PROFILE = "upper(string_split(string_split(CASE WHEN contains(url, '/quotes/') THEN string_split(url, '/quotes/')[-1] WHEN contains(url, '/symbol/') THEN string_split(url, '/symbol/')[-1] END, '?')[1], '/')[1])"
_IR = f"{_weight('lower(url)', R.LINK_URL_WEIGHTS)} + {_weight(_T := chr(39).join(['lower(text || ', ' ', ' || title)']), R.LINK_TEXT_WEIGHTS)} + {_weight(chr(39).join(['lower(text || ', ' ', ' || title || ', ' ', ' || url)']), R.LINK_DOCUMENT_WEIGHTS)}"
_SITE = f"{_weight('lower(url)', R.SITE_URL_WEIGHTS)} + {_weight(_T, R.SITE_TEXT_WEIGHTS)}"
_SPACED = r"trim(regexp_replace({s}, '\s+', ' ', 'g'))"
_SENTENCES = "s AS (SELECT ord // 100000000000 AS page_id, ord, text FROM v_metrics)"
_WEBSITE = (
    f"CASE WHEN dom = '' OR {_any('dom', R.IGNORED_HOSTS)} THEN -1000 ELSE CASE WHEN contains(dom, lower(ticker)) THEN 100 ELSE 0 END "
    r"+ 50 * len(list_filter(string_split_regex(trim(regexp_replace(lower(company_name), '[^\w\s]', '', 'g')), '\s+'), "
    f"lambda w: w <> '' AND NOT list_contains({_list(R.COMPANY_SUFFIXES)}, w) AND length(w) > 3 AND contains(dom, w))) + CASE WHEN {_any('lower(url)', R.SITE_URL_HINTS)} THEN 30 ELSE 0 END "
    f"+ CASE WHEN {_any('lower(text)', R.SITE_TEXT_HINTS)} THEN 20 ELSE 0 END + CASE WHEN length(dom) - length(replace(dom, '.', '')) <= 2 THEN 10 ELSE 0 END END"
)
_WEB = f"w AS (SELECT *, lower({_BARE.format(u='url')}) AS dom FROM v_links), scored AS (SELECT *, {_WEBSITE} AS score, {_any('lower(url)', R.SITE_URL_HINTS)} OR {_any('lower(text)', R.SITE_TEXT_HINTS)} AS is_ir FROM w)"
_CANDIDATES = (
    f"c AS (SELECT ticker, company_website, {_root(_BARE.format(u='company_website'))} AS root FROM v_company WHERE company_website IS NOT NULL), "
    f"cand AS (SELECT ticker, i - 1 AS ord, replace(replace(replace({_list(R.CANDIDATE_SITES)}[i], '{{root}}', root), '{{ticker}}', lower(ticker)), '{{base}}', string_split(root, '.')[1]) AS url FROM c, range(1, {len(R.CANDIDATE_SITES) + 1}) t(i))"
)
_ON_SITE = "(contains(lower({u}), {r}) OR " + _any("lower({u})", R.INVESTOR_HOSTS).replace("{u}", "{{u}}").replace("{{u}}", "{u}") + " OR " + " OR ".join("contains(lower({u}), '" + p.replace("{base}", "' || string_split({r}, '.')[1] || '") + "')" for p in R.OTHER_SITES) + ")"


def _on_site(u: str, r: str) -> str:
    return _ON_SITE.replace("{u}", u).replace("{r}", r)


_QUEUE = "q AS (SELECT -(ord % 97) / 97.0 AS priority, url || '/' || ord AS url, ord % 4 AS depth, ord AS seq FROM v_links), seen AS (SELECT url FROM q WHERE seq % 4 = 0)"


def _keyword_rank(name: str, text: str, words: list[str], most: int | None = None, order: str = "relevance_score DESC, ord") -> str:
    cut = "" if most is None else f" WHERE rank <= {most}"
    return _with(f"{_SENTENCES}, f AS (SELECT page_id, ord, {_hits(text, words)} AS relevance_score FROM s) "
                 f"SELECT * FROM (SELECT page_id, ord, relevance_score, row_number() OVER (PARTITION BY page_id ORDER BY {order}) AS rank FROM f WHERE relevance_score > 0){cut}", "v_metrics")  # fmt: skip


_ACTION = f"list_filter([{', '.join(f'CASE WHEN {_any('lower(intent)', w)} THEN {_text(n)} END' for n, w in R.ACTION_WORDS)}], lambda x: x IS NOT NULL)"
_TARGET = f"list_filter([{', '.join(f'CASE WHEN regexp_matches(lower(intent), {_text(p)}) THEN {_text(n)} END' for n, p in R.TARGET_PATTERNS)}], lambda x: x IS NOT NULL)"
_INTENT = (
    f"i0 AS (SELECT ord, intent, {_ACTION} AS a0, {_TARGET} AS t0 FROM v_intents), "
    "i1 AS (SELECT ord, intent, CASE WHEN len(a0) = 0 THEN ['find'] ELSE a0 END AS actions, CASE WHEN len(t0) = 0 THEN ['content'] ELSE t0 END AS targets FROM i0), "
    "i2 AS (SELECT *, list_filter([CASE WHEN list_contains(targets, 'documents') OR list_contains(actions, 'download') THEN 'documents' END, CASE WHEN list_contains(targets, 'links') OR list_contains(actions, 'find') THEN 'links' END, "
    "CASE WHEN list_contains(targets, 'tables') THEN 'tables' END, CASE WHEN list_contains(targets, 'content') OR list_contains(actions, 'extract') THEN 'content' END], lambda x: x IS NOT NULL) AS types FROM i1)"
)
_VARIANTS = ", ".join(f"CASE WHEN {_any('lower(intent)', when)} THEN {_list(more)} ELSE [] END" for when, more in R.INTENT_VARIANTS)
_KEYWORDS = f"list_sort(list_distinct(flatten([list_filter({_list(R.INTENT_KEYWORDS)}, lambda w: contains(lower(intent), w)), {_VARIANTS}])))"
_CONTENT_WORDS = (
    "cw AS (SELECT ord, word, min(i) AS i FROM (SELECT ord, ws[i] AS word, i FROM (SELECT ord, regexp_extract_all(lower(intent), '\\b\\w+\\b') AS ws FROM v_intents), unnest(range(1, len(ws) + 1)) t(i)) "
    f"WHERE length(word) > 3 AND NOT list_contains({_list(R.STOP_WORDS)}, word) GROUP BY ord, word), "
    "cl AS (SELECT ord, list(word ORDER BY i)[1:10] AS words FROM cw GROUP BY ord)"
)
_REFINED = "CASE " + " ".join(f"WHEN {_any(f'lower({c})', words)} THEN {_text(says)}" for c, words, says in R.REFINED_INTENTS) + f" ELSE {_text(R.REFINED_OTHER)} END"
_HEURISTIC = "CASE " + " ".join(f"WHEN {_any('(lower(text) || lower(url))', words)} THEN {_text(says + 'reports')}" for _, words, says in R.HEURISTIC_INTENTS) + " ELSE 'Explore ''' || lower(text) || ''' to find content relevant to: reports' END"
_SECTION = (
    f"x AS (SELECT *, lower(trim(text)) AS t, lower(url) AS h, 'https://' || {_HOST.format(u='url')} || '/' AS base, regexp_replace(url, '[?#].*$', '') AS address FROM v_links), "
    f"k AS (SELECT *, len(list_filter({_list(R.SECTION_PRIORITY)}, lambda w: contains(t, w) OR contains(h, w))) AS priority FROM x WHERE url <> '' AND NOT starts_with(url, '#') AND NOT starts_with(url, 'javascript:') AND length(trim(text)) >= 3 "
    f"AND {_HOST.format(u='url')} = {_HOST.format(u='base')} AND len(list_filter(string_split_regex(t, '\\s+'), lambda w: w <> '')) BETWEEN 1 AND 6 AND len(list_filter(string_split({_PATH.format(u='h')}, '/'), lambda p: p <> '')) <= 3 "
    f"AND ({_any('t', R.SECTION_WORDS)} OR {_any('h', R.SECTION_WORDS)}) AND NOT {_any('t', R.SECTION_STOPS)} AND address <> base), "
    "one AS (SELECT *, row_number() OVER (PARTITION BY page_id, address ORDER BY priority DESC, ord) AS rn FROM k) "
    "SELECT * FROM (SELECT page_id, address, ord, priority, row_number() OVER (PARTITION BY page_id ORDER BY priority DESC, ord) AS rank FROM one WHERE rn = 1) WHERE rank <= 20"
)
_SAFE = r"trim(regexp_replace(regexp_replace(translate({s}, '<>:" + '"' + r"/\|?*', '_________'), '^[. ]+|[. ]+$', '', 'g'), '\s+', ' ', 'g'))"
_FILE_TYPE = _class("lower(file_name)", R.FILE_NAME_TYPES, _text(R.OTHER_FILE))

ORACLE: dict[str, str] = {
    "latest_doc_per_type": _with(_FEATURED + """SELECT ticker, document_type, ord, title, url, extracted_year, extracted_quarter FROM (SELECT *, row_number() OVER (PARTITION BY ticker, document_type ORDER BY extracted_year DESC NULLS LAST,
        CASE WHEN extracted_year IS NOT NULL THEN coalesce(extracted_quarter, -1) ELSE -1 END DESC, CASE WHEN extracted_year IS NOT NULL THEN relevance_score ELSE 0 END DESC, ord) AS rn FROM featured) WHERE rn = 1""", "v_docs"),
    "latest_quarterly_report": _with(_FEATURED + f", p(document_type, k) AS (VALUES {', '.join(f'({_text(n)}, {k})' for n, k in R.QUARTERLY_PRIORITY)}) "
        "SELECT ticker, document_type, ord, extracted_year, extracted_quarter FROM (SELECT f.*, row_number() OVER (PARTITION BY ticker ORDER BY extracted_quarter IS NOT NULL DESC, coalesce(extracted_year, 0) DESC, coalesce(extracted_quarter, 0) DESC, k, relevance_score DESC, ord) AS rn "
        "FROM featured f JOIN p USING (document_type)) WHERE rn = 1", "v_docs"),
    "classify_documents": _with(f"SELECT ord, {_TYPE} AS document_type FROM v_docs", "v_docs"),
    "document_features": _with("u AS (SELECT ord, title, url, title || ' ' || url AS t FROM v_docs)," + _year("u", "ord, title, url, t", "t") + f""" SELECT ord, substr(title, 1, 200) AS title, string_split(string_split(url, '#')[1], '?')[1] AS normalized_url, {_TYPE} AS document_type, {_first('t', R.DATE_PATTERNS)} AS publication_date,
        {_EXT} AS file_extension, substr(title, 1, 150) AS content_preview, {_TYPE} AS subsection, year AS extracted_year, {_QUARTER.format(t='t')} AS extracted_quarter FROM dated""", "v_docs"),
    "classify_filenames": _with(f"SELECT ord, {_FILE_TYPE} AS document_type, 2000 + TRY_CAST(regexp_extract(file_name, '20(\\d{{2}})', 1) AS INTEGER) AS year, TRY_CAST(regexp_extract(file_name, '[Qq]([1-4])', 1) AS INTEGER) AS quarter FROM v_files", "v_files"),
    "extract_year_strict": _with(_year("v_docs", "ord", "title") + " SELECT ord, year FROM dated", "v_docs"),
    "extract_year_extended": _with("u AS (SELECT ord, url || ' ' || title AS t FROM v_docs)," + _year("u", "ord", "t") + rf""", z AS (SELECT ord, year, coalesce(TRY_CAST(regexp_extract(clean, '(?:[1-4]q|q[1-4])\s*(\d{{2}})(?:\D|$)', 1, 'i') AS INTEGER), TRY_CAST(regexp_extract(clean, '(?:^|\D)(\d{{2}})\s*$', 1) AS INTEGER)) AS short,
        TRY_CAST(regexp_extract(clean, '/(20\d{{2}})/', 1) AS INTEGER) AS a, TRY_CAST(regexp_extract(clean, '[-_](20\d{{2}})[.\-_]', 1) AS INTEGER) AS b, 2000 + TRY_CAST(regexp_extract(clean, '\d{{10}}-(\d{{2}})-\d{{6}}', 1) AS INTEGER) AS c FROM dated)
        SELECT ord, coalesce(year, CASE WHEN a BETWEEN 2020 AND {AS_OF + 2} THEN a END, CASE WHEN b BETWEEN 2020 AND {AS_OF + 2} THEN b END, CASE WHEN c BETWEEN 2020 AND {AS_OF + 2} THEN c END, CASE WHEN short BETWEEN 20 AND {min(30, AS_OF + 2 - 2000)} THEN 2000 + short END) AS year FROM z""", "v_docs"),
    "extract_quarter": _with(f"SELECT ord, {_QUARTER.format(t='title')} AS quarter FROM v_docs", "v_docs"),
    "extract_date_text": _with(f"SELECT ord, {_first('title', R.DATE_PATTERNS)} AS date_text FROM v_docs", "v_docs"),
    "file_extension": _with(rf"SELECT ord, {_EXT} AS contained, CASE WHEN regexp_matches(p, '[^.].*\.[^.]{{0,5}}$') THEN lower(regexp_extract(p, '(\.[^.]*)$', 1)) ELSE '.bin' END AS suffix FROM (SELECT ord, url, string_split({_PATH.format(u='url')}, '/')[-1] AS p FROM v_docs)", "v_docs"),
    "generate_filename": _with(_FEATURED + rf""", g AS (SELECT ord, document_type, title, file_extension, {_SAFE.format(s='substr(title, 1, 50)')} AS clean, CASE WHEN extracted_year IS NULL THEN '' ELSE ' - ' || extracted_year || CASE WHEN extracted_quarter IS NULL THEN '' ELSE '_Q' || extracted_quarter END END AS dated FROM featured),
        n AS (SELECT ord, document_type || dated || CASE WHEN length(title) > 10 AND NOT contains(document_type, clean) THEN ' - ' || clean ELSE '' END AS whole, file_extension AS e FROM g)
        SELECT ord, {_SAFE.format(s="CASE WHEN ends_with(whole, e) THEN whole ELSE whole || e END")} AS file_name FROM n""", "v_docs"),
    "filename_from_url": _with(rf"SELECT ord, CASE WHEN n = '' THEN 'Financial Document' ELSE n END AS name FROM (SELECT ord, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(string_split({_PATH.format(u='url')}, '/')[-1], '[-_]', ' ', 'g'), '\.(pdf|xlsx?|pptx?|docx?)$', '', 'i'), '\b[a-f0-9]{{32,}}\b', '', 'gi'), '\s+', ' ', 'g')) AS n FROM v_docs)", "v_docs"),
    "sanitize_company": _with(r"SELECT ticker, trim(regexp_replace(regexp_replace(translate(company_name, '/\', '__'), '[^a-zA-Z0-9 .\-_&]', '', 'g'), '\s+', ' ', 'g')) AS folder FROM v_company", "v_company"),
    "financial_metrics": _with(f"SELECT ord, {_first('text', [n + R.AMOUNT for n in R.REVENUE_NAMES], 1)} AS revenue, {_first('text', [n + R.AMOUNT for n in R.PROFIT_NAMES], 1)} AS profit FROM v_metrics", "v_metrics"),
    "normalize_url_doc": _with("SELECT ord, string_split(string_split(url, '#')[1], '?')[1] AS address FROM v_docs", "v_docs"),
    "normalize_url_crawl": _with(f"""u AS (SELECT ord, url FROM v_links UNION ALL SELECT ord, url FROM v_docs),
        k AS (SELECT ord, lower(regexp_extract(url, '^([^:/?#]+:)', 1)) || CASE WHEN regexp_matches(url, '^[^:/?#]+://') THEN '//' || {_HOST.format(u='url')} ELSE '' END AS site, rtrim({_PATH.format(u='url')}, '/') AS path, list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]*=.+')) AS ps FROM u),
        o AS (SELECT ord, site, path, list_transform(list_sort(list_transform(range(1, len(ps) + 1), lambda i: {{'k': string_split(ps[i], '=')[1], 'i': i, 'p': ps[i]}})), lambda x: x.p) AS qs FROM k)
        SELECT ord, site || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(qs) > 0 THEN '?' || array_to_string(qs, '&') ELSE '' END AS address FROM o""", "v_links", "v_docs"),
    "domain_info": _with(f"SELECT ord, {_HOST.format(u='url')} AS host, {_BARE.format(u='url')} AS bare, {_root(_BARE.format(u='url'))} AS root FROM v_links", "v_links"),
    "direct_file_filter": _with(f"SELECT ord, url FROM v_links WHERE {_any('lower(url)', R.FILE_EXTENSIONS)} OR " + " OR ".join(f"regexp_matches(lower(url), {_text(p)})" for p in R.DELIVERY_PATTERNS), "v_links"),
    "valid_ir_url": _with(f"SELECT ord, url FROM v_links WHERE NOT {_any('lower(url)', R.BAD_SITE_WORDS)} AND {_any('lower(url)', R.GOOD_SITE_WORDS)}", "v_links"),
    "valid_ir_domain": _with(f"SELECT ord, url FROM v_links WHERE {_on_site('url', chr(39) + 'building.com' + chr(39))}", "v_links"),
    "keyword_filter_docs": _with(f"f AS (SELECT ticker, ord, {_hits(_DOC_TEXT, WORDS)} AS relevance_score, array_to_string({_matched(_DOC_TEXT, WORDS)}, ',') AS matched FROM v_docs) SELECT *, {_RANK.format(keys='ticker')} AS rank FROM f WHERE relevance_score > 0", "v_docs"),
    "keyword_filter_links": _with(f"f AS (SELECT page_id, category, ord, {_hits(_LINK_TEXT, WORDS)} AS relevance_score FROM v_links) SELECT *, {_RANK.format(keys='page_id, category')} AS rank FROM f WHERE relevance_score > 0", "v_links"),
    "keyword_filter_paragraphs_top20": _keyword_rank("paragraphs", "lower(text)", ["revenue", "net income", "profit"], 20),
    "keyword_filter_images_top10": _keyword_rank("images", "lower(text || ' chart')", ["revenue", "chart", "earnings"], 10),
    "keyword_filter_headings": _keyword_rank("headings", "lower(text)", ["revenue", "profit"], None, "ord"),
    "keyword_filter_tables": _with(f"{_SENTENCES}, t AS (SELECT page_id, CAST(floor(ord / 1000) AS BIGINT) AS ord, 'item amount ' || lower(array_to_string(list(text ORDER BY ord, text)[1:5], ' ')) AS c FROM s GROUP BY page_id, CAST(floor(ord / 1000) AS BIGINT)), "
        f"f AS (SELECT page_id, ord, {_hits('c', ['revenue', 'amount', 'profit'])} AS relevance_score FROM t) SELECT *, {_RANK.format(keys='page_id')} AS rank FROM f WHERE relevance_score > 0", "v_metrics"),
    "ir_link_score": _with(f"f AS (SELECT page_id, category, ord, {_IR} AS ir_score, {_hits(_LINK_TEXT, ['investor', 'earnings'])} AS keyword_score, array_to_string({_matched('lower(url)', [p for p, _ in R.LINK_URL_WEIGHTS], 'URL:')} || {_matched(_T, [p for p, _ in R.LINK_TEXT_WEIGHTS], 'TEXT:')}, ',') AS patterns FROM v_links), "
        f"g AS (SELECT *, ir_score + 10 * keyword_score AS relevance_score FROM f) SELECT *, {_RANK.format(keys='page_id, category')} AS rank FROM g WHERE relevance_score > 15", "v_links"),
    "ir_link_score_ext": _with(f"f AS (SELECT page_id, category, ord, {_SITE} AS relevance_score FROM v_links) SELECT *, {_RANK.format(keys='page_id, category')} AS rank FROM f WHERE relevance_score > 15", "v_links"),
    "ir_doc_score": _with(f"f AS (SELECT ticker, ord, 2 * {_weight(_DOC_TEXT, R.DOCUMENT_WEIGHTS)} + {_hits(_DOC_TEXT, WORDS)} AS relevance_score, array_to_string({_matched(_DOC_TEXT, [p for p, _ in R.DOCUMENT_WEIGHTS])}, ',') AS patterns FROM v_docs) SELECT *, {_RANK.format(keys='ticker')} AS rank FROM f WHERE relevance_score > 0", "v_docs"),
    "table_company_links": _with(f"f AS (SELECT page_id, ord, category, {_PROFILE} AS t, lower(url) AS u, {_IR} + 10 * {_hits(_LINK_TEXT, ['investor'])} AS s FROM v_links), "
        "a AS (SELECT page_id, ord, 'internal' AS category, 2 AS tier, t AS ticker, CAST(0.95 AS DOUBLE) AS relevance_score FROM f WHERE (contains(u, '/quotes/') OR contains(u, '/symbol/')) AND contains(u, 'cnbc.com') AND length(t) BETWEEN 1 AND 5 "
        "UNION ALL SELECT page_id, ord, category, 3, NULL, CAST(s AS DOUBLE) FROM f WHERE s > 15) SELECT * FROM a WHERE tier = (SELECT min(tier) FROM a b WHERE b.page_id = a.page_id)", "v_links"),
    "link_priority": _with(f"b AS (SELECT *, CASE category WHEN 'internal' THEN CAST(1.0 AS DOUBLE) WHEN 'external' THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END AS p, CASE WHEN ord % 2 = 0 THEN ord % 3 ELSE 0 END AS r, {_LINK_TEXT} AS t FROM v_links), "
        f"c AS (SELECT page_id, ord, url, t, p + r * CAST(0.5 AS DOUBLE) + {_hits('t', ['investor', 'earnings'])} * CAST(0.2 AS DOUBLE) + CASE WHEN length(url) - length(replace(url, '/', '')) > 3 THEN CAST(0.1 AS DOUBLE) ELSE 0 END AS p FROM b), "
        f"e AS (SELECT page_id, ord, round(p * CASE WHEN {_any('lower(url)', R.PENALTY_WORDS)} THEN CAST(0.3 AS DOUBLE) ELSE 1 END + CASE WHEN {_any('t', R.DOCUMENT_BONUS)} THEN CAST(0.3 AS DOUBLE) ELSE 0 END + CASE WHEN {_any('t', R.TABLE_BONUS)} THEN CAST(0.3 AS DOUBLE) ELSE 0 END, 3) AS final_priority FROM c) "
        "SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY final_priority DESC, ord) AS rank FROM e WHERE final_priority >= 0.5", "v_links"),
    "refined_intent": _with(f"SELECT ord, {_REFINED} AS refined_intent, {_HEURISTIC} AS heuristic_intent FROM v_links", "v_links"),
    "intent_keywords": _with(f"{_CONTENT_WORDS} SELECT ord, array_to_string({_KEYWORDS}, ',') AS keywords, coalesce(array_to_string(words, ','), '') AS content_words FROM v_intents LEFT JOIN cl USING (ord)", "v_intents"),
    "intent_targets": _with(f"{_INTENT}, m AS (SELECT *, {_KEYWORDS} AS ks, lower(intent) AS low FROM i2) SELECT ord, array_to_string(list_concat(['links'], list_filter([{', '.join(f'CASE WHEN {_any('low', w)} THEN {_text(n)} END' for n, w in R.INTENT_TARGETS)}], lambda x: x IS NOT NULL)), ',') AS target_types, "
        f"array_to_string(actions, ',') AS actions, array_to_string(targets, ',') AS targets, {_class('low', R.DOMAIN_WORDS, 'NULL')} AS domain, (length(intent) > 50 OR (contains(low, ' and ') AND contains(low, ' then ')) OR {_any('low', R.COMPLEX_WORDS)} OR length(intent) - length(replace(intent, ',', '')) > 2) AS is_complex, "
        f"array_to_string(types, ',') AS strategy_types, (list_has_any(ks, {_list(R.INVESTOR_INTENT)}) OR {_any('low', R.INVESTOR_INTENT)}) AS is_investor FROM m", "v_intents"),
    "intent_strategy": _with(f"""{_CONTENT_WORDS}, {_INTENT}, j AS (SELECT i2.*, coalesce(array_to_string(words[1:5], ', '), '') AS k, ord % 2 = 0 AS hd, ord % 3 = 0 AS ht, ord % 5 AS il FROM i2 LEFT JOIN cl USING (ord)),
        st AS (SELECT *, list_filter([CASE WHEN list_contains(types, 'documents') THEN CASE WHEN hd THEN 'filter_documents: Document URL or text contains keywords: ' || k ELSE 'search_links_for_documents: Find links that might lead to documents (containing: ' || k || ')' END END,
        CASE WHEN list_contains(types, 'links') THEN 'filter_links: Link URL or text contains keywords: ' || k END, CASE WHEN list_contains(types, 'tables') THEN 'extract_tables: Tables with headers or content related to: ' || k END, CASE WHEN list_contains(types, 'content') THEN 'extract_content: Text content containing keywords: ' || k END], lambda x: x IS NOT NULL) AS s FROM j)
        SELECT ord, 'Action: ' || array_to_string(actions, ', ') || '. Targets: ' || array_to_string(targets, ', ') || '. Focus on: ' || k AS expanded_intent, array_to_string(list_transform(range(1, len(s) + 1), lambda i: CAST(i AS STRING) || '. ' || s[i]), '; ') AS steps,
        array_to_string(list_filter([CASE WHEN hd THEN 'Download and analyze documents' END, CASE WHEN il > 0 THEN 'Follow internal links for more content' END, CASE WHEN NOT hd AND NOT ht THEN 'Navigate to linked pages to find target content' END], lambda x: x IS NOT NULL), '; ') AS next_actions FROM st""", "v_intents"),
    "intent_sections": _with("SELECT ord, intent AS keywords, 'links' AS targets FROM v_intents", "v_intents"),
    "page_type": _with(f"g AS (SELECT page_id, list_sort(list(text))[1] AS h, count(*) FILTER (contains(url, '.pdf')) AS docs, count(*) FILTER (category = 'internal') AS n FROM v_links GROUP BY page_id) "
        f"SELECT page_id, {_class('lower(' + _text('Home ') + ' || h)', R.PAGE_TYPES, 'CASE WHEN docs > 5 THEN ' + _text('document_library') + ' WHEN n > 20 THEN ' + _text('navigation_hub') + ' ELSE ' + _text('content_page') + ' END')} AS page_type FROM g", "v_links"),
    "page_anchors": "WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\">[^<]*</a>', 1) AS h, regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1) AS t FROM pages) SELECT page_id, CAST(i - 1 AS INTEGER) AS ord, 'navigation' AS category, h[i] AS href, trim(t[i]) AS text FROM a, unnest(range(1, len(h) + 1)) u(i)",
    "page_titles": r"SELECT page_id, trim(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS title FROM pages",
    "page_headings": r"SELECT page_id, CAST(0 AS INTEGER) AS ord, CAST(1 AS INTEGER) AS level, trim(replace(replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS text FROM pages",
    "page_links_parsed": "WITH a AS (SELECT page_id, regexp_extract(url, '^[^:/?#]+://[^/?#]*') AS origin, regexp_extract_all(html, '<a href=\"([^\"]*)\">[^<]*</a>', 1) AS h, regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1) AS t FROM pages) "
        "SELECT page_id, CAST(i - 1 AS INTEGER) AS ord, 'navigation' AS category, origin || h[i] AS url, h[i] AS href, trim(t[i]) AS text, '' AS title FROM a, unnest(range(1, len(h) + 1)) u(i)",
    "page_tables": _with("""SELECT page_id, CAST(0 AS INTEGER) AS ord, CAST(part_key % 4 AS INTEGER) AS row_count, CAST(2 AS INTEGER) AS column_count, 'Name|Brand' AS headers, array_to_string(list_transform(range(part_key % 4), lambda i: name || '|' || brand), '|') AS body,
        'Sum|' || part_key AS footer, array_to_string(list_transform(range(part_key % 4), lambda i: origin || '/quotes/' || part_key || ' ' || name || ' true'), '|') AS links FROM v_wrapped
        UNION ALL SELECT page_id, 1, 1, 1, 'Type', type, '', '' FROM v_wrapped WHERE part_key % 3 = 0 UNION ALL SELECT page_id, 0, 0, 0, '', '', '', '' FROM pages WHERE contains(html, '<table')""", "v_wrapped"),
    "page_documents": _with(r"""SELECT page_id, CAST(0 AS INTEGER) AS ord, origin || '/files/' || part_key || '.pdf' AS url, 'Report on ' || name AS text, 'PDF' AS type FROM v_wrapped UNION ALL SELECT page_id, 1, origin || '/parts/' || part_key || '/data/' || part_key || '.CSV', 'Data', 'CSV' FROM v_wrapped
        UNION ALL SELECT page_id, 0, '', '', '' FROM pages WHERE regexp_matches(lower(html), 'href="[^"]*\.(pdf|docx?|xlsx?|pptx?|zip|csv)"')""", "v_wrapped"),
    "page_images": _with("SELECT page_id, CAST(i AS INTEGER) AS ord, origin || '/parts/' || part_key || '/i/' || part_key || '.png' AS url, name AS alt, brand AS title FROM v_wrapped, unnest(range(least(part_key % 25, 20))) t(i) UNION ALL SELECT page_id, 0, '', '', '' FROM pages WHERE contains(html, '<img')", "v_wrapped"),
    "page_metadata": _with("""SELECT page_id, '{"description":"' || CASE WHEN part_key % 2 = 0 THEN 'later ' || name ELSE type || ' ' || brand END || '","og:title":"' || name || '"}' AS metadata FROM v_wrapped UNION ALL SELECT page_id, '{}' FROM pages""", "v_wrapped"),
    "page_content": _with(r"""x AS (SELECT *, list_concat([name, 'All there is to say of', name, 'by ' || brand, type, 'Name', 'Brand'], flatten(list_transform(range(part_key % 4), lambda i: [name, brand])), ['Sum', CAST(part_key AS VARCHAR)], CASE WHEN part_key % 3 = 0 THEN ['Type', type] ELSE [] END,
        ['Report on ' || name, 'Data', 'Other', 'Out', 'Mail']) AS parts FROM v_wrapped)
        SELECT page_id, 'All there is to say of' || name || 'by ' || brand AS paragraphs, array_to_string(parts, chr(10)) AS full_text, CAST(len(regexp_extract_all(array_to_string(parts, ' '), '\S+')) AS INTEGER) AS word_count FROM x""", "v_wrapped"),
    "content_summary": _with("""SELECT page_id, CAST(1 + CAST(part_key % 3 = 0 AS INTEGER) AS INTEGER) AS table_count, CAST(2 AS INTEGER) AS document_count, CAST(3 + part_key % 4 AS INTEGER) AS internal_link_count, CAST(1 AS INTEGER) AS external_link_count, CAST(1 AS INTEGER) AS navigation_link_count,
        CAST(1 AS INTEGER) AS heading_count, true AS has_tables, true AS has_documents, true AS has_internal_links, true AS has_external_links, true AS has_navigation_links, 'CSV,PDF' AS document_types FROM v_wrapped
        UNION ALL SELECT page_id, 0, 0, 0, 0, CAST(len(regexp_extract_all(html, '<a href=')) AS INTEGER), CAST(len(regexp_extract_all(html, '<h[1-6]>')) AS INTEGER), false, false, false, false, contains(html, '<a href='), '' FROM pages""", "v_wrapped"),
    "section_discovery": _with(_SECTION, "v_links"),
    "website_score": _with(f"{_WEB} SELECT ord, score FROM scored", "v_links"),
    "best_website_and_ir": _with(f"{_WEB}, b AS (SELECT ticker, arg_max(url, score * 1000000000 - ord) FILTER (is_ir) AS ir, arg_max(url, score * 1000000000 - ord) FILTER (NOT is_ir) AS web FROM scored WHERE score > 0 GROUP BY ticker) "
        f"SELECT ticker, ir AS investor_relations_url, coalesce(web, 'https://' || {_root('lower(' + _BARE.format(u='ir') + ')')}) AS company_website FROM b", "v_links"),
    "ir_candidates": _with(f"{_CANDIDATES} SELECT ticker, CAST(ord AS INTEGER) AS ord, url FROM cand", "v_company"),
    "resolve_ir": _with(f"""{_CANDIDATES}, pg AS (SELECT DISTINCT url FROM cand WHERE (ord * 7 + length(url)) % 5 = 0 AND length(url) % 2 = 0), pr AS (SELECT ticker, arg_min(url, ord) AS probed FROM cand SEMI JOIN pg USING (url) GROUP BY ticker),
        l AS (SELECT 'S' || (ord % 100) AS ticker, ord, url, text, title, {_SITE} AS s FROM v_links), sc AS (SELECT l.ticker, arg_max(l.url, l.s * 1000000000 - l.ord) AS scored FROM l JOIN c USING (ticker) WHERE l.s > 0 AND {_on_site('l.url', 'c.root')} GROUP BY l.ticker),
        w AS (SELECT v.*, probed, scored, coalesce(investor_relations_url, '') <> '' AND investor_relations_url IS DISTINCT FROM company_website AS known FROM v_company v LEFT JOIN pr USING (ticker) LEFT JOIN sc USING (ticker))
        SELECT ticker, CASE WHEN known THEN investor_relations_url ELSE coalesce(probed, scored, company_website) END AS investor_relations_url, CASE WHEN known THEN 'known' WHEN probed IS NOT NULL THEN 'candidate' WHEN scored IS NOT NULL THEN 'link' WHEN company_website IS NOT NULL THEN 'website' ELSE 'none' END AS extraction_method FROM w""", "v_company", "v_links"),
    "review_split": _with("SELECT ticker, CASE WHEN coalesce(investor_relations_url, '') = '' OR investor_relations_url IS NOT DISTINCT FROM company_website THEN 'review' ELSE 'found' END AS state FROM v_company", "v_company"),
    "enrich_companies": _with("SELECT ticker, CASE WHEN length(ticker) % 2 = 0 THEN company_website ELSE 'https://new.example.com' END AS company_website, investor_relations_url FROM v_company", "v_company"),
    "evaluate_link_value": _with(f"""x AS (SELECT ord, lower(url) AS u, lower(text) AS t FROM v_links), y AS (SELECT *, contains(u, 'building') OR contains(u, 'bld') AS own FROM x)
        SELECT ord, greatest(CAST(0 AS DOUBLE), CASE WHEN {_any('(u || chr(10) || t)', ['investor', 'ir/', 'investors', 'investor-relations', 'stockholder'])} THEN CASE WHEN own THEN 4 ELSE 2 END ELSE 0 END + CASE WHEN own THEN 1 ELSE 0 END + CASE WHEN {_any('(u || chr(10) || t)', ['about', 'corporate', 'company', 'finance'])} THEN CAST(0.5 AS DOUBLE) ELSE 0 END
        - CASE WHEN {_any('(u || chr(10) || t)', ['products', 'shop', 'cart', 'login', 'careers', 'news'])} THEN 1 ELSE 0 END) AS value FROM y""", "v_links"),
    "search_link_score": _with(f"""x AS (SELECT ord, url, text, lower(url) AS u, lower(text) AS t FROM v_links) SELECT ord, CAST(3 * {_hits('u', ['investor', 'investors', 'ir', 'shareholders', 'financials', 'stock'])} + 2 * {_hits('t', ['investor', 'investors', 'ir', 'shareholders', 'financials', 'stock'])}
        + {_hits('(u || chr(10) || t)', ['about', 'company', 'corporate', 'menu', 'navigation', 'building'])} + 2 * CAST(contains(url || chr(10) || text, 'BLD') AS INTEGER) + 2 * CAST(contains(u || chr(10) || t, 'bld') AS INTEGER) + 2 * {_hits('u', ['stock/BLD', 'quote/BLD', 'nyse:', 'nasdaq:', 'bld-stock', 'BLD-stock'])} AS INTEGER) AS score FROM x""", "v_links"),
    "href_forms": _with("""x AS (SELECT ord, regexp_replace(url, '^https?://[^/]*', '') AS h FROM v_links) SELECT ord, CASE WHEN starts_with(h, 'http') THEN h WHEN starts_with(h, '//') THEN 'https:' || h WHEN starts_with(h, '/') THEN 'https://www.example.com' || h ELSE 'https://www.example.com/' || h END AS prefixed,
        CASE WHEN starts_with(h, 'http') THEN h WHEN contains(h, 'example.com') THEN 'https:' || h ELSE 'https://example.com/' || h END AS sanitized, CASE WHEN starts_with(h, 'http') THEN h WHEN starts_with(h, '/') THEN 'https://c.example.com' || h ELSE 'https://c.example.com/' || h END AS appended FROM x""", "v_links"),
    "company_info_direct": _with(r"x AS (SELECT ticker, company_name || ' (' || upper(substr(ticker, 1, 4)) || ')' AS text FROM v_company) SELECT ticker, nullif(regexp_extract(text, '\(([A-Z]{1,5})\)', 1), '') AS found, trim(regexp_replace(text, '\([A-Z]{1,5}\)', '', 'g')) AS name FROM x", "v_company"),
    "global_url_dedup": _with(f"k AS (SELECT *, string_split(string_split(url, '#')[1], '?')[1] AS address FROM v_docs WHERE {_any('lower(url)', R.FILE_EXTENSIONS)} OR " + " OR ".join(f"regexp_matches(lower(url), {_text(p)})" for p in R.DELIVERY_PATTERNS)
        + ") SELECT ticker, ord, address FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY company_ord, page_ord, ord) AS rn FROM k) WHERE rn = 1", "v_docs"),
    "stream_latest": _with(_FEATURED + f", k AS (SELECT ord, string_split(string_split(url, '#')[1], '?')[1] AS address, company_ord, page_ord FROM v_docs WHERE {_any('lower(url)', R.FILE_EXTENSIONS)} OR " + " OR ".join(f"regexp_matches(lower(url), {_text(p)})" for p in R.DELIVERY_PATTERNS)
        + "), o AS (SELECT ord FROM (SELECT ord, row_number() OVER (PARTITION BY address ORDER BY company_ord, page_ord, ord) AS rn FROM k) WHERE rn = 1) "
        """SELECT ticker, document_type, ord, extracted_year, extracted_quarter FROM (SELECT f.*, row_number() OVER (PARTITION BY ticker, document_type ORDER BY extracted_year DESC NULLS LAST,
        CASE WHEN extracted_year IS NOT NULL THEN coalesce(extracted_quarter, -1) ELSE -1 END DESC, CASE WHEN extracted_year IS NOT NULL THEN relevance_score ELSE 0 END DESC, f.ord) AS rn FROM featured f JOIN o USING (ord)) WHERE rn = 1""", "v_docs"),
    "distinct_companies": _with("SELECT ticker, url, min(ord) AS ord FROM v_links WHERE ord % 9 <> 0 GROUP BY ticker, url", "v_links"),
    "skip_existing_anti": _with("SELECT ord, url FROM v_docs WHERE url NOT IN (SELECT url FROM v_docs WHERE ord % 3 = 0)", "v_docs"),
    "ticker_semi": _with("SELECT ord, ticker FROM v_docs WHERE ticker IN (SELECT ticker FROM v_docs WHERE ord % 997 = 1)", "v_docs"),
    "metadata_broadcast": _with("n AS (SELECT ticker, count(*) AS total FROM v_files GROUP BY ticker) SELECT ord, v_files.ticker, CASE WHEN total % 2 = 0 THEN total END AS total FROM v_files JOIN n USING (ticker)", "v_files"),
    "sample_documents": _with(f"SELECT ticker, document_type, file_name FROM (SELECT ticker, {_FILE_TYPE} AS document_type, file_name FROM v_files) WHERE document_type IN ('Proxy Statement', 'Presentation') ORDER BY ALL LIMIT 20", "v_files"),
    "per_group_sample": _with("SELECT ticker, file_name, ord, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY file_name, ord) AS k, dense_rank() OVER (ORDER BY ticker) AS g FROM v_files) WHERE k <= 2 AND g <= 3", "v_files"),
    "batch_slices": _with("SELECT CAST(ord // 7 AS INTEGER) AS batch, count(*) AS n, min(ord) AS first FROM v_files WHERE ord >= 10 AND ord < 500 GROUP BY 1", "v_files"),
    "batch_last_wins": _with("SELECT ticker, ord, CAST(ord // 7 AS INTEGER) AS batch, file_name FROM v_files WHERE (ticker, ord) IN (SELECT ticker, max(ord) FROM v_files GROUP BY ticker)", "v_files"),
    "regroup_by_ticker": _with("SELECT ticker, string_agg(file_name, '|' ORDER BY ord) AS files FROM v_files GROUP BY ticker", "v_files"),
    "extraction_summary": _with(_FEATURED + f", c AS (SELECT 'C' || c_custkey AS ticker FROM customer), j AS (SELECT c.ticker, f.* FROM c LEFT JOIN featured f ON f.ticker = c.ticker) "
        f"SELECT (SELECT count(*) FROM c) AS companies, count(file_extension) AS documents, count(DISTINCT CASE WHEN file_extension IS NOT NULL THEN ticker END) AS with_documents, count(*) FILTER (contains(file_extension, '.pdf')) AS pdf_files, count(*) FILTER (contains(file_extension, '.xls')) AS excel_files, count(*) FILTER (extracted_year < {AS_OF - 1}) AS old_documents, "
        "round(count(file_extension) / (SELECT count(*) FROM c), 4) AS average FROM j", "v_docs"),
    "download_stats_rollup": _with("SELECT ticker, count(*) FILTER (status = 'downloaded') AS downloaded, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped, round(coalesce(sum(size_mb) FILTER (status = 'downloaded'), 0), 6) AS size_mb, "
        "CASE WHEN count(*) FILTER (status = 'downloaded') > 0 THEN round(100.0 * count(*) FILTER (status = 'downloaded') / count(*) FILTER (status IN ('downloaded', 'failed')), 4) END AS success_percent FROM v_files GROUP BY ROLLUP (ticker)", "v_files"),
    "type_breakdown": _with(_FEATURED + "SELECT document_type, count(*) AS n FROM featured GROUP BY document_type", "v_docs"),
    "depth_distribution": _with("SELECT ord % 4 AS depth, count(*) AS n FROM v_docs GROUP BY 1", "v_docs"),
    "pdf_summary": _with("SELECT count(*) AS files, count(*) FILTER (ord % 5 > 0) AS succeeded, CAST(sum(length(text)) AS BIGINT) AS text_length, CAST(sum(ord % 3) AS BIGINT) AS tables FROM v_metrics", "v_metrics"),
    "resolution_summary": _with("SELECT count(*) AS companies, count(*) FILTER (f) AS found, count(*) FILTER (f) / count(*) AS success_rate FROM (SELECT coalesce(investor_relations_url, '') <> '' AND investor_relations_url IS DISTINCT FROM company_website AS f FROM v_company)", "v_company"),
    "crawl_summary": _with("SELECT count(*) FILTER (ord % 7 > 0) AS pages_crawled, CAST(max(ord % 5) FILTER (ord % 7 > 0) AS BIGINT) AS max_depth, (SELECT count(*) FROM v_docs) AS results, round(count(*) FILTER (ord % 7 > 0) / 600.0, 4) AS pages_per_second FROM v_links", "v_links", "v_docs"),
    "result_buckets": _with("SELECT bucket, count(*) AS n FROM (SELECT CASE ord % 7 WHEN 1 THEN 'media' WHEN 2 THEN 'press_releases' WHEN 3 THEN 'press_releases' ELSE 'documents' END AS bucket FROM v_docs) GROUP BY bucket", "v_docs"),
    "threshold_children": _with("x AS (SELECT url, ord, ord % 5 AS depth, CAST(ord % 11 AS DOUBLE) / 10 AS p, CASE WHEN length(url) % 3 > 0 THEN CAST(length(url) % 10 AS DOUBLE) / 10 END AS g FROM v_links) SELECT ord, round(p + CASE WHEN g > 0.5 THEN CAST(0.3 AS DOUBLE) ELSE 0 END, 4) AS priority FROM x "
        "WHERE NOT coalesce((g > 0.8 AND depth >= 2) OR (g < 0.3 AND depth > 2), false) AND depth < 4 AND p + CASE WHEN g > 0.5 THEN CAST(0.3 AS DOUBLE) ELSE 0 END >= 0.5", "v_links"),
    "crawl_bfs_depth": "WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM (" + view_sql("v_edges") + ")), r AS (SELECT CAST(1 AS BIGINT) AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM r JOIN e ON e.src = r.node WHERE depth < 4) SELECT node, min(depth) AS depth FROM r GROUP BY node",
    "crawl_rate_limited_batch": _with(f"""{_QUEUE}, f AS (SELECT * FROM q ORDER BY priority, depth, seq LIMIT 25), h AS (SELECT f.*, {_HOST.format(u='url')} AS host, url NOT IN (SELECT url FROM seen) AS live FROM f),
        b AS (SELECT *, live AND (coalesce(sum(CAST(live AS INTEGER)) OVER (PARTITION BY host ORDER BY priority, depth, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 OR host = 'www.cnbc.com') AS bad FROM h),
        k AS (SELECT *, sum(CAST(bad AS INTEGER)) OVER (ORDER BY priority, depth, seq ROWS UNBOUNDED PRECEDING) AS n FROM b) SELECT seq, url, live AS taken FROM k WHERE n = 0""", "v_links"),
    "crawl_admission": _with(f"""{_QUEUE}, ch AS (SELECT regexp_replace(url, '[0-9]/', '/', 'g') AS url, seq % 13 AS page_ord, seq AS ord FROM q), n AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_ord, ord) AS k FROM ch WHERE url NOT IN (SELECT url FROM seen) AND url NOT IN (SELECT url FROM q WHERE seq % 3 = 0))
        SELECT url, page_ord, ord FROM n WHERE k = 1 ORDER BY page_ord, ord LIMIT 400""", "v_links"),
    "scorer_store": _with(f"SELECT ord, round({_hits('lower(title)', WORDS)} / {len(WORDS)}.0, 4) AS relevance_score FROM v_docs", "v_docs"),
    "visit_calendar": _with(f"h AS (SELECT ord, {_HOST.format(u='url')} AS host FROM v_links) SELECT ord, host, CAST(1.5 * (row_number() OVER (PARTITION BY host ORDER BY ord) - 1) AS DOUBLE) AS slot FROM h", "v_links"),
    "visited_filter": _with("SELECT page_id, ord, url FROM v_links WHERE ord % 4 > 0 AND url NOT IN (SELECT url FROM v_links WHERE ord % 4 = 0)", "v_links"),
    "report_store": _with(f"SELECT ticker, 'Company ' || ticker AS company_name, ord || ' ' || file_name AS file_name, '{{\"ticker\":\"' || ticker || '\"}}' AS metadata, document_type, extracted_year, extracted_quarter, file_name AS content FROM "
        f"(SELECT v_files.*, {_FILE_TYPE} AS document_type, CASE WHEN contains(file_name, '2023') THEN 2023 END AS extracted_year, nullif(TRY_CAST(regexp_extract(ord || ' ' || file_name, '[Qq]([1-4])', 1) AS INTEGER), 0) AS extracted_quarter FROM v_files)", "v_files"),
    "page_store": "SELECT page_id, url, sha256(html) AS html_sha256 FROM pages",
    "json_documents": _with("SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY ord) - 1 AS ord, title, url, company_name AS company FROM v_docs", "v_docs"),
    "stream_crawl": "WITH RECURSIVE g AS (SELECT src, dst, max(score) AS score FROM (" + view_sql("v_edges") + """) WHERE src <> dst GROUP BY src, dst),
        a AS (SELECT DISTINCT src AS node FROM g WHERE length('https://h' || CAST(src % 997 AS VARCHAR) || '.example.com/' || CAST(src AS VARCHAR)) % 5 > 0),
        l AS (SELECT src, dst FROM g JOIN a ON a.node = g.src WHERE score >= 3), r AS (SELECT CAST(1 AS BIGINT) AS node UNION SELECT dst FROM r JOIN l ON l.src = r.node)
        SELECT 'https://h' || CAST(node % 997 AS VARCHAR) || '.example.com/' || CAST(node AS VARCHAR) AS url, 'h' || CAST(node % 997 AS VARCHAR) || '.example.com' AS host, node IN (SELECT node FROM a) AS success FROM r""",
    "substring_join": _with("""x AS (SELECT ord, lower(concat_ws(' ', url, title)) AS text FROM v_docs), p AS (SELECT DISTINCT unnest(['/' || CAST(p_partkey AS VARCHAR) || '/', '/' || CAST(p_partkey * 7 AS VARCHAR) || '/doc_' || CAST(p_partkey % 50 AS VARCHAR),
        '_' || CAST(p_partkey % 10 AS VARCHAR) || '.', p_name, lower(p_brand) || ' ' || lower(p_type), CAST(2000 + p_partkey % 100 AS VARCHAR)]) AS pattern FROM part) SELECT ord, pattern FROM x JOIN p ON contains(x.text, p.pattern)""", "v_docs"),
    "path_search": "WITH RECURSIVE v AS (" + view_sql("v_edges") + """), g AS (SELECT src, dst, min(ord) AS ord, max(score) AS score FROM v GROUP BY src, dst), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, ord) AS k FROM g WHERE score > 0) WHERE k <= 3),
        r AS (SELECT DISTINCT src AS node, [src] AS path, CAST(2 AS BIGINT) AS score, 0 AS n FROM g UNION ALL SELECT b.dst, list_append(path, b.dst), b.score, n + 1 FROM r JOIN b ON b.src = r.node WHERE r.score BETWEEN 2 AND 3 AND n < 3 AND NOT list_contains(path, b.dst))
        SELECT array_to_string(path, '>') AS path, score AS confidence FROM r WHERE score >= 4""",
    "llm_filter_stub_docs": _with(f"""h AS (SELECT ticker, ord, {_hits(_DOC_TEXT, WORDS)} AS h, count(*) OVER (PARTITION BY ticker) AS n FROM v_docs), k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY CASE WHEN n > 20 THEN h ELSE 0 END DESC, ord) AS k FROM h WHERE n <= 20 OR h > 0),
        s AS (SELECT ticker, ord, round(h / {len(WORDS)}.0, 4) AS relevance_score FROM k WHERE k <= 20 AND h / {len(WORDS)}.0 > 0.3) SELECT *, {_RANK.format(keys='ticker')} AS rank FROM s""", "v_docs"),
    "llm_filter_stub_links": _with(f"k AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS k FROM v_links WHERE category = 'internal'), s AS (SELECT page_id, ord, {_hits(_LINK_TEXT, ['investor', 'com'])} / 2.0 AS relevance_score FROM k WHERE k <= 30) SELECT *, {_RANK.format(keys='page_id')} AS rank FROM s WHERE relevance_score > 0.4", "v_links"),
    "llm_summary_stub": r"SELECT doc_id, CAST(length(array_to_string(string_split_regex(trim(substr(text, 1, 2000)), '\s+')[1:150], ' ')) AS INTEGER) AS length FROM documents",
    "tumbling_events": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY date_trunc('hour', ts), event_type",
    "sessions_events": "WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM a) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM b GROUP BY user_id, k",
    "ranked_links_global": _with(f"f AS (SELECT page_id, ord, {_SITE} AS score FROM v_links) SELECT page_id, ord, score FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, ord) AS k FROM f) WHERE k = 1", "v_links"),
}
