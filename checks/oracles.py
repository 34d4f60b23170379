"""The same results as plain SQL over the test tables, for DuckDB."""

from __future__ import annotations

from checks import fixtures as X
from newsight import settings
from newsight.functions.html import BLOCK_ELEMENTS, DROPPED_CLASSES, DROPPED_ELEMENTS, ENTITIES
from newsight.functions.text import WHITESPACE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) for v in values)


_SPACES = "||".join(f"chr({ord(c)})" for c in WHITESPACE)
# RE2 class of the same characters; \s alone is ASCII there
_SPACE_CLASS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(e: str) -> str:
    return f"trim({e}, {_SPACES})"


def canonical(e: str) -> str:
    """Test URLs need no re-encoding and repeat no key."""
    body = f"split_part({e}, '#', 1)"
    base = f"split_part({body}, '?', 1)"
    query = f"substr({body}, length({base}) + 2)"
    kept = (
        f"list_filter(string_split({query}, '&'), lambda p: contains(p, '=') "
        f"AND split_part(p, '=', 2) <> '' "
        f"AND NOT split_part(p, '=', 1) IN ({_list(settings.TRACKING_PARAMS)}))"
    )
    return f"{base} || CASE WHEN len({kept}) = 0 THEN '' ELSE '?' || array_to_string({kept}, '&') END"


def netloc(e: str) -> str:
    return f"regexp_extract({e}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)"


def any_of(e: str, needles) -> str:
    return "(" + " OR ".join(f"contains({e}, {_text(n)})" for n in needles) + ")"


def blocked(e: str) -> str:
    return any_of(f"lower({netloc(e)})", X.BLOCKED)


def redirect(e: str) -> str:
    return f"contains({e}, {_text(settings.REDIRECT_HOST)})"


def round2(e: str) -> str:
    """Decimal rounding of the exact binary value, ties to even."""
    p = f"(({e}) * 200.0::DOUBLE)"
    big = f"(({e}) * 134217729.0::DOUBLE)"
    high = f"({big} - ({big} - ({e})))"
    err = f"(({high} * 200.0::DOUBLE - {p}) + (({e}) - {high}) * 200.0::DOUBLE)"
    odd = f"({p} % 2.0::DOUBLE = 1.0 OR {p} % 2.0::DOUBLE = -1.0)"
    return (
        f"(CASE WHEN {odd} AND {err} > 0 THEN ({p} + 1.0::DOUBLE) / 2.0::DOUBLE "
        f"WHEN {odd} AND {err} < 0 THEN ({p} - 1.0::DOUBLE) / 2.0::DOUBLE "
        f"ELSE round_even({p} / 2.0::DOUBLE, 0) END / 100.0::DOUBLE)"
    )


AS_OF = f"TIMESTAMP '{X.AS_OF}'"

# ---- feeds -------------------------------------------------------------------

ENTRIES = f"""entries AS (
  SELECT page_id,
    CASE WHEN page_id % 17 = 16 THEN '' ELSE url END AS url,
    CASE WHEN page_id % 10 <> 9 THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END AS title,
    CASE WHEN page_id % 13 <> 12 THEN {AS_OF} - to_minutes((page_id * 37) % 2880) END AS tick,
    page_id // {X.PER_PAYLOAD} AS source_ord,
    page_id % {X.PER_PAYLOAD} AS pos
  FROM pages)"""

_PLACED = f"""
    source_ord % 5 = 4 AS redirect_feed,
    CASE WHEN source_ord % 5 = 4 THEN 'news.google.com'
         ELSE 'feed' || (source_ord % 7) || '.example.org' END AS source"""


def _feed_select(kind: str, where: str = "TRUE") -> str:
    if kind == "rss":
        date = "strftime(tick, '%a, %d %b %Y %H:%M:%S') || ' GMT'"
        ts, flag = "tick", "redirect_feed"
    else:
        date = (
            "CASE WHEN page_id % 3 <> 2 THEN strftime(tick, '%Y-%m-%dT%H:%M:%S') || 'Z' "
            "ELSE strftime(tick, '%Y-%m-%d') END"
        )
        ts = "CASE WHEN page_id % 3 <> 2 THEN tick ELSE date_trunc('day', tick) END"
        flag = "FALSE"
    return f"""
  SELECT url, {date} AS date, coalesce(title, '') AS title, source,
    {flag} AS is_google_redirect, source_ord, pos::INTEGER AS item_ord,
    source_ord * {1 << settings.ITEM_ORD_BITS} + pos AS ord, CAST({ts} AS TIMESTAMP) AS ts
  FROM (SELECT *, {_PLACED} FROM entries)
  WHERE url <> '' AND source_ord % 9 <> 8 AND {where}"""


_SEARCH = f"""
  SELECT url, date, title, source, {redirect("url")} AS is_google_redirect, source_ord,
    item_ord, source_ord * {1 << settings.ITEM_ORD_BITS} + item_ord AS ord, ts
  FROM (SELECT
      CASE WHEN page_id % 6 = 5 THEN 'https://news.google.com/articles/' || page_id ELSE url END AS url,
      CASE WHEN page_id % 4 = 0 THEN (page_id % 50) || ' hours ago'
           WHEN page_id % 4 = 1 THEN (page_id % 50) || ' minutes ago'
           WHEN page_id % 4 = 2 THEN coalesce(strftime(tick, '%b %-d, %Y, %-I:%M %p'), '')
           ELSE 'some time ago' END AS date,
      coalesce(title, '') AS title,
      CASE WHEN page_id % 15 = 0 THEN {_text(settings.DEFAULT_SEARCH_SOURCE)}
           ELSE 'paper' || (page_id % 8) END AS source,
      {settings.SEARCH_SOURCE_BASE} + source_ord * {1 << settings.SEARCH_PAGE_BITS} + 1 AS source_ord,
      pos::INTEGER AS item_ord,
      CASE WHEN page_id % 4 = 0 THEN {AS_OF} - to_hours(page_id % 50)
           WHEN page_id % 4 = 1 THEN {AS_OF} - to_minutes(page_id % 50)
           WHEN page_id % 4 = 2 THEN date_trunc('minute', tick) END AS ts
    FROM entries)
  WHERE url <> ''"""

# with the results that have no link
_EVERY_RESULT = _SEARCH.removesuffix("WHERE url <> ''")

_ALL_ROWS = f"""{ENTRIES},
feed_rows AS ({_feed_select("rss", "source_ord % 2 = 0")}
  UNION ALL {_feed_select("sitemap", "source_ord % 2 = 1")}),
search_rows AS ({_SEARCH}),
all_rows AS (SELECT * FROM feed_rows UNION ALL SELECT * FROM search_rows)"""

_CUT = f"({AS_OF} - INTERVAL {settings.RECENCY_HOURS} HOUR)"

_RECENT = f"""{_ALL_ROWS},
recent_rows AS (
  SELECT * FROM feed_rows WHERE ts >= {_CUT}
  UNION ALL SELECT * FROM search_rows WHERE ts >= {_CUT} OR ts IS NULL)"""


def _greedy(rows: str) -> str:
    """Sequential scan over ``rows(tick, a, b)`` as a recursive CTE carrying the keys seen."""
    return f"""
numbered AS (SELECT *, row_number() OVER (ORDER BY tick) AS n FROM {rows}),
scan AS (
  SELECT 0::BIGINT AS n, []::VARCHAR[] AS seen_a, []::VARCHAR[] AS seen_b, NULL::BIGINT AS tick
  UNION ALL
  SELECT r.n,
    CASE WHEN ok THEN list_append(seen_a, a) ELSE seen_a END,
    CASE WHEN ok AND b IS NOT NULL THEN list_append(seen_b, b) ELSE seen_b END,
    CASE WHEN ok THEN r.tick END
  FROM (SELECT t.n, t.tick, t.a, t.b, s.seen_a, s.seen_b,
          NOT list_contains(s.seen_a, t.a) AND (t.b IS NULL OR NOT list_contains(s.seen_b, t.b)) AS ok
        FROM scan s JOIN numbered t ON t.n = s.n + 1) r),
kept AS (SELECT tick FROM scan WHERE tick IS NOT NULL)"""


_COLLECTED = f"""{_RECENT},
keyed AS (SELECT ord AS tick, {canonical("url")} AS a,
    CASE WHEN {strip("title")} <> '' THEN {strip("title")} END AS b FROM recent_rows),
{_greedy("keyed")},
collected AS (SELECT r.* FROM recent_rows r JOIN kept k ON r.ord = k.tick)"""

# Rows arrive in files, by feed. A row is late if it is not newer than the newest row of the files
# two before its own, less the window; the first row of a URL counts, then the first of a title.
_STREAMED = f"""
arrived AS (
  SELECT *, source_ord % {X.ARRIVALS} AS arrival, {canonical("url")} AS canonical_url,
    CASE WHEN {strip("title")} <> '' THEN {strip("title")} ELSE 'url ' || canonical_url END AS title_key
  FROM feed_rows WHERE ts IS NOT NULL),
newest AS (SELECT arrival, max(ts) AS top FROM arrived GROUP BY arrival),
in_time AS (
  SELECT a.* FROM arrived a WHERE NOT EXISTS (
    SELECT 1 FROM newest n WHERE n.arrival < a.arrival - 1
      AND a.ts <= n.top - INTERVAL {settings.RECENCY_HOURS} HOUR)),
by_url AS (
  SELECT * FROM in_time QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY arrival, ord) = 1),
taken AS (
  SELECT * FROM by_url QUALIFY row_number() OVER (PARTITION BY title_key ORDER BY arrival, ord) = 1)"""

# ---- relevance replies -------------------------------------------------------


def _category(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 90 THEN 'HIGHLY_RELEVANT' WHEN {score} >= 80 THEN 'MODERATELY_RELEVANT' "
        f"WHEN {score} >= 10 THEN 'LOW_RELEVANCE' ELSE 'NOT_RELEVANT' END"
    )


_LABEL_BATCHES = f"""scored AS (
  SELECT doc_id, quality, toxic, (quality * 60 + doc_id % 40)::INTEGER AS score FROM labels),
batched AS (
  SELECT *, (n - 1) // {settings.RELEVANCE_BATCH_SIZE} AS batch_id,
    ((n - 1) % {settings.RELEVANCE_BATCH_SIZE})::INTEGER AS batch_index
  FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS n FROM scored))"""


def _replies(batched: str) -> str:
    """Reply objects made for ``batched(doc_id, quality, toxic, score, batch_id, batch_index)``."""
    return f"""
items AS (
  SELECT batch_id, batch_index, 0 AS dup, doc_id, quality, toxic, score, '' AS extra
  FROM {batched} WHERE doc_id % 13 <> 0
  UNION ALL
  SELECT batch_id, batch_index, 1, doc_id, quality, toxic, score + 1, 'again '
  FROM {batched} WHERE doc_id % 17 = 0),
usable AS (
  SELECT *, CASE WHEN batch_id % 4 = 3 THEN 2 ELSE 1 END AS attempt,
    row_number() OVER (PARTITION BY batch_id ORDER BY dup, batch_index) - 1 AS pos
  FROM items WHERE batch_id % 7 <> 6)"""


_LABELS = f"{_LABEL_BATCHES}, {_replies('batched')}"

_ITEM_JSON = f"""'{{"article_id":"' || batch_index || '","relevance_score":' ||
  CASE WHEN doc_id % 5 = 0 THEN '"' || score || '"' ELSE score::VARCHAR END ||
  ',"category":"' || ({_category("score")}) || '","reasoning":"' || extra || 'thème ' ||
  CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE '' END || doc_id ||
  '","key_indicators":["q' || quality || '","t' || toxic || '"]}}'"""

_REASON = (
    "extra || 'thème ' || CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE '' END || doc_id"
)

_LAST_REPLY = """last_one AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id, batch_index ORDER BY pos DESC) AS k FROM usable)"""
_REPLY_JOIN = """LEFT JOIN last_one u
  ON b.batch_id = u.batch_id AND b.batch_index = u.batch_index AND u.k = 1"""
_RECONCILED = f"""coalesce(u.score, 0) AS relevance_score,
  CASE WHEN u.score IS NULL THEN 'ERROR' ELSE {_category("u.score")} END AS category,
  CASE WHEN u.score IS NULL AND b.batch_id % 14 = 6 THEN substr('429 RESOURCE_EXHAUSTED: the quota for batch '
      || b.batch_id || ' is used up, try again later', 1, {settings.ERROR_TEXT_CHARS})
    WHEN u.score IS NULL THEN {_text(settings.UNMATCHED_REASONING)}
    ELSE u.extra || 'thème ' || CASE WHEN u.doc_id % 3 = 0 THEN ' ' ELSE '' END || u.doc_id END AS reasoning,
  CASE WHEN u.score IS NULL THEN '' ELSE 'q' || u.quality || ', t' || u.toxic END AS key_indicators"""

# ---- pages -------------------------------------------------------------------

_REDIRECTED = """redirected AS (
  SELECT page_id, url AS true_url,
    CASE WHEN page_id % 6 = 5 THEN 'https://news.google.com/rss/articles/' || page_id ELSE url END AS url
  FROM pages),
targets AS (
  SELECT url, true_url AS target FROM redirected
  WHERE page_id % 6 = 5 AND page_id % 24 <> 23 AND page_id % 30 NOT IN (5, 11))"""

_RESOLVED = f"""{_REDIRECTED},
resolved AS (
  SELECT r.page_id, r.url, r.true_url,
    CASE WHEN {redirect("r.url")} THEN t.target ELSE r.url END AS fetch_url
  FROM redirected r LEFT JOIN targets t ON r.url = t.url)"""


def page_text(e: str) -> str:
    out = f"regexp_replace({e}, '<!--.*?-->', '', 'gs')"
    for element in DROPPED_ELEMENTS:
        out = f"regexp_replace({out}, '<{element}\\b[^>]*>.*?</{element}\\s*>', chr(10), 'gis')"
    out = (
        f"regexp_replace({out}, '<div\\b[^>]*(?:class|id)=\"(?:{DROPPED_CLASSES})\"[^>]*>.*?</div\\s*>', "
        "chr(10), 'gis')"
    )
    out = f"regexp_replace({out}, '</t[dh]\\s*>', ' ', 'gi')"
    out = f"regexp_replace({out}, '</?(?:{BLOCK_ELEMENTS})\\b[^>]*>', chr(10), 'gi')"
    out = f"regexp_replace({out}, '<[a-zA-Z/!?][^>]*>', '', 'gs')"
    for name, char in ENTITIES.items():
        out = f"replace({out}, '&{name};', {_text(char)})"
    out = f"regexp_replace({out}, '[ \\t\\r\\x0b\\f\\x{{a0}}]+', ' ', 'g')"
    return strip(f"regexp_replace({out}, ' ?\\n[ \\n]*', chr(10), 'g')")


_FETCHED = f"""fetched AS (
  SELECT page_id, url,
    CASE WHEN page_id % 10 = 7 THEN '<html><p>short</p></html>' WHEN page_id % 10 <> 8 THEN html END AS html,
    CASE WHEN page_id % 10 = 3 THEN 403 WHEN page_id % 10 = 4 THEN 429 ELSE 200 END AS http_status,
    CASE WHEN page_id % 10 = 5 THEN 'timeout' WHEN page_id % 10 = 6
         THEN 'net::ERR_CONNECTION_RESET while reading the response of the server' END AS error,
    CASE WHEN page_id % 10 = 1 THEN url || '&seen=1' ELSE url END AS final_url
  FROM pages),
unique_fetched AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS k FROM fetched)
  WHERE k = 1)"""


def _outcome(rows: str) -> str:
    """Outcome of ``rows(url, fetch_url, html, http_status, error, final_url, ...)``."""
    skipped, late = blocked("url"), f"(fetch_url <> url AND {blocked('fetch_url')})"
    refused = "coalesce(http_status IN (403, 429), FALSE)"
    return f"""
outcome AS (
  SELECT *, length(content) AS n_chars,
    CASE WHEN {skipped} THEN 'skipped' WHEN fetch_url IS NULL THEN 'redirect_failed'
      WHEN {late} THEN 'skipped' WHEN {refused} THEN 'error: ' || http_status
      WHEN error = 'timeout' THEN 'timeout'
      WHEN error IS NOT NULL THEN 'error: ' || substr(error, 1, {settings.ERROR_TEXT_CHARS})
      WHEN length(content) > {settings.MIN_CONTENT_CHARS} THEN 'success' ELSE 'partial' END AS status,
    CASE WHEN {skipped} OR fetch_url IS NULL THEN url
      WHEN {late} OR {refused} OR error IS NOT NULL THEN fetch_url
      ELSE coalesce(final_url, fetch_url) END AS resolved_url
  FROM (SELECT *, CASE WHEN NOT ({skipped} OR fetch_url IS NULL OR {late} OR {refused}
            OR error IS NOT NULL) THEN {page_text("html")} END AS content
        FROM {rows}))"""


# ---- text --------------------------------------------------------------------


def phrases(e: str) -> str:
    lo, hi = settings.PHRASE_MIN_CHARS, settings.PHRASE_MAX_CHARS
    marked = f"regexp_replace({e}, '([.!?]){_SPACE_CLASS}+', '\\1' || chr(1), 'g')"
    sentences = (
        f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')}), "
        f"lambda s: length(s) >= {lo})"
    )
    pieces = (
        f"list_transform({sentences}, lambda s: CASE WHEN length(s) <= {hi} THEN [s] ELSE "
        f"list_filter(list_transform(range(0, length(s), {hi}), "
        f"lambda i: {strip(f'substr(s, (i + 1)::INTEGER, {hi})')}), lambda p: length(p) >= {lo}) END)"
    )
    return f"flatten({pieces})"


def tokens(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, '{_SPACE_CLASS}+'), lambda t: t <> '')"


def windows(toks: str) -> str:
    size, stride = settings.WINDOW_TOKENS, settings.WINDOW_STRIDE
    return (
        f"CASE WHEN len({toks}) <= {size} THEN [{toks}] ELSE list_transform("
        f"range(0, len({toks}), {stride}), lambda i: list_slice({toks}, i + 1, i + {size})) END"
    )


def words(e: str) -> str:
    return f"regexp_extract_all(lower({e}), '\\p{{L}}+')"


def hits(w: str, vocabulary) -> str:
    return f"len(list_filter({w}, lambda x: x IN ({_list(vocabulary)})))"


_TITLE = "split_part(text, chr(10), 1)"

_SENTIMENT = f"""
polarity AS (
  SELECT id, {hits("w", X.POSITIVE)} AS p, {hits("w", X.NEGATIVE)} AS n
  FROM (SELECT id, {words("phrase")} AS w FROM phrase_rows)),
sentiments AS (
  SELECT id, CASE WHEN pos + neg = 0 THEN 0.0::DOUBLE
      ELSE {round2("((pos - neg)::DOUBLE / (pos + neg)::DOUBLE)")} END AS sentiment
  FROM (SELECT id, count(*) FILTER (p > n) AS pos, count(*) FILTER (p < n) AS neg
        FROM polarity GROUP BY id))"""

_ELIGIBLE = f"""eligible AS (
  SELECT ord, {strip("title")} AS title, {strip("scraped_content")} AS content FROM articles
  WHERE {strip("scraped_content")} <> '' AND {strip("title")} <> '')"""

_ARTICLES = f"""articles AS (
  SELECT doc_id AS ord, 'https://' || source || '.example.org/' || (doc_id % 900) AS url,
    strftime({AS_OF} - to_minutes(doc_id % 1440), '%Y-%m-%d %H:%M:%S') AS date,
    CASE WHEN doc_id % 19 <> 18 THEN {_TITLE} END AS title, source,
    (doc_id % 60 + 40)::INTEGER AS relevance_score,
    {_category("(doc_id % 60 + 40)")} AS category,
    'doc ' || doc_id AS reasoning, 'a, b' AS key_indicators,
    CASE WHEN doc_id % 23 = 22 THEN ' ' || chr(10) WHEN doc_id % 29 <> 28 THEN text END AS scraped_content,
    CASE WHEN doc_id % 4 = 3 THEN 'partial' ELSE 'success' END AS scrape_status
  FROM documents),
{_ELIGIBLE}"""


def _share(w: str, vocabulary) -> str:
    return f"({hits(w, vocabulary)}::DOUBLE / greatest(len({w}), 1)::DOUBLE)"


_TOPIC_ROWS = " UNION ALL ".join(
    f"SELECT ord, {_text(name)} AS label, {_share('w', vocabulary)} AS score FROM topic_words"
    for name, vocabulary in X.TOPICS.items()
)
_NAMES_FR = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in settings.TOPIC_LABELS_FR.items())

_TOPICS = f"""
topic_words AS (
  SELECT ord, {words(f"title || '. ' || substr(content, 1, {settings.TOPIC_CONTENT_CHARS})")} AS w
  FROM eligible),
topic_scores AS ({_TOPIC_ROWS}),
topics AS (
  SELECT ord, label AS iptc_topic, CASE label {_NAMES_FR} ELSE label END AS iptc_topic_fr
  FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, label) AS k FROM topic_scores)
  WHERE k = 1)"""


def _window_words(source: str, id_col: str, text: str) -> str:
    return f"""
toks AS (SELECT {id_col} AS id, {tokens(text)} AS t FROM {source}),
window_rows AS (SELECT id, unnest({windows("t")}) AS win FROM toks),
window_words AS (SELECT id, {words("array_to_string(win, ' ')")} AS w FROM window_rows)"""


_POOLED = ",\n".join(
    f"{round2(f'max({_share(chr(119), vocabulary)})')} AS \"{settings.LABEL_COLUMNS[name]}\""
    for name, vocabulary in X.LABELS.items()
)

_LABEL_SCORES = f"""{_window_words("eligible", "ord", "title || '. ' || content")},
label_scores AS (SELECT id AS ord, {_POOLED} FROM window_words GROUP BY id)"""


def _similar(vectors: str, threshold: float) -> str:
    return f"""SELECT a.id AS u, b.id AS v FROM {vectors} a JOIN {vectors} b ON a.id < b.id
  WHERE list_cosine_similarity(a.vec, b.vec) >= {threshold}"""


def _components(pairs: str) -> str:
    """Smallest reachable id per node, by repeated minimum over pairs (u, v)."""
    return f"""
pairs AS ({pairs}),
both_ways AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (
  SELECT u AS node, u AS low FROM both_ways
  UNION
  SELECT e.v, r.low FROM reach r JOIN both_ways e ON r.node = e.u),
component AS (SELECT node, min(low) AS low FROM reach GROUP BY node),
numbered_clusters AS (SELECT node, dense_rank() OVER (ORDER BY low) AS cluster_id FROM component)"""


# hashed terms: the first 32 bits of a word's MD5
_TERMS = f"""word_rows AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '(\\p{{L}}+)', 1)) AS word FROM documents),
term_rows AS (
  SELECT doc_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % {1 << 18} AS term, count(*) AS n
  FROM word_rows GROUP BY ALL)"""

_WEIGHTS = f"""{_TERMS},
frequency AS (SELECT term, count(*) AS df FROM term_rows GROUP BY term),
tf_idf AS (
  SELECT doc_id, term, n * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) AS w
  FROM term_rows JOIN frequency USING (term)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM tf_idf GROUP BY doc_id),
weights AS (SELECT doc_id, term, w / norm AS w FROM tf_idf JOIN norms USING (doc_id) WHERE w > 0)"""

_ALIKE = f"""SELECT a.doc_id AS u, b.doc_id AS v FROM weights a JOIN weights b
  ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL HAVING sum(a.w * b.w) >= {settings.SIMILARITY_THRESHOLD}"""

_VECTORS = "vectors AS (SELECT vec_id AS id, embedding AS vec FROM embeddings)"

_ENRICHMENT = f"""{_components(_similar("vectors", X.SIMILARITY))},
phrase_rows AS (
  SELECT ord AS id, unnest({phrases("scraped_content")}) AS phrase FROM articles
  WHERE scrape_status = 'success' AND scraped_content IS NOT NULL),
{_SENTIMENT},
{_TOPICS},
{_LABEL_SCORES},
enriched AS (
  SELECT a.*, coalesce(s.sentiment, 0.0::DOUBLE) AS sentiment, coalesce(c.cluster_id, 0) AS cluster_id,
    t.iptc_topic, t.iptc_topic_fr,
    {", ".join(f'coalesce(l."{c}", 0.0::DOUBLE) AS "{c}"' for c in settings.LABEL_COLUMNS.values())}
  FROM articles a LEFT JOIN sentiments s ON a.ord = s.id
    LEFT JOIN numbered_clusters c ON a.ord = c.node
    LEFT JOIN topics t ON a.ord = t.ord LEFT JOIN label_scores l ON a.ord = l.ord)"""


_ENRICHED = f"{_ARTICLES}, {_VECTORS}, {_ENRICHMENT}"


def _analysis(key: str, sent: str = "true") -> str:
    """``sent``: whether the article went to the model; all others have no analysis."""
    ok = f"{sent} AND {key} % 11 <> 10"
    return f"""CASE WHEN {ok} THEN 'Résumé ' || {key} END AS summary,
    CASE WHEN {ok} THEN CASE {key} % 2 WHEN 0 THEN 'oui' ELSE 'non' END END AS quebec,
    CASE WHEN {ok} THEN
      CASE {key} % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'neutre' ELSE 'negative' END END AS perception,
    CASE WHEN {ok} THEN CASE WHEN {key} % 4 = 1 THEN '1' ELSE '0' END END AS "Flag\""""


_ANALYSIS = f"""analysed AS (SELECT e.*, {_analysis('e.ord', 'k.ord IS NOT NULL')}
  FROM enriched e LEFT JOIN (SELECT DISTINCT ord FROM eligible) k ON e.ord = k.ord)"""
_ANALYSED = f"{_ENRICHED}, {_ANALYSIS}"

_EXPORTED = f"""firsts AS (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord) AS k FROM analysed
  WHERE "Flag" IS NULL OR "Flag" <> '1')
SELECT url, title, source, date, relevance_score::BIGINT AS relevance_score, category, reasoning,
  key_indicators, scraped_content, scrape_status, sentiment, cluster_id, iptc_topic, iptc_topic_fr,
  "Attrait", "Hebergement", "Restaurant", quebec, perception, summary, {AS_OF} AS processed_timestamp
FROM firsts WHERE k = 1"""

# the whole run: collect, batches, replies, threshold, redirects, pages, enrichment, analysis
_DAILY = f"""{_COLLECTED},
placed AS (
  SELECT *, (n - 1) // {settings.RELEVANCE_BATCH_SIZE} AS batch_id,
    ((n - 1) % {settings.RELEVANCE_BATCH_SIZE})::INTEGER AS batch_index,
    CASE WHEN source_ord < {settings.SEARCH_SOURCE_BASE} THEN source_ord
      ELSE (source_ord - {settings.SEARCH_SOURCE_BASE}) >> {settings.SEARCH_PAGE_BITS} END
      * {X.PER_PAYLOAD} + item_ord AS page_number
  FROM (SELECT *, row_number() OVER (ORDER BY ord) AS n FROM collected)),
relabelled AS (
  SELECT ord AS doc_id, 1 AS quality, 0 AS toxic, (ord % 40 + 60)::INTEGER AS score, batch_id, batch_index
  FROM placed),
{_replies("relabelled")},
{_LAST_REPLY},
relevant AS (
  SELECT * FROM (SELECT b.*, {_RECONCILED} FROM placed b {_REPLY_JOIN})
  WHERE relevance_score > {settings.RELEVANCE_THRESHOLD}),
targets AS (
  SELECT DISTINCT r.url, p.url AS target
  FROM (SELECT url, try_cast(regexp_extract(url, 'articles/(\\d+)$', 1) AS BIGINT) AS page_id FROM placed) r
    JOIN pages p ON r.page_id = p.page_id
  WHERE r.page_id % 24 <> 23),
wanted AS (
  SELECT DISTINCT r.url, CASE WHEN {redirect("r.url")} THEN t.target ELSE r.url END AS fetch_url
  FROM relevant r LEFT JOIN targets t ON r.url = t.url),
{_FETCHED},
joined AS (
  SELECT w.url, w.fetch_url, f.html, f.http_status, f.error, f.final_url, f.url IS NOT NULL AS found
  FROM wanted w LEFT JOIN unique_fetched f ON w.fetch_url = f.url),
{_outcome("joined")},
content AS (
  SELECT * FROM outcome
  WHERE found OR {blocked("url")} OR fetch_url IS NULL OR {blocked("fetch_url")}),
articles AS (
  SELECT r.* EXCLUDE (url), coalesce(c.resolved_url, r.url) AS url, c.content AS scraped_content,
    c.status AS scrape_status
  FROM relevant r LEFT JOIN content c ON r.url = c.url),
{_ELIGIBLE},
vectors AS (
  SELECT a.ord AS id, e.embedding AS vec FROM articles a JOIN embeddings e
    ON a.page_number - a.page_number % {X.SHARED_VECTORS} = e.vec_id
  WHERE {strip("a.scraped_content")} <> ''),
{_ENRICHMENT},
{_ANALYSIS}"""


def _pick(index: str, values) -> str:
    arms = " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {arms} END"


def _forms(e: str) -> str:
    arms = " ".join(
        f"WHEN {e} IN ({_list(forms)}) THEN {_text(name)}"
        for name, forms in settings.PERCEPTION_FORMS.items()
    )
    return f"CASE {arms} END"


ORACLES = {
    "q_url_canonical": f"SELECT page_id, {canonical('url')} AS canonical_url FROM pages",
    "q_url_domain": f"SELECT page_id, {netloc('url')} AS domain FROM pages",
    "q_blocked": f"SELECT page_id, {blocked('url')} AS blocked FROM pages",
    "q_locale": f"""SELECT page_id, CASE WHEN {any_of(f"lower({netloc('url')})", X.FRENCH)}
        THEN 'fr-CA' ELSE 'en-US' END AS locale FROM pages""",
    "q_feed_rss": f"WITH {ENTRIES} {_feed_select('rss')}",
    "q_feed_sitemap": f"WITH {ENTRIES} {_feed_select('sitemap')}",
    "q_feed_errors": f"""WITH {ENTRIES} SELECT DISTINCT
        CASE WHEN source_ord % 5 = 4 THEN 'https://news.google.com/rss/search'
             ELSE 'https://feed' || (source_ord % 7) || '.example.org/all.xml' END AS feed_url,
        source_ord FROM entries WHERE source_ord % 9 = 8""",
    "q_search_results": f"WITH {ENTRIES} {_SEARCH}",
    "q_union_sources": f"WITH {_RECENT} SELECT * FROM recent_rows",
    "q_source_counts": f"""WITH {_ALL_ROWS} SELECT source, count(*) AS total,
        count(*) FILTER (ts >= {_CUT}) AS recent, count(*) FILTER (ts < {_CUT}) AS old,
        count(*) FILTER (ts IS NULL) AS undated FROM all_rows GROUP BY source""",
    "q_collect": f"WITH RECURSIVE {_COLLECTED} SELECT * FROM collected",
    "q_collect_counts": f"""WITH RECURSIVE {_COLLECTED},
        results AS ({_EVERY_RESULT}),
        judged AS (SELECT (source_ord - {settings.SEARCH_SOURCE_BASE}) // {1 << settings.SEARCH_PAGE_BITS} AS search_ord,
            (source_ord - {settings.SEARCH_SOURCE_BASE}) % {1 << settings.SEARCH_PAGE_BITS} AS page,
            url <> '' AND (ts IS NULL OR ts >= {_CUT}) AS taken FROM results)
        SELECT 'page' AS scope, search_ord, page, count(*) FILTER (taken) AS kept,
          count(*) FILTER (NOT taken) AS skipped FROM judged GROUP BY search_ord, page
        UNION ALL SELECT 'dedup', NULL, NULL, (SELECT count(*) FROM collected),
          (SELECT count(*) FROM recent_rows) - (SELECT count(*) FROM collected)""",
    "q_stream_collect": f"""WITH RECURSIVE {_ALL_ROWS}, {_STREAMED}
        SELECT canonical_url, title, ord FROM taken""",
    "q_parse_date": """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL
        WHEN event_id % 5 = 3 THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
        ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS parsed FROM events""",
    "q_parse_relative_date": f"""SELECT event_id, CAST(CASE
        WHEN k = 0 THEN {AS_OF} - to_minutes(n) WHEN k = 1 THEN {AS_OF} - to_hours(n)
        WHEN k = 2 THEN {AS_OF} - to_days(n) WHEN k = 3 THEN {AS_OF} - to_days(7 * n)
        WHEN k = 4 THEN {AS_OF} - to_days(1) WHEN k = 5 THEN {AS_OF}
        WHEN k IN (6, 9, 14) THEN date_trunc('second', ts) WHEN k IN (7, 10, 12) THEN date_trunc('minute', ts)
        WHEN k < 18 THEN date_trunc('day', ts) END AS TIMESTAMP) AS parsed
        FROM (SELECT event_id, ts, event_id % 19 AS k, (event_id % 40)::INTEGER AS n FROM events)""",
    "q_recency_strict": f"""SELECT event_id, ts FROM events WHERE event_id % 7 <> 0
        AND ts >= TIMESTAMP '{X.EVENTS_AS_OF}' - INTERVAL 24 HOUR""",
    "q_recency_lenient": f"""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts FROM events
        WHERE event_id % 7 = 0 OR ts >= TIMESTAMP '{X.EVENTS_AS_OF}' - INTERVAL 24 HOUR""",
    "q_keep_first": """SELECT doc_id, lang, source FROM (SELECT *, row_number()
        OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1""",
    "q_greedy_dedup": f"""WITH RECURSIVE keyed AS (SELECT page_id AS tick,
        regexp_extract({canonical('url')}, '^https?://([^/]*/[a-z]+)', 1) AS a,
        CASE WHEN page_id % 9 <> 0 THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END AS b
        FROM pages), {_greedy('keyed')}
        SELECT r.tick AS page_id, r.a AS url_key, r.b AS title_key FROM keyed r JOIN kept k ON r.tick = k.tick""",
    "q_ascii_titles": f"""SELECT doc_id, regexp_replace({_TITLE}, '[^\\x00-\\x7F]+', ' ', 'g') AS title
        FROM documents""",
    "q_reply_repair": f"""WITH {_LABELS},
        clean AS (SELECT batch_id, '[' || string_agg({_ITEM_JSON}, ',' ORDER BY dup, batch_index) || ']' AS json
          FROM items GROUP BY batch_id)
        SELECT batch_id, CASE WHEN batch_id % 4 = 3 THEN 2 ELSE 1 END::INTEGER AS attempt, json AS repaired
        FROM clean WHERE batch_id % 7 <> 6
        UNION ALL SELECT batch_id, 1, 'Here is the list: [' FROM clean
        WHERE batch_id % 7 <> 6 AND batch_id % 4 = 3
        UNION ALL SELECT batch_id, unnest(range(1, 6))::INTEGER, '{{' FROM clean WHERE batch_id % 7 = 6""",
    "q_reply_parse": f"""WITH {_LABELS} SELECT batch_id, attempt, pos::INTEGER AS pos,
        batch_index::VARCHAR AS article_id, score AS relevance_score, {_category("score")} AS category,
        {_REASON} AS reasoning, 'q' || quality || ', t' || toxic AS key_indicators, 0 AS n_problems
        FROM usable""",
    "q_reply_attempts": f"""WITH {_LABELS} SELECT batch_id, attempt, count(*)::INTEGER AS n_results
        FROM usable GROUP BY batch_id, attempt""",
    "q_reply_reconcile": f"""WITH {_LABELS}, {_LAST_REPLY}
        SELECT b.doc_id, b.batch_id, b.batch_index, {_RECONCILED} FROM batched b {_REPLY_JOIN}""",
    "q_reply_counts": f"""WITH {_LABELS},
        received AS (SELECT batch_id, count(*) AS n FROM usable GROUP BY batch_id)
        SELECT b.batch_id, count(*) AS n_articles, coalesce(max(r.n), 0) AS n_results,
          coalesce(max(r.n), 0) = count(*) AS is_complete
        FROM batched b LEFT JOIN received r ON b.batch_id = r.batch_id GROUP BY b.batch_id""",
    "q_threshold": f"""WITH {_LABELS} SELECT doc_id, score FROM scored
        WHERE score > {settings.RELEVANCE_THRESHOLD}""",
    "q_redirects": f"WITH {_RESOLVED} SELECT page_id, url, fetch_url FROM resolved",
    "q_fetch_list": f"""WITH {_REDIRECTED},
        urls AS (SELECT url, min(page_id) AS ord, {netloc("url")} AS domain FROM redirected
          WHERE page_id % 30 + 70 > {settings.RELEVANCE_THRESHOLD} AND NOT {blocked("url")} GROUP BY url)
        SELECT url, domain,
          (row_number() OVER (ORDER BY ord) - 1) // {settings.FETCH_BATCH_SIZE} + 1 AS fetch_batch,
          row_number() OVER (PARTITION BY domain ORDER BY ord) AS domain_seq,
          CASE WHEN {any_of("lower(domain)", settings.FRENCH_DOMAIN_PATTERNS)} THEN 'fr-CA'
            ELSE 'en-US' END AS locale FROM urls""",
    "q_page_text": f"SELECT page_id, {page_text('html')} AS text FROM pages",
    "q_scrape_status": f"""WITH {_RESOLVED}, {_FETCHED},
        joined AS (SELECT r.url, r.fetch_url, f.html, f.http_status, f.error, f.final_url
          FROM resolved r JOIN fetched f ON r.page_id = f.page_id), {_outcome("joined")}
        SELECT url, status, resolved_url, n_chars FROM outcome""",
    "q_content_join": f"""WITH {_RESOLVED}, {_FETCHED},
        joined AS (SELECT DISTINCT r.url, r.fetch_url, f.html, f.http_status, f.error, f.final_url,
            f.url IS NOT NULL AS found
          FROM resolved r LEFT JOIN unique_fetched f ON r.fetch_url = f.url), {_outcome("joined")},
        content AS (SELECT * FROM outcome WHERE found OR {blocked("url")} OR fetch_url IS NULL
          OR {blocked("fetch_url")})
        SELECT r.page_id, coalesce(c.resolved_url, r.url) AS url, c.n_chars, c.status AS scrape_status
        FROM redirected r LEFT JOIN content c ON r.url = c.url""",
    "q_phrases": f"""SELECT doc_id, (unnest(range(len(p))))::INTEGER AS pos, unnest(p) AS phrase
        FROM (SELECT doc_id, {phrases("text")} AS p FROM documents)""",
    "q_topic_text": f"""SELECT doc_id, {strip(_TITLE)} || '. ' ||
        substr({strip("text")}, 1, {settings.TOPIC_CONTENT_CHARS}) AS topic_text FROM documents""",
    "q_token_windows": f"""WITH toks AS (SELECT doc_id, {tokens("text")} AS t FROM documents),
        wins AS (SELECT doc_id, {windows("t")} AS w FROM toks),
        rows AS (SELECT doc_id, (unnest(range(len(w))))::INTEGER AS chunk, unnest(w) AS win FROM wins)
        SELECT doc_id, chunk, len(win)::INTEGER AS n_tokens, array_to_string(win, ' ') AS window_text FROM rows""",
    "q_sentiment": f"""WITH phrase_rows AS (
        SELECT doc_id AS id, unnest({phrases("text")}) AS phrase FROM documents), {_SENTIMENT}
        SELECT doc_id, coalesce(sentiment, 0.0::DOUBLE) AS sentiment
        FROM documents LEFT JOIN sentiments ON doc_id = id""",
    "q_batch_scorer": f"""WITH pieces AS (
          SELECT doc_id, unnest({phrases("text")}) AS phrase FROM documents),
        weighed AS (SELECT doc_id, coalesce(list_sum(list_transform({words("phrase")},
          lambda w: CASE w {" ".join(f"WHEN '{w}' THEN {n}" for w, n in X.WEIGHTS.items())} ELSE 0 END)), 0) AS total
          FROM pieces),
        judged AS (SELECT doc_id, count(*) AS n_phrases, count(*) FILTER (total > 0) AS p,
          count(*) FILTER (total < 0) AS n FROM weighed GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_phrases, 0)::INTEGER AS n_phrases,
          CASE WHEN coalesce(p + n, 0) = 0 THEN 0.0::DOUBLE
            ELSE {round2("((p - n)::DOUBLE / (p + n)::DOUBLE)")} END AS sentiment
        FROM documents d LEFT JOIN judged j USING (doc_id)""",
    "q_topic_top1": f"""WITH {_ARTICLES}, {_TOPICS}
        SELECT a.ord, iptc_topic FROM articles a LEFT JOIN topics t ON a.ord = t.ord""",
    "q_topic_map": f"""WITH {_ARTICLES}, {_TOPICS}
        SELECT a.ord, iptc_topic, iptc_topic_fr FROM articles a LEFT JOIN topics t ON a.ord = t.ord""",
    "q_label_scores": f"""WITH {_ARTICLES}, {_LABEL_SCORES}
        SELECT a.ord, {", ".join(f'coalesce(l."{c}", 0.0::DOUBLE) AS "{c}"' for c in settings.LABEL_COLUMNS.values())}
        FROM articles a LEFT JOIN label_scores l ON a.ord = l.ord""",
    "q_train_labels": f"""WITH {_TERMS},
        seen AS (SELECT doc_id, quality AS k FROM documents JOIN labels USING (doc_id)),
        sizes AS (SELECT k, count(*) AS size FROM seen GROUP BY k),
        held AS (SELECT k, term, count(*) AS n FROM seen JOIN term_rows USING (doc_id) GROUP BY k, term),
        likely AS (SELECT s.k, t.term, ln((coalesce(h.n, 0) + 1) / (s.size + 2)) AS l
          FROM sizes s CROSS JOIN (SELECT DISTINCT term FROM term_rows) t
          LEFT JOIN held h ON h.k = s.k AND h.term = t.term),
        evidence AS (SELECT doc_id, k, sum(l) / sqrt(count(*)) AS e
          FROM term_rows JOIN likely USING (term) GROUP BY doc_id, k),
        logs AS (SELECT d.doc_id, s.k,
            ln(s.size / (SELECT sum(size) FROM sizes)) + coalesce(e.e, 0) AS l
          FROM documents d CROSS JOIN sizes s LEFT JOIN evidence e ON e.doc_id = d.doc_id AND e.k = s.k),
        shares AS (SELECT doc_id, k, exp(l - max(l) OVER (PARTITION BY doc_id)) AS share FROM logs)
        SELECT doc_id, round(sum(share) FILTER (k = 1) / sum(share), 6) AS score FROM shares GROUP BY doc_id""",
    "q_doc_vectors": f"""WITH {_WEIGHTS}
        SELECT d.doc_id, count(w.term) AS n_terms, round(coalesce(sum(w.w), 0), 6) AS weight_sum,
          round(max(w.w), 6) AS top_weight, arg_max(w.term, (w.w, -w.term)) AS top_term
        FROM documents d LEFT JOIN weights w USING (doc_id) GROUP BY d.doc_id""",
    "q_doc_clusters": f"""WITH RECURSIVE {_WEIGHTS}, {_components(_ALIKE)}
        SELECT doc_id, coalesce(cluster_id, 0) AS cluster_id
        FROM documents LEFT JOIN numbered_clusters ON doc_id = node""",
    "q_cosine_pairs": f"""SELECT a.vec_id AS src, b.vec_id AS dst FROM embeddings a JOIN embeddings b
        ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding, b.embedding) >= {X.SIMILARITY}""",
    "q_first_similar": f"""WITH every AS (SELECT vec_id, embedding FROM embeddings UNION ALL
          SELECT vec_id + {X.COPY_IDS}, embedding FROM embeddings WHERE vec_id % 3 = 0)
        SELECT b.vec_id, min(a.vec_id) AS first FROM every a JOIN every b ON a.vec_id < b.vec_id
        WHERE list_cosine_similarity(a.embedding, b.embedding) >= {X.SIMILARITY} GROUP BY b.vec_id""",
    "q_append": f"""WITH {_ARTICLES} SELECT url, ord, relevance_score, CAST({AS_OF} AS DATE) AS run_date
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord) AS k FROM articles) WHERE k = 1""",
    "q_publish": f"""WITH {_ARTICLES},
        runs AS (SELECT ord, url, {AS_OF} + to_hours(ord % 2) AS processed_timestamp FROM articles)
        SELECT 'runs' AS name, * FROM runs UNION ALL SELECT 'log', * FROM runs
        UNION ALL SELECT 'log', * FROM runs WHERE ord % 2 = 1""",
    "q_clusters": f"""WITH RECURSIVE {_VECTORS}, {_components(_similar("vectors", X.SIMILARITY))}
        SELECT id AS vec_id, coalesce(cluster_id, 0) AS cluster_id
        FROM vectors LEFT JOIN numbered_clusters ON id = node""",
    "q_analysis_normalize": f"""
        SELECT conv_id, turn, {strip("text")} AS summary, place AS quebec, mood AS perception, mark AS "Flag",
          array_to_string(list_filter([
            CASE WHEN length(text) BETWEEN 1 AND {settings.SUMMARY_MAX_CHARS} AND {strip("text")} <> ''
              THEN NULL ELSE 'summary' END,
            CASE WHEN place IN ({_list(settings.QUEBEC_VALUES)}) THEN NULL ELSE 'quebec' END,
            CASE WHEN mood IS NULL THEN 'perception' END,
            CASE WHEN mark IN ({_list(settings.FLAG_VALUES)}) THEN NULL ELSE 'Flag' END],
            lambda x: x IS NOT NULL), ',') AS problems
        FROM (SELECT *, {strip(f"lower({_pick('conv_id + turn', X.PLACES)})")} AS place,
            {_forms(strip(f"lower({_pick('conv_id + turn', X.PERCEPTIONS)})"))} AS mood,
            {strip(_pick('conv_id + turn', X.FLAGS))} AS mark FROM conversations)""",
    "q_analysis_attempts": f"SELECT doc_id, {_analysis('doc_id')} FROM documents",
    "q_flag_filter": """SELECT doc_id, CASE WHEN doc_id % 5 <> 4 THEN (doc_id % 3 = 1)::INTEGER::VARCHAR END AS "Flag"
        FROM documents WHERE NOT (doc_id % 5 <> 4 AND doc_id % 3 = 1)""",
    "q_flag_audit": f"""SELECT CASE WHEN doc_id % 5 = 4 THEN 'failed' ELSE 'dropped' END AS outcome,
        substr(source, 1, {settings.AUDIT_SOURCE_CHARS}) AS source,
        substr({_TITLE}, 1, {settings.AUDIT_TITLE_CHARS}) AS title,
        substr(text, 1, {settings.AUDIT_SUMMARY_CHARS}) AS summary
        FROM documents WHERE doc_id % 5 = 4 OR doc_id % 3 = 1""",
    "q_enrich": f"""WITH RECURSIVE {_ENRICHED} SELECT ord, sentiment, cluster_id, iptc_topic, iptc_topic_fr,
        {", ".join(f'"{c}"' for c in settings.LABEL_COLUMNS.values())} FROM enriched""",
    "q_run_metrics": f"""WITH RECURSIVE {_ANALYSED} SELECT count(*) AS articles,
        count(*) FILTER (relevance_score >= {settings.RELEVANT_COUNT_FLOOR}) AS relevant,
        count(*) FILTER (relevance_score > {settings.RELEVANCE_THRESHOLD}) AS over_threshold,
        count(*) FILTER (scrape_status = 'success') AS scraped,
        max(cluster_id) AS clusters, count(*) FILTER (cluster_id > 0) AS clustered,
        count("Flag") AS analysed, count(*) FILTER ("Flag" IS NULL) AS failed,
        count(*) FILTER ("Flag" = '1') AS dropped, count(url) - count(DISTINCT url) AS duplicate_urls
        FROM analysed""",
    "q_export": f"WITH RECURSIVE {_ANALYSED}, {_EXPORTED}",
    "q_daily": f"WITH RECURSIVE {_DAILY}, {_EXPORTED}",
    "q_append_new": f"""WITH {_ARTICLES},
        firsts AS (SELECT ord, url, relevance_score, row_number() OVER (PARTITION BY url ORDER BY ord) AS k
          FROM articles)
        SELECT ord, url, relevance_score FROM firsts WHERE k = 1 AND ord % 2 <> 0""",
}


def _prompts(ascii_titles: bool) -> str:
    title = f"regexp_replace({_TITLE}, '[^\\x00-\\x7F]+', ' ', 'g')" if ascii_titles else _TITLE
    size = settings.RELEVANCE_BATCH_SIZE
    head, tail = settings.BATCH_PROMPT_HEAD.split("{n}"), settings.BATCH_PROMPT_TAIL
    return f"""WITH numbered AS (SELECT doc_id, {title} AS title, row_number() OVER (ORDER BY doc_id) - 1 AS n
          FROM documents),
        lines AS (SELECT n // {size} AS batch_id, n, '**Article ' || (n % {size} + 1) || ' (ID: "' || (n % {size}) ||
            '"):**' || chr(10) || 'Title: ' || title || chr(10) || 'URL: https://example.org/' || doc_id AS line
          FROM numbered)
        SELECT batch_id, count(*)::INTEGER AS n_articles, {_text(head[0])} || count(*) || {_text(head[1])} ||
          chr(10) || chr(10) || string_agg(line, chr(10) || chr(10) ORDER BY n) || chr(10) || chr(10) ||
          {_text(tail)} AS prompt
        FROM lines GROUP BY batch_id"""


def _article_prompts(key: str, title: str, content: str, source: str) -> str:
    """``title`` and ``content`` are stripped expressions over ``source``."""
    long, short = settings.SUMMARY_CONTENT_CHARS, settings.SUMMARY_RETRY_CHARS
    intro, middle, outro = (
        settings.ARTICLE_PROMPT.replace("{title}", "\0").replace("{content}", "\0").split("\0")
    )

    def prompt(body: str) -> str:
        return f"{_text(intro)} || t || {_text(middle)} || {body} || {_text(outro)}"

    return f"""SELECT {key}, {prompt("c")} AS prompt,
          {prompt(f"CASE WHEN length(c) > {short} THEN substr(c, 1, {short}) || '...' ELSE c END")} AS retry_prompt
        FROM (SELECT {key}, t, CASE WHEN length(s) > {long} THEN substr(s, 1, {long}) || '...' ELSE s END AS c
          FROM (SELECT {key}, {title} AS t, {content} AS s FROM {source}))"""


def _ranked() -> str:
    rows = " UNION ALL ".join(
        f"SELECT id, {_text(name)} AS label, {round2(f'max({_share(chr(119), vocabulary)})')} AS score "
        "FROM window_words GROUP BY id"
        for name, vocabulary in X.LABELS.items()
    )
    return f"""WITH {_window_words("documents", "doc_id", "text")},
        scores AS ({rows})
        SELECT id AS doc_id, (row_number() OVER (PARTITION BY id ORDER BY score DESC, label) - 1)::INTEGER AS rank,
          label, score FROM scores WHERE score >= 0.05"""


ORACLES["q_prompt_batches"] = _prompts(False)
ORACLES["q_prompt_batches_ascii"] = _prompts(True)
ORACLES["q_truncate"] = _article_prompts("doc_id", strip(_TITLE), strip("text"), "documents")
ORACLES["q_article_prompts"] = (
    f"WITH {_ARTICLES} {_article_prompts('ord', 'title', 'content', 'eligible')}"
)
ORACLES["q_label_ranked"] = _ranked()
