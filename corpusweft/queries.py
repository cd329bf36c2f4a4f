"""Named queries over the test tables, each with a DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .config import Config
from .functions import html as H, http, robots as R, text as T, url as U
from .lineage import ensure_checkpoints, spread
from .operators import boilerplate, dedup, frontier, langid, stats, windows
from .plans import reprocess as plan
from .sources import prevertical, seeds, tables
from .streaming import crawl, politeness

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TINY = Config(max_paths=4, min_paths=2, host_length_tiers=(14, 20, 50), distance_tiers=(2, 4, 50), paths_per_selection=2, min_docs_downloaded=5, min_bytes_downloaded=1000, host_queue_cap=3)


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(table) if name in ("documents", "pages") else table


# --- shared SQL pieces ------------------------------------------------------------------

_RE = r"'^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?'"


def _strip(x: str) -> str:
    return f"replace(trim(replace({x}, '%20', ' ')), ' ', '%20')"


def sql_scheme(u: str) -> str:
    return f"lower(regexp_extract({u}, {_RE}, 1))"


def sql_host(u: str) -> str:
    return _strip(f"regexp_extract({u}, {_RE}, 2)")


def sql_path(u: str) -> str:
    p, q = _strip(f"regexp_extract({u}, {_RE}, 3)"), _strip(f"regexp_extract({u}, {_RE}, 4)")
    return f"CASE WHEN {q} <> '' THEN {p} || '?' || {q} WHEN {p} = '' THEN '/' ELSE {p} END"


SQL_PAGES = f"(SELECT page_id, url, html, {sql_scheme('url')} AS scheme, {sql_host('url')} AS host, {sql_path('url')} AS path FROM pages)"
_TOKENS = r"list_filter(regexp_split_to_array({0}, '[\s\p{{Z}}]+'), lambda x: x <> '')"


def sql_tokens(x: str) -> str:
    return _TOKENS.format(x)


_BUCKETS = " ".join(f"WHEN {{0}} >= {least} THEN '{name}'" for least, name in T.LENGTH_BUCKETS)


def sql_bucket(x: str) -> str:
    return "CASE " + _BUCKETS.format(x) + " END"


def pages(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "pages")
    u = F.col("url")
    return p.select("page_id", "url", "html", U.scheme_of(u).alias("scheme"), U.host_of(u).alias("host"), U.path_of(u).alias("path"))


# --- documents --------------------------------------------------------------------------


@query(
    f"""WITH d AS (SELECT lang, length(text) AS n, len({sql_tokens('text')}) AS tokens,
         row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1 AS one FROM documents WHERE text <> '')
    SELECT lang, count(*)::BIGINT AS docs, sum(one::INT)::BIGINT AS unique_docs, coalesce(sum(tokens) FILTER (one), 0)::BIGINT AS tokens, """
    + ", ".join(f"(count(*) FILTER (one AND {sql_bucket('n')} = '{name}'))::BIGINT AS \"{name}\"" for _, name in T.LENGTH_BUCKETS)
    + " FROM d GROUP BY lang"
)
def flagship_language_totals(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").where("text <> ''")
    status = dedup.two_stage(docs.withColumn("html", F.lit("")), "doc_id")
    m = docs.select("doc_id", "lang", T.length_bucket(F.length("text")).alias("bucket"), T.token_count(F.col("text")).alias("tokens")).join(status, "doc_id")
    one = F.col("status") == "kept"
    return m.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.count(F.when(one, 1)).alias("unique_docs"), F.coalesce(F.sum(F.when(one, F.col("tokens"))), F.lit(0)).alias("tokens"),
        *[F.count(F.when(one & (F.col("bucket") == name), 1)).alias(name) for _, name in T.LENGTH_BUCKETS],
    )


@query(
    f"""WITH d AS (SELECT octet_length(encode(text)) AS html_len, octet_length(encode(text)) AS txt_len, len({sql_tokens('text')}) AS tokens,
         CASE WHEN text = '' THEN 'no-text' WHEN row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1 THEN 'dup' ELSE 'kept' END AS status FROM documents)
    SELECT count(*)::BIGINT AS html_count, coalesce(sum(html_len), 0)::BIGINT AS raw_size, (count(*) FILTER (status = 'kept'))::BIGINT AS txt_count,
      coalesce(sum(txt_len) FILTER (status = 'kept'), 0)::BIGINT AS clean_size, coalesce(sum(tokens) FILTER (status = 'kept'), 0)::BIGINT AS token_count FROM d"""
)
def corpus_totals(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    status = dedup.two_stage(docs.withColumn("html", F.lit("")), "doc_id")
    size = F.octet_length("text")
    return stats.totals(docs.select("doc_id", size.alias("html_len"), size.alias("txt_len"), T.token_count(F.col("text")).alias("token_count")).join(status, "doc_id"))


@query(f"SELECT doc_id, len({sql_tokens('text')})::BIGINT AS n_tokens FROM documents")
def tokens_per_document(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.token_count(F.col("text")).alias("n_tokens"))


@query(f"SELECT {sql_bucket('length(text)')} AS bucket, count(*)::BIGINT AS n FROM (SELECT text FROM documents UNION ALL SELECT repeat('x', n) FROM (VALUES (100000), (999999), (1000000)) v(n)) GROUP BY 1")
def length_buckets(spark: SparkSession, d: str) -> DataFrame:
    long = spark.sql("SELECT repeat('x', n) AS text FROM VALUES (100000), (999999), (1000000) AS v(n)")
    return read(spark, d, "documents").select("text").unionByName(long).groupBy(T.length_bucket(F.length("text")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r FROM documents) WHERE r > 1")
def exact_dedup_ids(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_duplicates(read(spark, d, "documents"))


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def exact_dedup_keep(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return dedup.without(docs, dedup.exact_duplicates(docs)).select("doc_id", "lang", "source")


@query(
    """WITH d AS (SELECT doc_id, md5(text) AS t, md5(lower(regexp_replace(text, '[ \t\n\r0-9]+', '', 'g'))) AS r FROM documents WHERE text <> ''),
    a AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id) AS n FROM d),
    b AS (SELECT *, min(CASE WHEN n = 1 THEN doc_id END) OVER (PARTITION BY r) AS first_raw FROM a)
    SELECT doc_id, CASE WHEN n > 1 THEN 'duplicate-text' WHEN doc_id > first_raw THEN 'duplicate-raw' ELSE 'kept' END AS status FROM b
    UNION ALL SELECT doc_id, 'no-text' FROM documents WHERE text IS NULL OR text = ''"""
)
def two_stage_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")  # a second key of the whole text stands for raw content
    return dedup.two_stage(docs.select("doc_id", "text", F.lower(F.regexp_replace("text", "[ \\t\\n\\r0-9]+", "")).alias("html")))


def _sql_grams(table: str, keys: str, n: int = 3) -> str:
    pad = "'  ' || t || ' '" if n > 1 else "t || ' '"
    return f"""(SELECT {keys}, unnest(list_transform(range(1, length(p) - {n - 2}), lambda i: substring(p, i, {n}))) AS gram FROM
      (SELECT {keys}, {pad} AS p FROM (SELECT {keys}, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM {table}) WHERE t <> ''))"""


_MODEL = f"model AS (SELECT lang, gram, count(*)::BIGINT AS n FROM {_sql_grams('documents', 'lang')} GROUP BY ALL)"
_NORM = "norm AS (SELECT lang, sqrt(sum(n * n)::DOUBLE) AS norm FROM model GROUP BY lang)"


@query(f"WITH {_MODEL} SELECT * FROM model")
def trigram_model(spark: SparkSession, d: str) -> DataFrame:
    return langid.model(read(spark, d, "documents"))


@query(f"SELECT lang, gram, count(*)::BIGINT AS n FROM {_sql_grams('documents', 'lang', 1)} GROUP BY ALL")
def unigram_model(spark: SparkSession, d: str) -> DataFrame:
    return langid.model(read(spark, d, "documents"), n=1)


@query(f"WITH {_MODEL}, {_NORM} SELECT lang, round(norm, 6) AS norm FROM norm")
def trigram_norms(spark: SparkSession, d: str) -> DataFrame:
    return langid.norms(langid.model(read(spark, d, "documents"))).select("lang", F.round("norm", 6).alias("norm"))


@query(
    f"""WITH {_MODEL}, {_NORM}, dot AS (SELECT a.lang AS lang_a, b.lang AS lang_b, sum(a.n * b.n) AS dot FROM model a JOIN model b USING (gram) GROUP BY ALL)
    SELECT lang_a, lang_b, round(1 - dot::DOUBLE / (x.norm * y.norm), 6) + 0.0::DOUBLE AS difference FROM dot JOIN norm x ON x.lang = lang_a JOIN norm y ON y.lang = lang_b"""
)
def lang_cosine_matrix(spark: SparkSession, d: str) -> DataFrame:
    return langid.cosine_matrix(langid.model(read(spark, d, "documents")))


_DETECT = f"""{_MODEL}, {_NORM}, g AS (SELECT doc_id, gram, count(*)::BIGINT AS n FROM {_sql_grams('documents', 'doc_id')} GROUP BY ALL),
  own AS (SELECT doc_id, sqrt(sum(n * n)::DOUBLE) AS norm FROM g GROUP BY doc_id),
  dot AS (SELECT doc_id, model.lang AS m, sum(g.n * model.n) AS dot FROM g JOIN model USING (gram) GROUP BY ALL),
  diff AS (SELECT doc_id, m, round(1 - dot::DOUBLE / (own.norm * norm.norm), 6) AS difference FROM dot JOIN own USING (doc_id) JOIN norm ON norm.lang = m),
  best AS (SELECT doc_id, m AS detected, difference FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY difference, m) AS r FROM diff WHERE difference < 1) WHERE r = 1),
  detected AS (SELECT doc_id, lang, detected, difference FROM documents LEFT JOIN best USING (doc_id))"""


@query(f"WITH {_DETECT} SELECT doc_id, detected, difference FROM detected")
def detect_language(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return langid.detect(docs, langid.model(docs))


@query(f"WITH {_DETECT} SELECT lang, detected, count(*)::BIGINT AS n FROM detected GROUP BY ALL")
def lang_confusion(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return docs.select("doc_id", "lang").join(langid.detect(docs, langid.model(docs)), "doc_id").groupBy("lang", "detected").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_DETECT} SELECT doc_id FROM detected WHERE detected IN ('en', 'fr')")
def lang_accept_filter(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return langid.detect(docs, langid.model(docs)).where(F.col("detected").isin("en", "fr")).select("doc_id")


_STOPS = f"""stops AS (SELECT * FROM (SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM
  (SELECT lang, word, count(*)::BIGINT AS n FROM (SELECT lang, unnest({sql_tokens('lower(text)')}) AS word FROM documents) GROUP BY ALL)) WHERE rank <= 50)"""


@query(f"WITH {_STOPS} SELECT lang, word, n, rank::INT AS rank FROM stops")
def stopword_list_topk(spark: SparkSession, d: str) -> DataFrame:
    return langid.stop_words(read(spark, d, "documents"), 50)


@query(
    f"""WITH {_STOPS}, w AS (SELECT doc_id, lang, unnest({sql_tokens('lower(text)')}) AS word FROM documents),
    h AS (SELECT doc_id, count(*)::BIGINT AS n_words, count(stops.word)::BIGINT AS n_stops FROM w LEFT JOIN stops USING (lang, word) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_stops, 0) AS n_stops, coalesce(round(n_stops / n_words, 6), 0) AS density FROM documents LEFT JOIN h USING (doc_id)"""
)
def stopword_density(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return langid.stop_word_density(docs, langid.stop_words(docs, 50).select("lang", "word"))


@query(
    r"""SELECT doc_id, (i - 1)::INT AS par_idx, ps[i] AS paragraph FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM
    (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(text, '\n', chr(10) || chr(10), 'g'), '\n\s*\n'), lambda x: trim(x) <> '') AS ps FROM documents))"""
)
def paragraph_split(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")  # their lines stand for paragraphs
    return docs.select("doc_id", F.posexplode(T.paragraphs(F.regexp_replace("text", "\n", "\n\n"))).alias("par_idx", "paragraph"))


@query(
    """WITH c AS (SELECT source, count(*)::BIGINT AS count_downloaded, sum(octet_length(encode(text)) * 200)::BIGINT AS bytes_downloaded, (count(*) FILTER (doc_id % 3 = 0))::BIGINT AS count_cleaned,
       coalesce(sum(CASE WHEN doc_id % 3 = 0 THEN length(text) ELSE 0 END), 0)::BIGINT AS bytes_cleaned FROM documents WHERE text <> '' GROUP BY source)
    SELECT source, count_downloaded, bytes_downloaded, count_cleaned, bytes_cleaned, bytes_downloaded < 1000 OR count_downloaded < 5 OR bytes_cleaned / bytes_downloaded >= 0.002::DOUBLE * (log10(count_downloaded::DOUBLE) - 1) AS efficient FROM c"""
)
def yield_rate_by_source(spark: SparkSession, d: str) -> DataFrame:
    meta = read(spark, d, "documents").where("text <> ''").select("source", (F.octet_length("text") * 200).alias("html_len"), F.when(F.col("doc_id") % 3 == 0, F.length("text")).otherwise(0).alias("txt_len"))
    return stats.domain_counters(meta, ["source"]).withColumn("efficient", stats.is_efficient(TINY)).drop("bytes_primary")


_SOURCES = """s AS (SELECT source, try_cast(regexp_extract(source, '(\\d+)', 1) AS INT) AS k, count(*)::BIGINT AS n, sum(length(text))::BIGINT AS b FROM documents GROUP BY source)"""


@query(
    f"""WITH {_SOURCES}, t AS (SELECT CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN 'NO_HOST' ELSE '10.0.0.1' END AS ip, CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'FAIL' ELSE 'FILE' END AS robots, k * 400 AS waited, k * 400 AS idle, k % 2 AS n_paths, n, b FROM s WHERE k IS NOT NULL)
    SELECT CASE WHEN ip = 'NO_HOST' THEN 'bad' WHEN ip IS NULL THEN 'new-ip' WHEN coalesce(robots = 'FAIL', false) OR (robots IS NULL AND waited >= 3600) THEN 'bad' WHEN robots IS NULL THEN 'new-robots'
      WHEN NOT (b * 600 < 1000 OR n < 5 OR b / (b * 600) >= 0.002::DOUBLE * (log10(n::DOUBLE) - 1)) THEN 'bad' WHEN n_paths < 1 AND idle >= 3600 THEN 'sleeping' ELSE 'ready' END AS status, count(*)::BIGINT AS n FROM t GROUP BY 1"""
)
def domain_status_counts(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("count_downloaded"), F.sum(F.length("text")).alias("bytes_cleaned"))
    s = s.withColumn("k", F.regexp_extract("source", r"(\d+)", 1).try_cast("int")).where("k is not null")
    k = F.col("k")
    rows = s.withColumns({
        "bytes_downloaded": F.col("bytes_cleaned") * 600, "count_cleaned": F.col("count_downloaded"),
        "ip": F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "NO_HOST").otherwise("10.0.0.1"),
        "robots": F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, "FAIL").otherwise("FILE"), "waited": k * 400, "idle": k * 400, "n_paths": k % 2,
    })
    return frontier.status_counts(rows.withColumn("status", stats.domain_status(TINY)))


@query(
    f"""SELECT doc_id, '<doc id="' || doc_id || '" length="' || {sql_bucket('length(text)')} || '" lang="' || lang || '" url="' || source || '">' || chr(10) ||
      list_aggregate(list_transform(string_split(text, chr(10)), lambda x: '<p class="good" cfclass="good">' || replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>'), 'string_agg', chr(10)) || chr(10) || '</doc>' AS record
    FROM documents WHERE text <> '' AND lang IS NOT NULL AND source IS NOT NULL"""
)
def prevertical_export(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").where("text <> '' and lang is not null and source is not null")
    ps = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), F.lit(False).alias("heading"), F.lit("good").alias("class"), F.lit("good").alias("cfclass")))
    body = F.array_join(F.transform(ps, prevertical.paragraph_tag), "\n")
    tag = {"id": F.col("doc_id"), "length": T.length_bucket(F.length("text")), "lang": F.col("lang"), "url": F.col("source")}
    return docs.select("doc_id", prevertical.record(tag, body).alias("record"))


@query("SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM documents WHERE regexp_matches(text, '[&<>]')")
def html_escape(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").where(F.col("text").rlike("[&<>]")).select("doc_id", T.escape_html(F.col("text")).alias("escaped"))


# --- pages: URLs ------------------------------------------------------------------------

_VARIANT = """CASE page_id % 11 WHEN 0 THEN 'http://h' || page_id || '.example.org/file.PDF' WHEN 1 THEN 'http://h.example.org/a.zip' WHEN 2 THEN 'http://www.www.h.org/x' WHEN 3 THEN 'http://h.tk/page'
  WHEN 4 THEN 'http://' || repeat('a', 60) || '.org/x' WHEN 5 THEN 'http://h.org/' || repeat('x', 600) WHEN 6 THEN 'http://h.org/a/a/a/a/a/a/b' WHEN 7 THEN 'ftp://h.org/file.html'
  WHEN 8 THEN 'http://a.b' WHEN 9 THEN 'HTTP://a.a.a.a.a.org/x?y' ELSE 'http://[h.org/xyz' END"""


def _rep(x: str, mark: str, more: int) -> str:
    return f"len(string_split({x}, '{mark}')) - len(list_distinct(string_split({x}, '{mark}'))) > {more}"


def _cnt(x: str, mark: str) -> str:
    return f"length({x}) - length(replace({x}, '{mark}', ''))"


_REASON = f"""CASE WHEN NOT regexp_matches(u, '(?i)^https?://.+\\..+') OR length(u) < 12 THEN 'url-invalid-or-short' WHEN contains(host, '[') <> contains(host, ']') THEN 'url-unparseable'
  WHEN scheme NOT IN ('http', 'https') THEN 'scheme-unsupported' WHEN length(host) > 50 THEN 'host-too-long' WHEN starts_with(host, 'www.www.') OR {_rep('host', '.', 3)} THEN 'host-repetitive' WHEN host = '' THEN 'host-empty-domain'
  WHEN regexp_matches(host, '\\.tk$') THEN 'host-blacklisted-TLD' WHEN length(path) > 500 OR {_cnt('path', '/')} > 30 OR {_cnt('path', '.')} > 30 THEN 'path-too-long'
  WHEN {_rep('path', '/', 4)} OR {_rep('path', '&', 4)} OR {_rep('path', '.', 4)} THEN 'path-repetitive' WHEN regexp_matches(path, '{U.BAD_EXTENSION}') THEN 'path-bad-file-type' WHEN regexp_matches(path, '{U.BINARY_EXTENSION}') THEN 'path-binary-file' END"""
_ADMIT = f"""SELECT page_id, u, scheme, host, path, {_REASON} AS reason FROM (SELECT page_id, u, {sql_scheme('u')} AS scheme, {sql_host('u')} AS host, {sql_path('u')} AS path FROM
  (SELECT page_id, regexp_replace(url, '\\s+', '', 'g') AS u FROM (SELECT page_id, url FROM pages UNION ALL SELECT page_id, {_VARIANT} FROM pages)))"""


def _admitted(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "pages").select("page_id", "url")
    return U.admit(p.unionByName(p.select("page_id", F.expr(_VARIANT).alias("url"))))


@query(f"SELECT coalesce(reason, 'admitted') AS reason, count(*)::BIGINT AS n FROM ({_ADMIT}) GROUP BY 1")
def url_admission_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _admitted(spark, d).groupBy(F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT page_id, host, reason FROM ({_ADMIT}) WHERE reason IS NOT NULL")
def rejected_urls(spark: SparkSession, d: str) -> DataFrame:
    return _admitted(spark, d).where("reason is not null").select("page_id", "host", "reason")


@query(f"SELECT page_id, scheme, host, path FROM {SQL_PAGES}")
def url_split_parts(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("page_id", "scheme", "host", "path")


_TAIL = "regexp_replace({0}, '" + U.SESSION_TAIL + "', '')"


@query(f"SELECT scheme, host, count(DISTINCT {_TAIL.format('path')})::BIGINT AS n_paths FROM (SELECT scheme, host, path FROM {SQL_PAGES} UNION ALL SELECT scheme, host, {_TAIL.format('path')} FROM {SQL_PAGES}) GROUP BY ALL")
def url_session_strip_distinct(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).select("scheme", "host", "path")
    both = p.unionByName(p.withColumn("path", U.session_stripped(F.col("path"))))
    return both.groupBy("scheme", "host").agg(F.countDistinct(U.session_stripped(F.col("path"))).alias("n_paths"))


@query(f"SELECT page_id, left(regexp_replace(replace(replace(regexp_replace(replace(replace(replace(replace(trim(regexp_replace(lower(scheme) || '://' || lower(host) || CASE WHEN starts_with(path, '/') THEN path ELSE '/' || path END, '\\s+', '', 'g')), '\"', '&quot;'), '<', '&lt;'), '>', '&gt;'), '''', '&apos;'), '\\\\', '', 'g'), '[', '%5B'), ']', '%5D'), 'blogspot\\.../', 'blogspot.com/', 'g'), 500) AS display FROM {SQL_PAGES}")
def display_urls(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("page_id", U.display_url(F.col("scheme"), F.col("host"), F.col("path")).alias("display"))


@query(f"SELECT scheme, host, path, count(*)::BIGINT AS n FROM {SQL_PAGES} GROUP BY ALL")
def seed_edges(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "pages").select(F.col("url").alias("value")).unionByName(spark.sql("SELECT '# a comment' AS value UNION ALL SELECT ''"))
    return seeds.seed_edges(lines).groupBy("scheme", "host", "path").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT page_id FROM {SQL_PAGES} WHERE regexp_matches(host, '(?i)(?:^|\\.)(?:example\\.org|[a-m][^.]*\\.example\\.com)$')")
def domain_list_filter(spark: SparkSession, d: str) -> DataFrame:
    listed = U.domain_list_regex([r"example\.org # all of it", "", "# nothing", r"[a-m][^.]*\.example\.com"])
    return pages(spark, d).where(F.col("host").rlike(listed)).select("page_id")


# --- pages: content ---------------------------------------------------------------------


@query(r"SELECT page_id, left(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1), '\s+', ' ', 'g')), 300) AS title FROM pages")
def page_titles(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", T.page_title(F.col("html")).alias("title"))


@query(r"""SELECT page_id, coalesce(nullif(lower(regexp_extract(html, '(?is)<meta[^>]*http-equiv=[''"]?content-type[''"]?[^>]*charset=([a-zA-Z0-9_:.\-]+)', 1)), ''), nullif(lower(regexp_extract(html, '(?is)<meta\s+charset=[''"]?([a-zA-Z0-9_:.\-]+)', 1)), '')) AS charset FROM pages""")
def page_meta_charset(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", T.meta_charset(F.col("html")).alias("charset"))


_LINKS = f"""WITH a AS (SELECT url, {sql_scheme('url')} || '://' || {sql_host('url')} AS site, unnest(regexp_extract_all(html, '(?i)<a[^>]*>')) AS tag FROM pages),
    h AS (SELECT url, site, regexp_extract(tag, 'href="([^"#]*)', 1) AS href FROM a WHERE NOT regexp_matches(tag, '(?i)rel=.?nofollow'))
    SELECT DISTINCT url, CASE WHEN regexp_matches(href, '(?i)^https?://') THEN href ELSE site || href END AS link FROM h WHERE regexp_matches(href, '(?i)^(/|https?://)')"""


@query(_LINKS)
def page_links_distinct(spark: SparkSession, d: str) -> DataFrame:
    return H.regex_links(read(spark, d, "pages"))


@query("SELECT page_id, " + " OR ".join(f"contains(html, '{m}')" for m in T.TRANSLATION_MARKS) + " AS translated FROM (SELECT page_id, html FROM pages UNION ALL SELECT page_id, html || '<!-- qtranslate -->' FROM pages)")
def mt_marker_filter(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "pages").select("page_id", "html")
    return p.unionByName(p.withColumn("html", F.concat("html", F.lit("<!-- qtranslate -->")))).select("page_id", T.is_translated(F.col("html")).alias("translated"))


@query(f"""SELECT url, link, scheme, host, path, {_REASON} AS reason FROM (SELECT *, {sql_scheme('u')} AS scheme, {sql_host('u')} AS host, {sql_path('u')} AS path FROM (SELECT url, link, regexp_replace(link, '\\s+', '', 'g') AS u FROM ({_LINKS})))""")
def page_links_resolved(spark: SparkSession, d: str) -> DataFrame:
    return H.page_links(read(spark, d, "pages"))


@query()
def paragraph_classes(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    stops = langid.stop_words(docs, 100).select("lang", "word")
    p = read(spark, d, "pages").select("page_id", F.lit("en").alias("lang"), "html")
    found = boilerplate.classify(p, stops, html="html").select("page_id", F.posexplode_outer("paragraphs").alias("par_idx", "p"))
    return found.where("par_idx is not null").select("page_id", "par_idx", "p.*")  # a plain posexplode has pages filtered by their paragraphs first, so parsed twice


@query()
def reprocess_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    models, stops = langid.model(docs), langid.stop_words(docs, 100).select("lang", "word")
    got = plan.reprocess(read(spark, d, "pages"), stops, models, Config(accepted_languages=("en", "de", "fr", "es")))
    return got.documents.select("page_id", "title", "lang", "lang_diff", F.length("text").alias("n_chars"), F.size("paragraphs").alias("n_paragraphs"), "status")


_UP = "regexp_replace(regexp_replace(regexp_extract(path, '^[^?]*'), '[^/]*$', ''), '[^/]+/$', '')"
_RESPONSES = f"""SELECT page_id, url, CASE k WHEN 1 THEN 302 WHEN 3 THEN 404 ELSE 200 END AS code, CASE WHEN k IN (0, 5) THEN 'html' WHEN k = 2 THEN 'txt' END AS file_type, CASE k WHEN 0 THEN '2019-03-05' END AS modified_date,
  CASE k WHEN 1 THEN scheme || '://' || host || {_UP} || 'next?x=1' END AS redirect_url, CASE WHEN k IN (1, 3) THEN 0 ELSE octet_length(encode(html)) END::INT AS n_bytes,
  CASE k WHEN 1 THEN 'redirect' WHEN 3 THEN 'not-200' WHEN 4 THEN 'content-type' END AS reason FROM (SELECT *, page_id % 6 AS k FROM {SQL_PAGES})"""


def _responses(spark: SparkSession, d: str) -> DataFrame:
    """One response of some kind for each page."""
    p = pages(spark, d)
    k = F.col("page_id") % 6
    body = F.col("html")
    head = (
        F.when(k == 0, F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nLast-Modified: Tue, 05 Mar 2019 10:00:00 GMT"))
        .when(k == 1, F.lit("HTTP/1.1 302 Found\r\nLocation: ../next?x=1"))
        .when(k == 2, F.lit("200 OK\r\ncontent-type: text/plain"))
        .when(k == 3, F.lit("HTTP/1.1 404 Not Found"))
        .when(k == 4, F.lit("HTTP/1.1 200 OK\r\nContent-Type: image/png"))
        .otherwise(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked"))
    )
    content = F.when(k == 5, F.concat(F.lower(F.hex(F.octet_length(body))), F.lit("\r\n"), body, F.lit("\r\n0\r\n\r\n"))).otherwise(body)
    raw = p.select("page_id", "url", "path", F.concat(head, F.lit("\r\n\r\n"), content).cast("binary").alias("response"))
    return http.parse_responses(raw)


@query(f"SELECT page_id, code, file_type, modified_date, redirect_url, n_bytes, reason FROM ({_RESPONSES})")
def http_responses(spark: SparkSession, d: str) -> DataFrame:
    return _responses(spark, d).select("page_id", "code", "file_type", "modified_date", "redirect_url", F.octet_length("body").alias("n_bytes"), "reason")


@query(
    f"""WITH r AS (SELECT DISTINCT {sql_scheme('url')} AS src_scheme, {sql_host('url')} AS src_host, {sql_scheme('redirect_url')} AS scheme, {sql_host('redirect_url')} AS host, {sql_path('redirect_url')} AS path FROM ({_RESPONSES}) WHERE reason = 'redirect'),
    l AS (SELECT DISTINCT {sql_scheme('url')} AS src_scheme, {sql_host('url')} AS src_host, {sql_scheme('link')} AS scheme, {sql_host('link')} AS host, {sql_path('link')} AS path FROM ({_LINKS}))
    SELECT scheme, host, path, count(*)::BIGINT AS n_sources FROM (SELECT * FROM r UNION SELECT * FROM l) GROUP BY ALL"""
)
def redirect_and_link_edges(spark: SparkSession, d: str) -> DataFrame:
    """Redirects go back to the frontier as edges, beside the links."""
    followed, _ = http.redirect_edges(_responses(spark, d))
    links = H.edges(H.page_links(read(spark, d, "pages")))
    return followed.unionByName(links).distinct().groupBy("scheme", "host", "path").agg(F.count(F.lit(1)).alias("n_sources"))


@query(
    f"""WITH p AS (SELECT page_id, scheme, host, path, min(page_id) OVER (PARTITION BY scheme, host) % 3 AS k FROM {SQL_PAGES})
    SELECT page_id, scheme, host, path, CASE k WHEN 0 THEN NOT contains(path, '?') WHEN 1 THEN NOT starts_with(path, '/a') AND NOT ends_with(path, '.html') ELSE true END AS allowed FROM p"""
)
def robots_decisions(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    body = F.when(F.col("n") % 3 == 0, F.lit("User-agent: *\nDisallow: /*?\nAllow: /\n")).when(F.col("n") % 3 == 1, F.lit("User-agent: corpusweft\nCrawl-delay: 2\nDisallow: /a\nDisallow: /*.html$\n\nUser-agent: *\nDisallow: /")).otherwise(F.lit("User-agent: other\nDisallow: /"))
    files = p.groupBy("scheme", "host").agg(F.min("page_id").alias("n")).select("scheme", "host", body.alias("body"))
    rules = R.rules_table(files, "corpusweft")
    return R.allowed_paths(p.select("page_id", "scheme", "host", "path"), rules)


@query("SELECT page_id, CASE WHEN length(s) = 14 THEN s[1:4] || '-' || s[5:6] || '-' || s[7:8] || ' ' || s[9:10] || ':' || s[11:12] ELSE s END AS crawl_date FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'odd' ELSE (20200101000000 + page_id)::VARCHAR END AS s FROM pages)")
def format_dates(spark: SparkSession, d: str) -> DataFrame:
    s = F.when(F.col("page_id") % 4 == 0, F.lit("odd")).otherwise((F.lit(20200101000000) + F.col("page_id")).cast("string"))
    return read(spark, d, "pages").select("page_id", T.stamp_to_minutes(s).alias("crawl_date"))


# --- frontier ---------------------------------------------------------------------------


@query(f"SELECT page_id, host, r::INT AS rank FROM (SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r FROM {SQL_PAGES}) WHERE r <= 3")
def pages_per_host_cap(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).select("page_id", "host")
    return windows.ranked(windows.at_most(p, ["host"], ["page_id"], 3)[0], ["host"], ["page_id"])


@query(f"SELECT page_id, n <= 4 OR r <= 3 AS queued FROM (SELECT page_id, count(*) OVER (PARTITION BY scheme, host) AS n, row_number() OVER (PARTITION BY scheme, host ORDER BY length(path), page_id) AS r FROM {SQL_PAGES})")
def host_path_trim(spark: SparkSession, d: str) -> DataFrame:
    queue, over = frontier.trim_paths(pages(spark, d).select("page_id", "scheme", "host", "path"), "page_id", TINY)
    return queue.select("page_id", F.lit(True).alias("queued")).unionByName(over.select("page_id", F.lit(False).alias("queued")))


@query(
    f"""WITH r AS (SELECT page_id, scheme, host, path, count(*) OVER w AS n, row_number() OVER (PARTITION BY scheme, host ORDER BY length(path), page_id) AS r FROM {SQL_PAGES} WINDOW w AS (PARTITION BY scheme, host)),
    q AS (SELECT *, n <= 4 OR r <= 3 AS queued FROM r), left_q AS (SELECT * FROM q WHERE queued AND NOT contains(path, '?')),
    o AS (SELECT q.page_id, coalesce(h.have, 0) AS have, row_number() OVER (PARTITION BY q.scheme, q.host ORDER BY q.page_id) AS k FROM q LEFT JOIN (SELECT scheme, host, count(*) AS have FROM left_q GROUP BY ALL) h ON q.scheme = h.scheme AND q.host = h.host WHERE NOT queued)
    SELECT page_id, 'queue' AS place FROM left_q UNION ALL SELECT page_id, CASE WHEN have < 2 AND k <= 3 - have THEN 'queue' ELSE 'overflow' END FROM o"""
)
def queue_refill(spark: SparkSession, d: str) -> DataFrame:
    queue, over = frontier.trim_paths(pages(spark, d).select("page_id", "scheme", "host", "path"), "page_id", TINY)
    queue, over = frontier.refill_paths(queue.where(~F.contains("path", F.lit("?"))), over, "page_id", TINY)
    return queue.select("page_id", F.lit("queue").alias("place")).unionByName(over.select("page_id", F.lit("overflow").alias("place")))


@query("SELECT page_id, (r // 7)::BIGINT AS batch_id, ((r // 7) % 3)::BIGINT AS processor FROM (SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS r FROM pages)")
def round_robin_batches(spark: SparkSession, d: str) -> DataFrame:
    return windows.round_robin(read(spark, d, "pages").select("page_id"), ["page_id"], 7, 3).select("page_id", "batch_id", "processor")


@query("SELECT page_id, (sum(octet_length(encode(html))) OVER (ORDER BY page_id) // 100000)::BIGINT AS file_no FROM pages")
def archive_rolling(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "pages").select("page_id", F.octet_length("html").alias("size"))
    return windows.rolled(p, ["page_id"], F.col("size"), 100_000).select("page_id", "file_no")


_HOSTS = f"hosts AS (SELECT page_id, host FROM {SQL_PAGES}), edges AS (SELECT DISTINCT a.host AS src, b.host AS dst FROM hosts a JOIN hosts b ON b.page_id = a.page_id + 1), seed AS (SELECT arg_min(host, page_id) AS node FROM hosts)"


@query(f"WITH RECURSIVE {_HOSTS}, w AS (SELECT node, 0 AS d FROM seed UNION SELECT dst, d + 1 FROM w JOIN edges ON src = node WHERE d < 50) SELECT node, min(d)::INT AS distance FROM w GROUP BY node")
def link_graph_distance(spark: SparkSession, d: str) -> DataFrame:
    h = pages(spark, d).select("page_id", "host")
    e = h.select("page_id", F.col("host").alias("src")).join(h.select((F.col("page_id") - 1).alias("page_id"), F.col("host").alias("dst")), "page_id")
    return frontier.distances(e, h.agg(F.min_by("host", "page_id").alias("node")))


_DOMAINS = f"domains AS (SELECT DISTINCT scheme, host, (length(host) % 7)::INT AS distance FROM {SQL_PAGES} WHERE scheme = 'http')"


def _domains(p: DataFrame) -> DataFrame:
    return p.where("scheme = 'http'").select("scheme", "host", (F.length("host") % 7).alias("distance")).distinct()


@query(f"WITH {_DOMAINS} SELECT DISTINCT p.scheme, p.host, coalesce(d.distance, 0) AS distance FROM {SQL_PAGES} p LEFT JOIN domains d ON d.host = p.host AND d.scheme <> p.scheme")
def host_twin_scheme(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    return frontier.twin_distance(p.select("scheme", "host").distinct(), _domains(p))


@query(
    f"""WITH {_DOMAINS}, e AS (SELECT a.scheme AS src_scheme, CASE WHEN a.page_id % 10 = 0 THEN NULL ELSE a.host END AS src_host, b.scheme, b.host FROM {SQL_PAGES} a JOIN {SQL_PAGES} b ON b.page_id = a.page_id + 1)
    SELECT e.scheme, e.host, min(CASE WHEN src_host IS NULL THEN 0 ELSE coalesce(d.distance, 0) + 1 END)::INT AS distance FROM e LEFT JOIN domains d ON d.scheme = src_scheme AND d.host = src_host GROUP BY ALL HAVING min(CASE WHEN src_host IS NULL THEN 0 ELSE coalesce(d.distance, 0) + 1 END) <= 4"""
)
def target_distances(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    src = p.select((F.col("page_id") + 1).alias("page_id"), F.col("scheme").alias("src_scheme"), F.when(F.col("page_id") % 10 != 0, F.col("host")).alias("src_host"))
    e = p.select("page_id", "scheme", "host").join(src, "page_id")
    return frontier.within(frontier.target_distance(e, _domains(p)), Config(max_distance=4))[0]


_STATES = f"{_DOMAINS}, s AS (SELECT *, CASE distance % 3 WHEN 0 THEN 'sleeping' WHEN 1 THEN 'bad' ELSE 'ready' END AS status FROM domains), t AS (SELECT scheme, host, min(page_id % 6)::INT AS distance FROM {SQL_PAGES} GROUP BY ALL)"


@query(
    f"""WITH {_STATES} SELECT coalesce(s.scheme, t.scheme) AS scheme, coalesce(s.host, t.host) AS host, least(s.distance, t.distance) AS distance,
      CASE WHEN s.status IS NULL THEN 'new-ip' WHEN s.status = 'sleeping' AND t.distance IS NOT NULL THEN 'ready' ELSE s.status END AS status,
      CASE WHEN s.status IS NULL THEN 'new' WHEN t.distance IS NULL THEN NULL WHEN s.status = 'sleeping' THEN 'wake' WHEN s.status = 'bad' THEN 'removed' ELSE 'update' END AS change
    FROM s FULL JOIN t ON s.scheme = t.scheme AND s.host = t.host"""
)
def domain_upsert(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    k = F.col("distance") % 3
    states = _domains(p).withColumn("status", F.when(k == 0, "sleeping").when(k == 1, "bad").otherwise("ready"))
    targets = p.groupBy("scheme", "host").agg(F.min(F.col("page_id") % 6).cast("int").alias("distance"))
    return frontier.upsert(states, targets)


@query(f"SELECT scheme, host, count(*)::BIGINT AS count_downloaded, sum(octet_length(encode(html)))::BIGINT AS bytes_downloaded, (count(*) FILTER (page_id % 3 = 0))::BIGINT AS count_cleaned, coalesce(sum(octet_length(encode(html)) // 2) FILTER (page_id % 3 = 0), 0)::BIGINT AS bytes_cleaned FROM {SQL_PAGES} GROUP BY ALL")
def docmeta_by_domain(spark: SparkSession, d: str) -> DataFrame:
    size = F.octet_length("html")
    meta = pages(spark, d).select("scheme", "host", size.alias("html_len"), F.when(F.col("page_id") % 3 == 0, F.floor(size / 2)).otherwise(0).alias("txt_len"))
    return stats.domain_counters(meta).drop("bytes_primary")


@query(f"WITH {_DOMAINS}, t AS (SELECT scheme, host, '10.0.0.' || length(host) AS ip FROM domains WHERE length(host) % 2 = 0) SELECT d.scheme, d.host, coalesce(t.ip, 'NO_HOST') AS ip FROM domains d LEFT JOIN t USING (scheme, host)")
def dns_resolution(spark: SparkSession, d: str) -> DataFrame:
    dom = _domains(pages(spark, d)).select("scheme", "host")
    table = dom.where(F.length("host") % 2 == 0).withColumn("ip", F.concat(F.lit("10.0.0."), F.length("host").cast("string")))
    return frontier.resolve_hosts(dom, table)


@query(
    f"""WITH d AS (SELECT DISTINCT scheme, host, length(host) % 7 AS distance FROM {SQL_PAGES}),
    j AS (SELECT p.page_id, p.host, d.distance, row_number() OVER (PARTITION BY p.scheme, p.host ORDER BY length(p.path), p.page_id) AS rank FROM {SQL_PAGES} p JOIN d ON d.scheme = p.scheme AND d.host = p.host),
    q AS (SELECT *, ((length(host) <= 14)::INT + (length(host) <= 20)::INT + (length(host) <= 50)::INT) * ((distance <= 2)::INT + (distance <= 4)::INT + (distance <= 50)::INT) * 2 AS quota,
      (14 < length(host))::INT + (20 < length(host))::INT + (50 < length(host))::INT AS l0, (2 < distance)::INT + (4 < distance)::INT + (50 < distance)::INT AS d0 FROM j)
    SELECT page_id, rank::INT AS rank, (l0 + ((rank - 1) // 2) // (3 - d0))::INT AS length_tier, (d0 + ((rank - 1) // 2) % (3 - d0))::INT AS distance_tier FROM q WHERE rank <= quota"""
)
def tiered_selection(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).select("page_id", "scheme", "host", "path")
    dom = p.select("scheme", "host", (F.length("host") % 7).alias("distance")).distinct()
    return frontier.tiered_selection(p, dom, "page_id", TINY).select("page_id", "rank", "length_tier", "distance_tier")


@query("SELECT page_id, row_number() OVER (ORDER BY page_id DESC) <= 40 AS sent FROM pages")
def batch_remainder(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "pages").select("page_id", (-F.col("page_id")).alias("o"))
    batch, rest = frontier.batch_and_rest(p, ["o"], 40)
    return batch.select("page_id", F.lit(True).alias("sent")).unionByName(rest.select("page_id", F.lit(False).alias("sent")))


@query(f"SELECT page_id, row_number() OVER (PARTITION BY scheme, host ORDER BY page_id) <= 4 AS queued FROM {SQL_PAGES}")
def host_queue_cap(spark: SparkSession, d: str) -> DataFrame:
    queue, waiting = frontier.cap_queue(pages(spark, d).select("page_id", "scheme", "host"), ["scheme", "host"], "page_id", TINY)
    return queue.select("page_id", F.lit(True).alias("queued")).unionByName(waiting.select("page_id", F.lit(False).alias("queued")))


@query(f"SELECT page_id, row_number() OVER (PARTITION BY host ORDER BY page_id) <= 3 AS now FROM {SQL_PAGES}")
def postponed_pages(spark: SparkSession, d: str) -> DataFrame:
    now, later = crawl.postponed(pages(spark, d).select("page_id", "host"), 4000)
    return now.select("page_id", F.lit(True).alias("now")).unionByName(later.select("page_id", F.lit(False).alias("now")))


@query(f"SELECT scheme, host, path FROM {SQL_PAGES} UNION SELECT {sql_scheme('link')}, {sql_host('link')}, {sql_path('link')} FROM ({_LINKS})")
def frontier_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    links = H.regex_links(read(spark, d, "pages")).select(U.scheme_of(F.col("link")).alias("scheme"), U.host_of(F.col("link")).alias("host"), U.path_of(F.col("link")).alias("path"))
    return pages(spark, d).select("scheme", "host", "path").unionByName(links).distinct()


@query(f"SELECT page_id FROM {SQL_PAGES} p WHERE NOT EXISTS (SELECT 1 FROM {SQL_PAGES} x WHERE contains(x.path, '?') AND x.scheme = p.scheme AND x.host = p.host)")
def dead_host_antijoin(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    return frontier.alive(p, p.where(F.contains("path", F.lit("?")))).select("page_id")


@query(
    f"""WITH p AS (SELECT page_id, scheme, host, path, contains(path, '?') AS late FROM {SQL_PAGES}), dead AS (SELECT DISTINCT scheme, host FROM p WHERE ends_with(path, '/')),
    a AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM dead WHERE dead.scheme = p.scheme AND dead.host = p.host)), r AS (SELECT *, row_number() OVER (PARTITION BY scheme, host ORDER BY late, page_id) AS n FROM a)
    SELECT page_id, CASE WHEN NOT late OR n <= 4 THEN 'queue' ELSE 'waiting' END AS place FROM r"""
)
def waiting_rotation(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).select("page_id", "scheme", "host", "path")
    late = F.contains("path", F.lit("?"))
    queue, waiting = frontier.rotate_waiting(p.where(~late), p.where(late), p.where(F.endswith("path", F.lit("/"))), "page_id", config=TINY)
    return queue.select("page_id", F.lit("queue").alias("place")).unionByName(waiting.select("page_id", F.lit("waiting").alias("place")))


@query(f"SELECT scheme, host, part, list(path ORDER BY page_id) AS paths FROM (SELECT *, ((row_number() OVER (PARTITION BY scheme, host ORDER BY page_id) - 1) // 3)::INT AS part FROM {SQL_PAGES}) GROUP BY ALL")
def paths_by_host(spark: SparkSession, d: str) -> DataFrame:
    return frontier.paths_by_host(pages(spark, d).select("page_id", "scheme", "host", "path"), "page_id", 3)


@query(f"WITH k AS (SELECT scheme, host, {_TAIL.format('path')} AS k, min(path) AS path FROM {SQL_PAGES} GROUP BY ALL) SELECT scheme, host, path FROM k WHERE NOT EXISTS (SELECT 1 FROM {SQL_PAGES} o WHERE contains(o.path, '?') AND o.scheme = k.scheme AND o.host = k.host AND {_TAIL.format('o.path')} = k.k)")
def new_paths(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).select("page_id", "scheme", "host", "path")
    none = spark.sql("SELECT '' AS scheme, '' AS host, 0L AS path_key WHERE false")
    seen = frontier.new_paths(p.where(F.contains("path", F.lit("?"))), none).drop("path")
    return frontier.new_paths(p, seen).select("scheme", "host", "path")


@query(f"SELECT scheme || ' ' || host || ' ' || path || '  ' AS value FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS n FROM {SQL_PAGES}) WHERE n <= 2 AND length(host) <= 18")
def reformat_queue(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).select("page_id", "scheme", "host", "path", F.lit(None).cast("string").alias("ip"))
    return tables.reformat_queue(p, 18, 2, "page_id")[0]


# --- events -----------------------------------------------------------------------------


@query("SELECT event_id, gap / 1000000.0::DOUBLE AS gap_seconds FROM (SELECT event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events) WHERE gap < 60000000")
def min_gap_violations(spark: SparkSession, d: str) -> DataFrame:
    return stats.gap_violations(read(spark, d, "events"), ["user_id"], "ts", 60.0).select("event_id", "gap_seconds")


@query("WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) SELECT user_id, n - (SELECT avg(n) FROM c) AS n FROM c WHERE n > (SELECT avg(n) FROM c)")
def recent_load_decay(spark: SparkSession, d: str) -> DataFrame:
    return stats.recent_decay(read(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    ensure_checkpoints(spark)
    import uuid

    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    source = spark.readStream.schema(read(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    once = crawl.first_by_content(source.withColumn("text", F.concat_ws("|", "user_id", "event_type")))
    w = once.select("user_id", "event_type").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
    w.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(f"{base}/out")


@query(
    """WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
    w AS (SELECT event_id, user_id, r, t AS last, true AS accepted FROM e WHERE r = 1
      UNION ALL SELECT e.event_id, e.user_id, e.r, CASE WHEN e.t - w.last >= 3600000000 THEN e.t ELSE w.last END, e.t - w.last >= 3600000000 FROM w JOIN e ON e.user_id = w.user_id AND e.r = w.r + 1)
    SELECT event_id, user_id, accepted FROM w"""
)
def rate_limit_accept(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return crawl.accept_in_order(e, "user_id", ["at", "event_id"], "at", 3_600_000_000).select("event_id", "user_id", "accepted")


@query(
    """WITH RECURSIVE e AS (SELECT event_id, 'h' || user_id AS host, user_id // 10 AS ip, epoch_us(ts) // 1000000 AS t, epoch_us(ts) // 600000000 AS turn FROM events),
    o AS (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY t, event_id) AS r FROM e),
    w AS (SELECT event_id, ip, r, t AS last, turn AS used, MAP([host], [t]) AS hosts, true AS ok FROM o WHERE r = 1
      UNION ALL SELECT event_id, ip, r, CASE WHEN ok THEN t ELSE last END, CASE WHEN ok THEN turn ELSE used END, CASE WHEN ok THEN map_concat(hosts, MAP([host], [t])) ELSE hosts END, ok FROM
        (SELECT o.event_id, o.ip, o.r, o.t, o.turn, o.host, w.last, w.used, w.hosts, coalesce(o.t - w.hosts[o.host] >= 7200, true) AND o.t - w.last >= 120 AND o.turn <> w.used AS ok FROM w JOIN o ON o.ip = w.ip AND o.r = w.r + 1))
    SELECT event_id, ok AS opened FROM w"""
)
def polite_connections(spark: SparkSession, d: str) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = read(spark, d, "events").select("event_id", F.concat(F.lit("h"), "user_id").alias("host"), F.floor(F.col("user_id") / 10).cast("long").alias("ip"), F.floor(us / 1_000_000).alias("at"), F.floor(us / 600_000_000).cast("long").alias("turn"))
    now, later = politeness.polite_connections(e, ["at", "event_id"], batch="turn", config=Config(host_interval=7200.0, ip_interval=120.0))
    return now.select("event_id", F.lit(True).alias("opened")).unionByName(later.select("event_id", F.lit(False).alias("opened")))


@query("SELECT (row_number() OVER () - 1)::INT AS round, size::INT AS size FROM (SELECT unnest(list_concat(list_transform(range(10), lambda i: 1), range(1, 300, 30), [300])) AS size)")
def cold_start_batches(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(politeness.cold_start(1, 300))), "round int, size int")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
