"""Every registered query of the record operators, with its DuckDB equivalent.

The driver's tables have no author lists, DOIs or announcements, so queries that need them derive them from the rows by the
same expression on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom import session
from strataloom.functions import authors, html, jsonx, keywords, links, prompts, text
from strataloom.operators import breaker, calendar, enrich, feeds, pages, posters, quality, records
from strataloom.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL where it has one."""

    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def both(column: str) -> Column:
    """An expression that both engines read alike."""
    return F.expr(column)


# --- derived inputs ---------------------------------------------------------------------------------

LINK = """CASE doc_id % 9 WHEN 0 THEN concat('10.1103/', cast(doc_id AS STRING)) WHEN 1 THEN concat(' https://arxiv.org/abs/2601.', cast(10000 + doc_id % 90000 AS STRING), 'v2 ')
 WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN concat('http://x.org/2101.12345/', cast(doc_id AS STRING)) WHEN 5 THEN concat('arXiv:2501.', cast(1000 + doc_id % 9000 AS STRING))
 WHEN 6 THEN '2412.00001v3' WHEN 7 THEN 'https://ARXIV.org/pdf/cond-mat/0703124v1' ELSE 'arXiv:cond-mat/0703124' END"""
URL = """concat(url, CASE page_id % 6 WHEN 0 THEN '/feed.xml' WHEN 1 THEN '/data/x.js?v=1' WHEN 2 THEN '/daily/2026-01-01.html' WHEN 3 THEN '/weekly/a.html#top' WHEN 4 THEN '/index.json' ELSE '/style.css' END)"""
SUMMARY = """CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN concat('  ', substring(text, 1, 300), '  ') WHEN 2 THEN concat(substring(text, 1, 30), '摘要信息不足') WHEN 3 THEN NULL ELSE concat('亮点', substring(text, 1, 40)) END"""
AUTHORS = """CASE doc_id % 8 WHEN 0 THEN 'Alice Smith, Bob Jones, and Carol King' WHEN 1 THEN 'A. One; B. Two & C. Three, Jr.' WHEN 2 THEN '' WHEN 3 THEN 'Li Wei (MIT), Ana Sol https://ror.org/x, y'
 WHEN 4 THEN concat('Author', cast(doc_id AS STRING), ' and  Other  Name') WHEN 5 THEN 'A, B, C, D, E, F, G, H' WHEN 6 THEN ';;' ELSE concat('Team ', source, ', PhD') END"""
ANNOUNCED = """concat(CASE doc_id % 4 WHEN 0 THEN 'arXiv:2608.28719v1 Announce Type: replace-cross Abstract: ' WHEN 1 THEN 'arXiv:2604.20821v3 发布类型：替换 摘要：' WHEN 2 THEN 'Nature Electronics, Published online: 14 September 2026; doi:10.1/x ' ELSE 'arXiv 数据集 ' END, text)"""
LATEX = """concat(CASE doc_id % 4 WHEN 0 THEN '$\\\\omega$ and $\\\\lambda \\\\leq 5$ ' WHEN 1 THEN '$\\\\rho$, \\\\chi 4\\\\times10 ' WHEN 2 THEN '\\\\ss and \\\\o and \\\\AA and \\\\L ' ELSE 'Mn$_2$Ru$_{1-x}$Ga 10^10 50\\\\% ' END, source, ' ', text)""".replace("\\\\", "\\")
ITEM = f"""SELECT doc_id, source, text AS abstract, {SUMMARY} AS one_sentence_summary, CASE WHEN doc_id % 4 = 0 THEN '中文摘要' ELSE '' END AS abstract_zh FROM documents"""
KEYWORDS = ["tion", "heit"]
GROUPS = {"神经网络势·电子结构": ["idiot", "enden"], "AI × 物理/材料/化学": ["queeau", "ación", "theand"]}
REST = "其他物理/材料"
TEMPLATE = "标题 $title 作者 ${authors} 年 $year 未知 $unknown 正文 $context 摘要 $abstract"


def duck(sql: str) -> str:
    """Both engines' SQL but for the name of the string type."""
    return sql.replace("AS STRING", "AS VARCHAR")


def documents(spark: SparkSession, sf_dir: str, **columns: str) -> DataFrame:
    """doc_id, source, lang and text of documents with derived columns."""
    literal = {"spark.sql.parser.escapedStringLiterals": "true"}
    before = {k: spark.conf.get(k) for k in literal}
    for k, v in literal.items():  # so that a backslash in SQL text is one, as in DuckDB
        spark.conf.set(k, v)
    try:
        return read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", *[both(v).alias(k) for k, v in columns.items()])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# --- counts (A1-A3, A8) -------------------------------------------------------------------------------


@query("SELECT CASE WHEN source LIKE 'src1%' THEN 'arXiv' ELSE '期刊' END AS kind, count(*) AS n FROM documents GROUP BY 1")
def source_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.counts(read(spark, sf_dir, "documents"), feeds.source_kind(F.col("source"), F.col("source").startswith("src1")))


@query("SELECT coalesce(CASE WHEN doc_id % 3 = 0 THEN lang END, source) AS kind, count(*) AS n FROM documents GROUP BY 1")
def topic_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = documents(spark, sf_dir, classify_taxonomy="CASE WHEN doc_id % 3 = 0 THEN lang END")
    return feeds.counts(items, F.coalesce("classify_taxonomy", "source"))


def _groups_sql(column: str) -> str:
    cases = " ".join(f"WHEN {' OR '.join(f"contains(lower({column}), '{w}')" for w in words)} THEN '{name}'" for name, words in GROUPS.items())
    return f"CASE {cases} ELSE '{REST}' END"


@query(f"SELECT {_groups_sql('text')} AS kind, count(*) AS n FROM documents GROUP BY 1")
def priority_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.counts(read(spark, sf_dir, "documents"), enrich.first_match(F.lower("text"), GROUPS, REST))


@query("SELECT source AS journal, count(*) AS n, min(doc_id) AS first_id, sum(n_chars) AS chars FROM documents GROUP BY 1".replace("sum(n_chars)", "cast(sum(n_chars) AS BIGINT)"))
def journal_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").groupBy(F.col("source").alias("journal")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.sum("n_chars").alias("chars"))


# --- links and identifiers (X1, X2, X24, X26-X28, F11-F13, N1) -----------------------------------------

_NORM = "CASE WHEN l = '' OR starts_with(l, 'http://') OR starts_with(l, 'https://') THEN l ELSE 'https://doi.org/' || l END"


@query(duck(f"WITH d AS (SELECT doc_id, trim(coalesce({LINK}, '')) AS l FROM documents) SELECT doc_id, {_NORM} AS link FROM d"))
def normalize_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, raw=LINK).select("doc_id", links.normalize_link(F.col("raw")).alias("link"))


@query(
    duck(f"""WITH d AS (SELECT doc_id, trim(coalesce({LINK}, '')) AS l FROM documents),
 m AS (SELECT *, regexp_extract(l, 'arxiv\\.org/(?:abs|pdf|html)/([a-z-]+/[0-9]{{7}})', 1, 'i') AS o, regexp_extract(l, '([0-9]{{4}}\\.[0-9]{{4,5}})', 1) AS n FROM d)
 SELECT doc_id, CASE WHEN o <> '' THEN o WHEN contains(lower(l), 'arxiv.org') OR starts_with(lower(l), 'arxiv:') OR regexp_full_match(l, '[0-9]{{4}}\\.[0-9]{{4,5}}(v[0-9]+)?') THEN n ELSE '' END AS arxiv_id FROM m""")
)
def arxiv_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, raw=LINK).select("doc_id", links.arxiv_id(F.col("raw")).alias("arxiv_id"))


@query(
    duck(f"""WITH p AS (SELECT page_id, regexp_extract({URL}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages)
 SELECT page_id, path, (path LIKE '%.json' OR path LIKE '%.xml' OR contains(path, '/data/') OR ((contains(path, '/daily/') OR contains(path, '/weekly/')) AND path LIKE '%.html')) AS network_first FROM p""")
)
def route_network_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select("page_id", links.url_path(both(URL)).alias("path"))
    return p.withColumn("network_first", links.is_network_first(F.col("path")))


OWN = "https://blog.tionsh.example.net"


@query(f"""SELECT page_id, url FROM pages WHERE page_id % 3 <> 0 AND regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) = '{OWN}'""")
def request_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").withColumn("method", both("CASE WHEN page_id % 3 = 0 THEN 'POST' ELSE 'GET' END"))
    return p.where(links.is_guarded(F.col("method"), F.col("url"), OWN)).select("page_id", "url")


@query("SELECT 'cache-' || source AS name, count(*) AS n FROM documents WHERE source NOT IN ('src1', 'src2') GROUP BY 1")
def cache_eviction(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "documents").select(F.concat(F.lit("cache-"), "source").alias("name"))
    return names.where(~F.col("name").isin("cache-src1", "cache-src2")).groupBy("name").agg(F.count("*").alias("n"))


_PATH = f"regexp_extract({URL}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


@query(f"""WITH p AS (SELECT page_id, {_PATH} AS path, CASE page_id % 4 WHEN 0 THEN true WHEN 1 THEN NULL ELSE page_id % 5 = 0 END AS answered, page_id % 3 = 0 AS cached FROM pages),
 f AS (SELECT *, path LIKE '%.json' OR path LIKE '%.xml' OR contains(path, '/data/') OR ((contains(path, '/daily/') OR contains(path, '/weekly/')) AND path LIKE '%.html') AS first FROM p),
 s AS (SELECT page_id, answered, CASE WHEN first AND answered THEN 'network' WHEN cached THEN 'cache' WHEN answered THEN 'network' ELSE 'error' END AS served FROM f) SELECT page_id, served, coalesce(answered, false) AND served = 'network' AS stored FROM s""")
def served_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select("page_id", links.url_path(both(URL)).alias("path"), both("CASE page_id % 4 WHEN 0 THEN true WHEN 1 THEN NULL ELSE page_id % 5 = 0 END").alias("answered"), (F.col("page_id") % 3 == 0).alias("cached"))
    of = (F.col("path"), F.col("answered"), F.col("cached"))
    return p.select("page_id", links.served(*of).alias("served"), links.is_stored(*of).alias("stored"))


@query("""SELECT DISTINCT cache, url FROM (SELECT 'v' || page_id % 4 AS cache, url FROM pages UNION ALL SELECT 'v3', url FROM pages WHERE page_id % 10 = 0) WHERE cache IN ('v3', 'v1')""")
def asset_install(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select("page_id", "url", F.concat(F.lit("v"), (F.col("page_id") % 4).cast("string")).alias("cache"))
    return records.installed(p.where("page_id % 10 = 0"), p, ["v3", "v1"])


@query("""WITH rule AS (SELECT n_name AS person, r_regionkey AS nth, r_name AS direction, CASE WHEN r_regionkey % 2 = 0 THEN [r_name || 'O2', 'x'] ELSE [] END AS materials FROM nation, region WHERE (n_nationkey + r_regionkey) % 3 < 2)
 SELECT person, person || '：' || string_agg(direction || CASE WHEN len(materials) > 0 THEN '（' || array_to_string(materials, '、') || '）' ELSE '' END, '；' ORDER BY nth) AS digest FROM rule GROUP BY 1""")
def profile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    rows = n.join(r, (F.col("n_nationkey") + F.col("r_regionkey")) % 3 < 2)
    materials = F.when(F.col("r_regionkey") % 2 == 0, F.array(F.concat("r_name", F.lit("O2")), F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return enrich.profile_digest(rows.select(F.col("n_name").alias("person"), F.col("r_regionkey").alias("nth"), F.col("r_name").alias("direction"), materials.alias("materials")))


@query("""WITH p AS (SELECT page_id, rtrim(url || CASE page_id % 3 WHEN 0 THEN '/v1' WHEN 1 THEN '/v1//' ELSE '/chat/completions' END, '/') AS b FROM pages)
 SELECT page_id, CASE WHEN b LIKE '%/chat/completions' THEN b ELSE b || '/chat/completions' END AS chat_url FROM p""")
def chat_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = both("concat(url, CASE page_id % 3 WHEN 0 THEN '/v1' WHEN 1 THEN '/v1//' ELSE '/chat/completions' END)")
    return read(spark, sf_dir, "pages").select("page_id", links.chat_url(base).alias("chat_url"))


_ID = "substring(md5(text || coalesce(nullif(doi, ''), link, '')), 1, 12)"
_DOI = "CASE WHEN doc_id % 3 = 0 THEN concat('10.1/', source) ELSE '' END"


@query(duck(f"WITH d AS (SELECT doc_id, text, {_DOI} AS doi, {LINK} AS link FROM documents) SELECT doc_id, {_ID} AS article_id FROM d"))
def article_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, doi=_DOI, link=LINK)
    return d.select("doc_id", links.article_id(F.col("text"), F.col("doi"), F.col("link")).alias("article_id"))


@query("SELECT md5(text) AS id, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1")
def dedupe_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.md5("text").alias("id"), "doc_id", "source")
    return records.dedupe_by(d, "id", "doc_id")


@query(duck(f"""WITH a AS (SELECT doc_id, trim(coalesce({LINK}, '')) AS l FROM documents), n AS (SELECT doc_id, {_NORM} AS link_norm FROM a), p AS (SELECT page_id, 'https://doi.org/10.1103/' || page_id AS link_norm FROM pages)
 SELECT n.link_norm, doc_id, page_id FROM n JOIN p ON n.link_norm = p.link_norm WHERE n.link_norm <> ''"""))
def link_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, link=LINK).select("doc_id", "link")
    p = read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("10.1103/"), F.col("page_id").cast("string")).alias("page_link"))
    return records.join_on_links(d, p, "link", "page_link").select("link_norm", "doc_id", "page_id")


@query("SELECT event_id, CASE WHEN n IN ('localkimi', 'local-kimi', 'lk') THEN 'local' ELSE n END AS provider FROM (SELECT event_id, lower(trim(CASE event_id % 4 WHEN 0 THEN ' LocalKimi ' WHEN 1 THEN 'LK' WHEN 2 THEN event_type ELSE coalesce(NULL, '') END)) AS n FROM events)")
def provider_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = both("CASE event_id % 4 WHEN 0 THEN ' LocalKimi ' WHEN 1 THEN 'LK' WHEN 2 THEN event_type ELSE NULL END")
    return read(spark, sf_dir, "events").select("event_id", links.provider_name(raw).alias("provider"))


@query("SELECT page_id, nullif(replace(p, 'docs/', ''), '') AS image, 'docs/images/posters/' || coalesce(nullif(doc, ''), 'unknown') || '.webp' AS path FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'docs/docs/' WHEN 1 THEN 'docs/images/posters/' || page_id || '.webp' END AS p, CASE WHEN page_id % 4 = 0 THEN '' ELSE cast(page_id AS VARCHAR) END AS doc FROM pages)")
def poster_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select("page_id", both("CASE page_id % 3 WHEN 0 THEN 'docs/docs/' WHEN 1 THEN concat('docs/images/posters/', page_id, '.webp') END").alias("p"), both("CASE WHEN page_id % 4 = 0 THEN '' ELSE cast(page_id AS STRING) END").alias("doc"))
    return p.select("page_id", links.without_docs(F.col("p")).alias("image"), F.concat(F.lit("docs/images/posters/"), F.coalesce(F.nullif("doc", F.lit("")), F.lit("unknown")), F.lit(".webp")).alias("path"))


# --- texts (X3-X5, X17-X23, F2, F4, F6, E4) --------------------------------------------------------------

_CLEAN = "CASE WHEN contains(t, '摘要信息不足') OR contains(t, '需查阅原文确认具体方法与结论') THEN '' WHEN length(t) > 120 THEN regexp_replace(substring(t, 1, 120), '\\s+$', '') || '…' ELSE t END"


def _clean_sql(column: str, name: str, source: str) -> str:
    return f"SELECT *, {_CLEAN} AS {name} FROM (SELECT *, regexp_replace(coalesce({column}, ''), '^\\s+|\\s+$', '', 'g') AS t FROM ({source}))"


@query(duck(f"SELECT doc_id, highlight FROM ({_clean_sql('s', 'highlight', f'SELECT doc_id, {SUMMARY} AS s FROM documents')})"))
def clean_highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, s=SUMMARY).select("doc_id", text.clean_highlight(F.col("s")).alias("highlight"))


@query(duck(f"SELECT doc_id, coalesce(regexp_matches(s, '[\\x{{4e00}}-\\x{{9fff}}]'), false) AS cjk, coalesce(contains(s, '摘要信息不足'), false) AS degraded FROM (SELECT doc_id, {SUMMARY} AS s FROM documents)"))
def has_cjk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, s=SUMMARY).select("doc_id", text.has_cjk(F.col("s")).alias("cjk"), text.is_degraded(F.col("s")).alias("degraded"))


@query(duck(f"""WITH d AS (SELECT doc_id, regexp_replace(coalesce(CASE WHEN contains(s, '摘要信息不足') THEN '' ELSE s END, ''), '^\\s+|\\s+$', '', 'g') AS s, zh, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t
   FROM (SELECT doc_id, {SUMMARY} AS s, CASE WHEN doc_id % 10 = 0 THEN '中文摘要' ELSE '' END AS zh, text FROM documents))
 SELECT doc_id, coalesce(nullif(s, ''), nullif(zh, ''), nullif(CASE WHEN length(t) > 200 THEN regexp_replace(substring(t, 1, 200), '\\s+$', '') || '…' ELSE t END, ''), '') AS summary FROM d"""))
def pick_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, s=SUMMARY, zh="CASE WHEN doc_id % 10 = 0 THEN '中文摘要' ELSE '' END")
    return d.select("doc_id", enrich.pick_summary(F.col("s"), F.col("zh"), F.lit(""), F.col("text")).alias("summary"))


@query(duck(f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(a, '^arXiv:\\S+?v[0-9]+\\s+Announce Type:\\s*[\\w-]+\\s+Abstract:\\s*', ''), '^arXiv:[^\\s；;]+?v[0-9]+[\\s；;]*(?:公告|发布|公布)类型[:：]\\s*[^\\s。：:]{{1,15}}?(?:\\s*摘要\\s*[:：]\\s*|。\\s*)', ''),
 '^[^,，。.;]{{2,60}}, Published online: [0-9]{{1,2}} \\w+ [0-9]{{4}};\\s*doi:\\S+\\s+', '') AS abstract FROM (SELECT doc_id, {ANNOUNCED} AS a FROM documents)"""))
def announce_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, a=ANNOUNCED).select("doc_id", text.without_announcement(F.col("a")).alias("abstract"))


def _latex_sql() -> str:
    out = "l"
    for a, b in (("\\omega", "ω"), ("\\lambda", "λ"), ("\\leq", "≤"), ("\\rho", "ρ"), ("\\chi", "χ"), ("\\times", "×"), ("\\ss ", "ß "), ("\\o ", "ø "), ("\\AA ", "Å "), ("\\L ", "Ł "), ("$", ""), ("\\%", "%"), ("_2", "₂"), ("_{1-x}", "₁₋ₓ"), ("^10", "¹⁰")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


@query(duck(f"SELECT doc_id, {_latex_sql()} AS title FROM (SELECT doc_id, {LATEX} AS l FROM documents)"))
def latex_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, l=LATEX).select("doc_id", text.formula_marks(text.latex_wrappers(text.latex_commands(F.col("l")))).alias("title"))


@query("""SELECT doc_id, nfc_normalize(replace(replace(replace(replace(replace('Schr\\"odinger caf\\''e Fran\\c{c}ois \\v{S}tefan ', '\\"o', 'ö'), '\\''e', 'é'), '\\c{c}', 'ç'), '\\v{S}', 'Š'), '$', '') || replace(text, '$', '')) AS name FROM documents""")
def text_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accents, mojibake and normal form C together: the UDF runs after built-ins have done the rest."""
    raw = F.concat(F.lit('Schr\\"odinger caf\\\'e Fran\\c{c}ois \\v{S}tefan '), "text")
    return read(spark, sf_dir, "documents").select("doc_id", text.normalized(raw).alias("name"))


_BYTES = "list_transform(range(0, octet_length(encode(t))), lambda i: cast('0x' || substring(hex(encode(t)), 2 * i + 1, 2) AS INTEGER))"


@query(f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source || ' 轨道' ELSE text END AS t FROM documents), r AS (SELECT doc_id, t, CASE WHEN doc_id % 2 = 0 THEN array_to_string(list_transform({_BYTES}, lambda b: chr(b)), '') ELSE t END AS raw FROM d),
 f AS (SELECT *, regexp_matches(raw, '[\\x{{c2}}-\\x{{f4}}][\\x{{80}}-\\x{{bf}}]') AS suspect FROM r)
 SELECT doc_id, raw, CASE WHEN suspect AND regexp_full_match(raw, '[\\x{{0}}-\\x{{ff}}]*') THEN coalesce(try(decode(from_hex(array_to_string(list_transform(string_split(raw, ''), lambda c: lpad(to_hex(unicode(c)), 2, '0')), '')))), raw) ELSE raw END AS fixed,
 suspect OR regexp_matches(raw, '\\\\["''`^~=.a-zA-Z&%$_#]|\\$[^$]+\\$') AS damaged FROM f""")
def mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-8 read as Latin-1, by the platform's own conversion, and whole texts that were read well."""
    damaged = F.decode(F.encode(F.concat("source", F.lit(" 轨道")), "UTF-8"), "ISO-8859-1")
    d = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, damaged).otherwise(F.col("text")).alias("raw"))
    return d.select("doc_id", "raw", text.undone_mojibake(F.col("raw")).alias("fixed"), text.is_damaged(F.col("raw")).alias("damaged"))


def _html_sql() -> str:
    c = "regexp_replace(html, '(?s)<!--.*?-->|<![^>]*>', ' ', 'g')"
    for tag in html.SKIPPED:
        c = f"regexp_replace({c}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    c = f"regexp_replace({c}, '(?s)<[^>]*>', ' ', 'g')"
    for name in ("lt", "gt", "quot", "nbsp", "copy", "middot", "amp"):  # all that the pages have; the ampersand last, as it may begin another's name
        c = f"replace({c}, '&{name};', '{html.ENTITIES[name]}')"
    return f"trim(regexp_replace({c}, '[\\s\\x{{00a0}}]+', ' ', 'g'))"


@query(f"SELECT page_id, {_html_sql()} AS body FROM pages")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", html.html_to_text(F.col("html")).alias("body"))


_NESTED = """concat('<nav>a<header title="x>y">b</nav>c</header>d', html, CASE page_id % 3 WHEN 0 THEN '<footer>never closed <p>e' WHEN 1 THEN '</nav>f<script>if (a < b) "</nav>"' ELSE '<noscript>g<nav>h</noscript>i</nav></footer>j <!-- <nav> -->' END)"""


def _nested_sql() -> str:
    rest = """(?:\\s(?:[^>"'']|"[^"]*"|''[^'']*'')*)?/?>""".replace("\\\\", "\\")
    raw = "|".join(rf"<{t}{rest}.*?(?:</{t}\s*>|\z)" for t in html.RAW)
    tag = f"</?(?:{'|'.join(html.SKIPPED)}){rest}"
    out = r"regexp_replace(array_to_string(list_transform(list_filter(list_zip(parts, depths), lambda x: x[2] = 0), lambda x: x[1]), ' '), '(?s)<[^>]*>', ' ', 'g')"
    for name in ("lt", "gt", "quot", "nbsp", "copy", "middot", "amp"):
        out = f"replace({out}, '&{name};', '{html.ENTITIES[name]}')"
    return rf"""WITH b AS (SELECT page_id, regexp_replace({_NESTED}, '(?is)<!--.*?(?:-->|\z)|<![^>]*>|{raw}', ' ', 'g') AS bare FROM pages),
 t AS (SELECT page_id, regexp_split_to_array(bare, '(?is){tag}') AS parts, list_reduce(list_concat([[0]], list_transform(regexp_extract_all(bare, '(?is){tag}'), lambda t: [CASE WHEN starts_with(t, '</') THEN -1 ELSE 1 END])), lambda a, b: list_append(a, greatest(a[-1] + b[1], 0))) AS depths FROM b)
 SELECT page_id, trim(regexp_replace({out}, '[\s\x{{00a0}}]+', ' ', 'g')) AS body FROM t"""


@query(_nested_sql())
def html_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with skipped elements in each other, closed out of order, not at all, or never opened."""
    return read(spark, sf_dir, "pages").select("page_id", html.html_to_text(both(_NESTED)).alias("body"))


@query()
def html_to_text_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", html.exact_html_to_text(F.col("html")).alias("body"))


# --- authors (X6-X9, F5, A7) --------------------------------------------------------------------------------


_TIDY = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '(?i)^(?:and|&)\s+', ''), '^[ ,;]+|[ ,;]+$', '', 'g'), '\s+', ' ', 'g'))"
#: A list's names: its string is split, tidied, and a suffix rejoins the name before it. Names stand between bars.
_NAMES = rf"""WITH d AS (SELECT doc_id, trim(regexp_replace({AUTHORS.replace("STRING", "VARCHAR")}, '\s+', ' ', 'g')) AS a FROM documents),
 p AS (SELECT doc_id, a, list_filter(list_transform(regexp_split_to_array(regexp_replace(regexp_replace(a, '(?is)https?://.*$', ' ', 'g'), '\([^)]*\)', ' ', 'g'), '\s*[;,]\s*|\s+and\s+|\s*&\s*'), lambda x: {_TIDY}), lambda x: regexp_matches(x, '[\pL\pN_]')) AS parts FROM d),
 n AS (SELECT doc_id, CASE WHEN len(parts) > 0 THEN list_reduce(parts, lambda y, x: y || CASE WHEN regexp_matches(x, '{authors.SUFFIX}') THEN ', ' ELSE '|' END || x) ELSE a END AS names FROM p)"""


@query(f"{_NAMES} SELECT doc_id, names FROM n")
def author_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, a=AUTHORS).select("doc_id", F.array_join(authors.split_names(text.compacted(F.col("a"))), "|").alias("names"))


@query(f"{_NAMES}, l AS (SELECT doc_id, CASE WHEN names = '' THEN [] ELSE string_split(names, '|') END AS names FROM n) SELECT doc_id, array_to_string(names[1:6], ', ') || CASE WHEN len(names) > 6 THEN ' 等' || len(names) || '位作者' ELSE '' END AS label FROM l")
def authors_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, a=AUTHORS)
    return d.select("doc_id", authors.authors_label(authors.author_names(F.array("a"))).alias("label"))


_CHARACTERS = """CASE doc_id % 3 WHEN 0 THEN split(concat(source, ' ', lang), '') WHEN 1 THEN split(concat(source, ' and ', lang, ' and x y z a b c d'), ' ') ELSE array(source, 'a', 'b', 'c', 'd', 'e', 'f', 'g', '', lang) END"""


@query(f"""WITH c AS (SELECT doc_id, list_filter({_CHARACTERS.replace("split(", "string_split(").replace("array(", "list_value(")}, lambda x: x <> '') AS s FROM documents)
 SELECT doc_id, len(s) >= 8 AND len(list_filter(s, lambda x: length(trim(x)) <= 1)) / len(s) >= 0.85 AS stream FROM c""")
def char_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", authors.is_character_stream(both(_CHARACTERS)).alias("stream"))


_LISTED = """CASE doc_id % 6 WHEN 0 THEN concat('["A. One", "', source, '"]') WHEN 1 THEN concat('plain ', source) WHEN 2 THEN '[not a list' WHEN 3 THEN concat('[', chr(39), lang, chr(39), ', "O', chr(39), 'Brien", 7]') WHEN 4 THEN '[]' ELSE concat(' [ ', chr(39), 'x, y', chr(39), ' , ', chr(39), source, chr(39), ', ] ') END"""


@query(f"""SELECT doc_id, CASE WHEN regexp_full_match(r, '\\s*\\[\\s*((''[^'']*''|"[^"]*"|[0-9]+)\\s*,?\\s*)*\\]\\s*') THEN array_to_string(list_transform(regexp_extract_all(r, '''[^'']*''|"[^"]*"|[0-9]+'), lambda x: CASE WHEN x[1] IN ('''', '"') THEN x[2:length(x) - 1] ELSE x END), ', ') ELSE r END AS authors FROM (SELECT doc_id, {_LISTED} AS r FROM documents)""")
def listed_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, r=_LISTED).select("doc_id", authors.listed_authors(F.col("r")).alias("authors"))


# --- filters and joins (F1, F7-F9, N5, N6) ---------------------------------------------------------------------


@query(f"SELECT doc_id FROM documents WHERE {' OR '.join(f"contains(lower(text), '{w}')" for w in KEYWORDS)}")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.keyword_filter(read(spark, sf_dir, "documents"), F.col("text"), KEYWORDS).select("doc_id")


#: All words of the benchmark, the longest first: a list as long as a deployment's.
_WORDS = "SELECT word, row_number() OVER (ORDER BY strlen(word) DESC, word) - 1 AS nth FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[^ ]{4,}')) AS word FROM benchmark)"


@query(f"""WITH w AS ({_WORDS}), m AS (SELECT doc_id, count(*) AS n, min(nth) AS nth FROM documents, w WHERE contains(lower(text), word) GROUP BY 1)
 SELECT d.doc_id, coalesce(n, 0) AS n, coalesce(word, '') AS longest FROM documents d LEFT JOIN m USING (doc_id) LEFT JOIN w USING (nth)""")
def keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of a long list a text has, and the longest of them, from one pass over the text."""
    listed = read(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[^ ]{4,}"), 0)).alias("word")).distinct()
    words = [r["word"] for r in listed.orderBy(F.desc(F.octet_length("word")), "word").collect()]
    met = keywords.Words(spark, words).all(F.lower("text"))
    found = read(spark, sf_dir, "documents").select("doc_id", met.alias("met"))
    names = spark.createDataFrame(list(enumerate(words)), "nth int, word string")
    return found.select("doc_id", F.size("met").cast("long").alias("n"), F.get("met", F.lit(0)).alias("nth")).join(names, "nth", "left").select("doc_id", "n", F.coalesce("word", F.lit("")).alias("longest"))


_RULES_OF = "SELECT p_partkey AS rule, unnest(string_split(lower(p_name), ' ')) AS word FROM part WHERE p_partkey <= 400"


@query(f"""WITH r AS ({_RULES_OF}), t AS (SELECT doc_id, lower(text || ' ' || p_name) AS text FROM documents LEFT JOIN part ON p_partkey = 1 + doc_id % 700)
 SELECT doc_id, 'rule ' || coalesce(cast(min(rule) AS VARCHAR), 'none') AS category FROM t LEFT JOIN r ON contains(text, word) GROUP BY 1""")
def keyword_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of several hundred rules of whose words a text has one: first_match() over a table of rules."""
    parts = read(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").alias("p_name"))
    rules = {f"rule {r['p_partkey']}": r["p_name"].split(" ") for r in parts.where("p_partkey <= 400").orderBy("p_partkey").collect()}
    d = read(spark, sf_dir, "documents").select("doc_id", "text", (1 + F.col("doc_id") % 700).alias("p_partkey")).join(parts, "p_partkey", "left")
    return d.select("doc_id", enrich.first_match(F.lower(F.concat("text", F.lit(" "), "p_name")), rules, "rule none").alias("category"))


@query("SELECT doc_id, source FROM documents WHERE source IN (SELECT 'src' || r_regionkey FROM region)")
def venue_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "region").select(F.concat(F.lit("src"), "r_regionkey").alias("source"))
    return records.allowed(read(spark, sf_dir, "documents").select("doc_id", "source"), "source", names)


@query("SELECT doc_id, source FROM documents WHERE source NOT IN (SELECT 'src' || r_regionkey FROM region)")
def venue_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "region").select(F.concat(F.lit("src"), "r_regionkey").alias("source"))
    return records.excluded(read(spark, sf_dir, "documents").select("doc_id", "source"), "source", names)


_TITLE = "concat(source, CASE doc_id % 7 WHEN 0 THEN ' Ferroelectric switching' WHEN 1 THEN ' of domain walls' WHEN 2 THEN ' 斯格明子' ELSE ' and lines' END)"


@query(f"SELECT doc_id, title FROM (SELECT doc_id, {_TITLE} AS title FROM documents) WHERE {' OR '.join(f"contains(lower(title), '{w}')" for w in enrich.TOPICS)}")
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.on_topic(documents(spark, sf_dir, title=_TITLE).select("doc_id", "title"), F.col("title"))


# --- classification and enrichment (E1-E6, O1, U1, T5) -----------------------------------------------------------

_ANSWER = "CASE doc_id % 4 WHEN 0 THEN concat('类别：', 'AI × 物理/材料/化学', '。') WHEN 1 THEN '神经网络势·电子结构' WHEN 2 THEN '不知道' ELSE NULL END"


@query(f"SELECT doc_id, {_groups_sql('text')} AS category FROM documents")
def classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", enrich.first_match(F.lower("text"), GROUPS, REST).alias("category"))


@query(f"""SELECT doc_id, CASE WHEN {_groups_sql('text')} <> '{REST}' THEN {_groups_sql('text')} ELSE CASE doc_id % 4 WHEN 0 THEN 'AI × 物理/材料/化学' WHEN 1 THEN '神经网络势·电子结构' ELSE '其他' END END AS category FROM documents""")
def classify_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, answer=_ANSWER)
    return d.select("doc_id", enrich.classify(F.col("text"), F.col("answer"), GROUPS).alias("category"))


@query(f"""SELECT doc_id, '把下面这篇论文归入且仅归入这些类别之一（只输出类别名，不要解释）：{"、".join(GROUPS)}、其他。' || chr(10) || '标题：' || source || chr(10) || '摘要：' || substring(text, 1, 600) AS prompt FROM documents WHERE {_groups_sql("source || '  ' || text")} = '{REST}'""")
def classify_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what no rule decides is asked; the model gets the first 600 characters."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("title"), F.lit("").alias("summary"), F.col("text").alias("abstract"))
    return enrich.classify_requests(d, GROUPS).select("doc_id", "prompt")


@query(duck(f"SELECT doc_id, source FROM ({_clean_sql('one_sentence_summary', 'h', ITEM)}) WHERE h = '' AND abstract_zh = '' AND regexp_replace(abstract, '\\s', '', 'g') <> ''"))
def highlight_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, s=SUMMARY, zh="CASE WHEN doc_id % 4 = 0 THEN '中文摘要' ELSE '' END")
    return d.where(enrich.needs_highlight(F.col("s"), F.col("zh"), F.col("text"))).select("doc_id", "source")


@query(duck(f"""WITH c AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM ({_clean_sql('one_sentence_summary', 'h', ITEM)}) WHERE h = '' AND abstract_zh = '' AND regexp_replace(abstract, '\\s', '', 'g') <> '')
 SELECT source, count(*) AS n, count(*) FILTER (WHERE i <= 3) AS filled FROM (SELECT d.source, c.i FROM documents d LEFT JOIN c USING (doc_id)) GROUP BY 1"""))
def highlight_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, one_sentence_summary=SUMMARY, abstract_zh="CASE WHEN doc_id % 4 = 0 THEN '中文摘要' ELSE '' END").withColumn("abstract", F.col("text")).withColumn("translated", F.lit("翻译"))
    generated = read(spark, sf_dir, "documents").select("source").distinct().select("source", F.lit(2).alias("index"), F.lit("生成的亮点").alias("highlight"))
    done = enrich.fill_highlights(d, generated, "source", "doc_id", 3)
    return done.groupBy("source").agg(F.count("*").alias("n"), F.count("filled").alias("filled"))


@query(duck(f"""WITH c AS (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM ({_clean_sql('one_sentence_summary', 'h', ITEM)}) WHERE h = '' AND abstract_zh = '' AND regexp_replace(abstract, '\\s', '', 'g') <> '')
 SELECT d.doc_id, CASE WHEN i IS NULL OR i > 40 THEN NULL WHEN i % 3 = 0 THEN '亮点' || i || ' ' || source WHEN d.doc_id % 4 = 1 THEN '翻译 ' || text END AS filled FROM documents d LEFT JOIN c USING (doc_id)""").replace("'翻译 ' || text", "CASE WHEN length(trim(text)) > 117 THEN rtrim(substring('翻译 ' || trim(text), 1, 120), ' ' || chr(10)) || '…' ELSE '翻译 ' || trim(text) END"))
def highlight_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is filled in: every third candidate has an answer, and of the others some a translation of the whole text."""
    d = documents(spark, sf_dir, one_sentence_summary=SUMMARY, abstract_zh="CASE WHEN doc_id % 4 = 0 THEN '中文摘要' ELSE '' END").withColumn("abstract", F.col("text"))
    items = d.withColumn("translated", F.when(F.col("doc_id") % 4 == 1, F.concat(F.lit("翻译 "), "text")))
    of_source = d.select("source").distinct().select("source", F.explode(F.sequence(F.lit(3), F.lit(60), F.lit(3))).alias("index"))
    generated = of_source.select("source", "index", F.concat(F.lit("亮点"), F.col("index").cast("string"), F.lit(" "), "source").alias("highlight"))
    return enrich.fill_highlights(items, generated, "source", "doc_id", 40).select("doc_id", "filled")


@query("""SELECT doc_id, CASE WHEN contains(lower(text), 'idiot') AND contains(lower(text), 'stupid') THEN 'A、B' WHEN contains(lower(text), 'idiot') THEN 'A' WHEN contains(lower(text), 'stupid') THEN 'B' ELSE '一般方法' END AS note FROM documents""")
def direction_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", enrich.direction_note(F.col("text"), {"idiot": "A", "stupid": "B"}).alias("note"))


_ABSTRACT = "CASE doc_id % 3 WHEN 0 THEN ' ' WHEN 1 THEN text ELSE concat('Machine Learning and molecular dynamics. ', text) END"
_SAID = "CASE doc_id % 4 WHEN 0 THEN '摘要信息不足' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE source END"
_METHODS = f"coalesce(nullif(array_to_string(list_filter([{', '.join(f"CASE WHEN contains(lower(title_en || ' ' || abstract), '{k}') THEN '{v}' END" for k, v in enrich.METHODS.items())}], lambda x: x IS NOT NULL), '、'), ''), '一般方法')"


def _relation_sql() -> str:
    said = {"method_point": "方法：", "related_work": "相关方向：", "implication": "启示："}
    fields = ", ".join(f"CASE WHEN bare THEN '{enrich.NO_ABSTRACT[k]}' ELSE '{v}' || methods END AS {k}" for k, v in said.items())
    return f"""WITH d AS (SELECT doc_id, lang || ' ferroelectric' AS title_en, {_ABSTRACT} AS abstract, {_SAID} AS s FROM documents), m AS (SELECT *, {_METHODS} AS methods, regexp_matches(abstract, '^\\s*$') AS bare, regexp_replace(abstract, '^\\s+|\\s+$', '', 'g') AS a FROM d)
 SELECT doc_id, {fields}, coalesce(nullif(CASE WHEN contains(s, '摘要信息不足') THEN '' ELSE s END, ''), nullif(CASE WHEN length(a) > 200 THEN regexp_replace(substring(a, 1, 200), '\\s+$', '') || '…' ELSE a END, ''), title_en) AS summary FROM m"""


_PARTLY = {"method_point": "CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN '' END", "related_work": "CASE doc_id % 4 WHEN 1 THEN lang ELSE '' END", "implication": "CASE doc_id % 5 WHEN 2 THEN concat('启示 ', source) END"}


@query(f"WITH p AS (SELECT doc_id, {', '.join(f'{v} AS {k}' for k, v in _PARTLY.items())} FROM documents), r AS ({_relation_sql()}) SELECT doc_id, {', '.join(f"coalesce(nullif(p.{k}, ''), r.{k}) AS {k}" for k in _PARTLY)}, r.summary FROM p JOIN r USING (doc_id)")
def relation_partly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that are filled stay, whichever of them."""
    d = documents(spark, sf_dir, title_en="concat(lang, ' ferroelectric')", abstract=_ABSTRACT, abstract_zh="''", summary=_SAID, **_PARTLY)
    return enrich.relation_fields(d).select("doc_id", *_PARTLY, "summary")


@query(_relation_sql())
def relation_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, title_en="concat(lang, ' ferroelectric')", abstract=_ABSTRACT, abstract_zh="''", summary=_SAID, method_point="''", related_work="''", implication="''")
    return enrich.relation_fields(d).select("doc_id", "method_point", "related_work", "implication", "summary")


# --- full texts and answers (E8, F14, S7, N3, J1-J5) ------------------------------------------------------------------


@query("""SELECT d.doc_id, CASE WHEN length(coalesce(p.html, '')) >= 4000 THEN substring(p.html, 1, 40000) WHEN length(d.text) >= 4000 THEN substring(d.text, 1, 40000) ELSE '' END AS body,
 CASE WHEN length(coalesce(p.html, '')) >= 4000 THEN 'html' WHEN length(d.text) >= 4000 THEN 'pdf' ELSE '' END AS mode FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id""")
def fulltext_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, p = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "html")
    found = records.full_text([(F.col("html"), "html"), (F.col("text"), "pdf")])
    return d.join(p, "doc_id", "left").select("doc_id", found.alias("f")).select("doc_id", F.col("f.text").alias("body"), F.col("f.mode").alias("mode"))


@query("""SELECT d.doc_id, CASE WHEN length(coalesce(p.html, '')) >= 4000 THEN substring(p.html, 1, 40000) WHEN length(coalesce(m.html, '')) >= 4000 THEN substring(m.html, 1, 40000) WHEN length(d.text) >= 4000 THEN substring(d.text, 1, 40000) ELSE '' END AS body,
 CASE WHEN length(coalesce(p.html, '')) >= 4000 THEN 'html' WHEN length(coalesce(m.html, '')) >= 4000 THEN 'mirror' WHEN length(d.text) >= 4000 THEN 'pdf' ELSE '' END AS mode FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id * 2 LEFT JOIN pages m ON m.page_id = d.doc_id * 2 + 1""")
def fulltext_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page, its mirror, and the document's own text; each of the three is the first with enough text for some."""
    d, p = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "pages")
    page = p.where("page_id % 2 = 0").select((F.col("page_id") / 2).cast("long").alias("doc_id"), "html")
    mirror = p.where("page_id % 2 = 1").select(((F.col("page_id") - 1) / 2).cast("long").alias("doc_id"), F.col("html").alias("mirror"))
    found = records.full_text([(F.col("html"), "html"), (F.col("mirror"), "mirror"), (F.col("text"), "pdf")])
    return d.join(page, "doc_id", "left").join(mirror, "doc_id", "left").select("doc_id", found.alias("f")).select("doc_id", F.col("f.text").alias("body"), F.col("f.mode").alias("mode"))


_PAPER = "concat('2601.', cast(10000 + doc_id % 80000 AS STRING))"
#: Landed answers: a third of the papers as HTML, a third by the mirror (every other one too short), the others not at all.
_LANDED = "CASE doc_id % 3 WHEN 0 THEN concat('https://arxiv.org/html/', {paper}) WHEN 1 THEN concat('https://ar5iv.org/abs/', {paper}) END"


@query(duck(f"""WITH d AS (SELECT doc_id, text, {_PAPER} AS paper, CASE WHEN doc_id % 5 = 0 THEN 'https://doi.org/10.1/x' ELSE 'https://arxiv.org/abs/' || {_PAPER} || 'v1' END AS link FROM documents),
 p AS (SELECT paper, doc_id % 3 AS kind, trim(regexp_replace(replace(replace(replace(text, '&', ' '), '<', ' '), '>', ' '), '[ \\t]+', ' ', 'g')) AS body FROM d WHERE doc_id % 3 < 2), f AS (SELECT d.doc_id, coalesce(max(CASE WHEN kind = 0 AND length(body) >= 4000 THEN body END), max(CASE WHEN kind = 1 AND length(body) >= 4000 THEN body END)) AS body FROM d JOIN p ON d.paper = p.paper WHERE d.doc_id % 5 <> 0 GROUP BY 1)
 SELECT d.doc_id, coalesce(substring(f.body, 1, 40000), '') AS body, CASE WHEN f.body IS NULL THEN '' ELSE 'html' END AS mode FROM d LEFT JOIN f ON d.doc_id = f.doc_id"""))
def fulltext_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a link to the paper's full text among landed answers. Their bodies are made of the documents' texts."""
    d = documents(spark, sf_dir, paper=_PAPER, link=f"CASE WHEN doc_id % 5 = 0 THEN 'https://doi.org/10.1/x' ELSE concat('https://arxiv.org/abs/', {_PAPER}, 'v1') END", url=_LANDED.format(paper=_PAPER))
    body = F.concat(F.lit("<html><script>no</script><p>"), F.translate("text", "&<>", "   "), F.lit("</p></html>"))
    landed = d.where("url IS NOT NULL").select("url", body.alias("body"))
    files = spark.createDataFrame([], "url string, content binary")
    return records.fetched(d.select("doc_id", "link"), landed, files).select("doc_id", "body", "mode")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'own ' || event_id WHEN cast(ts AS DATE) = DATE '2024-01-02' THEN 'day' ELSE 'default' END AS content FROM events")
def dated_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("today"), both("CASE WHEN event_id % 3 = 0 THEN concat('own ', event_id) END").alias("own"))
    chosen = jsonx.dated_answer(F.col("own"), F.lit("2024-01-02").cast("date"), F.lit("day"), F.col("today"))
    return e.select("event_id", F.when(chosen == jsonx.DEFAULT_ANSWER, "default").otherwise(chosen).alias("content"))


_REPLY = """concat('答案 {"items": [5, {"index": 1, "highlight": "旧"}, {"index": ', cast(event_id % 3 AS STRING), ', "highlight": "亮点', event_type, '"}, {"index": "x", "highlight": "坏"}, {"index": 2.7, "highlight": "', CASE WHEN event_id % 2 = 0 THEN 'english' ELSE '数' END, '"}, null, "文", {"highlight": "无"}, [1], {"index": "3", "one_sentence_summary": " 三 "}, {"index": 4, "highlight": "", "one_sentence_summary": "含摘要信息不足"}]} 完')"""


@query(duck(f"""WITH r AS (SELECT event_id, regexp_extract({_REPLY}, '(?s)\\{{.*\\}}') AS j FROM events), i AS (SELECT event_id, unnest(json_extract(j, '$.items[*]')) AS x, unnest(range(len(json_extract(j, '$.items[*]')))) AS nth FROM r),
 e AS (SELECT event_id, nth, CASE WHEN json_type(x, '$.index') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN cast(trunc(cast(x->>'$.index' AS DOUBLE)) AS INTEGER) WHEN regexp_full_match(x->>'$.index', '\\s*[+-]?[0-9]{{1,9}}\\s*') THEN cast(trim(x->>'$.index') AS INTEGER) END AS index,
  trim(coalesce(nullif(x->>'$.highlight', ''), x->>'$.one_sentence_summary', '')) AS h FROM i WHERE json_type(x) = 'OBJECT')
 SELECT event_id, index, arg_max(h, nth) AS highlight FROM e WHERE index IS NOT NULL AND regexp_matches(h, '[\\x{{4e00}}-\\x{{9fff}}]') AND NOT contains(h, '摘要信息不足') GROUP BY 1, 2"""))
def json_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of an index wins, within the answer itself: nothing is shuffled."""
    return read(spark, sf_dir, "events").select("event_id", F.inline(jsonx.highlight_items(both(_REPLY))))


_ELEMENTS = """concat('x {"研究问题": "', event_type, '", "创新方法": "", "工作流程": " w ", "关键结果": ', CASE WHEN event_id % 3 = 0 THEN '12' ELSE '""' END, ', ', CASE WHEN event_id % 2 = 0 THEN '"应用价值": "", ' ELSE '' END, '"title_zh": "题', cast(event_id AS STRING), '"', CASE WHEN event_id % 5 = 0 THEN '' ELSE '}' END)"""
_KEYS = [f"""j->>'$."{k}"'""" for k in jsonx.ELEMENTS]


@query(duck(f"""WITH r AS (SELECT event_id, try_cast(nullif(regexp_extract({_ELEMENTS}, '(?s)\\{{.*\\}}'), '') AS JSON) AS j FROM events), w AS (SELECT event_id, j, coalesce({' AND '.join(f"({k}) IS NOT NULL" for k in _KEYS)}, false) AS whole FROM r)
 SELECT event_id, whole, CASE WHEN whole THEN coalesce(j->>'$.title_zh', '') END AS title_zh, CASE WHEN whole THEN array_to_string(list_filter([{', '.join(f"CASE WHEN trim({k}) <> '' THEN '{i}. {name}：' || trim({k}) END" for i, (name, k) in enumerate(zip(jsonx.ELEMENTS, _KEYS), 1))}], lambda x: x IS NOT NULL), chr(10)) END AS lines FROM w"""))
def json_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", jsonx.poster_elements(both(_ELEMENTS)).alias("p"))
    return e.select("event_id", F.col("p").isNotNull().alias("whole"), F.col("p.title_zh").alias("title_zh"), F.when(F.col("p").isNotNull(), prompts.poster_lines(F.col("p.elements"))).alias("lines"))


_LENIENT = """concat('```json', chr(10), '{"overview": "总览', event_type, '", "summaries": [{"index": ', cast(event_id AS STRING), '}', chr(10), CASE WHEN event_id % 2 = 0 THEN '{"index": 2,}' ELSE '' END, '],}', chr(10), '```')"""


@query(duck(f"""WITH r AS (SELECT event_id, cast(regexp_extract(regexp_replace(regexp_replace(regexp_replace({_LENIENT}, '(?m)^\\s*```[a-zA-Z]*\\s*$', '', 'g'), '\\}}(\\s*)\\{{', '}},\\1{{', 'g'), ',(\\s*[}}\\]])', '\\1', 'g'), '(?s)\\{{.*\\}}') AS JSON) AS j FROM events)
 SELECT event_id, j->>'$.overview' AS overview, cast(json_array_length(j, '$.summaries') AS INTEGER) AS n, cast(j->>'$.summaries[0].index' AS INTEGER) AS first_index FROM r"""))
def json_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", jsonx.answer(both(_LENIENT)).alias("a"))
    return e.select("event_id", F.col("a.overview").alias("overview"), F.size("a.summaries").alias("n"), F.element_at("a.summaries", 1)["index"].alias("first_index"))


_ODD = " [a,] and {x} {y} ```, }"
_OUTSIDE = r"""regexp_replace(regexp_replace(regexp_replace(t, '(?m)^\s*```[a-zA-Z]*\s*$', '', 'g'), '\}(\s*)\{', '},\1{', 'g'), ',(\s*[}\]])', '\1', 'g')"""


@query(rf"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '{{"overview": ' || to_json(text || '{_ODD}') || ', "summaries": [{{"index": 1, "title_zh": "x"}}]}}'
   ELSE '```json' || chr(10) || '{{"overview": ' || to_json(text || '{_ODD}') || ', "summaries": [{{"index": 1, "title_zh": ' || to_json('"' || source || '\",}}') || ',}}' || chr(10) || ' {{"index": 2,}},],}}' || chr(10) || '```' END AS t FROM documents),
 m AS (SELECT doc_id, CASE WHEN json_valid(t) THEN t ELSE array_to_string(list_transform(regexp_extract_all(t, '(?s)"[^"\\]*(?:\\.[^"\\]*)*"|[^"]+|"'), lambda t: CASE WHEN starts_with(t, '"') THEN t ELSE {_OUTSIDE} END), '') END AS t FROM r)
 SELECT doc_id, j->>'$.overview' AS overview, cast(json_array_length(j, '$.summaries') AS INTEGER) AS n, j->>'$.summaries[0].title_zh' AS title FROM (SELECT doc_id, cast(regexp_extract(t, '(?s)\{{.*\}}') AS JSON) AS j FROM m)""")
def json_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, commas, braces and fences in the strings of sound and of damaged answers: strings come back as they were."""
    d = read(spark, sf_dir, "documents")
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    overview = F.concat(F.lit('{"overview": '), quoted(F.concat("text", F.lit(_ODD))), F.lit(', "summaries": [{"index": 1, "title_zh": '))
    damaged = F.concat(F.lit("```json\n"), overview, quoted(F.concat(F.lit('"'), "source", F.lit('\\",}'))), F.lit(',}\n {"index": 2,},],}\n```'))
    answers = d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(overview, F.lit('"x"}]}'))).otherwise(damaged).alias("t"))
    a = answers.select("doc_id", jsonx.answer(F.col("t")).alias("a"))
    return a.select("doc_id", F.col("a.overview").alias("overview"), F.size("a.summaries").alias("n"), F.get("a.summaries", F.lit(0))["title_zh"].alias("title"))


@query(f"""WITH q AS (SELECT event_id AS id, cast(ts AS DATE) AS day FROM events), own AS (SELECT p_partkey AS id, p_name AS content FROM part UNION ALL SELECT p_partkey, p_type FROM part WHERE p_partkey % 2 = 0),
 daily AS (SELECT cast(ts AS DATE) AS date, event_type AS content FROM events WHERE event_type <> 'view' AND event_id % 7 = 0)
 SELECT q.id AS event_id, coalesce((SELECT min(content) FROM own WHERE own.id = q.id), (SELECT min(content) FROM daily WHERE daily.date = DATE '2024-01-02'), 'none') AS content FROM q""")
def answered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, p = read(spark, sf_dir, "events"), read(spark, sf_dir, "part")
    own = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("content")).unionByName(p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("content")))
    daily = e.where("event_type <> 'view' AND event_id % 7 = 0").select(F.to_date("ts").alias("date"), F.col("event_type").alias("content"))
    return records.answered(e.select(F.col("event_id").alias("id")), own, daily, F.lit("2024-01-02").cast("date"), "none").withColumnRenamed("id", "event_id")


_SUMMARIES = """concat('{', CASE WHEN event_id % 3 = 0 THEN concat('"full_list": [{"title": "', event_type, '"}], ') ELSE '' END, CASE WHEN event_id % 3 < 2 THEN concat('"summaries": [{"title": "b', cast(event_id AS STRING), '"}, {"title": "c"}], ') ELSE '' END, '"overview": "o"}')"""


@query(duck(f"""WITH r AS (SELECT event_id, cast({_SUMMARIES} AS JSON) AS j FROM events), l AS (SELECT event_id, coalesce(j->'$.full_list', j->'$.summaries') AS i FROM r)
 SELECT event_id, cast(coalesce(json_array_length(i), 0) AS INTEGER) AS n, i->>'$[0].title' AS first_title FROM l"""))
def listed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", jsonx.listed_items(both(_SUMMARIES)).alias("i"))
    return e.select("event_id", F.size("i").alias("n"), F.get("i", F.lit(0))["title"].alias("first_title"))


@query("SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS answer FROM documents")
def landed_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.concat(F.lit(" \n"), "text", F.lit("\n"))
    return read(spark, sf_dir, "documents").select("doc_id", prompts.landed_answer(F.col("text"), answer).alias("answer"))


# --- quality (A4, A5, J7) --------------------------------------------------------------------------------------------------

_QUALITY = """SELECT d.source, CASE WHEN l.quality = 1 THEN 'x' ELSE '' END AS title_zh, d.lang AS abstract_zh, coalesce(nullif(d.lang, 'fr'), '') AS summary,
 CASE WHEN l.toxic = 1 THEN NULL ELSE 'm' END AS method_point, 'r' AS related_work, 'i' AS implication FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
_REPORT = """SELECT source, count(*) AS total, count(*) FILTER (WHERE coalesce(title_zh, '') <> '') AS title_zh, count(*) FILTER (WHERE coalesce(abstract_zh, '') <> '') AS abstract_zh,
 count(*) FILTER (WHERE coalesce(summary, '') <> '') AS summary, count(*) FILTER (WHERE method_point IS NOT NULL) AS relation FROM q GROUP BY 1"""


def _quality_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, l = read(spark, sf_dir, "documents").select("doc_id", "source", "lang"), read(spark, sf_dir, "labels")
    j = d.join(l, "doc_id", "left")
    return j.select("source", F.when(F.col("quality") == 1, "x").otherwise("").alias("title_zh"), F.col("lang").alias("abstract_zh"), F.when(F.col("lang") == "fr", "").otherwise(F.col("lang")).alias("summary"),
                    F.when(F.coalesce(F.col("toxic"), F.lit(0)) != 1, "m").alias("method_point"), F.lit("r").alias("related_work"), F.lit("i").alias("implication"))


@query(f"WITH q AS ({_QUALITY}) {_REPORT}")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_quality_items(spark, sf_dir), "source")


@query(f"""WITH q AS ({_QUALITY}), r AS ({_REPORT}), s AS (SELECT DISTINCT source, 'o' AS overview FROM documents UNION ALL SELECT 'none', 'o' UNION ALL SELECT 'nothing', '')
 SELECT s.source, CASE WHEN r.total IS NULL THEN s.overview <> '' ELSE r.total = r.title_zh AND r.total = r.abstract_zh AND r.total = r.summary AND r.total = r.relation END AS ok FROM s LEFT JOIN r ON s.source = r.source""")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _quality_items(spark, sf_dir)
    more = spark.createDataFrame([("none", "o"), ("nothing", "")], "source string, overview string")
    summaries = items.select("source").distinct().withColumn("overview", F.lit("o")).unionByName(more).withColumn("trends", F.lit("t"))
    return quality.quality_gate(summaries, quality.quality_report(items, "source"), "source")


# --- days and weeks (A9, W1-W4, U2, U3, L3, N4, D3, D4) -----------------------------------------------------------------------


@query("SELECT cast(ts AS DATE) AS day, count(*) AS total FROM events GROUP BY 1")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("total"))


@query("""WITH d AS (SELECT DISTINCT cast(ts AS DATE) AS day FROM events)
 SELECT day, cast(day AS VARCHAR) AS label, lag(day) OVER w AS previous_key, lag(cast(day AS VARCHAR)) OVER w AS previous_label, lead(day) OVER w AS next_key, lead(cast(day AS VARCHAR)) OVER w AS next_label FROM d WINDOW w AS (ORDER BY day)""")
def day_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    return calendar.neighbours(days, "day", F.col("day").cast("string"))


@query("""WITH d AS (SELECT DISTINCT cast(date_trunc('week', ts) AS DATE) AS week FROM events), l AS (SELECT week, week || ' → ' || cast(week + INTERVAL 6 DAY AS DATE) AS label FROM d)
 SELECT week, label, lag(week) OVER w AS previous_key, lag(label) OVER w AS previous_label, lead(week) OVER w AS next_key, lead(label) OVER w AS next_label FROM l WINDOW w AS (ORDER BY week)""")
def week_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = read(spark, sf_dir, "events").select(calendar.week_start(F.col("ts")).alias("week")).distinct()
    return calendar.neighbours(weeks, "week", calendar.week_label(F.col("week")))


@query("SELECT cast(date_trunc('week', ts) AS DATE) AS week_start, cast(date_trunc('week', ts) + INTERVAL 6 DAY AS DATE) AS week_end, event_type, count(*) AS n FROM events GROUP BY ALL")
def week_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = calendar.week_start(F.col("ts"))
    return read(spark, sf_dir, "events").groupBy(start.alias("week_start"), F.date_add(start, 6).alias("week_end"), "event_type").agg(F.count("*").alias("n"))


@query("SELECT doc_id, source, 'paper-' || row_number() OVER (PARTITION BY source ORDER BY doc_id) AS anchor FROM documents")
def paper_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.anchors(read(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")


@query("""WITH f AS (SELECT doc_id, contains(lower(text), 'idiot') OR lang = 'de' AS is_ferro, n_chars > 1000 AS is_ai FROM documents)
 SELECT doc_id, CASE WHEN is_ferro AND is_ai THEN 'both' WHEN is_ferro THEN 'is_ferro' ELSE 'is_ai' END AS section FROM f WHERE is_ferro OR is_ai""")
def weekly_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", (F.lower("text").contains("idiot") | (F.col("lang") == "de")).alias("is_ferro"), (F.col("n_chars") > 1000).alias("is_ai"))
    return calendar.partition_by_flags(d, "is_ferro", "is_ai").select("doc_id", "section")


@query("""WITH f AS (SELECT doc_id, lang = 'de' AS a, n_chars > 1000 AS b FROM documents) SELECT doc_id, 0 AS part FROM f WHERE a AND b UNION ALL SELECT doc_id, 1 FROM f WHERE a AND NOT b UNION ALL SELECT doc_id, 2 FROM f WHERE b AND NOT a""")
def weekly_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", (F.col("lang") == "de").alias("a"), (F.col("n_chars") > 1000).alias("b"))
    a, b = F.col("a"), F.col("b")
    return calendar.all_sections(d.where(a & b), d.where(a & ~b), d.where(b & ~a)).select("doc_id", "part")


@query("SELECT cast(date_trunc('week', ts) AS DATE) AS week, cast(date_trunc('week', ts) AS DATE) || '.html' AS file, count(*) AS total, max(ts) AS latest FROM events GROUP BY 1, 2")
def weekly_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = calendar.week_start(F.col("ts"))
    return read(spark, sf_dir, "events").groupBy(week.alias("week")).agg(F.count("*").alias("total"), F.max("ts").alias("latest")).withColumn("file", F.concat(F.col("week").cast("string"), F.lit(".html")))


@query("""SELECT week, event_id, value, rank FROM (SELECT cast(date_trunc('week', ts) AS DATE) AS week, event_id, value, cast(row_number() OVER (PARTITION BY date_trunc('week', ts) ORDER BY value DESC, event_id) AS INTEGER) AS rank FROM events) WHERE rank <= 8""")
def weekly_top8(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(calendar.week_start(F.col("ts")).alias("week"), "event_id", "value")
    return calendar.top_of_each(e, "week", 8, F.desc("value"), "event_id")


@query("SELECT event_id, try_cast(d AS DATE) AS day, nullif(try_cast(d AS DATE), DATE '1900-01-01') AS real_day FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '1900-01-01' WHEN 1 THEN 'soon' WHEN 2 THEN '' ELSE '2026-03-27' END AS d FROM events)")
def article_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", both("CASE event_id % 4 WHEN 0 THEN '1900-01-01' WHEN 1 THEN 'soon' WHEN 2 THEN '' ELSE '2026-03-27' END").alias("d"))
    return e.select("event_id", F.expr("try_cast(d AS date)").alias("day"), F.nullif(F.expr("try_cast(d AS date)"), F.lit("1900-01-01").cast("date")).alias("real_day"))


@query("""WITH m AS (SELECT cast(ts AS DATE) AS day, count(*) AS total FROM events GROUP BY 1), p AS (SELECT DISTINCT cast(ts AS DATE) AS day, cast(ts AS DATE) || '.html' AS file FROM events WHERE event_type = 'error' AND day(ts) % 3 <> 0)
 SELECT m.day, total, file FROM m JOIN p ON m.day = p.day""")
def manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the manifest that have a page file."""
    e = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    files = e.where((F.col("event_type") == "error") & (F.dayofmonth("day") % 3 != 0)).select("day").distinct().withColumn("file", F.concat(F.col("day").cast("string"), F.lit(".html")))
    return e.groupBy("day").agg(F.count("*").alias("total")).join(files, "day")


# --- pages (K5, K6, T6) ------------------------------------------------------------------------------------------------------------


def _pages_sql(key: str, label: str, words: dict[str, str]) -> str:
    """The pages of days or weeks. The query enhances them twice: a second run changes nothing."""
    nav = lambda place: f"""'{pages.BEGIN}<nav class="{words["name"]}-enhancement-{place}-nav">' || coalesce('<a href="' || pk || '.html">{words["previous"]} · ' || pl || '</a>', '') || coalesce('<a href="' || nk || '.html">{words["next"]} · ' || nl || '</a>', '') || '<a href="{pages.FEED}">{words["feed"]}</a></nav>'"""
    return f"""WITH e AS (SELECT cast({key} AS DATE) AS page, event_id, event_type, value FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY value DESC, event_id) AS nth FROM e), t AS (SELECT * FROM r WHERE nth <= 4),
 l AS (SELECT page, string_agg('<article id="paper-' || nth || '" data-section="' || event_type || '"><h3><a href="https://x.org/?a=1&amp;b=' || event_id || '">&lt;' || event_id || '&gt;</a></h3><p>arXiv · A, B &amp; C</p><p></p></article>', '' ORDER BY nth) AS body,
  string_agg('<a class="{words["outline"]} {words["title"]}" href="#paper-' || nth || '">{pages.PLACE} ' || nth || '</a>', '' ORDER BY nth) AS entries FROM t GROUP BY 1),
 k AS (SELECT *, {label} AS label FROM l), n AS (SELECT *, lag(page) OVER w AS pk, lag(label) OVER w AS pl, lead(page) OVER w AS nk, lead(label) OVER w AS nl FROM k WINDOW w AS (ORDER BY page))
 SELECT page, '<html><body>' || {nav("top")} || '<aside class="{words["toc"]}"><h2>{pages.CONTENTS}</h2><p>{pages.SECTION}</p>' || entries || '</aside>{pages.END}' || '<h1>' || page || '</h1><section><p>o &quot;q&quot;</p><p></p></section><main id="papers">' || body || '</main>' || {nav("bottom")} || '{pages.END}</body></html>' AS html FROM n"""


def _pages(spark: SparkSession, sf_dir: str, key: Column, label: Column, words: dict[str, str]) -> DataFrame:
    top = calendar.top_of_each(read(spark, sf_dir, "events").select(key.alias("page"), "event_id", "event_type", "value"), "page", 4, F.desc("value"), "event_id")
    number = F.col("event_id").cast("string")
    items = top.select("page", F.col("rank").alias("ordinal"), F.lit("").alias("title_zh"), F.concat(F.lit("<"), number, F.lit(">")).alias("title_en"), F.lit(None).cast("string").alias("summary"), F.concat(F.lit("https://x.org/?a=1&b="), number).alias("link"), F.lit("arXiv").alias("journal"), F.array(F.lit("A"), F.lit("B & C")).alias("authors"), F.col("event_type").alias("section"))
    made = pages.pages(items.select("page").distinct().select("page", F.lit('o "q"').alias("overview"), F.lit("").alias("trends")), items, "page")
    return pages.enhanced(pages.enhanced(made, "page", label, words), "page", label, words)


@query(_pages_sql("ts", "cast(page AS VARCHAR)", pages.DAILY))
def daily_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, F.to_date("ts"), F.col("page").cast("string"), pages.DAILY)


@query(_pages_sql("date_trunc('week', ts)", "page || ' → ' || cast(page + INTERVAL 6 DAY AS DATE)", pages.WEEKLY))
def weekly_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, calendar.week_start(F.col("ts")), calendar.week_label(F.col("page")), pages.WEEKLY)


# --- feeds (K3, K4, A10, F15) ----------------------------------------------------------------------------------------------------


@query("""SELECT event_id, title, category, day FROM (SELECT event_id, 'event ' || event_id AS title, '📚 ' || event_type AS category, cast(ts AS DATE) AS day, row_number() OVER (PARTITION BY cast(ts AS DATE) ORDER BY ts DESC, event_id) AS nth FROM events) WHERE nth <= 5""")
def feed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    articles = e.select("event_id", "ts", F.lit("").alias("title_zh"), F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("title"), F.lit("").alias("link"), F.array(F.lit("A")).alias("authors"), F.lit("").alias("summary"), F.lit("").alias("abstract"), F.col("event_type").alias("journal"), F.to_date("ts").alias("pub_date"))
    top = calendar.top_of_each(articles, "pub_date", 5, F.desc("ts"), "event_id")
    rows = feeds.feed_rows(top.withColumn("link", F.col("event_id").cast("string")))
    return rows.select(F.col("link").cast("long").alias("event_id"), "title", "category", F.col("pub_date").alias("day"))


def _feed_sql() -> str:
    escaped = lambda c: f"replace(replace(replace({c}, '&', '&amp;'), '>', '&gt;'), '<', '&lt;')"
    field = lambda tag, c: f"'<{tag}>' || {escaped(c)} || '</{tag}>'"
    item = " || ".join([field("title", "source || ' <' || lang || '>'"), field("link", "'https://e.org/?a&b=' || doc_id"), "'<author>A, B</author>'", field("category", "'📚 ' || lang"), field("pubDate", "CAST(day AS VARCHAR)"), field("description", "text")])
    return f"""WITH d AS (SELECT *, DATE '2026-01-01' + cast(doc_id % 90 AS INTEGER) AS day FROM documents)
 SELECT day || '.xml' AS name, '<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>' || day || ' {feeds.DAILY_TITLE}</title><link>https://s/daily/' || day || '.html</link><docs>https://s/daily/' || day || '.xml</docs>' || string_agg('<item>' || {item} || '</item>', '' ORDER BY doc_id) || '</channel></rss>' AS content FROM d GROUP BY day"""


@query(_feed_sql())
def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's whole feed, as the file that is written."""
    d = read(spark, sf_dir, "documents").withColumn("day", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 90).cast("int")))
    articles = d.select("day", "doc_id", F.lit("").alias("title_zh"), F.concat("source", F.lit(" <"), "lang", F.lit(">")).alias("title"), F.concat(F.lit("https://e.org/?a&b="), F.col("doc_id").cast("string")).alias("link"), F.array(F.lit("A"), F.lit("B")).alias("authors"), F.col("text").alias("summary"), F.lit("").alias("abstract"), F.col("lang").alias("journal"), F.col("day").cast("string").alias("pub_date"))
    return feeds.feed_files(feeds.feed_rows(articles, "day", "doc_id"), "https://s", "day", "doc_id")


@query("SELECT count(*) AS feeds, count(*) FILTER (WHERE event_type = 'error') AS broken FROM events")
def feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.feed_health(read(spark, sf_dir, "events").select(F.col("event_id").alias("url"), F.when(F.col("event_type") == "error", "failed").otherwise("").alias("problem")))


# --- the breaker (W5, T1, T2, F10) ------------------------------------------------------------------------------------------------------

_STREAK = """WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' OR value > 50 THEN 1 ELSE 0 END AS f FROM events), g AS (SELECT *, sum(1 - f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e),
 s AS (SELECT user_id, event_id, ts, cast(sum(f) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS BIGINT) AS streak FROM g)"""


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.coalesce((F.col("event_type") == "error") | (F.col("value") > 50), F.lit(False)).alias("failed"))


@query(f"{_STREAK} SELECT user_id, event_id, streak FROM s")
def failure_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker.failure_streaks(_calls(spark, sf_dir), "user_id", F.col("failed"), "ts", "event_id").select("user_id", "event_id", "streak")


@query(f"{_STREAK} SELECT user_id, event_id, coalesce(max(streak) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < 2, true) AS sent FROM s")
def breaker_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker.without_cooldown(_calls(spark, sf_dir), "user_id", F.col("failed"), "ts", "event_id").select("user_id", "event_id", "sent")


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS sec, coalesce(event_type = 'error' OR value > 50, false) AS failed, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
 b AS (SELECT user_id, event_id, n, true AS sent, cast(failed AS INTEGER) AS streak, cast(NULL AS DOUBLE) AS opened FROM e WHERE n = 1
  UNION ALL SELECT user_id, event_id, n, NOT waits AS sent, CASE WHEN waits THEN streak WHEN failed THEN streak + 1 ELSE 0 END, CASE WHEN waits THEN opened WHEN failed AND (opened IS NOT NULL OR streak + 1 >= 2) THEN sec END
   FROM (SELECT e.*, b.streak, b.opened, b.opened IS NOT NULL AND e.sec - b.opened < 3600 AS waits FROM b JOIN e ON e.user_id = b.user_id AND e.n = b.n + 1))
 SELECT user_id, event_id, sent, opened IS NOT NULL AS open FROM b""")
def breaker_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker.with_cooldown(_calls(spark, sf_dir), "user_id", "ts", "failed", "event_id", cooldown=3600.0)


@query("SELECT event_id, coalesce(CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END, true) AS keep FROM events")
def relevance_fail_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = both("CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END")
    return read(spark, sf_dir, "events").select("event_id", enrich.relevant(judged).alias("keep"))


# --- prompts (X10-X16, K1) ----------------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, '标题 ' || source || ' 作者 ' || lang || ' 年 2026 未知 $unknown 正文 ' || CASE WHEN length(text) > 40000 THEN substring(text, 1, 40000) || '\n\n[内容过长已截断]' ELSE text END || ' 摘要 $abstract' AS prompt FROM documents")
def prompt_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = prompts.deep_prompt(TEMPLATE, F.col("source"), F.col("lang"), F.lit("2026"), F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"))


@query("SELECT doc_id, '标题 ' || source || ' 作者 ' || lang || ' 年 $year 未知 $unknown 正文 $context 摘要 ' || substring(text, 1, 6000) AS prompt FROM documents")
def prompt_abstract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", prompts.abstract_prompt(TEMPLATE, F.col("source"), F.col("lang"), F.col("text")).alias("prompt"))


@query("SELECT doc_id, " + " || ".join(["'" + prompts.WEEKLY.split("$title")[0] + "'", "lang", "'" + prompts.WEEKLY.split("$title")[1].split("$journal")[0] + "'", "source", "'" + prompts.WEEKLY.split("$journal")[1].split("$abstract")[0] + "'", "substring(text, 1, 500)", "'" + prompts.WEEKLY.split("$abstract")[1] + "'"]) + " AS prompt FROM documents")
def prompt_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", prompts.weekly_prompt(F.col("lang"), F.col("source"), F.col("text")).alias("prompt"))


@query("""SELECT source, '高亮 [' || string_agg('{"index": ' || i || ', "title": ' || cast(to_json(CASE WHEN i % 2 = 0 THEN lang || ' "t"' ELSE source END) AS VARCHAR) || ', "abstract": ' || cast(to_json(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS VARCHAR) || '}', ', ' ORDER BY i) || '] $x' AS prompt FROM (SELECT source, lang, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents) WHERE i <= 20 GROUP BY 1""")
def prompt_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch prompt takes a source's first 20 items: a bounded list."""
    top = calendar.top_of_each(read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"), "source", 20, "doc_id")
    item = F.struct("rank", F.when(F.col("rank") % 2 == 0, F.concat("lang", F.lit(' "t" '))).otherwise("").alias("title"), F.col("source").alias("title_en"), F.col("text").alias("abstract"))
    return top.groupBy("source").agg(prompts.batch_prompt("高亮 ${items} $x", F.array_sort(F.collect_list(item))).alias("prompt"))


@query("SELECT doc_id, '语言 中文 标题 ' || source || ' 正文 ' || substring(text, 1, 40000) AS prompt FROM documents")
def prompt_poster(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = prompts.poster_prompt("语言 $language 标题 $title 正文 $context", F.col("source"), F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"))


_POSTER = """concat('{"研究问题": "', source, '", "创新方法": "m", "工作流程": "", "关键结果": "r", ', CASE WHEN doc_id % 3 = 0 THEN '' ELSE '"应用价值": "v", ' END, '"title_zh": "题"}')"""


@query(duck(f"""WITH d AS (SELECT doc_id, source, cast({_POSTER} AS JSON) AS j FROM documents WHERE length(text) > 0)
 SELECT cast(doc_id AS VARCHAR) AS doc_id, '题' AS title_zh, j->>'$."研究问题"' AS question, CASE WHEN doc_id % 2 = 0 THEN 'images/posters/' || doc_id || '.webp' END AS image FROM d WHERE (j->>'$."应用价值"') IS NOT NULL"""))
def poster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From papers and landed answers to the posters' rows; every other picture was made."""
    d = documents(spark, sf_dir, answer=_POSTER).withColumn("title", F.col("source")).withColumn("paper_id", F.lit(""))
    asked = posters.element_requests(d, "t $title c $context", F.col("text"))
    found = posters.extracted(asked.drop("answer"), d.select("doc_id", "answer"), "doc_id")
    saved = posters.image_requests(found, "p ${summaryForImage}").where("doc_id % 2 = 0").select("path")
    out = posters.posters(found, saved)
    return out.select("doc_id", "title_zh", F.col("elements")["研究问题"].alias("question"), "image")


@query("SELECT doc_id, '图 1. 研究问题：' || source || chr(10) || '5. 应用价值：v 题 ' || lang AS prompt FROM documents")
def prompt_infographic(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = F.create_map(F.lit("研究问题"), "source", F.lit("创新方法"), F.lit(" "), F.lit("应用价值"), F.lit(" v"))
    prompt = prompts.infographic_prompt("图 ${summaryForImage} 题 $title", elements, F.col("lang"))
    return read(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"))


@query("SELECT '1772582400000-' || doc_id AS id, prompt, 1772582400.0::DOUBLE AS timestamp FROM (" + ORACLE_SQL["prompt_weekly"] + ")")
def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as they are written, at a fixed time and numbered by document."""
    asked = read(spark, sf_dir, "documents").select("doc_id", prompts.weekly_prompt(F.col("lang"), F.col("source"), F.col("text")).alias("prompt"))
    return sinks.request_rows(asked, F.lit("2026-03-04 00:00:00").cast("timestamp"), F.col("doc_id"))
