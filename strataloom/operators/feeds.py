"""Feed rows, feed health and chart counts."""

from __future__ import annotations

from collections.abc import Iterable
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.text import first_of
from strataloom.operators.enrich import first_match
from strataloom.sources.named_files import write_named

# Titles of the feeds and charts.
SITE_TITLE, DAILY_TITLE, NO_DATA = "文献追踪系统", "AI × Science 文献日报 RSS", "暂无数据"
ARXIV, JOURNAL = "arXiv", "期刊"
TOPIC_CHART, SOURCE_CHART, PRIORITY_CHART = "研究方向分布", "来源分布", "优先分组"
# The groups of a daily report, with sample words of each, and the group of the rest.
PRIORITY = {"神经网络势·电子结构": ["neural network potential", "electronic structure"], "AI × 物理/材料/化学": ["machine learning", "deep learning", "neural network"]}
REST = "其他物理/材料"


def feed_rows(articles: DataFrame, *also: str) -> DataFrame:
    """title, link, author, description, category and date of each article, the Chinese texts first, and other columns as asked."""
    return articles.select(
        *also,
        first_of(F.col("title_zh"), F.col("title")).alias("title"), F.coalesce("link", F.lit("")).alias("link"), F.array_join("authors", ", ").alias("author"),
        first_of(F.col("summary"), F.col("abstract")).alias("description"), F.concat(F.lit("📚 "), F.col("journal")).alias("category"), F.col("pub_date"),
    )


def feed_xml(title: str, page: str, own: str, rows: Iterable[dict]) -> str:
    """One feed as XML. A feed has few items: the driver or a task writes it from its rows."""
    items = "".join(
        f"<item><title>{escape(r['title'])}</title><link>{escape(r['link'])}</link><author>{escape(r['author'])}</author>"
        f"<category>{escape(r['category'])}</category><pubDate>{escape(str(r['pub_date']))}</pubDate><description>{escape(r['description'])}</description></item>"
        for r in rows
    )
    return f'<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>{escape(title)}</title><link>{escape(page)}</link><docs>{escape(own)}</docs>{items}</channel></rss>'


def daily_feed_xml(site: str, date: str, rows: Iterable[dict]) -> str:
    return feed_xml(f"{date} {DAILY_TITLE}", f"{site}/daily/{date}.html", f"{site}/daily/{date}.xml", rows)


def site_feed_xml(site: str, rows: Iterable[dict]) -> str:
    """The whole site's feed."""
    return feed_xml(SITE_TITLE, site, f"{site}/feed.xml", rows)


def xml_escaped(c: Column) -> Column:
    c = F.coalesce(c.cast("string"), F.lit(""))
    for sign, name in (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def feed_files(rows: DataFrame, site: str, key: str, order: str) -> DataFrame:
    """name and content of each day's feed, `<date>.xml`, from feed_rows() with the day and the items' order: daily_feed_xml() as a plan.

    A day has a bounded number of items, which meet by day; days that have none have no feed.
    """
    field = lambda tag, c: F.concat(F.lit(f"<{tag}>"), xml_escaped(F.col(c)), F.lit(f"</{tag}>"))
    item = F.concat(F.lit("<item>"), field("title", "title"), field("link", "link"), field("author", "author"), field("category", "category"), field("pubDate", "pub_date"), field("description", "description"), F.lit("</item>"))
    listed = rows.groupBy(F.col(key).cast("string").alias("day")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, item.alias("item")))), lambda x: x["item"]), "").alias("items"))
    at = lambda end: F.concat(F.lit(f"{site}/daily/"), F.col("day"), F.lit(end))
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>'), F.col("day"), F.lit(f" {escape(DAILY_TITLE)}</title><link>"), xml_escaped(at(".html")), F.lit("</link><docs>"), xml_escaped(at(".xml")), F.lit("</docs>"))
    return listed.select(F.concat("day", F.lit(".xml")).alias("name"), F.concat(head, "items", F.lit("</channel></rss>")).alias("content"))


def write_feeds(rows: DataFrame, path: str, site: str, key: str, order: str) -> None:
    """Each day's feed as its own file; other days' feeds stay."""
    write_named(feed_files(rows, site, key, order), path)


def source_kind(source: Column, arxiv: Column | None = None) -> Column:
    return F.when(arxiv if arxiv is not None else F.lower(source).contains("arxiv"), ARXIV).otherwise(JOURNAL)


def counts(items: DataFrame, kind: Column) -> DataFrame:
    return items.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def topic_counts(items: DataFrame) -> DataFrame:
    """How many items each category has: the taxonomy's, else the topic's."""
    return counts(items, F.coalesce(F.nullif("classify_taxonomy", F.lit("")), F.nullif("topic_bucket", F.lit("")), F.lit("其他")))


def priority_counts(items: DataFrame, rules: dict[str, list[str]] = PRIORITY, rest: str = REST) -> DataFrame:
    """How many items each group of the daily report has, by the words of the title."""
    return counts(items, first_match(F.lower("title"), rules, rest))


def charts(items: DataFrame) -> dict[str, str]:
    """The three charts of a day's items (title, journal, classify_taxonomy, topic_bucket), by name: each is drawn from a few counts."""
    drawn = lambda title, df: bars_svg(title, sorted(((r["kind"], r["n"]) for r in df.collect()), key=lambda x: (-x[1], x[0])))
    return {"topics": drawn(TOPIC_CHART, topic_counts(items)), "sources": drawn(SOURCE_CHART, counts(items, source_kind(F.col("journal")))), "priority": drawn(PRIORITY_CHART, priority_counts(items))}


def feed_health(health: DataFrame) -> DataFrame:
    """How many feeds there are and how many have a problem."""
    broken = F.coalesce(F.col("problem") != "", F.lit(False))
    return health.agg(F.count("*").alias("feeds"), F.count_if(broken).alias("broken"))


def bars_svg(title: str, rows: Iterable[tuple[str, int]]) -> str:
    """Counts as an accessible bar chart."""
    rows = list(rows)
    top = max([n for _, n in rows], default=1) or 1
    height = 24 * max(1, len(rows)) + 16
    body = "".join(
        f'<text x="4" y="{24 * i + 28}">{escape(k)}</text><rect x="220" y="{24 * i + 16}" width="{300 * n // top}" height="14"/><text x="530" y="{24 * i + 28}">{n}</text>'
        for i, (k, n) in enumerate(rows)
    ) or f'<text x="4" y="28">{NO_DATA}</text>'
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 600 {height}" role="img" aria-label="{escape(title)}"><title>{escape(title)}</title>{body}</svg>'
