"""Daily and weekly pages as rows: one page of HTML for each day or week, built and enhanced in plans, written by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.text import first_of, text_or_empty
from strataloom.operators.calendar import neighbours
from strataloom.sources.named_files import write_named

# The words and class names of the pages.
DAILY = {"name": "daily", "previous": "前一天", "next": "后一天", "feed": "当日RSS", "outline": "daily-outline-link", "toc": "daily-toc-card", "title": "daily-title-link"}
WEEKLY = {"name": "weekly", "previous": "前一周", "next": "后一周", "feed": "站点RSS", "outline": "weekly-outline-scroll", "toc": "weekly-report-sidebar", "title": "weekly-permalink-link"}
CONTENTS, PLACE, SECTION, FEED = "单页目录", "页内定位", "所在专题", "../feed.xml"
#: What enhance() puts in stands between these marks, so that a second run replaces the first one's.
BEGIN, END = "<!--enhanced-->", "<!--/enhanced-->"


def escaped(c: Column) -> Column:
    """Text as HTML has it."""
    c = text_or_empty(c)
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def pages(summaries: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """key and html of each summary (key, overview, trends) with its items (key, ordinal, title_zh, title_en, summary, link, journal, authors, section).

    A page holds its items in order, each with an anchor. A day or week has a bounded number of them; all items are shuffled once, by page.
    """
    title = escaped(first_of(F.col("title_zh"), F.col("title_en")))
    body = F.concat(
        F.lit('<article id="paper-'), F.col("ordinal").cast("string"), F.lit('" data-section="'), escaped(F.col("section")), F.lit('"><h3><a href="'), escaped(F.col("link")), F.lit('">'), title, F.lit("</a></h3><p>"),
        escaped(F.col("journal")), F.lit(" · "), escaped(F.array_join("authors", ", ")), F.lit("</p><p>"), escaped(F.col("summary")), F.lit("</p></article>"),
    )
    listed = items.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", body.alias("body")))), lambda x: x["body"]), "").alias("body"))
    html = F.concat(F.lit("<html><body><h1>"), F.col(key).cast("string"), F.lit("</h1><section><p>"), escaped(F.col("overview")), F.lit("</p><p>"), escaped(F.col("trends")), F.lit('</p></section><main id="papers">'), text_or_empty(F.col("body")), F.lit("</main></body></html>"))
    return summaries.join(listed, key, "left").select(key, html.alias("html"))


def enhanced(pages: DataFrame, key: str, label: Column, words: dict[str, str]) -> DataFrame:
    """key and html with links to the neighbouring pages above and below, the feed, and an outline of the papers.

    What an earlier run put in is replaced, so running it again changes nothing.
    """
    near = neighbours(pages.select(key), key, label)
    bare = F.regexp_replace("html", f"(?s){BEGIN}.*?{END}", "")
    link = lambda side: F.when(F.col(f"{side}_key").isNotNull(), F.concat(F.lit('<a href="'), F.col(f"{side}_key").cast("string"), F.lit(f'.html">{words[side]} · '), F.col(f"{side}_label"), F.lit("</a>"))).otherwise("")
    nav = lambda place: F.concat(F.lit(f'{BEGIN}<nav class="{words["name"]}-enhancement-{place}-nav">'), link("previous"), link("next"), F.lit(f'<a href="{FEED}">{words["feed"]}</a></nav>'))
    papers = F.regexp_extract_all("bare", F.lit(r'<article id="paper-(\d+)"'), 1)
    entries = F.array_join(F.transform(papers, lambda n: F.concat(F.lit(f'<a class="{words["outline"]} {words["title"]}" href="#paper-'), n, F.lit(f'">{PLACE} '), n, F.lit("</a>"))), "")
    outline = F.concat(F.lit(f'<aside class="{words["toc"]}"><h2>{CONTENTS}</h2><p>{SECTION}</p>'), entries, F.lit(f"</aside>{END}"))
    whole = F.replace(F.replace(F.col("bare"), F.lit("<body>"), F.concat(F.lit("<body>"), nav("top"), outline)), F.lit("</body>"), F.concat(nav("bottom"), F.lit(END), F.lit("</body>")))
    return pages.withColumn("bare", bare).join(near, key).select(key, whole.alias("html"))


def page_files(pages: DataFrame, key: str) -> DataFrame:
    """name and content of each page: a day's or week's page is `<date>.html`."""
    return pages.select(F.concat(F.col(key).cast("string"), F.lit(".html")).alias("name"), F.col("html").alias("content"))


def write_pages(pages: DataFrame, path: str, key: str) -> None:
    """Each page as its own file; pages that are written again replace themselves and no others."""
    write_named(page_files(pages, key), path)
