"""Joins, deduplication and the full-text ladder over article records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions.html import exact_html_to_text
from strataloom.functions.links import arxiv_id, normalize_link
from strataloom.functions.pdf import pdf_text

LEAST_CHARS, MOST_CHARS = 4000, 40000
# Where an arXiv paper's full text is, in the order of trying.
HTML, AR5IV, PDF = "https://arxiv.org/html/", "https://ar5iv.org/abs/", "https://arxiv.org/pdf/"


def dedupe_by(df: DataFrame, key: Column | str, *order: Column | str) -> DataFrame:
    """The first row, by order, of each key. A filter on the rank lets each task drop what cannot be first before the shuffle."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_nth = 1").drop("_nth")


def join_on_links(left: DataFrame, right: DataFrame, left_link: str, right_link: str) -> DataFrame:
    """Inner join where both links, normalized, are equal and not empty."""
    a = left.withColumn("link_norm", normalize_link(F.col(left_link))).where("link_norm <> ''")
    b = right.withColumn("link_norm", normalize_link(F.col(right_link))).where("link_norm <> ''")
    return a.join(b, "link_norm")


def allowed(df: DataFrame, key: str, names: DataFrame) -> DataFrame:
    return df.join(names, key, "left_semi")


def excluded(df: DataFrame, key: str, names: DataFrame) -> DataFrame:
    return df.join(names, key, "left_anti")


def installed(assets: DataFrame, cached: DataFrame, current: list[str]) -> DataFrame:
    """After an install and activation (cache, url): the current caches' entries, and the assets in the first of them."""
    kept = cached.where(F.col("cache").isin(current)).select("cache", "url")
    return kept.union(assets.select(F.lit(current[0]).alias("cache"), "url")).distinct()


def full_text(candidates: list[tuple[Column, str]], least: int = LEAST_CHARS, most: int = MOST_CHARS) -> Column:
    """text and mode of the first candidate body of `least` characters or more, cut to `most`; empty where there is none."""
    out = F.struct(F.lit("").alias("text"), F.lit("").alias("mode"))
    for body, mode in reversed(candidates):
        out = F.when(F.length(F.coalesce(body, F.lit(""))) >= least, F.struct(F.substring(body, 1, most).alias("text"), F.lit(mode).alias("mode"))).otherwise(out)
    return out


def fetched(items: DataFrame, pages: DataFrame, files: DataFrame, link: str = "link", *, least: int = LEAST_CHARS, most: int = MOST_CHARS) -> DataFrame:
    """Adds body and mode: the full text of the arXiv paper that an item's link names, from landed answers.

    pages (url, body) and files (url, content) are what sources.landed reads, each answer read once. HTML comes first, then its mirror, then
    the PDF; a text of less than `least` characters doesn't count, and of several answers of one place the greatest text does. So an item
    returns once, however many items and answers a paper has. Links of other places have empty texts.
    """
    paper = arxiv_id(F.col(link))

    def told(of: DataFrame, text: Column, *places: tuple[str, int, str]) -> DataFrame:
        """_paper and _found of each answer: its place's turn (the greatest comes first), its text and mode; null where the text is short. The greatest of cut texts is the greatest, cut."""
        at = F.coalesce(*[F.when(F.col("url").startswith(place), F.struct(F.lit(turn).alias("turn"), F.expr(f"substring(url, {len(place) + 1})").alias("paper"), F.lit(mode).alias("mode"))) for place, turn, mode in places])
        texts = of.withColumn("_at", at).where("_at IS NOT NULL").select("_at", text.alias("_text"))
        cut = F.struct(F.col("_at.turn").alias("turn"), F.substring("_text", 1, most).alias("text"), F.col("_at.mode").alias("mode"))
        return texts.select(F.col("_at.paper").alias("_paper"), F.when(F.length("_text") >= least, cut).alias("_found"))

    answers = told(pages, exact_html_to_text(F.col("body")), (HTML, 3, "html"), (AR5IV, 2, "html")).union(told(files, pdf_text(F.col("content")), (PDF, 1, "pdf")))
    best = answers.groupBy("_paper").agg(F.max("_found").alias("_found"))
    named = items.where(paper != "").withColumn("_paper", paper).join(best, "_paper", "left")
    said = named.withColumn("body", F.coalesce("_found.text", F.lit(""))).withColumn("mode", F.coalesce("_found.mode", F.lit(""))).drop("_paper", "_found")
    # Apart, as items without a paper would all be joined in one task.
    return said.union(items.where(paper == "").withColumn("body", F.lit("")).withColumn("mode", F.lit("")))


def answered(requests: DataFrame, responses: DataFrame, daily: DataFrame, today: Column, default: str) -> DataFrame:
    """Each request's content: its own response by id, else the day's by date, else the default.

    Of several responses with an id, and of several of a day, the least content counts, so a request returns once.
    """
    own = responses.groupBy("id").agg(F.min("content").alias("own"))
    day = daily.where(F.col("date") == today).agg(F.min("content").alias("day"))  # one row
    return requests.join(own, "id", "left").join(F.broadcast(day), how="left", on=F.lit(True)).withColumn("content", F.coalesce("own", "day", F.lit(default))).drop("own", "day")
