"""What is written: requests as JSON, articles as Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.text import text_or_empty


def request_rows(prompts: DataFrame, at: Column, number: Column | None = None) -> DataFrame:
    """id (milliseconds and a row's own number, so that none collide), prompt and timestamp (seconds); without a number rows get one."""
    own = (F.monotonically_increasing_id() if number is None else number).cast("string")
    return prompts.select(F.concat(F.unix_millis(at).cast("string"), F.lit("-"), own).alias("id"), "prompt", (F.unix_micros(at) / 1e6).alias("timestamp"))


def write_requests(prompts: DataFrame, path: str, at: Column) -> None:
    request_rows(prompts, at).write.mode("append").json(path)


def article_markdown() -> Column:
    """An article row as its file's text."""
    c = lambda name: text_or_empty(F.col(name))
    line = lambda key: F.concat(F.lit(f'{key}: "'), c(key if key != "authors" else "authors_raw"), F.lit('"\n'))
    return F.concat(
        F.lit("---\nid: "), c("id"), F.lit("\n"), line("title"), line("title_zh"), F.lit("date: "), c("date"), F.lit("\n"), line("journal"), line("authors"), line("link"),
        F.when(F.col("doi").isNotNull(), line("doi")).otherwise(""), F.lit("---\n\n# "), c("title"), F.lit("\n\n## 中文标题\n"), c("title_zh"), F.lit("\n\n## 基本信息\n- **期刊**: "), c("journal"),
        F.lit("\n- **作者**: "), c("authors_raw"), F.lit("\n- **发表日期**: "), c("date"), F.lit("\n- **DOI**: "), c("doi"), F.lit("\n- **原文链接**: ["), c("link"), F.lit("]("), c("link"),
        F.lit(")\n\n## Abstract\n"), c("abstract"), F.lit("\n\n## 摘要（中文）\n"), c("abstract_zh"), F.lit("\n"),
    )


def write_articles(articles: DataFrame, path: str) -> None:
    """One text file a partition would hold many articles, so each row's text goes below its own date and id."""
    articles.select(article_markdown().alias("value"), F.col("date").cast("string").alias("day"), F.col("id").alias("article")).write.partitionBy("day", "article").mode("append").text(path, lineSep="\n")
