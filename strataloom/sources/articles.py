"""Article files: Markdown with front matter and fixed sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions.authors import split_names
from strataloom.functions.text import compacted

KEYS = ["id", "title", "title_zh", "date", "journal", "authors", "link", "doi"]
NO_DATE = "1900-01-01"


#: The columns of articles as they are read.
ARTICLE = "file_name string, id string, title string, title_zh string, date date, journal string, authors_raw string, link string, doi string, abstract string, abstract_zh string, authors array<string>, real_date date"


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file: front matter, both abstracts, the names of the authors, and the file's name."""
    return parsed_articles(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file_name")))


def parsed_articles(raw: DataFrame) -> DataFrame:
    """Articles of whole files (file_name, value), from a table or a stream.

    A value runs to the quote before the next key, so it may hold lines and quotes. The date is null where it isn't one.
    """
    head = F.regexp_extract("value", r"(?s)\A---\n(.*?)\n---\n", 1)

    def value(key: str):
        if key in ("id", "date"):
            return F.regexp_extract(head, rf"(?m)^{key}: (.*)$", 1)
        return F.regexp_extract(head, rf'(?s)(?:\A|\n){key}: "(.*?)"(?=\n[a-z_]+: |\z)', 1)

    section = lambda name, end: F.trim(F.regexp_replace(F.regexp_extract("value", rf"(?s)\n## {name}\n(.*?){end}", 1), r"^\s+|\s+$", ""))
    out = raw.select("file_name", *[value(k).alias(k) for k in KEYS], section("Abstract", r"\n## 摘要（中文）").alias("abstract"), section("摘要（中文）", r"\z").alias("abstract_zh"))
    date = F.expr("try_cast(date AS date)")
    return out.withColumnsRenamed({"authors": "authors_raw"}).withColumn("authors", split_names(compacted(F.col("authors_raw")))).withColumn("date", date).withColumn("real_date", F.nullif("date", F.lit(NO_DATE).cast("date")))
