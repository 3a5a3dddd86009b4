"""Landed files that stand in for what a pipeline asks of the network: manifests, answers, bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "summaries array<struct<date:string,file:string,total:int>>"
RESPONSE = "id string, date string, content string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """date, file and total of each entry of daily manifests."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True).select(F.explode("summaries").alias("s")).select("s.*")


def read_template(spark: SparkSession, path: str) -> str:
    """A prompt's template: one small file, read to the driver."""
    return spark.read.text(path, wholetext=True).first()["value"]


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE).json(path, multiLine=True)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """url and body of landed text answers (JSON rows of url, status, body): those of status 200 that aren't empty, one for a url."""
    rows = spark.read.schema("url string, status int, body string").json(path)
    return rows.where("status = 200 AND body <> ''").groupBy("url").agg(F.min("body").alias("body"))


def read_bodies(spark: SparkSession, path: str, index: str) -> DataFrame:
    """url and content of landed binary answers: files below `path`, with an index (JSON rows of url, status, file) that names them."""
    rows = spark.read.schema("url string, status int, file string").json(index).where("status = 200").groupBy("url").agg(F.min("file").alias("file"))
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return rows.join(files, "file").select("url", "content")


RSS = "title string, link string, description string, author string, category string, pubDate string"
ATOM = "title string, link struct<_href:string>, summary string, author struct<name:string>, updated string"


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """title, link, summary, author, pub_date and file of the items of landed RSS and the entries of landed Atom files."""
    file = F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
    rss = spark.read.option("rowTag", "item").schema(RSS).xml(path).select("title", "link", F.col("description").alias("summary"), "author", F.col("pubDate").alias("pub_date"), file)
    atom = spark.read.option("rowTag", "entry").schema(ATOM).xml(path).select("title", F.col("link._href").alias("link"), "summary", F.col("author.name").alias("author"), F.col("updated").alias("pub_date"), file)
    return rss.unionByName(atom)


def feed_problems(spark: SparkSession, path: str) -> DataFrame:
    """url (the file's name) and problem of each landed feed: empty where it has items."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("url"))
    kind = F.col("value").rlike(r"<(?:rss|feed|rdf:RDF|RDF)[\s>]")
    problem = F.when(F.trim("value") == "", "empty").when(~kind, "not a feed").when(~F.col("value").rlike(r"<(?:item|entry)[\s>]"), "no items").otherwise("")
    return raw.select("url", problem.alias("problem"))
