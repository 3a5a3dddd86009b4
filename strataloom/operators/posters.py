"""Concept posters: what is asked of the model, what its answers hold, and the poster's row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.jsonx import poster_elements
from strataloom.functions.links import without_docs
from strataloom.functions.prompts import infographic_prompt, poster_prompt
from strataloom.functions.text import first_of

# Fixed value: where posters are kept.
FOLDER = "docs/images/posters"


def element_requests(papers: DataFrame, template: str, text: Column, language: str = "中文") -> DataFrame:
    """The papers that have a text, with the `prompt` that asks for their elements."""
    return papers.where(F.coalesce(text != "", F.lit(False))).withColumn("prompt", poster_prompt(template, F.col("title"), text, language))


def extracted(papers: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Each paper with `poster`: elements, elements_en and title_zh of its answer (key, answer), null where there is none or it isn't whole."""
    return papers.join(answers.select(key, F.col("answer").alias("_answer")), key, "left").withColumn("poster", poster_elements(F.col("_answer"))).drop("_answer")


def doc_id() -> Column:
    return F.coalesce(F.nullif(F.col("doc_id").cast("string"), F.lit("")), F.nullif(F.col("paper_id").cast("string"), F.lit("")), F.lit("unknown"))


def image_requests(papers: DataFrame, template: str, folder: str = FOLDER) -> DataFrame:
    """For each paper with a poster the prompt of its picture and the path where that goes; other papers have none."""
    some = papers.where(F.col("poster").isNotNull())
    return some.withColumn("prompt", infographic_prompt(template, F.col("poster.elements"), F.col("title"))).withColumn("path", F.concat(F.lit(f"{folder}/"), doc_id(), F.lit(".webp")))


def posters(papers: DataFrame, saved: DataFrame) -> DataFrame:
    """doc_id, title_zh, elements, elements_en and image of each paper with a poster; saved has the path of each picture that was made."""
    asked = image_requests(papers, "")
    made = saved.select(F.col("path"), F.col("path").alias("_made")).distinct()
    return asked.join(made, "path", "left").select(doc_id().alias("doc_id"), F.col("poster.title_zh").alias("title_zh"), F.col("poster.elements").alias("elements"), F.col("poster.elements_en").alias("elements_en"), without_docs(first_of(F.col("_made"))).alias("image"))
