"""Article files as a stream: each run reads what is new, and a table by id keeps the articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataloom.operators.records import dedupe_by
from strataloom.sources.articles import parsed_articles
from strataloom.sources.keyed import KeyedTable


def scan_new_articles(spark: SparkSession, files: str, articles: KeyedTable, checkpoint: str) -> int:
    """Takes the article files that no earlier run has read, and returns how many articles came.

    The checkpoint knows the files; the table knows the ids, of which the first file by name counts within a run, and an earlier
    run's article stays. A batch that is taken again after a failure changes nothing, as its ids are there.
    """
    came = 0

    def take(batch: DataFrame, _: int) -> None:
        nonlocal came
        rows = dedupe_by(parsed_articles(batch), "id", "file_name")
        new = rows.join(articles.read().select("id"), "id", "left_anti")
        came += articles.upsert(new.select(*articles.schema.names))

    stream = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.md").load(files).selectExpr("value", "_metadata.file_name AS file_name")
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return came
