"""The quality report and gate over groups of summary items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ["title_zh", "abstract_zh", "summary"]
RELATION = ["method_point", "related_work", "implication"]


def _there(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)) != "", F.lit(False))


def quality_report(items: DataFrame, group: str) -> DataFrame:
    """For each group the number of items, of those with each field, and of those with all relation fields."""
    relation = _there(RELATION[0]) & _there(RELATION[1]) & _there(RELATION[2])
    return items.groupBy(group).agg(F.count("*").alias("total"), *[F.count_if(_there(c)).alias(c) for c in FIELDS], F.count_if(relation).alias("relation"))


def quality_gate(summaries: DataFrame, report: DataFrame, group: str) -> DataFrame:
    """Whether each summary (group, overview, trends) passes: every count is the total, both texts there; without items, the overview."""
    both = summaries.join(report, group, "left")
    total = F.coalesce(F.col("total"), F.lit(0))
    whole = F.lit(True)
    for c in [*FIELDS, "relation"]:
        whole = whole & (F.coalesce(F.col(c), F.lit(0)) == total)
    return both.select(group, F.when(total == 0, _there("overview")).otherwise(whole & _there("overview") & _there("trends")).alias("ok"))
