"""Days, weeks and their neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions.ranges import range_of


def week_start(c: Column) -> Column:
    """The Monday of a date's week."""
    return F.date_trunc("week", c).cast("date")


def neighbours(pages: DataFrame, key: str, label: Column) -> DataFrame:
    """Each page's previous and next key and label; null at either end.

    pages has one row for each day or week, so the window without partitions is bounded by the calendar.
    """
    w = Window.orderBy(key)
    named = pages.withColumn("label", label)
    return named.select(key, "label", *[f(c).over(w).alias(f"{side}_{c if c == 'label' else 'key'}") for side, f in (("previous", F.lag), ("next", F.lead)) for c in (key, "label")])


def week_label(start: Column) -> Column:
    return F.concat(start.cast("string"), F.lit(" → "), F.date_add(start, 6).cast("string"))


def ordinals(items: DataFrame, group: str, order: str, name: str = "ordinal") -> DataFrame:
    """Adds each row's number (from 1) in its group, by a numeric column without ties.

    A group may hold most rows, so it isn't numbered in one task: rows are numbered within ranges of the order column, and
    the counts of the ranges before, one for each group and range, are added. Range bounds: one for each shuffle partition.
    """
    n = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(items.select(F.percentile_approx(order, [i / n for i in range(1, n)] or [0.5], 10000).alias("q")).first()["q"] or []))
    ranged = items.withColumn("_range", range_of(F.col(order), cuts))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    base = counts.select(F.col(group).alias("_group"), F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(group, "_range").orderBy(order))
    joined = ranged.withColumn("_own", own).join(base, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return joined.withColumn(name, F.col("_own") + F.col("_before")).drop("_own", "_before", "_range", "_of", "_group")


def anchors(items: DataFrame, group: str, order: str) -> DataFrame:
    """Ordinal anchors paper-1, paper-2, … within each group."""
    return ordinals(items, group, order, "_nth").withColumn("anchor", F.concat(F.lit("paper-"), F.col("_nth").cast("string"))).drop("_nth")


def top_of_each(items: DataFrame, group: Column | str, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of each group, with their rank: Spark keeps n rows a group in each task before it shuffles."""
    return items.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)


def partition_by_flags(items: DataFrame, a: str, b: str) -> DataFrame:
    """All items in disjoint sections `both`, `a` only and `b` only, in a column `section`; rows with neither flag go."""
    section = F.when(F.col(a) & F.col(b), "both").when(F.col(a), a).when(F.col(b), b)
    return items.withColumn("section", section).where(F.col("section").isNotNull())


def all_sections(*sections: DataFrame) -> DataFrame:
    """Disjoint sections under one another, with the number of each row's section in `part`."""
    out = sections[0].withColumn("part", F.lit(0))
    for i, section in enumerate(sections[1:], 1):
        out = out.unionByName(section.withColumn("part", F.lit(i)))
    return out
