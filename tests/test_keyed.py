"""The table by key, enrichment as an upsert, and the incremental article scan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataloom.operators import enrich, records
from strataloom.sources import articles
from strataloom.sources.keyed import KeyedTable
from strataloom.streaming.articles import scan_new_articles


def folders(table):
    return table._folders(table.version())


def test_only_changed_buckets_are_written(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id", "id long, text string, tags array<string>", buckets=8)
    rows = lambda pairs: spark.createDataFrame([(i, t, None if t is None else [t]) for i, t in pairs], "id long, text string, tags array<string>")
    read = lambda version=None: {r["id"]: r["text"] for r in table.read(version).collect()}
    assert read() == {} and table.upsert(rows([])) == 0 and table.version() == 0
    assert table.upsert(rows([(i, f"t{i}") for i in range(40)])) == 40 and len(read()) == 40
    first = folders(table)
    assert table.upsert(rows([(i, f"t{i}") for i in range(40)])) == 0 and folders(table) == first and table.version() == 1
    assert table.upsert(rows([(7, "new"), (7, "aaa"), (8, "t8"), (99, None)])) == 2
    assert read() == {i: f"t{i}" for i in range(40)} | {7: "new", 99: None} and read(1)[7] == "t7"
    second = folders(table)
    assert 1 <= sum(second[b] != first.get(b) for b in second) <= 2
    assert table.upsert(rows([(99, None)])) == 0
    with pytest.raises(ValueError, match="without id"):
        table.upsert(rows([(None, "x")]))
    with pytest.raises(Exception, match="exist"):  # another writer was first
        table._snapshot(2, {})
    table.forget(keep=1)
    assert len(read()) == 41 and not (tmp_path / "t/_snapshots/1").exists()


def test_enrichment_is_an_upsert(spark, tmp_path):
    """A run counts what it fills; the next one finds nothing to fill, writes nothing and counts 0."""
    schema = "id long, g string, abstract string, abstract_zh string, one_sentence_summary string"
    table = KeyedTable(spark, str(tmp_path / "t"), "id", schema, buckets=4)
    table.upsert(spark.createDataFrame([(1, "g", "a", "", "done"), (2, "g", "b", "", None), (3, "g", "c", "", "摘要信息不足"), (4, "h", "d", "有", None)], schema))
    generated = spark.createDataFrame([("g", 1, "生成一"), ("g", 2, "生成二"), ("h", 1, "生成三")], "g string, index int, highlight string")

    def run() -> int:
        items = table.read().withColumn("translated", F.lit(None).cast("string"))
        done = enrich.fill_highlights(items, generated, "g", "id", 60).where("filled IS NOT NULL")
        return table.upsert(done.withColumn("one_sentence_summary", F.col("filled")))

    assert run() == 2 and table.version() == 2
    assert {r["id"]: r["one_sentence_summary"] for r in table.read().collect()} == {1: "done", 2: "生成一", 3: "生成二", 4: None}
    assert run() == 0 and table.version() == 2


def test_articles_come_once(spark, tmp_path):
    write = lambda name, id_, title: (tmp_path / "in" / name).write_text(f'---\nid: {id_}\ntitle: "{title}"\ndate: 2026-01-01\n---\n\n## Abstract\nWe.\n', encoding="utf-8")
    (tmp_path / "in").mkdir()
    table = KeyedTable(spark, str(tmp_path / "t"), "id", articles.ARTICLE, buckets=4)
    scan = lambda: scan_new_articles(spark, str(tmp_path / "in"), table, str(tmp_path / "c"))
    write("b.md", "x", "second of x")
    write("a.md", "x", "first of x")
    write("c.md", "y", "y")
    assert scan() == 2
    batch = records.dedupe_by(articles.read_articles(spark, str(tmp_path / "in")), "id", "file_name")
    assert sorted(map(str, table.read().select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
    assert scan() == 0 and table.version() == 1
    write("d.md", "z", "z")
    write("0.md", "y", "y again")
    assert scan() == 1 and {r["id"]: r["title"] for r in table.read().collect()} == {"x": "first of x", "y": "y", "z": "z"}
