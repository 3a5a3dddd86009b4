"""The breaker, articles, feeds and quality gate on small inputs."""

from __future__ import annotations

import json
import random
import xml.dom.minidom

import duckdb
import pytest
from pyspark.sql import functions as F

from strataloom.operators import breaker, calendar, enrich, feeds, pages, posters, quality, records
from strataloom.plans import catalogue
from strataloom.sources import articles, landed, named_files, sinks


def sent(outcomes, cooldown, step=1.0):
    return [s for s, _ in breaker.fold(((i * step, not ok) for i, ok in enumerate(outcomes)), breaker.Breaker(cooldown=cooldown))]


def test_breaker_trips_and_recovers():
    assert sent([False] * 22, 3600) == [True, True] + [False] * 20
    assert sent([False, True, False, True], 3600) == [True] * 4
    assert sent([False, False, True, True], 0) == [True] * 4
    assert sent([False, False, False, True], 3) == [True, True, False, False]


def test_breaker_queries_agree_with_a_fold(spark):
    rows = [(u, i, (i * 7 + u) % 3 != 0) for u in range(5) for i in range(40)]
    df = spark.createDataFrame(rows, "u int, i int, failed boolean").withColumn("ts", F.timestamp_seconds(F.col("i") * 10))
    got = {(r["u"], r["i"]): r["sent"] for r in breaker.with_cooldown(df, "u", "ts", "failed", "i", cooldown=25).collect()}
    plain = {(r["u"], r["i"]): r["sent"] for r in breaker.without_cooldown(df, "u", F.col("failed"), "i").collect()}
    for u in range(5):
        own = [f for v, _, f in rows if v == u]
        assert [got[u, i] for i in range(40)] == [s for s, _ in breaker.fold(((i * 10.0, f) for i, f in enumerate(own)), breaker.Breaker(cooldown=25))]
        assert [plain[u, i] for i in range(40)] == [s for s, _ in breaker.fold(((float(i), f) for i, f in enumerate(own)), breaker.Breaker(cooldown=1e9))]


def test_streaks_over_ranges(spark):
    """Whatever the number of ranges, streaks are those of a plain count; one provider has nearly all calls, one none that succeeds."""
    rng = random.Random(5)
    rows = [("hot", i, rng.random() < 0.8) for i in range(300)] + [("down", i * 7, True) for i in range(40)] + [("up", 3, False), (None, 5, True), (None, 6, True)]
    df = spark.createDataFrame(rows, "p string, i int, failed boolean")
    want, trip = {}, {}
    for p in {r[0] for r in rows}:
        streak, out = 0, True
        for _, i, f in sorted((r for r in rows if r[0] == p), key=lambda r: r[1]):
            streak = streak + 1 if f else 0
            want[p, i], trip[p, i] = streak, out
            out = out and streak < 3
    for n in (1, 2, 7, 64):
        got = breaker.without_cooldown(df, "p", F.col("failed"), "i", limit=3, ranges=n).collect()
        assert {(r["p"], r["i"]): r["streak"] for r in got} == want and {(r["p"], r["i"]): r["sent"] for r in got} == trip and len(got) == len(rows)
    assert breaker.failure_streaks(df.limit(0), "p", F.col("failed"), "i").count() == 0


def test_one_provider_of_all_calls_is_many_tasks(spark):
    """The largest task that sorts calls has few more than a range's share of them."""
    df = spark.range(40_000).select(F.lit("one").alias("p"), F.col("id").alias("i"), (F.col("id") % 9 != 0).alias("failed"))
    ranges = df.withColumn("r", breaker.time_ranges(df, "i", 16)).groupBy("p", "r").count()
    assert ranges.count() == 16 and ranges.agg(F.max("count")).first()[0] < 3_500
    assert breaker.failure_streaks(df, "p", F.col("failed"), "i", ranges=16).where("streak <> i % 9").count() == 0


def test_articles_round_trip(spark, tmp_path):
    text = '---\nid: abc\ntitle: "A \\"quoted\\" title"\ntitle_zh: ""\ndate: 1900-01-01\njournal: "J"\nauthors: "One,\nTwo"\nlink: ""\ndoi: ""\n---\n\n# A\n\n## 中文标题\n\n\n## 基本信息\n- x\n\n## Abstract\nWe.\n\n## 摘要（中文）\n我们。\n'
    (tmp_path / "1900-01-01_abc.md").write_text(text, encoding="utf-8")
    row = articles.read_articles(spark, str(tmp_path)).first()
    assert (row["id"], row["title"], row["authors"], row["abstract"], row["abstract_zh"], row["real_date"]) == ("abc", 'A \\"quoted\\" title', ["One", "Two"], "We.", "我们。", None)
    sinks.write_articles(articles.read_articles(spark, str(tmp_path)), str(tmp_path / "out"))
    again = articles.read_articles(spark, str(tmp_path / "out/*/*")).first()
    assert [again[c] for c in ("id", "title", "authors", "abstract", "abstract_zh", "date")] == [row[c] for c in ("id", "title", "authors", "abstract", "abstract_zh", "date")]


def test_landed_files(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"summaries": [{"date": "2026-03-27", "file": "a", "total": 2}]}')
    assert landed.read_manifest(spark, str(tmp_path / "m.json")).first()["total"] == 2
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>t</title><link>l</link></item></channel></rss>")
    (tmp_path / "feeds").mkdir()
    (tmp_path / "feeds/f.xml").write_text("<rss><channel><item><title>t</title><link>l</link></item></channel></rss>")
    (tmp_path / "feeds/a.xml").write_text('<feed><entry><title>u</title><link href="m"/><summary>s</summary><author><name>N</name></author><updated>2026-01-01</updated></entry></feed>')
    assert {(r["title"], r["link"], r["file"]) for r in landed.read_feeds(spark, str(tmp_path / "feeds")).collect()} == {("t", "l", "f.xml"), ("u", "m", "a.xml")}
    (tmp_path / "feeds/none.xml").write_text("<rss><channel></channel></rss>")
    (tmp_path / "feeds/page.xml").write_text("<html>503</html>")
    problems = landed.feed_problems(spark, str(tmp_path / "feeds"))
    assert {r["url"]: r["problem"] for r in problems.collect()} == {"f.xml": "", "a.xml": "", "none.xml": "no items", "page.xml": "not a feed"}
    assert tuple(feeds.feed_health(problems).first()) == (4, 2)
    sinks.write_requests(spark.createDataFrame([("p",), ("q",)], "prompt string"), str(tmp_path / "r"), F.current_timestamp())
    assert spark.read.json(str(tmp_path / "r")).select("id").distinct().count() == 2


def test_feeds_and_charts(spark):
    schema = "title_zh string, title string, link string, journal string, authors array<string>, summary string, abstract string, pub_date string"
    df = spark.createDataFrame([("测试", "T", "https://e.com/?a&b", "arXiv", ["Alice", "Bob"], "一段", None, "2026-03-27")], schema)
    out = feeds.daily_feed_xml("https://s", "2026-03-27", [r.asDict() for r in feeds.feed_rows(df).collect()])
    xml.dom.minidom.parseString(out)
    assert all(x in out for x in ("Alice, Bob", "https://s/daily/2026-03-27.xml", "https://s/daily/2026-03-27.html", "2026-03-27 AI × Science 文献日报 RSS", "📚 arXiv"))
    chart = feeds.bars_svg("t", [("arXiv", 1), ("期刊", 2)])
    assert chart.startswith("<svg") and ">1<" in chart and ">2<" in chart and "暂无数据" in feeds.bars_svg("t", [])


def test_quality_gate(spark):
    items = "source string, title_zh string, abstract_zh string, summary string, method_point string, related_work string, implication string"
    rows = [("ok", "a", "a", "a", "a", "a", "a"), ("bad", "a", "a", "", "a", "a", "a"), ("thin", "a", "a", "a", "", "a", "a"), ("flat", "a", "a", "a", "a", "a", "a")]
    report = quality.quality_report(spark.createDataFrame(rows, items), "source")
    s = spark.createDataFrame([("ok", "o", "t"), ("bad", "o", "t"), ("thin", "o", "t"), ("flat", "o", ""), ("none", "o", None), ("empty", "", "t")], "source string, overview string, trends string")
    assert {r[0]: r[1] for r in quality.quality_gate(s, report, "source").collect()} == {"ok": True, "bad": False, "thin": False, "flat": False, "none": True, "empty": False}


def test_fill_highlights(spark):
    items = "g string, o int, one_sentence_summary string, abstract_zh string, abstract string, translated string"
    rows = [("g", 1, "done", "", "a", None), ("g", 2, "摘要信息不足", "", "a", "译"), ("g", 3, None, "", "a", "a"), ("g", 4, None, "有", "a", "译"), ("g", 5, "", "", "a", "译"), ("g", 6, "", "", "a", "译")]
    generated = spark.createDataFrame([("g", 1, "生成"), ("g", 2, "plain")], "g string, index int, highlight string")
    got = {r["o"]: r["filled"] for r in enrich.fill_highlights(spark.createDataFrame(rows, items), generated, "g", "o", 3).collect()}
    assert got == {1: None, 2: "生成", 3: None, 4: None, 5: "译", 6: None}


def test_full_texts_from_landed_answers(spark, tmp_path):
    """The first place with enough text counts; a failed or short answer is passed over."""
    page = lambda url, status, n: {"url": url, "status": status, "body": f"<p>{'x' * n}</p><script>no</script>"}
    rows = [page("https://arxiv.org/html/2601.00001", 200, 60), page("https://arxiv.org/html/2601.00002", 200, 5), page("https://ar5iv.org/abs/2601.00002", 200, 70), page("https://arxiv.org/html/2601.00003", 404, 90), page("https://arxiv.org/html/2601.00001", 200, 60)]
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, [*rows, {"url": "https://arxiv.org/html/2601.00004", "status": 200, "body": ""}])))
    (tmp_path / "files").mkdir()
    (tmp_path / "files/a.pdf").write_bytes(b"%PDF")
    (tmp_path / "index.json").write_text(json.dumps({"url": "https://arxiv.org/pdf/2601.00003", "status": 200, "file": "a.pdf"}))
    landed_pages, files = landed.read_pages(spark, str(tmp_path / "pages.json")), landed.read_bodies(spark, str(tmp_path / "files"), str(tmp_path / "index.json"))
    assert landed_pages.count() == 3 and [bytes(r["content"]) for r in files.collect()] == [b"%PDF"]
    items = spark.createDataFrame([(1, "https://arxiv.org/abs/2601.00001v2"), (2, "arXiv:2601.00002"), (3, "2601.00003"), (4, "https://doi.org/10.1/2601.00001"), (5, None)], "id int, link string")
    got = {r["id"]: (len(r["body"]), r["mode"]) for r in records.fetched(items, landed_pages, files, least=50, most=55).collect()}
    assert got == {1: (55, "html"), 2: (55, "html"), 3: (0, ""), 4: (0, ""), 5: (0, "")}


def test_full_texts_of_papers_with_several_items_and_answers(spark):
    """An item returns once: of a place's answers that are long enough the greatest text counts, and an earlier place's before a later one's."""
    at = "https://{}/2601.0000{}".format
    pages = [(at("arxiv.org/html", 1), "<p>" + "a" * 60), (at("arxiv.org/html", 1), "<p>" + "b" * 50 + "<i>c</i>"), (at("arxiv.org/html", 1), "z"), (at("arxiv.org/html", 1), None), (at("ar5iv.org/abs", 1), "y" * 60), (at("ar5iv.org/abs", 2), "d" * 60), (at("ar5iv.org/abs", 2), "e" * 55), (None, "f" * 60), ("https://x.org/1", "g" * 60)]
    pages = spark.createDataFrame([(url, body and f"{body}</p>") for url, body in pages], "url string, body string")
    files = spark.createDataFrame([(at("arxiv.org/pdf", 2), b"%PDF"), (at("arxiv.org/pdf", 3), b"%PDF"), (at("arxiv.org/pdf", 3), b"%PDF")], "url string, content binary")
    items = [(i, f"https://arxiv.org/abs/2601.0000{i % 4}v1") for i in range(12)] + [(12, None), (13, "https://doi.org/10.1/2601.00001")]
    got = sorted(tuple(r) for r in records.fetched(spark.createDataFrame(items, "id int, link string"), pages, files, least=50, most=51).collect())
    assert got == [(i, link, *{1: ("b" * 50 + " ", "html"), 2: ("e" * 51, "html")}.get(i % 4 if i < 12 else 0, ("", ""))) for i, link in items]


def test_full_texts_are_moved_once(spark):
    """However often a paper is named: texts meet by paper before items join them, and no join's rows are dealt again."""
    pages = spark.range(400).select(F.concat(F.lit("https://arxiv.org/html/2601.0000"), F.col("id") % 2).alias("url"), F.concat(F.lit("<p>"), F.repeat(F.lit("x"), 4000)).alias("body"))
    items = spark.range(400).select("id", F.concat(F.lit("2601.0000"), F.col("id") % 2).alias("link"))
    got = records.fetched(items, pages, spark.createDataFrame([], "url string, content binary"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.index("Join ") < plan.index("Aggregate ") and got.count() == 400


def test_full_texts_equal_the_sql_where_papers_repeat(spark, tmp_path):
    """fulltext_fetch on ids from 80,000 on, whose papers are those of smaller ids."""
    con, name = duckdb.connect(), "fulltext_fetch"
    con.execute(f"copy (select doc_id + 80000 * n as doc_id, chr(cast(97 + n as int)) || repeat(text, 3) as text, lang, source, n_chars from '/root/testdata/sf0.001/documents.parquet', range(6) t(n)) to '{tmp_path}/documents.parquet'")
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    got = sorted(tuple(r) for r in catalogue.QUERIES[name](spark, str(tmp_path)).collect())
    wanted = con.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in wanted.description]
    assert len(got) == 1200 and got == sorted(tuple(r[names.index(c)] for c in ("doc_id", "body", "mode")) for r in wanted.fetchall())


def test_answers_of_several_responses(spark):
    requests = spark.createDataFrame([("a",), ("b",)], "id string")
    own = spark.createDataFrame([("a", "2"), ("a", "1")], "id string, content string")
    daily = spark.createDataFrame([("2026-01-02", "y"), ("2026-01-02", "x"), ("2026-01-01", "old")], "date string, content string")
    answered = lambda day: sorted((r["id"], r["content"]) for r in records.answered(requests, own, daily, F.lit(day), "none").collect())
    assert answered("2026-01-02") == [("a", "1"), ("b", "x")] and answered("2026-01-03") == [("a", "1"), ("b", "none")]


def test_classify_requests(spark):
    rows = [("Spintronic order", "", "a"), ("Other", "s" * 700, "a"), ("Third", "", "b" * 5), ("In the abstract", "", "an Altermagnet")]
    got = {r["title"]: r["prompt"] for r in enrich.classify_requests(spark.createDataFrame(rows, "title string, summary string, abstract string")).collect()}
    assert set(got) == {"Other", "Third"} and got["Other"].endswith("摘要：" + "s" * 600) and "、".join([*enrich.TAXONOMY, "其他"]) in got["Third"] and got["Third"].endswith("标题：Third\n摘要：bbbbb")


def test_posters(spark):
    whole = '{"研究问题": "q", "创新方法": "", "工作流程": "w", "关键结果": "r", "应用价值": "v", "title_zh": "题", "elements_en": {"method": "m"}}'
    papers = spark.createDataFrame([("d1", "T1", "text"), ("d2", "T2", "text"), ("d3", "T3", ""), (None, "T4", "text")], "doc_id string, title string, text string").withColumn("paper_id", F.lit(None).cast("string"))
    asked = posters.element_requests(papers, "$title|$context", F.col("text"))
    assert {r["prompt"] for r in asked.collect()} == {"T1|text", "T2|text", "T4|text"}
    answers = spark.createDataFrame([("d1", f"x {whole} y"), ("d2", '{"研究问题": 1}'), ("d3", whole)], "doc_id string, answer string")
    found = posters.extracted(asked, answers, "doc_id")
    images = posters.image_requests(found, "p ${summaryForImage} $title").collect()
    assert [(r["path"], r["prompt"]) for r in images] == [("docs/images/posters/d1.webp", "p 1. 研究问题：q\n3. 工作流程：w\n4. 关键结果：r\n5. 应用价值：v T1")]
    saved = spark.createDataFrame([("docs/images/posters/d1.webp",)], "path string")
    row = posters.posters(found, saved).first()
    assert (row["doc_id"], row["title_zh"], row["image"], row["elements_en"]["method"]) == ("d1", "题", "images/posters/d1.webp", "m")
    assert posters.posters(found, saved.limit(0)).first()["image"] is None


def test_pages_are_enhanced_again(spark, tmp_path):
    schema = "page date, ordinal int, title_zh string, title_en string, summary string, link string, journal string, authors array<string>, section string"
    days = ["2026-04-01", "2026-04-02", "2026-04-03"]
    items = spark.createDataFrame([(d, i, "", f"T{i} <b>", "s", "https://e.org/?a&b", "arXiv", ["A"], "x") for d in days for i in (1, 2)], schema.replace("date", "string", 1)).withColumn("page", F.to_date("page"))
    summaries = items.select("page").distinct().select("page", F.lit("o").alias("overview"), F.lit("t").alias("trends"))
    once = pages.enhanced(pages.pages(summaries, items, "page"), "page", F.col("page").cast("string"), pages.DAILY)
    pages.write_pages(once, str(tmp_path), "page")
    (tmp_path / "index.html").write_text("other")
    read = lambda: spark.createDataFrame([(f.stem, f.read_text(encoding="utf-8")) for f in tmp_path.iterdir() if f.stem != "index"], "page string, html string")
    assert sorted(f.name for f in tmp_path.iterdir()) == [*(f"{d}.html" for d in days), "index.html"]
    first = {str(r["page"]): r["html"].rstrip("\n") for r in read().collect()}
    middle = first["2026-04-02"]
    assert all(x in middle for x in ("daily-enhancement-top-nav", "daily-enhancement-bottom-nav", "前一天 · 2026-04-01", "后一天 · 2026-04-03", "当日RSS", "../feed.xml", 'href="#paper-2"', "单页目录", "T1 &lt;b&gt;", "?a&amp;b"))
    assert "前一天" not in first["2026-04-01"] and "后一天" not in first["2026-04-03"]
    again = pages.enhanced(spark.createDataFrame(sorted(first.items()), "page string, html string").withColumn("page", F.to_date("page")), "page", F.col("page").cast("string"), pages.DAILY)
    pages.write_pages(again.where("page > '2026-04-01'"), str(tmp_path), "page")  # replaces two pages, leaves the others
    assert {str(r["page"]): r["html"].rstrip("\n") for r in read().collect()} == first and (tmp_path / "index.html").read_text() == "other"


def test_weekly_pages(spark):
    weeks = spark.createDataFrame([("2026-04-06",), ("2026-04-13",)], "w string").select(F.to_date("w").alias("page"), F.lit("<html><body><main></main></body></html>").alias("html"))
    got = {str(r["page"]): r["html"] for r in pages.enhanced(weeks, "page", calendar.week_label(F.col("page")), pages.WEEKLY).collect()}
    assert "后一周 · 2026-04-13 → 2026-04-19" in got["2026-04-06"] and "前一周 · 2026-04-06 → 2026-04-12" in got["2026-04-13"] and "站点RSS" in got["2026-04-13"]


def test_three_charts(spark):
    schema = "title string, journal string, classify_taxonomy string, topic_bucket string"
    rows = [("A neural network potential", "arXiv", "AI×物理", None), ("Domain walls", "PRB", None, "physics"), ("Deep learning of phases", "Nature", "", "physics")]
    got = feeds.charts(spark.createDataFrame(rows, schema))
    assert all(s.startswith("<svg") and "<title>" in s and "aria-label=" in s and s.endswith("</svg>") for s in got.values())
    assert ">physics<" in got["topics"] and "AI×物理" in got["topics"] and ">2<" in got["sources"] and "期刊" in got["sources"] and got["priority"].count(">1<") == 3
    assert all("暂无数据" in s for s in feeds.charts(spark.createDataFrame([], schema)).values())
    assert f"<title>{feeds.SITE_TITLE}</title>" in feeds.site_feed_xml("https://s", [])


def test_ranges(spark):
    from strataloom.functions.ranges import range_of

    for bounds in ([], [5], [1, 4, 9], list(range(0, 100, 3))):
        got = [r[0] for r in spark.range(-5, 110).select(range_of(F.col("id"), bounds)).collect()]
        assert got == [sum(b <= x for b in bounds) for x in range(-5, 110)]


def test_named_files_are_written_all_or_none(spark, tmp_path):
    rows = spark.createDataFrame([("a.html", "A"), ("weekly/b.html", "ß"), ("c.html", None)], "name string, content string").repartition(3)
    named_files.write_named(rows, str(tmp_path / "out"))
    files = lambda: {str(f.relative_to(tmp_path / "out")): f.read_text(encoding="utf-8") for f in (tmp_path / "out").rglob("*") if f.is_file()}
    assert files() == {"a.html": "A", "weekly/b.html": "ß", "c.html": ""}
    named_files.write_named(spark.createDataFrame([("a.html", "new"), ("d.html", "D")], "name string, content string"), str(tmp_path / "out"))
    after = {"a.html": "new", "weekly/b.html": "ß", "c.html": "", "d.html": "D"}
    assert files() == after
    failing = spark.range(8).select(F.concat(F.col("id").cast("string"), F.lit(".html")).alias("name"), F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise("x").alias("content")).repartition(4)
    for bad in (failing, spark.createDataFrame([("e.html", "1"), ("e.html", "2")], "name string, content string"), spark.createDataFrame([("../e.html", "1")], "name string, content string")):
        with pytest.raises(Exception):  # noqa: B017, PT011
            named_files.write_named(bad, str(tmp_path / "out"))
        assert files() == after
    named_files.write_named(rows.limit(0), str(tmp_path / "out"))
    assert files() == after


def test_feeds_as_files(spark, tmp_path):
    schema = "day string, nth int, title string, link string, author string, category string, pub_date string, description string"
    rows = [("2026-03-27", 2, "B <b>", "l?a&b", "x", "c", "d", None), ("2026-03-27", 1, "A", "m", "y", "c", "d", "s"), ("2026-03-28", 1, "C", "n", "z", "c", "d", "t")]
    feeds.write_feeds(spark.createDataFrame(rows, schema), str(tmp_path), "https://s", "day", "nth")
    assert sorted(f.name for f in tmp_path.iterdir()) == ["2026-03-27.xml", "2026-03-28.xml"]
    first = [dict(zip(schema.replace(" string", "").replace(" int", "").split(", "), r, strict=True)) for r in sorted(rows) if r[0] == "2026-03-27"]
    assert (tmp_path / "2026-03-27.xml").read_text(encoding="utf-8") == feeds.daily_feed_xml("https://s", "2026-03-27", [r | {"description": r["description"] or ""} for r in first])


def test_one_read_of_feeds(spark, tmp_path):
    """Items and health from one read, equal to those of separate ones."""
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>t</title><link>l</link><category>k</category></item><item><title>t2 &amp; u</title></item></channel></rss>")
    (tmp_path / "a.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>u</title><link href="m"/><summary>s</summary><author><name>N</name></author><updated>2026-01-01</updated></entry></feed>')
    (tmp_path / "none.xml").write_text("<rss><channel></channel></rss>")
    (tmp_path / "page.xml").write_text("<html>503</html>")
    (tmp_path / "void.xml").write_text("")
    (tmp_path / "cut.xml").write_text("<rss><channel><item><title>kept</title></item><item><title>lo")
    rows = named_files.read_feed_rows(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 6
    items = lambda df: {tuple(r[c] for c in ("title", "link", "summary", "author", "pub_date", "file")) for r in df.collect()}
    whole = named_files.items_of(rows).where("file <> 'cut.xml'")
    assert items(whole) == items(landed.read_feeds(spark, str(tmp_path / "[fa].xml")))
    assert {(r["url"], r["items"], r["problem"]) for r in named_files.health_of(rows).collect()} == {("f.xml", 2, ""), ("a.xml", 1, ""), ("none.xml", 0, "no items"), ("page.xml", 0, "not a feed"), ("void.xml", 0, "empty"), ("cut.xml", 1, "broken off")}
    assert tuple(feeds.feed_health(named_files.health_of(rows)).first()) == (6, 4)
