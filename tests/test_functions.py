"""Test vectors for the column functions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strataloom.functions import authors, html, jsonx, links, prompts, text
from strataloom.operators import enrich


def values(spark, f, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (links.normalize_link, [("10.5555/loom-17", "https://doi.org/10.5555/loom-17"), ("http://arxiv.org/abs/2601.001", "http://arxiv.org/abs/2601.001"), ("", ""), (None, ""), ("  ", ""), ("HTTP://x", "https://doi.org/HTTP://x")]),
        (
            links.arxiv_id,
            [("https://arxiv.org/abs/2601.12345v2", "2601.12345"), ("arXiv:2501.1234", "2501.1234"), ("2412.00001v3", "2412.00001"), ("https://arxiv.org/pdf/cond-mat/0703124v1", "cond-mat/0703124"), ("arXiv:cond-mat/0703124", ""), ("https://arxiv.org/abs/cond-mat.str-el/0001234", ""), ("10.1/2101.12345", ""), (None, "")],
        ),
        (links.chat_url, [("https://llm.example.com/v1", "https://llm.example.com/v1/chat/completions"), ("https://llm.example.com/v1/", "https://llm.example.com/v1/chat/completions"), ("https://x/v1/chat/completions", "https://x/v1/chat/completions")]),
        (
            text.without_announcement,
            [
                ("arXiv:2502.01234v7 Announce Type: replace Abstract: Walls move slowly.", "Walls move slowly."), ("arXiv:2401.5678v1 Announce Type: cross-list Abstract: \nTwo lines.", "Two lines."),
                ("arXiv:2503.00009v2；公告类型：交叉提交。晶格很软。", "晶格很软。"), ("arXiv:2503.00010v1 发布类型：新 摘要：界面有电荷。", "界面有电荷。"), ("arXiv:2503.00011v1 公布类型：新摘要：一。二。", "一。二。"),
                ("arXiv 上的文章没有前缀。", "arXiv 上的文章没有前缀。"), ("See arXiv:2503.00009v2 Announce Type: new Abstract: inside.", "See arXiv:2503.00009v2 Announce Type: new Abstract: inside."), ("", ""), (None, ""),
                ("Nature Physics, Published online: 2 March 2026; doi:10.1038/x-1 A soft mode.", "A soft mode."), ("Rates, published online: never; doi:10.1/x stay.", "Rates, published online: never; doi:10.1/x stay."),
            ],
        ),
        (
            text.normalized,
            [
                (r"$\gamma$ rays", "γ rays"), (r"$\Sigma \geq \delta$", "Σ ≥ δ"), (r"\approx 3 \pm 1", "≈ 3 ± 1"), (r"na\"ive Poincar\'e", "naïve Poincaré"), (r"Fa\c{c}ade of \v{Z}i\v{z}kov", "Façade of Žižkov"),
                (r"\aa ngstrom, Stra\ss e, \l \'od\'z", "å ngstrom, Straß e, ł ódź"), (r"$\mathrm{CO_2}$ \& 7\%", "CO₂ & 7%"), (r"La$_{1-x}$Sr$_3$ at 2\times10^12", "La₁₋ₓSr₃ at 2×10¹²"),
                (r"{\L}\'odz and \~nandu", "Łódz and ñandu"), ("ç\x94µè\x8d·", "电荷"), ("没有损坏的标题", "没有损坏的标题"), (None, ""),
            ],
        ),
        (text.is_damaged, [("没有损坏的标题", False), ("na\\\"ive", True), ("ç\x94µè\x8d·", True), ("costs $5 or $6", True), (None, False)]),
        (text.clean_highlight, [(" a ", "a"), ("x" * 121, "x" * 120 + "…"), ("x" * 120, "x" * 120), ("含摘要信息不足。", ""), (None, "")]),
        (links.provider_name, [(" LK ", "local"), ("OpenRouter", "openrouter"), (None, "")]),
        (html.exact_html_to_text, [("<p>a</p>AT&T", "a"), ("<p>a</p>tail", "a tail"), ("<p>x &amp; y</p><script>no</script><nav>no<p>no", "x & y"), (None, "")]),
    ],
)
def test_vectors(spark, f, cases):
    assert values(spark, f, [a for a, _ in cases]) == [b for _, b in cases]


def test_regex_html_is_the_parser_modulo_white_space(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    squeezed = lambda c: F.regexp_replace(c, r"(?U)\s", "")
    assert pages.where(squeezed(html.html_to_text(F.col("html"))) != squeezed(html.exact_html_to_text(F.col("html")))).count() == 0


def test_author_names(spark):
    cases = [
        (["Alice", "Bob"], "Alice, Bob"), (list("Carol Smith, David Lee"), "Carol Smith, David Lee"), (["A, B, and C"], "A, B, C"), (["X One, Jr.; Y (MIT) https://ror.org/1, z"], "X One, Jr., Y"),
        ([], ""), (None, ""), (["a b", "c d", "e f", "g h", "i j", "k l", "m n"], "a b, c d, e f, g h, i j, k l 等7位作者"), ([";;"], ";;"),
    ]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, a array<string>")
    got = [r["y"] for r in df.select("i", authors.authors_label(authors.author_names(F.col("a"))).alias("y")).orderBy("i").collect()]
    assert got == [b for _, b in cases]


def test_lenient_json(spark):
    raw = 'Here:\n```json\n{"overview": "晶体", "trends": "", "summaries": [{"index": 7, "title_zh": "甲",}\n\n{"index": 8, "title_zh": "乙"}], "highlights": [],}\n```'
    got = values(spark, jsonx.answer, [raw])[0]
    assert got["overview"] == "晶体" and [(s["index"], s["title_zh"]) for s in got["summaries"]] == [(7, "甲"), (8, "乙")] and got["highlights"] == []


def test_entities(spark):
    import html as standard

    texts = ["a &lt;b&gt; &amp;amp; &quot;", "&#233;&#x1F600;&#xe9; &eacute;&AMP; &zzanentity; &", "&amp &;&#0;&#xD800; &CounterClockwiseContourIntegral;", "no signs", None]
    got = values(spark, html.unescaped, texts)
    assert got[:2] == [standard.unescape(t) for t in texts[:2]] and got[2] == "&amp &;&#0;&#xD800; ∳" and got[3:] == ["no signs", None]


def test_listed_authors(spark):
    cases = [("['A. One', \"O'Two\", 3]", "A. One, O'Two, 3"), (r"['it\'s', 'a\\b', 'x\ny']", "it's, a\\b, x\ny"), ("[]", ""), ("['a',]", "a"), ("[a, b]", "[a, b]"), ("['a' 'b", "['a' 'b"), ("plain, name", "plain, name"), (None, ""), ("[None, True]", "None, True")]
    assert values(spark, authors.listed_authors, [a for a, _ in cases]) == [b for _, b in cases]


def test_batch_prompt(spark):
    import json

    rows = [[(' 标 "q"', "en", " a\nb "), ("", "en\\", None)], []]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x array<struct<title:string,title_en:string,abstract:string>>")
    got = [r["p"] for r in df.select("i", prompts.batch_prompt("$a ${items}!", F.col("x")).alias("p")).orderBy("i").collect()]
    want = [{"index": 1, "title": '标 "q"', "abstract": "a\nb"}, {"index": 2, "title": "en\\", "abstract": ""}]
    assert got == [f"$a {json.dumps(want, ensure_ascii=False)}!", "$a []!"]


def test_highlight_items_are_read_one_by_one(spark):
    raw = 'x {"items": [5, null, "文", {"index": 1, "highlight": "旧"}, {"index": "1", "highlight": "新"}, {"index": null, "highlight": "无"}, {"index": 2, "highlight": "plain"}, {"index": 3.9, "one_sentence_summary": "三"}, {"index": true, "highlight": ""}, {"index": [1], "highlight": "列"}, {"index": " 4 ", "highlight": "四"}]} y'
    got = values(spark, jsonx.highlight_items, [raw, None, "no json", '{"items": 7}', '{"items": {"index": 1}}', '{"other": 1}'])
    assert [(x["index"], x["highlight"]) for x in got[0]] == [(1, "新"), (3, "三"), (4, "四")] and got[1:] == [[]] * 5


def test_weekly_prompt_takes_500_characters_and_keeps_dollars(spark):
    got = values(spark, lambda c: prompts.weekly_prompt(c, F.lit("$title"), c), ["甲" * 1000])[0]
    assert "甲" * 1000 in got.split("期刊")[0] and "期刊: $title" in got and got.split("摘要: ")[1].startswith("甲" * 500 + "\n")


def test_pick_summary(spark):
    long = "Seven looms weave a strata of thread by thread, and none stops. " * 8
    got = values(spark, lambda c: enrich.pick_summary(F.lit("摘要信息不足"), F.lit(""), F.lit(None), c), [long, "short", None])
    assert len(got[0]) <= 201 and got[0].endswith("…") and got[1:] == ["short", ""]


def test_classify(spark):
    rules = {"磁性·自旋电子学": ["altermagnet"]}
    df = spark.createDataFrame([("Altermagnetic order", "其他"), ("x", "答：磁性·自旋电子学"), ("x", "?"), ("x", None)], "t string, a string")
    assert [r[0] for r in df.select(enrich.classify(F.col("t"), F.col("a"), rules)).collect()] == ["磁性·自旋电子学", "磁性·自旋电子学", "其他", "其他"]


def test_answers_keep_their_strings(spark):
    """Sound answers come back as they are; damaged ones are mended outside strings only."""
    long = "a\\\"" * 100_000
    rows = [
        ('{"overview": "see [a,] and {x} {y}"}', "see [a,] and {x} {y}", None),
        ('```json\n{"overview": "a ,] } { \\" ,}", "summaries": [{"index":1}\n {"index":2,},],}\n```', 'a ,] } { " ,}', 2),
        ('{"overview": "```json\\n, }", "summaries": [],}', "```json\n, }", 0),
        ('say "{": {"overview": "x",}', None, None),
        ('{"overview": "never closed', None, None),
        (f'{{"overview": "{long}", }}', 'a"' * 100_000, None),
        ("", None, None),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "i int, t string")
    got = {r["i"]: (r["a"]["overview"], None if r["a"]["summaries"] is None else len(r["a"]["summaries"])) if r["a"] else (None, None) for r in df.select("i", jsonx.answer(F.col("t")).alias("a")).collect()}
    assert got == {i: (o, n) for i, (_, o, n) in enumerate(rows)}


def test_many_items_take_linear_time(spark):
    """Four times the items take far less than sixteen times as long; the last of an index counts, in the order of the answer."""
    import time

    def run(n: int) -> float:
        items = ", ".join(f'{{"index": {i % (n // 2)}, "highlight": "亮{i}"}}' for i in range(n))
        df = spark.createDataFrame([(f'{{"items": [{items}]}}',)], "t string").select(jsonx.highlight_items(F.col("t")).alias("h"))
        began = time.perf_counter()
        got = [(x["index"], x["highlight"]) for x in df.first()["h"]]
        assert got == [(i % (n // 2), f"亮{i}") for i in range(n // 2, n)]
        return time.perf_counter() - began

    run(500)
    assert run(8_000) < 10 * run(2_000) + 2


def test_nested_html_is_read_as_a_parser_does(spark):
    rng = random.Random(4)
    bits = ["<nav>", "</nav>", "<header class='a>b'>", "</header>", "<script>", "</script>", "<style>", "</style>", "<footer>", "</footer >", "<noscript>", "</noscript>", "text ", "a &amp; b ", "<p>", "</p>", "<!-- <nav> -->", '<b title="x>y">', "&lt;i&gt; ", "&copy;&Aacute; ", "<br/>", "<navy>n</navy>", "5 ", "<NAV>"]
    pages = ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(600)]
    df = spark.createDataFrame([(p,) for p in pages], "h string")
    bare = lambda t: "".join(t.split())
    for r in df.select("h", html.html_to_text(F.col("h")).alias("t")).collect():
        assert bare(r["t"]) == bare(html.read_html(r["h"])), r["h"]
    assert "Python" not in df.select(html.html_to_text(F.col("h")))._jdf.queryExecution().executedPlan().toString()
