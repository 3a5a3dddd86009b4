"""JSON in free text: model answers, repaired where their damage is of a known kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom.functions.text import bound, clean_highlight, first_of, has_cjk, text_or_empty

# The elements of a poster, and their English names.
ELEMENTS = ["研究问题", "创新方法", "工作流程", "关键结果", "应用价值"]
ELEMENTS_EN = ["research_question", "method", "workflow", "result", "value"]
# Fixed value: the answer that stands in for a missing one.
DEFAULT_ANSWER = '{"overview": "今日文献已收录，AI摘要待生成。", "trends": "", "full_list": [], "ml_highlights": [], "ferro_highlights": []}'
ANSWER = "overview string, trends string, summaries array<struct<index:int,title_zh:string,one_sentence_summary:string>>, highlights array<struct<index:int,reason:string>>"


def object_in(text: Column) -> Column:
    """From the first opening to the last closing brace."""
    return F.regexp_extract(text_or_empty(text), r"(?s)(\{.*\})", 1)


def _number(v: Column) -> Column:
    """A JSON value as a whole number: numbers lose their fraction, strings must be whole numbers; else null."""
    kind, text = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    whole = F.when(text.rlike(r"^\s*[+-]?[0-9]{1,9}\s*$"), F.trim(text).cast("int"))
    return F.when(kind == "STRING", whole).when(kind == "BOOLEAN", (text == "true").cast("int")).otherwise(F.try_variant_get(v, "$", "double").cast("int"))


def highlight_items(answer: Column) -> Column:
    """index and highlight of an answer's items: those that are objects with a number and a Chinese highlight; the last of an index.

    Each item is read by itself, so one that isn't as it should be costs no other.
    """
    items = F.coalesce(F.try_variant_get(F.try_parse_json(object_in(answer)), "$.items", "array<variant>"), F.array().cast("array<variant>"))
    objects = F.filter(items, lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)))
    read = F.transform(
        objects,
        lambda x: F.struct(
            _number(F.try_variant_get(x, "$.index", "variant")).alias("index"),
            clean_highlight(first_of(F.try_variant_get(x, "$.highlight", "string"), F.try_variant_get(x, "$.one_sentence_summary", "string"))).alias("highlight"),
        ),
    )
    kept = F.filter(read, lambda x: x["index"].isNotNull() & (x["highlight"] != "") & has_cjk(x["highlight"]))

    def lasts(rows: Column) -> Column:
        """Sorted by index and place, an item is the last of its index where the next one has another."""
        placed = F.sort_array(F.transform(rows, lambda x, i: F.struct(x["index"].alias("index"), i.alias("at"))))
        after = lambda order, i: F.get(order, i + 1)["index"]
        at = bound(placed, lambda order: F.filter(order, lambda x, i: ~x["index"].eqNullSafe(after(order, i))))
        return F.transform(F.sort_array(F.transform(at, lambda x: x["at"])), lambda i: F.get(rows, i))

    return bound(kept, lasts)


def poster_elements(answer: Column) -> Column:
    """elements (by Chinese name), elements_en and title_zh; null unless all five elements are there."""
    text = object_in(answer)
    found = F.from_json(text, "map<string,string>")
    en = F.from_json(F.get_json_object(text, "$.elements_en"), "map<string,string>")
    whole = F.forall(F.array(*[F.lit(k) for k in ELEMENTS]), lambda k: F.map_contains_key(found, k))
    value = lambda m, k: F.coalesce(m[k], F.lit(""))
    pairs = lambda m, keys: F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[value(m, k) for k in keys]))
    return F.when(
        found.isNotNull() & whole,
        F.struct(pairs(found, ELEMENTS).alias("elements"), pairs(F.coalesce(en, F.create_map().cast("map<string,string>")), ELEMENTS_EN).alias("elements_en"), value(found, "title_zh").alias("title_zh")),
    )


#: A string with its escapes, or all that stands up to the next one; a quotation mark that nothing closes stands alone. Fixed repeats don't
#: go back, so long strings cost no stack.
TOKENS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"]++|"'


def mended(text: Column) -> Column:
    """Without code fences and trailing commas, and with the commas that are missing between objects; strings stay as they are."""

    def outside(c: Column) -> Column:
        c = F.regexp_replace(c, r"(?m)^\s*```[a-zA-Z]*\s*$", "")
        c = F.regexp_replace(c, r"\}(\s*)(?=\{)", "},$1")
        return F.regexp_replace(c, r",(\s*[}\]])", "$1")

    # The patterns hold no quotation mark, so what they match lies between two strings.
    tokens = F.regexp_extract_all(text_or_empty(text), F.lit(f"(?s){TOKENS}"), 0)
    return F.array_join(F.transform(tokens, lambda t: F.when(t.startswith('"'), t).otherwise(outside(t))), "")


def answer(text: Column, schema: str = ANSWER) -> Column:
    """An answer by its schema: as it is where it is sound, else mended."""
    plain, other = object_in(text), object_in(mended(text))
    return F.from_json(F.when(F.try_parse_json(plain).isNotNull(), plain).otherwise(other), schema)


def dated_answer(exact: Column, daily_date: Column, daily: Column, today: Column) -> Column:
    """The request's own answer, else the day's if it is today's, else the default."""
    return F.coalesce(exact, F.when(daily_date == today, daily), F.lit(DEFAULT_ANSWER))


def listed_items(summary: Column, item: str = "title string") -> Column:
    """The items of a daily summary: full_list, or summaries where that is missing."""
    both = F.from_json(summary, f"full_list array<struct<{item}>>, summaries array<struct<{item}>>")
    return F.coalesce(both["full_list"], both["summaries"], F.array().cast(f"array<struct<{item.replace(' ', ':')}>>"))
