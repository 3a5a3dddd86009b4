"""Prompts as columns. Templates are constants; $name or ${name} is replaced, other dollars stay."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom.functions.jsonx import ELEMENTS
from strataloom.functions.text import first_of, stripped, text_or_empty

# Limits of prompts, and the mark of a cut context.
DEEP_MOST, ABSTRACT_MOST, WEEKLY_MOST = 40000, 6000, 500
CUT_MARK = "\n\n[内容过长已截断]"
# Fixed value: the weekly analysis prompt.
WEEKLY = """请对以下文献进行分析，生成一段 2~3 句、≤100 字的中文解读，突出核心创新点、最强结论与研究意义。

标题: $title
期刊: $journal
摘要: $abstract

要求:
1. 用中文输出
2. 2~3 句、≤100 字
3. 突出核心创新点与最强结论
4. 说明研究意义或应用价值
5. 不要照抄摘要，而是分析总结

直接输出分析结果，不要添加任何前缀或格式："""


def filled(template: str, **values: Column) -> Column:
    """The template with its known names replaced in one pass: a value's own dollars are never names."""
    parts, at = [], 0
    for m in re.finditer(r"\$(?:(\w+)|\{(\w+)\})", template):
        if (name := m[1] or m[2]) in values:
            parts += [F.lit(template[at : m.start()]), text_or_empty(values[name])]
            at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def context(text: Column, most: int = DEEP_MOST, mark: str = "") -> Column:
    text = text_or_empty(text)
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(mark))).otherwise(text)


def deep_prompt(template: str, title: Column, authors: Column, year: Column, text: Column, most: int = DEEP_MOST) -> Column:
    return filled(template, title=title, authors=authors, year=year, context=context(text, most, CUT_MARK))


def abstract_prompt(template: str, title: Column, authors: Column, abstract: Column, most: int = ABSTRACT_MOST) -> Column:
    return filled(template, title=title, authors=authors, abstract=context(abstract, most))


def weekly_prompt(title: Column, journal: Column, abstract: Column) -> Column:
    return filled(WEEKLY, title=title, journal=journal, abstract=context(abstract, WEEKLY_MOST))


def poster_lines(elements: Column) -> Column:
    """Numbered lines of the elements that have a value; a gap in the numbers stays."""
    lines = []
    for i, key in enumerate(ELEMENTS, 1):
        value = stripped(text_or_empty(elements[key]))
        lines.append(F.when(value != "", F.concat(F.lit(f"{i}. {key}："), value)))
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def _quoted(c: Column) -> Column:
    """A string as JSON has it."""
    return F.regexp_replace(F.to_json(F.struct(c.alias("a"))), r'^\{"a":|\}$', "")


def items_json(items: Column) -> Column:
    """An array of structs (title, title_en, abstract) as JSON for a batch prompt: numbered from 1, the title or else the English one."""
    one = lambda x, i: F.concat(
        F.lit('{"index": '), (i + 1).cast("string"), F.lit(', "title": '), _quoted(stripped(first_of(x["title"], x["title_en"]))), F.lit(', "abstract": '), _quoted(stripped(text_or_empty(x["abstract"]))), F.lit("}")
    )
    return F.concat(F.lit("["), F.array_join(F.transform(items, one), ", "), F.lit("]"))


def batch_prompt(template: str, items: Column) -> Column:
    """The template with ${items} replaced by the items' JSON."""
    return F.replace(F.lit(template), F.lit("${items}"), items_json(items))


def poster_prompt(template: str, title: Column, text: Column, language: str = "中文", most: int = DEEP_MOST) -> Column:
    """The prompt that asks for a poster's elements; the context is cut without a mark."""
    return filled(template, language=F.lit(language), title=title, context=context(text, most))


def infographic_prompt(template: str, elements: Column, title: Column, language: str = "中文") -> Column:
    return filled(template, summaryForImage=poster_lines(elements), title=title, language=F.lit(language))


def landed_answer(text: Column, answer: Column) -> Column:
    """A landed answer, trimmed; empty where there was nothing to ask about."""
    return F.when(text_or_empty(text) == "", "").otherwise(stripped(text_or_empty(answer)))
