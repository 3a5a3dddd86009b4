"""Author lists: strings of several names, character streams and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom.functions.text import compacted, text_or_empty

# What separates names, what belongs to the name before it, what isn't of a name, and when a list is taken for characters.
SEPARATOR = r"(?U)\s*[;,]\s*|\s+and\s+|\s*&\s*"
SUFFIX = r"(?i)^(?:Jr|Sr|II|III|IV|Ph\.?\s?D|M\.?\s?D)\.?$"
LINKS, BRACKETS, JOINER = r"(?is)https?://.*$", r"\([^)]*\)", r"(?iU)^(?:and|&)\s+"
STREAM_LEAST, STREAM_SHARE = 8, 0.85


def is_character_stream(items: Column) -> Column:
    """Whether a list holds a string's characters: 8 or more items, 85 % of them of a single character or none."""
    some = F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
    short = F.size(F.filter(some, lambda x: F.length(F.trim(x)) <= 1))
    return (F.size(some) >= STREAM_LEAST) & (short / F.greatest(F.size(some), F.lit(1)) >= STREAM_SHARE)


def split_names(text: Column) -> Column:
    """The names in a string; the whole string where none is found. A suffix (Jr, III, PhD) rejoins the name before it."""
    text = text_or_empty(text)
    plain = F.regexp_replace(F.regexp_replace(text, LINKS, " "), BRACKETS, " ")

    def tidied(part: Column) -> Column:
        part = F.regexp_replace(F.regexp_replace(part, r"(?U)^\s+|\s+$", ""), JOINER, "")
        return F.trim(F.regexp_replace(F.regexp_replace(part, "^[ ,;]+|[ ,;]+$", ""), r"(?U)\s+", " "))

    parts = F.filter(F.transform(F.split(plain, SEPARATOR), tidied), lambda p: p.rlike(r"(?U)\w"))
    none = F.array().cast("array<string>")
    joined = F.aggregate(
        parts,
        none,
        lambda names, part: F.when(
            part.rlike(SUFFIX) & (F.size(names) > 0),
            F.concat(F.slice(names, 1, F.size(names) - 1), F.array(F.concat(F.element_at(names, -1), F.lit(", "), part))),
        ).otherwise(F.array_append(names, part)),
    )
    return F.when(F.size(joined) > 0, joined).when(text != "", F.array(text)).otherwise(none)


def author_names(authors: Column) -> Column:
    """The names in a list of strings, each of which may hold several; a character stream is joined first."""
    some = F.filter(F.coalesce(authors, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
    each = F.flatten(F.transform(some, lambda x: split_names(compacted(x))))
    return F.when(is_character_stream(some), split_names(compacted(F.array_join(some, "")))).otherwise(each)


def authors_label(names: Column, most: int = 6) -> Column:
    """Names joined; of more than `most` the first, and how many there are."""
    first = F.array_join(F.slice(names, 1, most), ", ")
    return F.when(F.size(names) > most, F.concat(first, F.lit(" 等"), F.size(names).cast("string"), F.lit("位作者"))).otherwise(F.coalesce(first, F.lit("")))


# What an item of a written list can be: a string in either quotes, with escapes, a number or a constant.
_ITEM = r"""(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[+-]?[0-9]+(?:\.[0-9]+)?|None|True|False)"""
# Escapes of quoted strings and their characters.
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def listed_authors(raw: Column) -> Column:
    """A string that is written as a Python list, joined; any other string as it is. Quotes may be mixed and escaped."""

    def unquoted(item: Column) -> Column:
        # Split at backslashes: each part after one begins with the escaped character; an empty part is a backslash itself.
        body = F.replace(F.substring(item, 2, F.length(item) - 2), F.lit("\\\\"), F.lit("\u0000"))
        parts = F.split(body, r"\\")
        sign = lambda p: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for e in ESCAPES.items() for x in e]), F.substring(p, 1, 1)), F.when(F.substring(p, 1, 1).isin("'", '"'), F.substring(p, 1, 1)), F.concat(F.lit("\\"), F.substring(p, 1, 1)))
        whole = F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.concat(sign(p), F.substring(p, 2, F.length(p)))), ""))
        return F.when(item.rlike("^['\"]"), F.replace(whole, F.lit("\u0000"), F.lit("\\"))).otherwise(item)

    written = raw.rlike(rf"(?s)^\s*\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*,?\s*)?\]\s*$")
    items = F.regexp_extract_all(raw, F.lit(f"(?s)({_ITEM})"), 1)
    return F.when(written, F.array_join(F.transform(items, unquoted), ", ")).otherwise(text_or_empty(raw))
