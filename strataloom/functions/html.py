"""HTML to text."""

from __future__ import annotations

import re
from functools import reduce
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom.functions.text import bound

# Elements whose text isn't read.
SKIPPED = ["script", "style", "nav", "header", "footer", "noscript"]
#: Entities by name, from the standard library's table. Those that pages mostly have are looked up first, the others by their first letter.
ENTITIES = {name[:-1]: sign for name, sign in html5.items() if name.endswith(";")}
COMMON = ["amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "middot", "ndash", "mdash", "hellip"]
#: Elements whose content is no markup, and tags with attributes in quotes.
RAW = ["script", "style"]
REST_OF_TAG = r"""(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def _named(name: Column) -> Column:
    """The sign of an entity's name, null if there is none."""
    table = lambda names: F.create_map(*[F.lit(x) for n in names for x in (n, ENTITIES[n])])
    letters = sorted({n[0] for n in ENTITIES})
    by_letter = reduce(lambda out, x: F.when(name.startswith(x), F.try_element_at(table([n for n in ENTITIES if n[0] == x]), name)).otherwise(out), letters, F.lit(None).cast("string"))
    return F.coalesce(F.try_element_at(table(COMMON), name), by_letter)


def unescaped(c: Column) -> Column:
    """Character references, by name and by number, as their characters. Unknown ones stay; each must end in a semicolon."""
    def one(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]*);", 1)
        hexed = name.rlike("^#[xX]")
        code = F.when(hexed, F.conv(F.substring(name, 3, 6), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 7)).cast("long")
        good = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        sign = F.when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).when(code.isNull() & (name != ""), _named(name))
        return F.when(sign.isNotNull(), F.concat(sign, F.substring(part, F.length(name) + 2, F.length(part)))).otherwise(F.concat(F.lit("&"), part))

    return bound(F.split(c, "&"), lambda parts: F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), "")))


def visible(c: Column) -> Column:
    """What stands outside the skipped elements, which may be nested or never closed.

    Each of their tags goes one deeper or comes back, never above the outside; the parts of the text between them at depth 0
    are seen. Only these tags are folded, of which a page has few. What raw elements hold is no markup and is cut before, up to the end where
    they aren't closed.
    """
    tag = rf"</?(?:{'|'.join(SKIPPED)}){REST_OF_TAG}"
    raw = rf"<({'|'.join(RAW)}){REST_OF_TAG}.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
    bare = F.regexp_replace(c, rf"(?is)<!--.*?(?:-->|\z)|<![^>]*>|{raw}", " ")
    last = lambda depth: F.get(depth, F.size(depth) - 1)
    deeper = lambda depth, t: F.when(t.startswith("</"), F.greatest(last(depth) - 1, F.lit(0))).otherwise(last(depth) + 1)

    def seen(bare: Column) -> Column:
        depths = F.aggregate(F.regexp_extract_all(bare, F.lit(f"(?is){tag}"), 0), F.array(F.lit(0)), lambda depth, t: F.concat(depth, F.array(deeper(depth, t))))
        return bound(depths, lambda d: F.array_join(F.filter(F.split(bare, f"(?is){tag}"), lambda _, i: F.get(d, i) == 0), " "))

    return bound(bare, seen)


def html_to_text(html: Column) -> Column:
    """Text outside the skipped elements with all white space as single blanks, from built-in functions.

    Equal to exact_html_to_text() but for white space.
    """
    c = visible(F.coalesce(html, F.lit("")))
    c = F.regexp_replace(c, r"""(?s)</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</[^>]*>|<\?[^>]*>""", " ")
    return F.trim(F.regexp_replace(unescaped(c), r"(?U)\s+", " "))


class _Events(HTMLParser):
    """What a parser meets, in order: 1 and -1 where a skipped element begins and ends, and the texts."""

    def __init__(self) -> None:
        super().__init__()
        self.met: list[int | str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.met += [1] if tag in SKIPPED else []

    def handle_endtag(self, tag: str) -> None:
        self.met += [-1] if tag in SKIPPED else []

    def handle_data(self, data: str) -> None:
        self.met.append(data)


def read_html(html: str | None) -> str:
    """Text nodes outside the skipped elements, joined by blanks; tabs and blanks in them squeezed.

    What follows the last tag is lost where it ends in the beginning of an entity, as the input isn't closed.
    """
    events = _Events()
    events.feed(html or "")
    hidden, texts = 0, []
    for met in events.met:
        if isinstance(met, int):
            hidden = max(0, hidden + met)
        elif not hidden:
            texts.append(met.strip())
    return re.sub(r"[ \t]+", " ", " ".join(filter(None, texts))).strip()


def _read_all(s: pd.Series) -> pd.Series:
    return s.map(read_html)


def exact_html_to_text(html: Column) -> Column:
    """read_html() of each row: nested and unclosed elements as a parser sees them."""
    return F.pandas_udf(_read_all, "string")(html)
