"""Text columns: trimming, truncation, repair of damaged characters and LaTeX, announcement prefixes."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that mark a summary as degraded, and the mark of a cut text.
DEGRADED = ["摘要信息不足", "需查阅原文确认具体方法与结论"]
ELLIPSIS = "…"

# LaTeX commands and the characters they stand for.
COMMANDS = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ε", "zeta": "ζ", "eta": "η", "theta": "θ",
    "kappa": "κ", "lambda": "λ", "mu": "μ", "nu": "ν", "xi": "ξ", "pi": "π", "rho": "ρ", "sigma": "σ", "tau": "τ",
    "phi": "φ", "chi": "χ", "psi": "ψ", "omega": "ω", "Gamma": "Γ", "Delta": "Δ", "Theta": "Θ", "Lambda": "Λ",
    "Xi": "Ξ", "Pi": "Π", "Sigma": "Σ", "Phi": "Φ", "Psi": "Ψ", "Omega": "Ω", "times": "×", "pm": "±", "leq": "≤",
    "geq": "≥", "approx": "≈", "sim": "∼", "to": "→", "infty": "∞", "cdot": "·", "left": "", "right": "",
    "ss": "ß", "ae": "æ", "AE": "Æ", "aa": "å", "AA": "Å", "o": "ø", "O": "Ø", "l": "ł", "L": "Ł", "i": "ı",
}
# LaTeX accents and the combining characters they stand for.
ACCENTS = {'"': "\u0308", "'": "\u0301", "`": "\u0300", "^": "\u0302", "~": "\u0303", "v": "\u030c", "c": "\u0327", "u": "\u0306", "H": "\u030b", "r": "\u030a"}
# What formulas can raise or lower, and the characters for it.
PLAIN, LOWERED, RAISED = "0123456789+-=()x", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎ₓ", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ˣ"

# Announcements that stand before abstracts.
ARXIV_PREFIX = r"^arXiv:\S+?v\d+\s+Announce Type:\s*[\w-]+\s+Abstract:\s*"
ARXIV_PREFIX_ZH = r"^arXiv:[^\s；;]+?v\d+[\s；;]*(?:公告|发布|公布)类型[:：]\s*[^\s。：:]{1,15}?(?:\s*摘要\s*[:：]\s*|。\s*)"
NATURE_PREFIX = r"^[^,，。.;]{2,60}, Published online: \d{1,2} \w+ \d{4};\s*doi:\S+\s+"


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once however often it is named."""
    return F.transform(F.array(value), then)[0]


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def first_of(*columns: Column) -> Column:
    """The first that is neither null nor empty, else empty."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in columns], F.lit(""))


def compacted(c: Column) -> Column:
    """All white space, no-break spaces too, as single blanks."""
    return F.trim(F.regexp_replace(text_or_empty(c), r"(?U)[\s\u00a0]+", " "))


def cut(c: Column, most: int, mark: str = ELLIPSIS) -> Column:
    """The first `most` code points, and the mark if there were more."""
    c = text_or_empty(c)
    short = F.regexp_replace(F.substring(c, 1, most), r"(?U)\s+$", "")
    return F.when(F.length(c) > most, F.concat(short, F.lit(mark))).otherwise(c)


def has_cjk(c: Column) -> Column:
    return F.coalesce(c.rlike("[\u4e00-\u9fff]"), F.lit(False))


def is_degraded(c: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c.contains(p), F.lit(False)) for p in DEGRADED])


def clean_highlight(c: Column, most: int = 120) -> Column:
    """Trimmed and cut; empty where the summary is degraded."""
    text = stripped(text_or_empty(c))
    return F.when(is_degraded(text), "").otherwise(cut(text, most))


def is_damaged(c: Column) -> Column:
    """Whether UTF-8 was read as Latin-1, or LaTeX is left."""
    return F.coalesce(c.rlike(r"[\u00c2-\u00f4][\u0080-\u00bf]") | c.rlike(r"""\\["'`^~=.a-zA-Z&%$_#]|\$[^$]+\$"""), F.lit(False))


def undone_mojibake(c: Column) -> Column:
    """Latin-1 characters that are really UTF-8 bytes, read again; other texts stay."""
    suspect = c.rlike(r"[\u00c2-\u00f4][\u0080-\u00bf]") & c.rlike(r"^[\u0000-\u00ff]*$")
    again = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.when(F.coalesce(suspect, F.lit(False)), F.coalesce(again, c)).otherwise(c)


def _folded(c: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, rule: F.regexp_replace(c, *rule), rules, c)


def latex_commands(c: Column) -> Column:
    """Commands become their characters, the longest names first; a name ends where letters end."""
    return _folded(c, [(rf"\\{name}(?![A-Za-z])(?:\{{\}})?", COMMANDS[name]) for name in sorted(COMMANDS, key=lambda n: (-len(n), n))])


def latex_accents(c: Column) -> Column:
    """Accent commands become combining characters after their letter; composed() joins the two.

    Letters (\\v, \\c, \\u, \\H, \\r) are accents only before a brace, so that they don't split longer names.
    """
    rules = []
    for mark, combining in ACCENTS.items():
        name = mark if mark.isalpha() else "\\" + mark
        letter = r"(?:\\i(?![A-Za-z])|([A-Za-z]))"
        rules.append((rf"\\{name}\{{{letter}\}}", "$1" + combining))
        if not mark.isalpha():
            rules.append((rf"\\{name}([A-Za-z])", "$1" + combining))
    return _folded(c, rules)


def unbraced(c: Column) -> Column:
    """Takes the braces off a single accented or special letter."""
    return F.regexp_replace(c, r"\{([A-Za-z]\p{M}|[ßæÆåÅøØłŁı])\}", "$1")


def _composed(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def composed(c: Column) -> Column:
    """Unicode normal form C, which Spark has no function for."""
    return F.pandas_udf(_composed, "string")(c)


def formula_marks(c: Column) -> Column:
    """Lowers and raises what follows _ and ^ (a number, or braces around characters that have such a form)."""

    def moved(c: Column, sign: str, to: str) -> Column:
        # Split at the marks; in each part after a mark the leading group changes, the rest stays.
        parts = F.split(c, rf"(?={sign}(?:\{{[{_CLASS}]+\}}|[0-9]+))")
        one = lambda p: F.when(p.rlike(rf"^{sign}(?:\{{[{_CLASS}]+\}}|[0-9]+)"), F.concat(F.translate(F.regexp_replace(F.regexp_extract(p, rf"^{sign}(\{{[{_CLASS}]+\}}|[0-9]+)", 1), r"[{}]", ""), PLAIN, to), F.regexp_replace(p, rf"^{sign}(?:\{{[{_CLASS}]+\}}|[0-9]+)", ""))).otherwise(p)
        return F.array_join(F.transform(parts, one), "")

    return moved(moved(c, "_", LOWERED), r"\^", RAISED)


_CLASS = r"0-9+\-=()x"


def latex_wrappers(c: Column) -> Column:
    """Takes off \\mathrm{…} and its kin, dollar signs, and backslashes before & % $ _ #."""
    c = F.regexp_replace(c, r"\\(?:mathrm|mathbf|mathit|text|textit|textbf|rm|bf)\s*\{([^{}]*)\}", "$1")
    c = F.regexp_replace(c, r"(?<!\\)\$", "")
    return F.regexp_replace(c, r"\\([&%$_#])", "$1")


def normalized(c: Column) -> Column:
    """Mojibake, accents, commands, formulas and wrappers, in this order, in normal form C."""
    c = latex_accents(undone_mojibake(text_or_empty(c)))
    return composed(formula_marks(latex_wrappers(unbraced(latex_commands(c)))))


def without_announcement(c: Column) -> Column:
    """The text after an arXiv or Nature announcement at its very beginning; null becomes empty."""
    return _folded(text_or_empty(c), [(ARXIV_PREFIX, ""), (ARXIV_PREFIX_ZH, ""), (NATURE_PREFIX, "")])
