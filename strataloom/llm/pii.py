"""Personal data: exact patterns, and a character BiLSTM-CRF in numpy that adds what they can't see (operator 9).

The patterns' spans are the base. The tagger learns from windows of the corpus, labelled with the base spans and with
personal data that is put in, written in ways that the patterns don't know (see variant()): an at sign in words, a phone number
without a plus, a card's digits between dots, the dots of an address in brackets. It reads every character of every text in
overlapping windows; the windows' spans are reconciled over the whole text.
"""

from __future__ import annotations

import hashlib
import pickle
import random
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import prepare
from strataloom.llm.tagger import BLANK, Tagger, symbols

KINDS = ("email", "ip", "card", "phone")
#: Windows begin every STRIDE characters and are decoded ROWS at a time.
WINDOW, STRIDE, ROWS = 512, 448, 768
#: The model is fitted on so many windows at most, of TAUGHT characters, from documents of the least hash, read EPOCHS times.
MOST_WINDOWS, TAUGHT, EPOCHS = 2560, 96, 8
#: So many characters of each of these documents, from a place that its hash says, are sent to the task that fits.
SAMPLED = 4096

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that fails from its first digit fails from each later one too, so a match starts where a run does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind: str, text: str) -> bool:
    """What a match of a kind must fulfil besides its pattern."""
    if kind == "email":
        return "@" in text[1:-1]
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(re.fullmatch("[0-9]+", p) and (p.lstrip("0") or "0").isdigit() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
    digits = "".join(_DIGIT.findall(text))
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of all that the patterns find, by start, then kind as listed."""
    out = [(a, b, 0) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            out += [(m.start(), m.end(), k) for m in pattern.finditer(text) if valid(KINDS[k], m[0])]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda x: (x[0], x[2]))]


# --- the model's part ----------------------------------------------------------------------------------

#: What may stand around and between the parts of made personal data. Brackets come in pairs, marks on both sides.
BRACKETS, MARKS, ENDS = ["()", "[]", "{}", "<>"], "-_*/|+=~", ["com", "org", "net", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "it", "uk", "co", "biz"]


def spelt(sign: str, name: str, rng: random.Random) -> str:
    """A sign, or its name in any case, between blanks, brackets or marks drawn at random."""
    said = rng.choice([name, name, name.upper(), name.capitalize(), sign])
    if rng.random() < 0.35:
        return f" {said} "
    left, right = rng.choice(BRACKETS) if rng.random() < 0.7 else rng.choice(MARKS) * 2
    inside, around, n = rng.choice(["", "", " "]), rng.choice(["", " "]), rng.choice([1, 1, 1, 1, 2])
    return around + left * n + inside + said + inside + right * n + around


def between(rng: random.Random, signs: str) -> str:
    """What stands between groups of digits: a sign, with blanks or twice, or two of them."""
    sign = rng.choice(signs)
    return rng.choice([sign, sign, f" {sign} ", f"{sign} ", sign * 2, "  "])


def variant(kind: str, rng: random.Random) -> str:
    """Made personal data of a kind, written in a way that the patterns don't match."""
    while True:
        made = _made(kind, rng)
        if settled(kind, made) == (kind, 0, len(made)) and (0, len(made), kind) not in base_spans(made):
            return made


def _made(kind: str, rng: random.Random) -> str:
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    if kind == "email":
        at, dot = spelt("@", "at", rng), spelt(".", "dot", rng)
        at = at if at != "@" else " at "
        name = rng.choice([word(), word() + digits(2), f"{word()}.{word()}", f"{word()}.{digits(2)}", f"{word()}_{word()}", word().capitalize()])
        end = rng.choice(ENDS) if rng.random() < 0.9 else word()[: rng.randint(2, 3)]
        return name + at + dot.join([*[word() + rng.choice(["", digits(1)]) for _ in range(rng.randint(1, 2))], end])
    if kind == "ip":
        sign = spelt(".", "dot", rng) if rng.random() < 0.7 else between(rng, "-_/|:,")
        return sign.join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        body = rng.choice("3456") + digits(14)
        whole = body + next(d for d in "0123456789" if luhn(body + d))
        sign = between(rng, "./_|*:,")
        cuts = rng.choice([(4, 8, 12), (4, 8, 12), (4, 10)])
        return sign.join(whole[i:j] for i, j in zip((0, *cuts), (*cuts, 16), strict=True))
    a, b, c = str(rng.randint(2, 9)) + digits(2), digits(3), digits(4)
    sign = rng.choice(["-", ".", " ", "/", between(rng, "-./_:")])
    return rng.choice([f"({a}) {b}-{c}", f"({a}) {b} {c}", f"({a}){b}{sign}{c}", f"{a}{sign}{b}{sign}{c}", f"{a}-{b}-{c}", f"00{rng.randint(1, 99)}{sign}{a}{sign}{b}{sign}{c}", f"1-{a}-{b}-{c}"])


def settled(told: str, text: str) -> tuple[str, int, int]:
    """The kind of a span that the model has found, by its parts, however these are set apart, and where it begins and ends; the kind is empty
    if it is none.

    An address has a name, a host and an end of two to four letters, and where only blanks part it words for its signs; a longer
    last word isn't its end. Spans of digits begin and end with digits or brackets; they are
    told apart by their numbers: four of a byte each, a card's check digit, or as many digits as a phone has.
    """
    if told == "email":
        parts = list(re.finditer(r"[A-Za-z0-9]+", text))
        if len(parts) > 3 and len(parts[-1][0]) > 4:
            parts.pop()
        if not parts:
            return "", 0, 0
        a, b, last = parts[0].start(), parts[-1].end(), parts[-1][0]
        signs = re.search(r"[^A-Za-z0-9 ]", text[a:b]) is not None
        good = text[a:b].isascii() and (3 if signs else 5) <= len(parts) <= 16 and len({p[0].lower() for p in parts}) >= min(4, len(parts))
        return told if good and last.isalpha() and 2 <= len(last) <= 4 else "", a, b
    found = re.search(r"[+(\[]?[0-9](?:.*[0-9])?", text, re.DOTALL)
    if not found:
        return "", 0, 0
    numbers = re.findall("[0-9]+", text)
    digits = "".join(numbers)
    if len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers):
        return "ip", *found.span()
    return "card" if 12 <= len(digits) <= 19 and luhn(digits) else "phone" if told == "phone" and 9 <= len(digits) <= 15 else "", *found.span()


def tags(text_length: int, spans: list[tuple[int, int, str]]) -> np.ndarray:
    """0 outside; 1 + 2k at a span's first character and 2 + 2k after it."""
    out = np.zeros(text_length, np.int64)
    for a, b, kind in reversed(spans):
        k = KINDS.index(kind)
        out[a:b] = 2 + 2 * k
        out[a] = 1 + 2 * k
    return out


def laid_out(texts: list[str]) -> Iterator[tuple[list[tuple[int, int]], np.ndarray]]:
    """All texts in overlapping windows, ROWS at a time: number of the text and start of each window, and their symbols."""
    where: list[tuple[int, int]] = []
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - (WINDOW - STRIDE)), STRIDE) if t else ():
            where.append((i, a))
            if len(where) == ROWS:
                yield where, _symbols(texts, where)
                where = []
    if where:
        yield where, _symbols(texts, where)


def _symbols(texts: list[str], where: list[tuple[int, int]]) -> np.ndarray:
    parts = [texts[i][a : a + WINDOW] for i, a in where]
    size = np.array([len(p) for p in parts])
    out = np.full((len(parts), WINDOW), BLANK, np.uint8)
    out[np.arange(WINDOW) < size[:, None]] = symbols("".join(parts))
    return out


def in_window(tag: np.ndarray, above: np.ndarray, first: bool, last: bool) -> Iterator[tuple[int, int, int, float]]:
    """Start, end, number of the kind and score of a window's spans. One that an edge may have cut isn't told, unless the text ends there."""
    at = np.flatnonzero(tag)
    starts = at[(tag[at] % 2 == 1) | (at == 0)]
    for a in starts.tolist():
        k, b = (int(tag[a]) - 1) // 2, a + 1
        while b < len(tag) and tag[b] == 2 + 2 * k:
            b += 1
        if (a or first) and (b < len(tag) or last):
            yield a, b, k, float(above[a:b].sum())


def reconciled(found: dict[tuple[int, int, int], float]) -> list[tuple[int, int, int]]:
    """Of a text's spans, each with the sum of its windows' scores, the disjoint ones of the largest total (ties: the fewest)."""
    spans = sorted(found, key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in spans]
    best: list[tuple[float, int, int]] = [(0.0, 0, -1)]  # total, less the number of spans, and which span was taken last
    for n, s in enumerate(spans):
        before = best[bisect_right(ends, s[0], hi=n)]
        taken = (before[0] + found[s], before[1] - 1, n)
        best.append(max(taken, (*best[-1][:2], -1), key=lambda x: x[:2]))
    out, n = [], len(spans)
    while n:
        if best[n][2] < 0:
            n -= 1
        else:
            out.append(spans[n - 1])
            n = bisect_right(ends, spans[n - 1][0], hi=n - 1)
    return out[::-1]


def model_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, str]]]:
    """The tagger's spans of each text whose parts are those of a kind."""
    found: dict[int, dict[tuple[int, int, int], float]] = {}
    for where, x in laid_out(texts):
        for row, tag, above in zip(*tagger.decode(x), strict=True):
            i, a = where[row]
            size = min(WINDOW, len(texts[i]) - a)
            for b, e, k, score in in_window(tag[:size], above[:size], a == 0, a + size == len(texts[i])):
                own = found.setdefault(i, {})
                own[a + b, a + e, k] = own.get((a + b, a + e, k), 0.0) + score
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for i, spans in found.items():
        judged = [(a, *settled(KINDS[k], texts[i][a:b])) for a, b, k in reconciled(spans)]
        out[i] = [(a + first, a + last, kind) for a, kind, first, last in judged if kind]
    return out


def all_spans(texts: list[str], tagger: Tagger | None) -> Iterator[tuple[list, list]]:
    """Of each text the base spans, and those with the model's: spans that touch no base span are added."""
    for text, more in zip(texts, model_spans(texts, tagger) if tagger else [[] for _ in texts], strict=True):
        base = base_spans(text)
        more = [x for x in more if all(x[1] <= a or b <= x[0] for a, b, _ in base)]
        yield base, sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in angle brackets; where spans overlap, by the first's."""
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{k}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def example(text: str, rng: random.Random) -> tuple[np.ndarray, np.ndarray]:
    """A window of a text, somewhere or near a digit or an @, with its tags; often a variant() is put in."""
    hints = [m.start() for m in re.finditer("[0-9@]", text)] if rng.random() < 0.5 else []
    a = max(0, (rng.choice(hints) if hints else rng.randrange(len(text) + 1)) - rng.randrange(TAUGHT))
    part = text[a : a + TAUGHT]
    spans = base_spans(part)
    if rng.random() < 0.6:
        kind = rng.choice(KINDS)
        made = variant(kind, rng)
        free = [m.end() for m in re.finditer(r"\s", part) if not any(b < m.end() < e for b, e, _ in spans) and m.end() + len(made) < TAUGHT]
        if free:
            at = rng.choice(free)
            end = rng.choice([" ", " ", " ", ". ", ", ", "\n"])
            spans = [(b + (len(made) + len(end)) * (b >= at), e + (len(made) + len(end)) * (b >= at), k) for b, e, k in spans] + [(at, at + len(made), kind)]
            part = part[:at] + made + end + part[at:]
    x, y = np.full(TAUGHT, BLANK, np.uint8), np.zeros(TAUGHT, np.uint8)
    part = part[:TAUGHT]
    x[: len(part)] = symbols(part)
    y[: len(part)] = tags(max(len(part), *[e for _, e, _ in spans], 0), sorted(spans))[: len(part)]
    return x, y


def _fitted(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Fits a tagger in one task: the same for the same texts, in whatever order they come."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = sorted(t for batch in batches for t in batch["text"].to_pylist())
        if not texts:
            return
        rng = random.Random(9)
        x, y = map(np.stack, zip(*[example(texts[k % len(texts)], rng) for k in range(most)], strict=True))
        tagger = Tagger.fitted(x.astype(np.int64), y.astype(np.int64), 1 + 2 * len(KINDS), epochs=EPOCHS)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tagger.w)], pa.binary())], ["weights"])

    return of_partition


def trained(docs: DataFrame, *, most_windows: int = MOST_WINDOWS) -> Tagger | None:
    """A tagger fitted on a bounded sample: `most_windows` windows of as many texts at most; None where no text has a character.

    Texts are thinned by a hash before they are ordered by it, so that a task sends few. The fit is a task of its own; the
    driver gets the weights.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''").withColumn("hash", F.xxhash64("text"))
    thin = max(1, docs.count() // (4 * most_windows))
    start = F.pmod(F.col("hash"), F.greatest(F.lit(1), F.length("text") - SAMPLED)).cast("int") + 1
    parts = texts.where(F.pmod(F.col("hash"), F.lit(thin)) == 0).select("hash", F.substring(F.col("text"), start, F.lit(SAMPLED)).alias("text"))
    some = parts.orderBy("hash", "text").limit(most_windows).select("text")
    got = some.repartition(1).mapInArrow(_fitted(most_windows), "weights binary").collect()
    if not got:
        return None
    tagger = Tagger(1 + 2 * len(KINDS))
    tagger.w = pickle.loads(got[0]["weights"])
    return tagger


def _find(shared, carried: list[str], redact: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            both = list(all_spans(texts, shared.value))
            columns = {"doc_id": batch["doc_id"]}
            for kind in KINDS:
                columns[f"n_{kind}"] = pa.array([sum(k == kind for _, _, k in base) for base, _ in both], pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in both], pa.string())
            columns["spans"] = pa.array([written(spans) for _, spans in both], pa.string())
            if redact:
                columns["redacted"] = pa.array([redacted(t, spans) for t, (_, spans) in zip(texts, both, strict=True)], pa.string())
            columns |= {c: batch[c] for c in carried}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return of_partition


def personal_data(docs: DataFrame, *, redact: bool = False, carried: tuple[str, ...] = (), most_windows: int = MOST_WINDOWS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (of base spans), base_sha256, spans and, if asked for, the redacted text.

    Null and empty texts have no spans (base_sha256 is that of nothing). Null and repeated doc_ids return as they are;
    carried columns come back with a leading underscore. No rows give no rows. One pass, without a shuffle.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(trained(docs, most_windows=most_windows))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c).alias(f"_{c}") for c in carried])
    extra = [f"_{c}" for c in carried]
    schema = ["doc_id long", *[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string", *["redacted string"] * redact, *[f"`{c}` {own.schema[c].dataType.simpleString()}" for c in extra]]
    return own.mapInArrow(_find(model, extra, redact), ", ".join(schema))
