"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation estimates how right they are, and the posterior decides.

Everything is a built-in function: texts are measured in their own row, what rules say of a document is one number, and
the model is fitted over the counts of these numbers, of which there are 3 ** (number of rules) at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import stored

# What separates words, and the characters that count as symbols.
WHITE, GAP, SYMBOLS = " \t\n\x0b\f\r", r"[\x20\x09-\x0D]+", "[#*$%&|<>]"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Rounds of expectation-maximisation, the rates that they begin with, and what each rate is kept within.
ROUNDS, BEGIN, PRIOR, WITHIN = 40, (0.95, 0.6), 0.8, 0.001


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value computed once."""
    return F.transform(F.array(value), then)[0]


def covered(starts: Column) -> Column:
    """How many words windows cover that begin at the given words, which are in order."""
    step = lambda s, i: F.when(i + 1 < F.size(starts), F.least(F.lit(WINDOW), F.get(starts, i + 1) - s)).otherwise(WINDOW)
    return F.aggregate(F.transform(starts, step), F.lit(0), lambda a, x: a + x)


def repeated_words(words: Column, hashed: Callable[[Column, Column], Column] = lambda a, b: F.xxhash64(a, b)) -> Column:
    """How many words stand in a window that the text has twice or more.

    A window's first four words are hashed by two at a time; where all these hashes differ no window stands twice. Else the windows' hashes are
    sorted, and neighbours of one hash are compared word by word. Should they differ, windows are sorted as they are spelt.
    """
    after = lambda rows, k: F.slice(rows, k + 1, F.greatest(F.size(rows) - k, F.lit(0)))
    joined = lambda rows, k, f: F.zip_with(rows, after(rows, k), f)
    whole = lambda rows: F.slice(rows, 1, F.size(words) - WINDOW + 1)  # noqa: E731  the last ones lack words

    def windows(f: Callable[[Column, Column], Column], then: Callable[[Column], Column]) -> Column:
        return let(joined(words, 1, f), lambda two: let(joined(two, 2, f), then))

    def neighbours(rows: Column) -> Column:
        """Where equal ones of the windows begin, two at a time."""
        order = F.sort_array(F.transform(rows, lambda x, i: F.struct(x.alias("x"), i.alias("at"))))
        pair = lambda a, b: F.when(a["x"] == b["x"], F.struct(a["at"].alias("i"), b["at"].alias("j")))
        return F.filter(let(order, lambda o: joined(o, 1, pair)), lambda p: p.isNotNull())

    starts = lambda pairs: F.sort_array(F.concat(F.transform(pairs, lambda p: p["i"]), F.transform(pairs, lambda p: p["j"])))
    five = lambda f: windows(f, lambda four: whole(F.zip_with(four, after(words, 4), f)))
    alike = lambda p: reduce(lambda a, b: a & b, [F.get(words, p["i"] + k) == F.get(words, p["j"] + k) for k in range(WINDOW)])
    spelt = let(neighbours(five(lambda a, b: F.concat_ws(" ", a, b))), lambda pairs: let(starts(pairs), covered))
    exact = let(neighbours(five(hashed)), lambda pairs: F.when(F.forall(pairs, alike), let(starts(pairs), covered)).otherwise(spelt))
    differ = let(windows(hashed, whole), lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(F.size(words) <= WINDOW, 0).when(differ, 0).otherwise(exact)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, and what the rules need to know of each text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = F.btrim(F.col("text"), F.lit(WHITE))
    own = docs.select(F.col("doc_id"), text.alias("text"))
    read = own.select(
        "doc_id",
        "text",
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias("lines"),
    )
    without = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    return read.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        without(r"\P{L}+").cast("long").alias("n_letters"),
        without(r"\P{Lu}+").cast("long").alias("n_capitals"),
    )


#: What speaks against a document and what for it, by rule; where neither holds the rule abstains. Of shares both sides are whole numbers.
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words < 20", "n_words >= 50"),
    "word_length": ("word_chars < 2 * n_words OR word_chars > 15 * n_words", "word_chars BETWEEN 3 * n_words AND 12 * n_words"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "lines": ("10 * n_dup_lines > 3 * n_lines", "n_lines > 1 AND n_dup_lines = 0"),
    "windows": ("10 * n_repeat_words > n_words", "50 * n_repeat_words <= n_words"),
    "letters": ("100 * n_letters < 80 * word_chars", "100 * n_letters >= 92 * word_chars"),
    "capitals": ("2 * n_capitals > n_letters", "5 * n_capitals <= n_letters"),
}


def votes(rules: dict[str, tuple[str, str]]) -> Column:
    """What the rules say, as an array: 1 for, -1 against, 0 abstains."""
    return F.array(*[F.when(F.expr(against), -1).when(F.expr(for_), 1).otherwise(0) for against, for_ in rules.values()])


def numbered(said: Column, n: int) -> Column:
    """The votes as one number in base 3."""
    return F.aggregate(said, F.lit(0), lambda a, v: a * 3 + v + 1)


def quality(model: Column, said: Column) -> Column:
    """The posterior probability that a document with these votes is good.

    The model has the share `good` of good documents and, by rule, how often its vote is `right` on good documents and on `poor` ones.
    """
    log_odds = lambda r: F.log(r["good"] / (1 - r["poor"])) * (r["vote"] == 1).cast("int") + F.log((1 - r["good"]) / r["poor"]) * (r["vote"] == -1).cast("int")
    each = F.zip_with(model["rates"], said, lambda r, v: log_odds({"good": r["good"], "poor": r["poor"], "vote": v}))
    odds = F.aggregate(each, F.log(model["good"] / (1 - model["good"])), lambda a, x: a + x)
    return 1 / (1 + F.exp(-odds))


def fitted(seen: Column, n: int, rounds: int = ROUNDS) -> Column:
    """The model of votes: seen is an array of (code, said, n), one for each combination of votes.

    Rules begin as right as BEGIN says, on good and on poor documents; each round takes the posteriors as they
    are and counts anew how often a rule that votes is right on good and on poor documents. A rate that would be 0 or 1 is kept within a small distance.
    """
    inside = lambda x: F.greatest(F.lit(WITHIN), F.least(F.lit(1 - WITHIN), x))
    sum_of = lambda rows, of: F.aggregate(rows, F.lit(0.0), lambda a, x: a + of(x))
    rate = lambda right, all_: F.when(all_ > 0, inside(right / all_)).otherwise(F.lit(0.5))
    first = F.struct(F.lit(PRIOR).alias("good"), F.array_repeat(F.struct(F.lit(BEGIN[0]).alias("good"), F.lit(BEGIN[1]).alias("poor")), n).alias("rates"))

    def counted(rows: Column) -> Column:
        """rows: (said, good, poor), the documents of each combination dealt between the two classes."""

        def of_rule(r: Column) -> Column:
            said = lambda x: F.get(x["said"], r)
            sums = F.struct(
                sum_of(rows, lambda x: F.when(said(x) == 1, x["good"]).otherwise(0.0)).alias("good_right"),
                sum_of(rows, lambda x: F.when(said(x) != 0, x["good"]).otherwise(0.0)).alias("good"),
                sum_of(rows, lambda x: F.when(said(x) == -1, x["poor"]).otherwise(0.0)).alias("poor_right"),
                sum_of(rows, lambda x: F.when(said(x) != 0, x["poor"]).otherwise(0.0)).alias("poor"),
            )
            return let(sums, lambda s: F.struct(rate(s["good_right"], s["good"]).alias("good"), rate(s["poor_right"], s["poor"]).alias("poor")))

        good = rate(sum_of(rows, lambda x: x["good"]), sum_of(rows, lambda x: x["good"] + x["poor"]))
        return F.struct(good.alias("good"), F.transform(F.sequence(F.lit(0), F.lit(n - 1)), of_rule).alias("rates"))

    def step(model: Column, _: Column) -> Column:
        dealt = F.transform(seen, lambda s: let(quality(model, s["said"]), lambda q: F.struct(s["said"].alias("said"), (s["n"] * q).alias("good"), (s["n"] * (1 - q)).alias("poor"))))
        return let(dealt, counted)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, step)


def judged(docs: DataFrame, *, rules: dict[str, tuple[str, str]] | None = None, rounds: int = ROUNDS) -> tuple[DataFrame, str]:
    """doc_id, the measures, votes (by rule), base_failed, quality (a probability) and kept of each row of docs (doc_id, text).

    A document is kept if the base conditions hold (10 words, at most a fifth of them in repeated windows) and its quality is at
    least a half. Null texts have no words. Repeated rows and null ids are documents of their own; other columns aren't read. No
    rows give no rows. Also returns the scratch table to delete in the end: texts are read once, their measures are stored.
    """
    rules = RULES if rules is None else rules
    names = list(rules)
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = measured(docs).withColumn("said", votes(rules)).withColumn("base_failed", base)
    kept, at = stored(rows.withColumn("code", numbered(F.col("said"), len(rules))), "measured")
    # Base conditions decide alone where they fail, so the model is of the other documents.
    seen = kept.groupBy("code").agg(F.first("said").alias("said"), F.count_if(~F.col("base_failed")).alias("n"))
    gathered = seen.agg(F.sort_array(F.collect_list(F.struct("code", "said", "n"))).alias("seen"))
    model = gathered.select("seen", fitted(F.col("seen"), len(rules), rounds).alias("model"))
    # One row for each combination of votes: 3 ** len(rules) at most.
    posterior = model.select("model", F.inline("seen")).select("code", quality(F.col("model"), F.col("said")).alias("quality"))
    out = kept.join(F.broadcast(posterior), "code")
    by_rule = F.struct(*[F.get("said", i).alias(name) for i, name in enumerate(names)])
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *measures, "base_failed", (~F.col("base_failed") & (F.col("quality") >= 0.5)).alias("kept"), "quality", by_rule.alias("votes")), at
