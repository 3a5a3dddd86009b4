"""Classification, highlights, summaries and relation fields, with model answers as landed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.functions.keywords import Words
from strataloom.functions.prompts import filled
from strataloom.functions.text import clean_highlight, cut, first_of, has_cjk, is_degraded, stripped, text_or_empty

OTHER = "其他"
# The categories that are known, with sample keywords of their rules. A deployment passes its own table.
TAXONOMY = {"磁性·自旋电子学": ["altermagnet", "spintronic"], "AI×物理": ["neural network"], "AI×化学·材料": ["machine learning"]}
# Methods that a direction note names.
METHODS = {"graph neural network": "图神经网络", "machine learning": "机器学习", "molecular dynamics": "分子动力学", "ferroelectric": "铁电"}
# Words of the topics that are followed, and the question that a model classifies by.
TOPICS = ["ferroelectric", "ferromagnetic", "multiferroic", "piezoelectric", "antiferroelectric", "antiferromagnetic", "magnetoelectric", "polarization", "magnetization", "domain wall", "skyrmion", "铁电", "铁磁", "多铁", "压电", "反铁电", "反铁磁", "磁电", "极化", "磁化", "畴壁", "斯格明子"]
CLASSIFY = "把下面这篇论文归入且仅归入这些类别之一（只输出类别名，不要解释）：$names、其他。\n标题：$title\n摘要：$text"
CLASSIFY_MOST = 600
NO_ABSTRACT = {"method_point": "仅有元数据，无法确认具体方法。", "related_work": "仅有元数据，不作强结论。", "implication": "待阅读原文后判断。"}


#: Up to so many words are sought one by one in generated code; more of them in one pass over the text. The result is the same.
FEW = 32


def any_of(text: Column, words: Sequence[str]) -> Column:
    if len(words) > FEW:
        return Words(SparkSession.active(), words).first(text).isNotNull()
    return F.coalesce(reduce(lambda a, b: a | b, [text.contains(w) for w in words], F.lit(False)), F.lit(False))


def first_match(text: Column, rules: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """The first name, in the table's order, of whose words the text has one."""
    if sum(map(len, rules.values())) > FEW:
        names, listed = list(rules), [(i, w) for i, words in enumerate(rules.values()) for w in words]
        first = Words(SparkSession.active(), [w for _, w in listed]).first(text)
        of_word = F.array(*[F.lit(i) for i, _ in listed])
        return F.coalesce(F.get(F.array(*[F.lit(n) for n in names]), F.get(of_word, first)), F.lit(otherwise))
    out = F.lit(otherwise)
    for name, words in reversed(list(rules.items())):
        out = F.when(any_of(text, words), name).otherwise(out)
    return out


def keyword_filter(df: DataFrame, text: Column, words: Sequence[str]) -> DataFrame:
    return df.where(any_of(F.lower(text), [w.lower() for w in words]))


def on_topic(items: DataFrame, text: Column, topics: Sequence[str] = TOPICS) -> DataFrame:
    """The items whose text has a word of the followed topics."""
    return keyword_filter(items, text, topics)


def relevant(judged: Column) -> Column:
    """A model's judgement; what it couldn't judge stays."""
    return F.coalesce(judged.cast("boolean"), F.lit(True))


def named_in(answer: Column, names: Sequence[str]) -> Column:
    """The longest of the names that an answer contains (ties by name), else OTHER."""
    ordered = sorted({*names, OTHER}, key=lambda n: (-len(n), n))
    return first_match(text_or_empty(answer), {n: [n] for n in ordered}, OTHER)


def classify(text: Column, answer: Column, rules: Mapping[str, Sequence[str]] = TAXONOMY) -> Column:
    """A rule's category; only where no rule matches, the one that the answer names."""
    rule = first_match(F.lower(text_or_empty(text)), rules, OTHER)
    return F.when(rule != OTHER, rule).otherwise(named_in(answer, list(rules)))


def classify_requests(items: DataFrame, rules: Mapping[str, Sequence[str]] = TAXONOMY) -> DataFrame:
    """The items (title, summary, abstract) that no rule decides, with the `prompt` that asks a model: only they cost a call."""
    text = F.concat_ws(" ", "title", "summary", "abstract")
    open_ = items.where(first_match(F.lower(text), rules, OTHER) == OTHER)
    said = F.substring(first_of(F.col("summary"), F.col("abstract")), 1, CLASSIFY_MOST)
    return open_.withColumn("prompt", filled(CLASSIFY, names=F.lit("、".join(rules)), title=F.col("title"), text=said))


def needs_highlight(summary: Column, abstract_zh: Column, abstract: Column) -> Column:
    return (clean_highlight(summary) == "") & (stripped(text_or_empty(abstract_zh)) == "") & (stripped(text_or_empty(abstract)) != "")


def fill_highlights(items: DataFrame, generated: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """Fills one_sentence_summary of each group's first `most` candidates, by order, in a new column `filled`.

    generated has group, index (from 1) and highlight, the answer to a batch of candidates; items may have `translated`,
    which stands in where it is Chinese and not the abstract's beginning itself. What is already there stays.
    """
    wanted = needs_highlight(F.col("one_sentence_summary"), F.col("abstract_zh"), F.col("abstract"))
    nth = F.row_number().over(Window.partitionBy(group).orderBy(order))
    todo = items.where(wanted).withColumn("index", nth).where(F.col("index") <= most)
    translated = clean_highlight(F.col("translated"))
    usable = (translated != "") & (translated != F.substring(stripped(F.col("abstract")), 1, 200)) & has_cjk(translated)
    made = clean_highlight(F.col("highlight"))
    new = todo.join(generated, [group, "index"], "left").select(group, order, F.when((made != "") & has_cjk(made), made).when(usable, translated).alias("filled"))
    return items.join(new, [group, order], "left")


def pick_summary(sentence: Column, abstract_zh: Column, abstract_zh_full: Column, abstract: Column) -> Column:
    """The first usable of the sentence, the Chinese abstracts and the English abstract's first 200 characters."""
    clean = lambda c: F.when(is_degraded(c), "").otherwise(stripped(text_or_empty(c)))
    return first_of(clean(sentence), clean(abstract_zh), clean(abstract_zh_full), cut(clean(abstract), 200))


def relation_fields(df: DataFrame) -> DataFrame:
    """Fills method_point, related_work, implication and summary where they are empty; claims nothing without an abstract."""
    methods = direction_note(F.concat_ws(" ", "title_en", "abstract"))
    bare = stripped(text_or_empty(F.col("abstract"))) == ""
    said = {"method_point": F.concat(F.lit("方法："), methods), "related_work": F.concat(F.lit("相关方向："), methods), "implication": F.concat(F.lit("启示："), methods)}
    new = {k: first_of(F.col(k), F.when(bare, NO_ABSTRACT[k]).otherwise(v)) for k, v in said.items()}
    usable = F.when(is_degraded(F.col("summary")), "").otherwise(text_or_empty(F.col("summary")))
    new["summary"] = first_of(usable, pick_summary(F.lit(""), F.col("abstract_zh"), F.lit(""), F.col("abstract")), F.col("title_en"))
    return df.withColumns(new)


def profile_digest(profile: DataFrame) -> DataFrame:
    """One line for each person of a profile (person, nth, direction, materials): the directions in order, each with its materials."""
    of = F.when(F.coalesce(F.size("materials"), F.lit(0)) > 0, F.concat(F.lit("（"), F.array_join("materials", "、"), F.lit("）"))).otherwise("")
    line = F.concat(F.col("direction"), of)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", line.alias("line")))), lambda x: x["line"]), "；")
    return profile.groupBy("person").agg(F.concat(F.first("person"), F.lit("："), listed).alias("digest"))


def direction_note(text: Column, methods: Mapping[str, str] = METHODS) -> Column:
    """The methods that a text names, joined; a general word where it names none."""
    found = F.array_compact(F.array(*[F.when(F.lower(text).contains(k), v) for k, v in methods.items()]))
    return F.when(F.size(found) > 0, F.array_join(found, "、")).otherwise("一般方法")
