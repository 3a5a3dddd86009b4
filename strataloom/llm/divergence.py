"""Source divergence audit: how unlike the word shares of a language's sources are, from joint histograms of counts.

A term's share follows from its count alone, so a pair of sources is a table of (count, count) combinations with the number of
terms that have each; the divergence is evaluated once for a combination.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.common import prepare, stored, utf8

# The bytes of terms (letters, and all of characters beyond ASCII), and the lower case of A to Z.
LETTERS = np.isin(np.arange(256), [*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], invert=True)
LOWER = np.where(np.isin(np.arange(256), np.arange(65, 91)), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
LEAST_DOCS, TOP = 3, 200
#: Bytes of texts that are counted at a time, and entries that are paired at a time.
BYTES, ENTRIES = 1 << 23, 1 << 17


def terms(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The row and the term of each run of letters, from rows' bytes end to end."""
    solid = LETTERS[raw]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cuts = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(raw))]  # a term ends with its row
    first[cuts] |= solid[cuts]
    last[cuts - 1] |= solid[cuts - 1]
    start = np.flatnonzero(first)
    ends = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - start)])
    body = pa.py_buffer(LOWER[raw[solid]])
    return np.searchsorted(off, start, "right") - 1, pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int64)), body)


def _of_texts(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    """n and docs, how often and in how many of the texts, by lang, source and term."""
    table = pa.Table.from_batches(rows)
    doc, term = terms(*utf8(table["text"]))
    coded = term.dictionary_encode()
    group = table.select(["lang", "source"]).append_column("n", pa.array(np.arange(len(table)))).group_by(["lang", "source"], use_threads=False).aggregate([("n", "list")])
    of_doc = np.zeros(len(table), np.int64)
    members = group["n_list"].combine_chunks()
    of_doc[members.flatten().to_numpy()] = members.value_parent_indices().to_numpy()
    k = max(1, len(coded.dictionary))
    own, times = np.unique(doc * k + coded.indices.to_numpy(), return_counts=True)
    key, at = np.unique(of_doc[own // k] * k + own % k, return_inverse=True)
    n = np.bincount(at, times, len(key)).astype(np.int64)
    of, word = pa.array(key // k), pa.array(key % k)
    return pa.RecordBatch.from_arrays([group["lang"].combine_chunks().take(of), group["source"].combine_chunks().take(of), coded.dictionary.take(word).cast(pa.string()), pa.array(n), pa.array(np.bincount(at, minlength=len(key)))], ["lang", "source", "term", "n", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's documents, BYTES of texts at a time; a longer text is counted by itself."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch["text"].nbytes
        if size > BYTES:
            yield _of_texts(held)
            held, size = [], 0
    if size:
        yield _of_texts(held)


def _pairs(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    """How many of the rows' terms have each pair of counts in each pair of sources that both have the term."""
    table = pa.Table.from_batches(rows)
    found = table["found"].combine_chunks()
    entry = pc.list_flatten(found)
    row = pc.list_parent_indices(found).to_numpy()
    source, n = entry.field("source").dictionary_encode(), entry.field("n").to_numpy()
    code = source.indices.to_numpy()
    lang = table["lang"].combine_chunks().dictionary_encode()
    of_row = lang.indices.to_numpy()
    made = []
    step = 1
    while True:  # entries of a row are in the order of sources, so the first of a pair is before the second
        i = np.flatnonzero(row[:-step] == row[step:]) if step < len(row) else []
        if not len(i):
            break
        made.append(pa.table({"lang": of_row[row[i]], "s": code[i], "t": code[i + step], "a": n[i], "b": n[i + step]}).group_by(["lang", "s", "t", "a", "b"]).aggregate([([], "count_all")]))
        step += 1
    names = ["lang", "s", "t", "a", "b", "m"]
    if not made:
        return pa.RecordBatch.from_arrays([pa.array([], pa.string())] * 3 + [pa.array([], pa.int64())] * 3, names)
    all_ = pa.concat_tables(made).group_by(["lang", "s", "t", "a", "b"]).aggregate([("count_all", "sum")])
    column = lambda c: all_[c].combine_chunks()
    return pa.RecordBatch.from_arrays([lang.dictionary.take(column("lang")), source.dictionary.take(column("s")), source.dictionary.take(column("t")), column("a"), column("b"), column("count_all_sum")], names)


def _joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch["found"].flatten())
        if size > ENTRIES:
            yield _pairs(held)
            held, size = [], 0
    if held:
        yield _pairs(held)


def share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(10**9 * (count + 1) / (total + terms)), in whole numbers that can't overflow."""
    c, n, v = (F.col(x) if isinstance(x, str) else x for x in (count, total, terms))
    return F.call_function("div", F.lit(1000000000).cast("decimal(20,0)") * (c + 1).cast("decimal(18,0)"), (n + v).cast("decimal(38,0)")).cast("long") + 1


def unlike(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top: int = TOP) -> tuple[DataFrame, list[str]]:
    """lang, source, part, item, value and rank of every source of each language in docs (lang, source, text).

    Part `pair` has each other source of the language, part `term` the top terms that a source has more of than its language. Only terms
    in `least_docs` documents of the language count. Null lang, source and text are empty strings, which are a language, a source
    and a text without terms. Each row is a document of its own, so repeated rows count; other columns aren't read. No rows give
    no rows. Also returns the scratch tables to delete in the end.
    """
    spark = docs.sparkSession
    prepare(spark)
    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = own.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    # What tasks counted meets by term; the largest key has a row for each task and source.
    by_source = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("found"))
    kept, at = stored(terms.where(F.col("docs") >= least_docs).drop("docs"), "terms")

    entries = kept.select("lang", "term", F.col("n").alias("of_lang"), F.inline("found"))
    hist, to = stored(entries.groupBy("lang", "source", F.col("n").alias("a")).agg(F.count("*").alias("m")), "histograms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("total_lang"))
    sums = hist.groupBy("lang", "source").agg(F.sum(F.col("a") * F.col("m")).alias("total"))
    groups = own.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v", "total_lang"])

    # Every unordered pair of sources, its first the lesser, with the sums that shares need.
    side = lambda name: groups.select("lang", F.col("source").alias(name), F.col("total").alias(f"total_{name}"), *(["v"] if name == "s" else []))
    pairs = side("s").join(side("t"), "lang").where("s < t")

    # Cells (a, b) of a pair's table. Terms that both have come by combination; those that only one has are its histogram less these, and
    # those that neither has are the rest. So each of these counts is added where it belongs and taken off where it was counted before.
    both = kept.select("lang", "found").where(F.size("found") > 1).mapInArrow(_joint, "lang string, s string, t string, a long, b long, m long")
    summed = both.groupBy("lang", "s", "t", "a", "b").agg(F.sum("m").alias("m"))
    cell = lambda a, b, m: F.struct(F.lit(a).cast("long").alias("a") if isinstance(a, int) else F.col(a).alias("a"), F.lit(b).cast("long").alias("b") if isinstance(b, int) else F.col(b).alias("b"), m.alias("m"))
    m, less = F.col("m"), -F.col("m")
    shared = summed.select("lang", "s", "t", F.inline(F.array(cell("a", "b", m), cell("a", 0, less), cell(0, "b", less), cell(0, 0, m))))
    named = pairs.select("lang", "s", "t")
    first = named.join(hist.withColumnRenamed("source", "s"), ["lang", "s"]).select("lang", "s", "t", F.inline(F.array(cell("a", 0, m), cell(0, 0, less))))
    second = named.join(hist.select("lang", F.col("source").alias("t"), F.col("a").alias("b"), "m"), ["lang", "t"]).select("lang", "s", "t", F.inline(F.array(cell(0, "b", m), cell(0, 0, less))))
    neither = pairs.select("lang", "s", "t", F.inline(F.array(cell(0, 0, F.col("v")))))
    cells = shared.unionByName(first).unionByName(second).unionByName(neither).groupBy("lang", "s", "t", "a", "b").agg(F.sum("m").alias("m"))

    # An empty language's cell counts nothing.
    shares = cells.join(pairs, ["lang", "s", "t"]).withColumn("v", F.greatest("v", F.lit(1))).withColumns({"p": share("a", "total_s", "v"), "q": share("b", "total_t", "v")})
    values = shares.groupBy("lang", "s", "t").agg(F.sum(m * unlike(F.col("p"), F.col("q"))).alias("x"), F.sum(m * unlike(F.col("q"), F.col("p"))).alias("y"))
    way = lambda a, b, value: F.struct(F.col(a).alias("source"), F.col(b).alias("item"), F.col(value).alias("value"))
    by_pair = values.select("lang", F.inline(F.array(way("s", "t", "x"), way("t", "s", "y"))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    of_pairs = by_pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    told = entries.join(groups, ["lang", "source"]).withColumns({"p": share("n", "total", "v"), "q": share("of_lang", "total_lang", "v")}).where("p > q")
    ranked = told.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), unlike(F.col("p"), F.col("q")).alias("value"))
    of_terms = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return of_pairs.unionByName(of_terms), [at, to]
