"""Quality rules, the prefix trie and the divergence audit against brute force, SQL and odd tables."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from math import exp, log

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataloom.llm import divergence, prefix_trie, queries, weak_quality
from strataloom.llm.common import dropped

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_quality", "op12_prefix_trie", "op13_divergence"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet{'/*' * os.path.isdir(f'{SF}/{t}.parquet')}'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == columns
    assert Counter(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == Counter(map(repr, con.sql(f"select {', '.join(columns)} from ({queries.ORACLE_SQL[name]})").fetchall()))


# --- quality rules ------------------------------------------------------------------------------------


def repeated(words):
    n = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return len({i + k for i in range(len(words) - 4) if n[tuple(words[i : i + 5])] > 1 for k in range(5)})


def measures(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated(words)


ODD = [
    None, "", " \n\t\x0b\x0c\r ", "one", "a b c d", "a b c d e", "a b c d e f", "a b c d e a b c d e", "x " * 4, "x " * 5, "x " * 6, "x " * 7, " nbsp 　is a word here", "l\nl\n l\nl \n\n\nl",
    "a b c d e X a b c d e Y a b c d e", "a\x1fb c", "#*$%&|<> # ##", "𝄞 é ß " * 30, "﻿z" * 3, "w " * 3000, " ".join(f"v{i}" for i in range(3000)) + " v7 v8 v9 v10 v11 v12", "long" * 50_000,
]


def test_measures(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choices(["a", "b", "c", "dé", " ", "  ", "\n", "#"], k=rng.randint(0, 60))) + " " + " ".join(rng.choices("abc", k=rng.randint(0, 40))) for _ in range(300)]
    rows = [(None if i % 7 == 0 else i % 90, t, "no") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, words string").repartition(3)
    got, at = weak_quality.judged(docs)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = Counter()
    for d, t, _ in rows:
        m = measures(t)
        want[d, *m, m[0] < 10 or 100 * m[4] > 20 * m[0]] += 1
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == want
    assert all(not r["kept"] for r in got.where("base_failed").collect())
    dropped(spark, at)


def test_windows_of_one_hash_are_told_apart(spark):
    """Hashes of 50 values only: all that they mistake is found out by the words."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcd", k=rng.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame([(t, t.split()) for t in texts], "t string, words array<string>")
    weak = weak_quality.repeated_words(F.col("words"), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(50)))
    assert all(r["n"] == repeated(r["words"]) for r in df.select("words", weak.alias("n")).collect())


def test_model_and_verdicts(spark):
    """Expectation-maximisation in plain Python over the same votes gives the same posteriors; three kinds of junk are told from prose."""
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) + ("." if rng.random() < 0.1 else "") for _ in range(n))
    loud = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) + rng.choice(["###", "&&&", "***"]) for _ in range(n))
    menu = lambda n: " | ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))
    texts = [(prose(rng.randint(30, 300)), True) for _ in range(240)] + [(loud(rng.randint(30, 200)), False) for _ in range(20)] + [(menu(rng.randint(30, 200)), False) for _ in range(20)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in weak_quality.judged(docs)[0].collect()}
    assert all(got[i]["kept"] == good for i, (_, good) in enumerate(texts))
    seen = Counter(tuple(got[i]["votes"]) for i in got)
    n, low = len(weak_quality.RULES), weak_quality.WITHIN
    good, rates = weak_quality.PRIOR, [weak_quality.BEGIN] * n
    posterior = lambda v: 1 / (1 + exp(-(log(good / (1 - good)) + sum(log(a / (1 - b)) if x == 1 else log((1 - a) / b) if x == -1 else 0 for x, (a, b) in zip(v, rates, strict=True)))))
    inside = lambda a, b: min(1 - low, max(low, a / b)) if b else 0.5
    for _ in range(weak_quality.ROUNDS):
        q = {v: posterior(v) for v in seen}
        rates = [(inside(sum(c * q[v] for v, c in seen.items() if v[k] == 1), sum(c * q[v] for v, c in seen.items() if v[k])), inside(sum(c * (1 - q[v]) for v, c in seen.items() if v[k] == -1), sum(c * (1 - q[v]) for v, c in seen.items() if v[k]))) for k in range(n)]
        good = inside(sum(c * q[v] for v, c in seen.items()), sum(seen.values()))
    assert all(abs(r["quality"] - posterior(tuple(r["votes"]))) < 1e-9 for r in got.values())


def test_quality_against_labels(spark):
    """At sf0.1: of documents labelled good that the base conditions let pass nearly all stay, of those labelled poor nearly none."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    out = weak_quality.judged(docs)[0].where("not base_failed").join(labels, "doc_id")
    n = {(r["label"], r["kept"]): r["count"] for r in out.groupBy("label", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.002 * n[1, True] and n.get((0, True), 0) <= 0.05 * n[0, False], n


def test_quality_is_built_in_functions_only(spark):
    out = weak_quality.measured(spark.read.parquet(f"{SF}/documents.parquet"))
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())
    empty = weak_quality.judged(spark.createDataFrame([], "doc_id long, text string"))[0]
    assert empty.count() == 0


# --- the prefix trie --------------------------------------------------------------------------------------


def plain_trie(rows):
    """conv_id, depth, parent, members, children, leaves, saved, digest of each node, from sequences of turns."""
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own[r[0]].append((r[2] or "", r[3] or ""))
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    digest = lambda c: hashlib.sha256(",".join(map(str, sorted(c))).encode()).hexdigest()
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], digest(ends.get(k, []))) for k, m in members.items())


def made_trie(df, **more):
    out, scratch = prefix_trie.trie(df, **more)
    got = Counter(map(tuple, out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))
    for at in scratch:
        dropped(df.sparkSession, at)
    return got


def conversations(seed, n=120, longest=14):
    """Few different turns, so conversations share beginnings of every length; some are copies, some end early."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 260), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, None if rng.random() < 0.03 else t, rng.choice(["user", "assistant", None]) if t < 2 else "user", rng.choice(["", "ja", None, "né " * 3]) if t % 4 == 1 else f"t{t % 3}"))
    rows += [(c, t, "user", f"same{t}") for c in range(300, 340) for t in range(12)]
    return rows + rng.sample(rows, 25)  # repeated rows are turns


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", range(2))
def test_trie(spark, seed):
    rows = conversations(seed) + [(None, 0, "user", "nobody's")]
    df = spark.createDataFrame([(*r, "no") for r in rows], f"{SCHEMA}, depth string").repartition(5)
    assert made_trie(df) == plain_trie(rows)


def test_colliding_fingerprints_are_split(spark):
    """Fields of a few hundred elements: many prefixes have another's fingerprint, and texts tell them apart."""
    rows = conversations(9, 60, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    rounds, plain = [], prefix_trie._nodes
    prefix_trie._nodes = lambda *a: rounds.append(1) or plain(*a)
    try:
        assert made_trie(df, fields=(17, 13)) == plain_trie(rows)
    finally:
        prefix_trie._nodes = plain
    assert len(rounds) > 1


def test_one_conversation_over_many_parts(spark):
    """A conversation with nearly all turns is scanned by several tasks, whose sums are carried on."""
    rng = random.Random(4)
    rows = [(5, t, "user", f"{rng.random()}") for t in range(3000)] + [(6, t, "user", "x") for t in range(12)] + [(7, 0, "user", "y")]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(6)
        scanned = df.repartitionByRange(7, "conv_id", "turn").sortWithinPartitions("conv_id", "turn").select("conv_id", "role", "text").mapInArrow(prefix_trie._scan(prefix_trie.FIELDS, {}), prefix_trie.SCANNED)
        assert scanned.where("conv_id = 5").select("part").distinct().count() >= 4
        assert made_trie(df) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_group_sends_few_rows():
    """Rows of one fingerprint become one row of the task, with their number and the least conversation."""
    names = [x.split()[0] for x in prefix_trie.NODE.split(", ")]
    rows = [(1, 9, 0, c, 1, 0, 1, "user", "x" if c % 50 else "other") for c in range(500, 0, -1)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)
    got = [tuple(r.values()) for r in prefix_trie._combined([batch]).to_pylist()]
    assert got == [(1, 9, 0, 1, 490, 0, 1, "user", "x"), (1, 9, 0, 50, 10, 0, 1, "user", "other")]


def test_empty_conversations(spark):
    assert made_trie(spark.createDataFrame([], SCHEMA)) == Counter()
    assert made_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)) == Counter()
    assert made_trie(spark.createDataFrame([(3, None, None, None)], SCHEMA)) == plain_trie([(3, None, None, None)])


# --- the divergence audit -------------------------------------------------------------------------------------


def plain_audit(rows, least=3, top=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(a or "", b or "", ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in term.findall(t or "")]) for a, b, t in rows]
    df, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        df[lang].update(set(words))
        count[lang, source].update(words)
    out = Counter()
    for lang in {d[0] for d in docs}:
        kept = sorted(w for w, n in df[lang].items() if n >= least)
        groups = sorted(s for x, s in count if x == lang)
        share = {}
        for s in [None, *groups]:
            c = {w: sum(count[lang, x][w] for x in groups) if s is None else count[lang, s][w] for w in kept}
            total = sum(c.values())
            share[s] = {w: 1 + 10**9 * (c[w] + 1) // (total + len(kept)) for w in kept}
        f = lambda p, q: (p - q) * (p - q) // q
        for s in groups:
            pairs = [(t, sum(f(share[s][w], share[t][w]) for w in kept)) for t in groups if t != s]
            terms = [(w, f(share[s][w], share[None][w])) for w in kept if count[lang, s][w] and share[s][w] > share[None][w]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                    out[lang, s, part, item, value, rank] += 1
    return out


def made_audit(df, **more):
    out, scratch = divergence.audit(df, **more)
    got = Counter(map(tuple, out.select("lang", "source", "part", "item", "value", "rank").collect()))
    for at in scratch:
        dropped(df.sparkSession, at)
    return got


def audited(seed):
    rng = random.Random(seed)
    words = [f"{rng.choice(['Wort', 'été', 'AbC', 'Ünd', 'x', '語'])}{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8 % 8]}" for i in range(90)]
    rows = []
    for i in range(260):
        source = "hot" if rng.random() < 0.35 else rng.choice(["s1", "s2", "s3", None, "none"])
        own = words[:60] if source == "hot" else words[20:]
        rows.append((rng.choice(["en", "de", None]), source, None if source == "none" else " ".join(rng.choices(own, k=rng.randint(0, 30))) + rng.choice(["", "1@[`{~ \x7f", " Z", " ʼn’tÀB"])))
    return rows + rows[:10] + [("lone", "only", "a a a"), ("bare", "p", ""), ("bare", "q", None), ("bare", "r", "once")]


@pytest.mark.parametrize(("seed", "top"), [(1, 200), (2, 3)])
def test_audit(spark, seed, top):
    rows = audited(seed)
    df = spark.createDataFrame([(*r, "no") for r in rows], "lang string, source string, text string, term string").repartition(4)
    assert made_audit(df, top=top) == plain_audit(rows, top=top)


def test_audit_of_blocks(spark, monkeypatch):
    """Counts of a few texts at a time, from slices, add up to the same."""
    rows = [("x", f"s{i % 5}", f"w{i % 7} u v w") for i in range(60)]
    rows = [(a, b, t.replace("0", "a").replace("1", "b").replace("2", "c").replace("3", "d").replace("4", "e").replace("5", "f").replace("6", "g")) for a, b, t in rows]
    names = ["lang", "source", "text"]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)
    plain = Counter()
    for b in divergence._counted(iter([batch])):
        for r in b.to_pylist():
            plain[r["lang"], r["source"], r["term"]] += r["n"] * 1000 + r["docs"]
    monkeypatch.setattr(divergence, "BYTES", 16)
    early = Counter()
    parts = list(divergence._counted(iter([*(batch.slice(i, 3) for i in range(0, 60, 3)), batch.slice(0, 0)])))
    for b in parts:
        b.validate(full=True)
        for r in b.to_pylist():
            early[r["lang"], r["source"], r["term"]] += r["n"] * 1000 + r["docs"]
    assert early == plain and len(parts) > 2


def test_shares_that_overflow_a_long(spark):
    """10**9 times a count is beyond 64 bits; shares are whole numbers all the same."""
    big = 10**12
    df = spark.createDataFrame([(big, 3 * big, 7), (0, 0, 1), (big, big, 10**6)], "c long, n long, v long")
    got = [r[0] for r in df.select(divergence.share("c", "n", "v")).collect()]
    assert got == [1 + 10**9 * (c + 1) // (n + v) for c, n, v in ((big, 3 * big, 7), (0, 0, 1), (big, big, 10**6))]


def test_empty_audit(spark):
    assert made_audit(spark.createDataFrame([], "lang string, source string, text string")) == Counter()
    rows = [("a", "s", None), (None, None, ""), ("a", "t", "...")]
    assert made_audit(spark.createDataFrame(rows, "lang string, source string, text string")) == plain_audit(rows)
