"""The pipeline's stages, each against a plain version on its own input."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from strataloom.llm import bpe, common, pii, simhash
from strataloom.llm.common import stored, table
from tests.llm.test_queries import WORD, cut_bytes, odd, sha  # noqa: F401

SF = "/root/testdata/sf0.001"


def near_pairs(texts, similarity=0.8):
    """All pairs of different texts that resemble each other so much or more in five-word shingles, by exact counts.

    Only pairs that share one of their rarest shingles can: at least similarity * n of n must be shared.
    """
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for t in texts for w in [WORD.findall(t)]]
    often = Counter(x for s in sets for x in s)
    meet = defaultdict(list)
    for k, s in enumerate(sets):
        for x in sorted(s, key=lambda x: (often[x], x))[: len(s) - int(similarity * len(s) - 1e-9)]:
            meet[x].append(k)
    pairs = {(a, b) for some in meet.values() for n, a in enumerate(some) for b in some[n + 1 :]}
    return [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]


def least_of_groups(rows):
    """The least id of each group that equal texts and near pairs connect, and the ids that have an earlier, not equal, near text."""
    first = {}
    for d, t in sorted(rows):
        first.setdefault(t, d)
    texts = list(first)
    label, later = {first[t]: first[t] for t in texts}, set()
    links = [(first[texts[a]], first[texts[b]]) for a, b in near_pairs(texts)]
    ids = defaultdict(list)
    for d, t in rows:
        ids[first[t]].append(d)
    for a, b in links:
        later |= {d for x, y in ((a, b), (b, a)) for d in ids[y] if d > x}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return set(label.values()), later


def test_near_copies_are_found_among_all_pairs(spark):
    """At sf0.1, against exact resemblances of all pairs."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want, later = least_of_groups(rows)
    kept = {r["doc_id"] for r in simhash.one_of_each(docs).collect()}
    assert want <= kept and len(later - kept) >= 0.98 * len(later) and len(later) > 20, (len(later), len(later & kept), len(kept - want))


def test_near_copies_need_one_worker_a_task(spark, monkeypatch):
    """No Python function reads another's rows in a task of what is stored or joined up, so a core has one worker."""
    plans = []
    for name in ("stored", "stars"):
        monkeypatch.setattr(simhash, name, lambda df, *a, f=getattr(simhash, name): plans.append((f.__name__, df._jdf.queryExecution().executedPlan().toString())) or f(df, *a))
    assert simhash.one_of_each(table(spark, "/root/testdata/sf0.001", "documents")).count()
    assert {n for n, _ in plans} == {"stored", "stars"} and not any("MapInArrow" in x for n, x in plans if n == "stars")


def test_workers_begin_without_what_others_left():
    """A tokenizer that packing keeps for its next task goes before a task of near copies begins."""
    bpe.loaded(bpe.standard_path())
    assert bpe.loaded.cache_info().currsize
    assert list(common.with_room(lambda batches: batches)(iter([1, 2]))) == [1, 2] and not bpe.loaded.cache_info().currsize


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    made = []
    for name, stage in pipeline.STAGES:
        out, _ = stored(stage(spark, docs, SF), name)
        made.append((name, docs, out))
        docs = out
    assert all(out.columns == columns for _, _, out in made[:-1])
    rows = [(sorted((r["doc_id"], r["text"]) for r in a.collect()), sorted((r["doc_id"], r["text"]) for r in b.collect())) for _, a, b in made[:-1]]
    (before, clean), (_, one), (_, cut), (_, hidden) = rows
    assert set(clean) <= set(before) and len(clean) > 0.8 * len(before)
    assert set(one) <= set(clean)
    assert {d for d, _ in one} == least_of_groups(clean)[0]
    assert [d for d, _ in cut] == [d for d, _ in one]
    want = [w[3] for w in cut_bytes([t for _, t in one], 100)]
    assert sum(sha(t) != w for (_, t), w in zip(cut, want, strict=True)) <= 0.02 * len(cut)  # but for a cut character
    assert [d for d, _ in hidden] == [d for d, _ in cut] and all(not pii.base_spans(t) for _, t in hidden)
    packed = made[-1][2].collect()
    assert {r["doc_id"] for r in packed} == {d for d, _ in hidden}
    assert pipeline.run(spark, SF).count() == len(packed)


def test_stages_on_odd_and_empty_tables(spark, odd):
    """Null ids and texts, repeated rows and ids, and columns of clashing names: every stage keeps the columns of documents."""
    more = odd[1].withColumn("lang", pipeline.F.col("kind")).withColumn("source", pipeline.F.col("row")).withColumn("n_chars", pipeline.F.lit(0).cast("long"))
    for docs in (more, more.limit(0)):
        for name, stage in pipeline.STAGES[:-1]:
            out, _ = stored(stage(spark, docs, SF), name)
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            rows = out.collect()
            assert {r["source"] for r in rows} <= {"no"} and all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
            docs = out
        packed = pipeline.pack(spark, docs, SF)
        assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
