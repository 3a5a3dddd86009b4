"""The numpy cores on their own: hashing, runs, levels, BPE, packing, tagging, matching."""

from __future__ import annotations

import random
import time
import tracemalloc
import types
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strataloom.llm import ann, bpe, chat, common, components, fingerprints, packing, pii, repeats, simhash, substring_dedup, suffix_dedup, tagger, toxicity

PATH = bpe.standard_path()


def test_even_keys_match_sparks_hash(spark):
    for n in (1, 7, 51):
        keys = common.even_keys(n)
        rows = spark.createDataFrame([(k,) for k in keys], "k int").selectExpr(f"pmod(hash(k), {n}) as p").collect()
        assert [r["p"] for r in rows] == list(range(n))


def test_words_and_span_hashes():
    texts = ["  a bc\td ", None, "", "x", " \n", "é ü", "a"]
    raw, off = common.utf8(pa.array(texts))
    start, end, first = common.words(raw, off)
    got = [[raw[s:e].tobytes().decode() for s, e in zip(start[a:b], end[a:b], strict=True)] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [["a", "bc", "d"], [], [], ["x"], [], ["é", "ü"], ["a"]]
    h = common.span_hashes(raw, start, end)
    assert h[0] == h[-1] and len(set(h.tolist())) == 6


def test_suffix_levels_equal_a_set():
    """Many small batches: several levels, merges, and both ways of merging."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 3, 3000).astype(np.uint8)
    seen, levels, most = set(), suffix_dedup.SuffixLevels(12), 0
    for i in range(300):
        n = int(rng.integers(12, 60)) if i != 150 else 2500
        text = (base[a : a + n] if (a := int(rng.integers(0, 400))) % 2 else rng.integers(0, 3, n).astype(np.uint8)).copy()
        place = np.arange(len(text) - 11)
        got, want = levels.add(text, place), []
        for p in place.tolist():
            w = text[p : p + 12].tobytes()
            want.append(w in seen)
            seen.add(w)
        assert got.tolist() == want
        most = max(most, len(levels.levels))
        ranks = [r for r, _ in levels.levels]
        assert ranks == sorted(ranks, reverse=True) and len(set(ranks)) == len(ranks)
    assert most >= 6
    for _, level in levels.levels:  # a suffix array: in lexicographic order, all different
        own = [level.text[p : p + 12].tobytes() for p in level.place.tolist()]
        assert own == sorted(set(own))
    assert sum(len(level.place) for _, level in levels.levels) == len(seen)


def test_common_prefixes():
    a, b = np.array([b"abcd", b"abcd", b"xbcd"], "S4"), np.array([b"abcd", b"abxd", b"abcd"], "S4")
    assert suffix_dedup.common(a, b).tolist() == [4, 2, 0]


@pytest.mark.parametrize(("window", "gram"), [(5, 2), (9, 3), (100, 32)])
def test_equal_windows_have_equal_anchors(window, gram):
    rng = np.random.default_rng(window)
    base = rng.integers(0, 4, 400)
    t = common.BYTE[np.concatenate([base, rng.integers(0, 4, 37), base, np.zeros(300, int), np.zeros(250, int)])]
    off = np.array([0, 400, 837, 1137, len(t)])
    row, pos, more, at, h, _ = repeats.runs(t, off, window, gram)
    anchor = {}
    for r, p, m, a, g in zip(row, pos, more, at, h, strict=True):
        assert 0 <= a - m and a <= window - gram
        for s in range(p, p + m + 1):
            anchor[int(r), int(s)] = (g, p + a - s)
    assert len(anchor) == sum(max(0, n - window + 1) for n in np.diff(off))
    by_text = {}
    for (r, s), g in anchor.items():
        by_text.setdefault(t[off[r] + s : off[r] + s + window].tobytes(), set()).add(g)
    assert all(len(v) == 1 for v in by_text.values())


def test_anchors_of_parts_are_those_of_the_whole(monkeypatch):
    rng = np.random.default_rng(4)
    table = pa.table({"doc_id": pa.array([1, 2]), "hash": pa.array([0, 0]), "text": ["".join(rng.choice(list("ab c"), n)) for n in (5000, 700)]})
    for by_words in (False, True):
        rule = repeats.Rule(20, 6, by_words, True, None)
        windows = []
        for piece in (1 << 18, 300):
            monkeypatch.setattr(repeats, "PIECE", piece)
            row, pos, more, at, *_ = repeats.Tokens(table, rule).runs()
            windows.append({(int(r), int(s), int(p + a)) for r, p, m, a in zip(row, pos, more, at, strict=True) for s in range(p, p + m + 1)})
        assert windows[0] == windows[1]



def test_compared_windows_equal_brute_force():
    """Segments around a shared gram, some of one character only, against a count of all windows."""
    rng = random.Random(6)
    for by_words in (False, True):
        window, gram = 12, 4
        segments, more, at = [], [], []
        while len(segments) < 400:
            a, m = rng.randint(0, window - gram), rng.randint(0, window - gram)
            m = min(m, a)
            left, right = [rng.choice("ab") for _ in range(a)], [rng.choice("ab") for _ in range(window + m - a - gram)]
            tokens = [*left, *"cdef", *right] if rng.random() < 0.8 else ["c"] * (window + m)
            body = ((" " if by_words else "").join(tokens)).encode()
            if body not in segments:
                segments.append(body), more.append(m), at.append(a)
        cut = (lambda s, m: [tuple(s.split()[i : i + window]) for i in range(m + 1)]) if by_words else (lambda s, m: [s[i : i + window] for i in range(m + 1)])
        # Equal windows have their anchor at one distance.
        all_windows = [(a - i, w) for s, m, a in zip(segments, more, at, strict=True) for i, w in enumerate(cut(s, m))]
        if by_words:
            n = Counter(all_windows)
            want = [n[w] > 1 for w in all_windows]
            assert substring_dedup.shared(segments, np.array(more), np.array(at), window, gram).tolist() == want
        else:
            seen, want = set(), []
            for _, w in all_windows:
                want.append(w in seen)
                seen.add(w)
            for batch in (7, 1 << 15):
                got = suffix_dedup.seen_before(segments, np.array(more), np.array(at), window, gram, batch)
                assert [g for g, w in zip(got.tolist(), want, strict=True) if g != w] == []


def test_cuts_cover_all_distances():
    for reach in (0, 1, 2, 5, 23, 68):
        limits = repeats.cuts(reach)
        assert limits[0] == 0 and limits[-1] == reach + 1 and limits == sorted(set(limits)) and len(limits) <= 2 + 2 * max(1, reach.bit_length())


def thue_morse(k):
    a, b = "a", "b"
    for _ in range(k):
        a, b = a + b, b + a
    return a, b


def test_words_that_a_polynomial_hash_mixes_up():
    a, b = thue_morse(11)
    raw, off = common.utf8(pa.array([f"{a} {b} {a}"]))
    start, end, _ = common.words(raw, off)
    h = common.span_hashes(raw, start, end)
    assert h[0] == h[2] != h[1]
    own, lib = bpe.ByteBpe(PATH), Tokenizer.from_file(PATH)
    ids, at = own.texts(*common.utf8(pa.array([a, b])))
    assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:], strict=True)] == [lib.encode(t, add_special_tokens=False).ids for t in (a, b)]


def test_span_hashes_of_blocks(monkeypatch):
    rng = np.random.default_rng(9)
    text = " ".join("".join(rng.choice(list("abc"), int(n))) for n in rng.integers(1, 90, 400))
    raw, off = common.utf8(pa.array([text]))
    start, end, _ = common.words(raw, off)
    whole = common.span_hashes(raw, start, end)
    monkeypatch.setattr(common, "SPAN_BLOCK", 100)
    assert np.array_equal(whole, common.span_hashes(raw, start, end))
    words = text.split()
    assert len(set(whole.tolist())) == len(set(words)) and len({w: h for w, h in zip(words, whole.tolist(), strict=True)}) == len(set(words))


def test_bpe_equals_the_library():
    lib, own = Tokenizer.from_file(PATH), bpe.ByteBpe(PATH)
    rng = random.Random(3)
    bits = ["'s", "'re", "'ll", "'", " ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "!", "'x", "　", "\xa0", " ", "日本", "<|endoftext|>", "🎉", "\x85", "'ve", "<", "|>", "ſ", "​"]
    texts = ["", "a", "x" * 20000, " " * 9000 + "a", "the" * 9000, "日本語" * 5000, *("".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000))]
    ids, at = own.texts(*common.utf8(pa.array(texts)))
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
    assert [own.decode(np.array(x)) for x in want] == [lib.decode(x, skip_special_tokens=False) for x in want]
    assert own.decode(np.array([220, 255])) == lib.decode([220, 255], skip_special_tokens=False)


def test_tree_concatenation_is_exact():
    own = bpe.ByteBpe(PATH)
    rng = random.Random(5)
    for signs in ("etaoinshrdlu", "é日本a", "x"):
        text = "".join(rng.choice(signs) for _ in range(30000)).encode()
        assert own.tree(text).tolist() == own.bpe._core_bpe.encode_single_piece(text)


def test_long_texts_in_stretches(monkeypatch):
    lib, own = Tokenizer.from_file(PATH), bpe.ByteBpe(PATH)
    rng = random.Random(8)
    bits = ["'s ", "don't ", " ", "  ", "\n\n", "word ", "über ", "日本，語。", "12 ", "a.b ", "!'t", "x" * 50, "\u3000", "<|endoftext|>"]
    texts = ["".join(rng.choice(bits) for _ in range(800)) for _ in range(6)]
    monkeypatch.setattr(bpe, "BLOCK", 64)
    ids, at = own.texts(*common.utf8(pa.array(texts)))
    assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:], strict=True)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(bpe, "DECODED", 7)
    assert [own.decode(ids[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)] == [lib.decode(lib.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for t in texts]


def test_memory_of_a_long_text():
    own = bpe.ByteBpe(PATH)
    raw, off = common.utf8(pa.array(["the quick brown fox, über 12 " * 500000]))  # 15 MB
    bpe.classes()
    tracemalloc.start()
    ids, _ = own.texts(raw, off)
    sum(len(t) for t in own.decoded(ids))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(raw) + (100 << 20), peak


def test_packer_places_every_token_once():
    rng = np.random.default_rng(2)
    packer = packing.Packer(64, 0, most_open=8)  # so few that pieces are cut
    sizes = [*rng.integers(1, 200, 300).tolist(), 64, 128, 1, *[40] * 50]
    for doc, n in enumerate(sizes):
        packer.add(doc, np.arange(n, dtype=np.uint32))
        assert packer.n_open == packer.level.sum() == sum(map(len, packer.open.values())) <= 8
    packer.flush()
    got: dict[int, list] = {}
    fill: dict[int, list] = {}
    for doc, start, length, _, total, seq, offset in packer.rows:
        got.setdefault(doc, []).append((start, length))
        fill.setdefault(seq, []).append((offset, length))
        assert total == sizes[doc]
    for doc, n in enumerate(sizes):
        at = 0
        for start, length in sorted(got[doc]):
            assert start == at
            at += length
        assert at == n
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0


def test_pieces_go_where_the_sum_of_squares_grows_least():
    rng = np.random.default_rng(3)
    for _ in range(300):
        level = np.where(rng.random(17) < 0.5, rng.integers(0, 6, 17), 0)
        level[[0, 16]] = 0
        size = int(rng.integers(1, 16))
        sums = {}
        for at in [0, *np.flatnonzero(level[: 17 - size]).tolist()]:
            after = level.copy()
            after[at] -= bool(at)
            after[at + size] += at + size < 16
            sums[at] = int((after[1:16] ** 2).sum())
        assert packing.chosen(level, size) == max(a for a in sums if sums[a] == min(sums.values()))


def test_escapes_are_reversible():
    rng = random.Random(1)
    bits = [chat.OPEN, chat.CLOSE, chat.HEAD, "\\", "<", "a", "\n", "turn>", "é"]
    own = bpe.ByteBpe(PATH)
    for _ in range(300):
        turns = [(rng.choice(["user", "assistant", "<turn>\\"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))) for _ in range(rng.randint(1, 4))]
        out = chat.formatted(turns, own)
        back = chat.parsed(out["text"])
        assert [(r, chat.unescaped(out["text"][a:b])) for r, a, b in back] == turns
        assert out["loss_chars"] == sum(len(t) for r, t in turns if r == "assistant")
        assert len(out["ids"]) == len(out["mask"])


def test_blocks_of_a_long_conversation(monkeypatch):
    own, rng = bpe.ByteBpe(PATH), random.Random(2)
    turns = [(rng.choice(["user", "assistant"]), "word " * rng.randint(0, 30) + "\\<turn>") for _ in range(60)]
    whole = chat.formatted(turns, own)
    monkeypatch.setattr(chat, "BLOCK", 200)
    parts = chat.formatted(turns, own)
    assert all(np.array_equal(whole[k], parts[k]) for k in whole)


def test_fingerprint_estimates_resemblance():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    a = [" ".join(rng.choices(words, k=400)) for _ in range(60)]
    b = [t if i % 3 == 0 else " ".join((x := t.split())[: 400 - 20 * (i % 7)] + rng.choices(words, k=20 * (i % 7))) for i, t in enumerate(a)]
    low_a, has_a = fingerprints.signatures(*common.utf8(pa.array([*a, "", "one two"])))
    low_b, has_b = fingerprints.signatures(*common.utf8(pa.array([*b, "", "two one"])))
    near = fingerprints.likeness(low_a, low_b, has_a, has_b, fingerprints.LOW_BITS)
    sets = lambda t: {tuple(t.split()[i : i + 5]) for i in range(396)}
    true = [len(sets(x) & sets(y)) / len(sets(x) | sets(y)) for x, y in zip(a, b, strict=True)]
    assert np.abs(near[:60] - true).mean() < 0.03 and near[60] == 1 and near[61] < 0.15
    assert fingerprints.packed_hex(low_a[:1], 4)[0] != fingerprints.packed_hex(low_b[1:2], 4)[0]


def test_matches_finds_every_near_fingerprint():
    rng = np.random.default_rng(6)
    fp = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    hot = (np.uint64(7) << np.uint64(32)) | rng.integers(0, 1 << 10, 900).astype(np.uint64)  # many rows of one key
    table = np.unique(np.concatenate([fp, fp ^ np.uint64(5), hot]))
    got = {(int(a), int(b)) for who, place in simhash.matches(table, table, 2) for a, b in zip(who, place, strict=True)}
    hi = table >> np.uint64(32)
    want = {(i, int(j)) for i in range(len(table)) for j in np.flatnonzero((hi == hi[i]) & (np.bitwise_count(table ^ table[i]) <= 2))}
    assert got == want


def test_forest_keeps_components():
    u, v = np.array([5, 9, 9, 1, 4], np.uint64), np.array([3, 5, 3, 2, 4], np.uint64)
    a, b = simhash.forest(u, v)
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(2, 1), (5, 3), (9, 3)]


def test_long_texts_are_described_as_short_ones():
    text = " ".join(f"w{i % 700} é" for i in range(3000))
    raw, off = common.utf8(pa.array([text, text + " end"]))
    short = [(a, b) for a, b in zip(*fingerprints.signatures(raw, off), strict=True)]
    sets = [np.unique(fingerprints.shingle_hashes(raw[off[i] : off[i + 1]], np.array([0, off[i + 1] - off[i]]), 5)[0]) for i in range(2)]
    block, fingerprints.BLOCK = fingerprints.BLOCK, 1000
    try:
        assert all((a == c).all() and b == d for (a, b), (c, d) in zip(short, zip(*fingerprints.signatures(raw, off), strict=True), strict=True))
        assert all(np.array_equal(simhash.whole_set(raw[off[i] : off[i + 1]], 5), sets[i]) for i in range(2))
        one = common.utf8(pa.array(["a b"]))[0]
        assert len(simhash.whole_set(one, 5)) == 1 and len(simhash.whole_set(one[:0], 5)) == 0
    finally:
        fingerprints.BLOCK = block


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 400)] + [(5, 5), (9, 9), (9, 8), (8, 9)] + [(rng.randint(500, 700), rng.randint(500, 700)) for _ in range(150)] + [(-3, 160), (-3, 399)]
    rng.shuffle(edges)
    label = {n: n for e in edges for n in e}
    while True:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    for parts in (1, 7, 40):
        got, _ = components.stars(spark.createDataFrame(edges, "u long, v long").repartition(parts))
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len(set(rows)) and dict(rows) == {n: m for n, m in label.items() if n != m}
    assert components.stars(spark.createDataFrame([], "u long, v long"))[0].count() == 0


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    model = tagger.Tagger(5)
    model.w = {k: w.astype(np.float64) for k, w in model.w.items()}
    x, y = rng.integers(0, tagger.SYMBOLS, (3, 6)), np.array([[0, 1, 2, 2, 0, 3], [1, 2, 0, 0, 3, 4], [0, 0, 0, 0, 0, 0]])
    _, grad = model._loss(x, y)
    for name, at in (("into_f", (int(x[0, 2]), 3)), ("again_b", (2, 5)), ("out", (4, 1)), ("moves", (1, 2)), ("bias", (3,)), ("again_f", (1, 40))):
        losses = []
        for step in (1e-2, -1e-2):
            model.w[name][at] += step
            losses.append(model._loss(x, y)[0])
            model.w[name][at] -= step
        assert abs((losses[0] - losses[1]) / 2e-2 - grad[name][at]) < 2e-3


def test_base_spans():
    text = "x a.b@c.de, 1.2.3.4 256.1.1.1 +1 (771) 555-1655, 4984763833005551 a@b@c.d 4111 1111 1111 1111 x 1.2.3.4.5.6.7.8"
    got = [(text[a:b], k) for a, b, k in pii.base_spans(text)]
    assert got == [("a.b@c.de", "email"), ("1.2.3.4", "ip"), ("+1 (771) 555-1655", "phone"), ("4984763833005551", "card"), ("b@c.d", "email"), ("4111 1111 1111 1111", "card"), ("1.2.3.4", "ip"), ("5.6.7.8", "ip")]
    assert pii.base_spans("1" * 50000) == [] and pii.base_spans("a" * 50000 + "@") == []
    assert pii.redacted("x a@b.c y", [(2, 7, "email")]) == "x <email> y"


def test_spans_are_reconciled_over_the_text():
    """The best disjoint spans of a few, against all subsets."""
    rng = random.Random(2)
    for _ in range(300):
        found = {}
        for _ in range(rng.randint(0, 7)):
            a = rng.randint(0, 20)
            found[a, a + rng.randint(1, 8), rng.randint(0, 3)] = rng.randint(-3, 9)
        best = 0
        for n in range(1 << len(found)):
            some = [s for k, s in enumerate(sorted(found)) if n >> k & 1]
            if all(x[1] <= y[0] for x, y in zip(some, some[1:], strict=False)):
                best = max(best, sum(found[s] for s in some))
        got = pii.reconciled(found)
        assert sum(found[s] for s in got) == best and all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))


def test_windows_tell_whole_spans_only():
    tag, above = np.array([2, 2, 0, 1, 2, 0, 3, 5, 6]), np.arange(9.0)
    assert list(pii.in_window(tag, above, False, False)) == [(3, 5, 0, 7.0), (6, 7, 1, 6.0)]
    assert [x[:3] for x in pii.in_window(tag, above, True, True)] == [(0, 2, 0), (3, 5, 0), (6, 7, 1), (7, 9, 2)]


def test_all_texts_are_laid_out():
    texts = ["a" * 1000, "", "b", "c" * pii.WINDOW, "d" * (pii.WINDOW + 1)]
    seen = [np.zeros(len(t), int) for t in texts]
    for where, x in pii.laid_out(texts):
        for (i, a), row in zip(where, x, strict=True):
            n = min(pii.WINDOW, len(texts[i]) - a)
            assert (row[:n] == tagger.symbols(texts[i][0])[0]).all() and (row[n:] == tagger.BLANK).all()
            seen[i][a : a + n] += 1
    assert all((s >= 1).all() for s in seen)


def test_windows_without_spans_are_told_for_certain():
    """decode() leaves out just the windows whose best tags are all zeros."""
    rng = np.random.default_rng(5)
    model = tagger.Tagger(5, seed=1)
    model.w["bias"] = np.array([0.6, 0, 0, 0, 0], np.float32)
    model.w["out"] *= 3
    x = rng.integers(0, tagger.SYMBOLS, (40, 9))
    rows, tags, above = model.decode(x)
    scores, _ = model.emissions(x)
    moves = model.w["moves"] + model.barred
    for k in range(len(x)):
        best, back = scores[0, k] + model.start, []
        for now in scores[1:, k]:
            back.append((best[:, None] + moves).argmax(0))
            best = (best[:, None] + moves).max(0) + now
        path = [int(best.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        at = np.flatnonzero(rows == k)
        assert (tags[at[0]].tolist() if len(at) else [0] * 9) == path[::-1]
    assert 0 < len(rows) < 40 and above.shape == tags.shape


def test_variants_are_beyond_the_patterns():
    rng = random.Random(1)
    for kind in pii.KINDS:
        for _ in range(200):
            made = pii.variant(kind, rng)
            assert not any(k == kind and (a, b) == (0, len(made)) for a, b, k in pii.base_spans(made)), made
            assert pii.settled(kind, made) == (kind, 0, len(made)), made


def test_found_spans_are_settled_by_their_parts():
    """Whatever sets the parts apart; what can't be of a kind is none, and a long last word isn't an address's end."""
    cases = [
        ("email", "maria.lopez <at> mail <dot> com today", ("email", 0, 31)), ("email", "jsmith AT-SIGN gmail DOT-SIGN com", ("email", 0, 33)), ("email", "jo at gmail dot com", ("email", 0, 19)),
        ("email", "from from from from from", ""), ("email", "a b c", ""), ("email", "é at b dot com", ""), ("email", "  ", ""), ("email", "it ends. Sooner", ""),
        ("phone", "10,0,0,1", ("ip", 0, 8)), ("ip", "10 ; 0 ; 0 ; 256", ""), ("phone", "4111:1111:1111:1111 ", ("card", 0, 19)), ("card", "4111:1111:1111:1112", ""), ("phone", " (212) 555-0199.", ("phone", 1, 15)), ("card", "(212) 555-0199", ""), ("phone", "12345678", ""), ("ip", "none", ""),
    ]
    for told, text, want in cases:
        kind, a, b = pii.settled(told, text)
        assert (kind, a, b) == want if want else kind == "", (text, kind, a, b)


def test_toxicity_scores_a_text_alone_as_in_a_batch():
    place = np.full(1 << toxicity.BITS, -1)
    code, _ = toxicity.characters(["idiot"])
    bucket = np.unique(toxicity.grams(code, 4))
    place[bucket] = np.arange(len(bucket))
    model = toxicity.Classifier(place, np.ones(len(bucket)), -4.0)
    texts = ["you idiot", "", None, "fine words", "x", "idiot " * 3]
    assert np.allclose(model.score(texts), [model.score([t])[0] for t in texts])
    assert model.score(["you idiot"])[0] > 0.9 > 0.3 > model.score([""])[0]


def plain_grams(text):
    """Each n-gram's bucket, one after the other."""
    low = f" {text.lower()} "
    out = []
    for order in toxicity.ORDERS:
        for k in range(max(0, len(low) - order + 1)):
            h = order * 0x9E3779B1 & 0xFFFFFFFF
            for c in low[k : k + order]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ ord(c)
                h = h * 0x85EBCA6B & 0xFFFFFFFF
            h = (h ^ (h >> 15)) * 0xC2B2AE35 & 0xFFFFFFFF
            out.append(h >> (32 - toxicity.BITS))
    return out


def test_log_count_ratios_equal_a_plain_count():
    rng = random.Random(3)
    texts = [(" ".join(rng.choice(["you", "idiot", "fine", "über", "day"]) for _ in range(rng.randint(0, 9))), rng.randint(0, 1)) for _ in range(60)]
    has = np.zeros((2, 1 << toxicity.BITS), np.int64)
    for t, y in texts:
        has[y][toxicity._buckets(t)[0]] += 1
    count = [Counter(b for t, y in texts if y == label for b in set(plain_grams(t))) for label in (0, 1)]
    assert all(has[label][b] == n for label in (0, 1) for b, n in count[label].items()) and has.sum() == sum(sum(c.values()) for c in count)
    n = [sum(y == label for _, y in texts) for label in (0, 1)]
    chosen, ratio = toxicity.told(has, np.array(n))
    for b, r in zip(chosen.tolist(), ratio.tolist(), strict=True):
        assert np.isclose(r, np.log((count[1][b] + 1) / (n[1] + 2)) - np.log((count[0][b] + 1) / (n[0] + 2)))


def test_scores_equal_a_plain_sum():
    rng = random.Random(5)
    place = np.full(1 << toxicity.BITS, -1)
    known = sorted({b for w in ("idiot", "you", "fine") for b in plain_grams(w)})
    place[known] = np.arange(len(known))
    model = toxicity.Classifier(place, np.array([rng.uniform(-1, 1) for _ in known]), -0.3)
    texts = ["", "you Idiot", "fine fine day", "x", " ".join(rng.choice(["you", "idiot", "fine", "day"]) for _ in range(500))]
    for t, got in zip(texts, model.score(texts), strict=True):
        grams = plain_grams(t)
        z = -0.3 + sum(model.weight[place[b]] * np.sqrt(toxicity.SHARE * n / len(grams)) for b, n in Counter(grams).items() if place[b] >= 0)
        assert np.isclose(got, 1 / (1 + np.exp(-z)))


def test_fit_separates_what_its_features_tell():
    """The fitted weights are near a minimum of the penalised loss."""
    rng = np.random.default_rng(2)
    x = rng.random((200, 6)).astype(np.float32)
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=200) > 0).astype(float)
    ratio = np.array([1.0, -1, 0.2, 0.1, -0.1, 0.3])
    model = toxicity.fit(y, x, np.arange(6), ratio, steps=2000, penalty=0.01)

    def loss(w, b):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + 0.005 * ((w / ratio) ** 2).sum()

    least = loss(model.weight, model.bias)
    assert all(loss(model.weight + d, model.bias) > least - 1e-4 for d in 0.05 * np.vstack([np.eye(6), -np.eye(6)])) and model.weight[0] > 0 > model.weight[1]


def test_a_file_with_everything_reranked_is_exact():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 8))
    x[50:120] = x[50]  # many equal vectors
    orders = ann.permutations(x, x[:16], 8)
    which, found, far = ann.searched(x, orders, x[:70], orders[:70], 16, 10, 0)
    for i in (0, 50, 60):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        want = np.lexsort((np.arange(200), d))[:10]
        assert found[which == i].tolist() == want.tolist() and np.array_equal(far[which == i], d[want])


def test_candidates_are_those_of_the_least_footrule():
    """With a limit that none passes, the `top` vectors whose orders are nearest are reranked."""
    rng = np.random.default_rng(9)
    x, q, pivots = rng.normal(size=(300, 6)), rng.normal(size=(5, 6)), rng.normal(size=(40, 6))
    orders, q_orders = ann.permutations(x, pivots, 8), ann.permutations(q, pivots, 8)
    which, found, _ = ann.searched(x, orders, q, q_orders, 40, 10, 1 << 30)

    def distance(a, b):
        place = lambda o, p: o.index(p) if p in o else 8
        return sum(abs(place(a, p) - place(b, p)) for p in {*a, *b})

    for i in range(5):
        far = [distance(q_orders[i].tolist(), o.tolist()) for o in orders]
        assert sorted(found[which == i].tolist()) == sorted(np.lexsort((np.arange(300), far))[:10].tolist())


def test_permutations_are_the_nearest_pivots():
    rng = np.random.default_rng(7)
    x, pivots = rng.normal(size=(50, 5)), rng.normal(size=(30, 5))
    far = ((x[:, None] - pivots[None]) ** 2).sum(2)
    assert np.array_equal(ann.permutations(x, pivots, 7), np.argsort(far, axis=1)[:, :7]) and np.array_equal(ann.permutations(x, pivots, 99), np.argsort(far, axis=1))


def test_queries_visit_files_until_they_hold_enough():
    files = ann.files_of(np.array([[2, 0, 1], [1, 2, 0]]), np.array([5, 1, 1]), 1, 4)
    assert [f.tolist() for f in files] == [[2, 0], [1, 2, 0]]


def clustered(n, seed=1):
    """n vectors of 48 dimensions about one centre for each 100."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 100, 48))
    return centres[rng.integers(0, len(centres), n)] + 0.25 * rng.normal(size=(n, 48))


def test_index_over_clusters_reranks_little_and_finds_nearly_all():
    """20,000 vectors: recall against brute force, the share that is reranked, and the time of a search against brute force's."""
    x, k = clustered(20000), 10
    rng = np.random.default_rng(3)
    pivots, asked = x[rng.permutation(len(x))[: ann.PER_ROOT * 141]], np.arange(0, len(x), 100)
    order = ann.permutations(x, pivots, ann.NEAREST)
    rows = rng.permutation(len(x))[: ann.SAMPLE]
    shared = types.SimpleNamespace(value=(pivots, rows, x[rows]))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(list(x))], ["vec_id", "x"])
    told = [r for b in ann._survey(shared, ann.NEAREST, k, 48)(iter([batch.slice(i, 4000) for i in range(0, len(x), 4000)])) for r in b.to_pylist()]
    size = np.zeros(len(pivots), np.int64)
    for r in told:
        if r["far"] < 0:
            size[r["key"]] += r["gain"]
    assert size.sum() == len(x)
    near = {}
    for r in sorted((r for r in told if r["far"] >= 0), key=lambda r: r["far"]):
        near.setdefault(r["key"], []).append(r)
    some = [r for rs in near.values() for r in rs[:k]]
    probed, gain = ann.chosen([r["rank"] for r in some], [r["gain"] for r in some], ann.AIM)
    began = time.perf_counter()
    whole = ann.permutations(x[asked], pivots, len(pivots))
    visitors, found, reranked = {}, {}, 0
    for q, files in enumerate(ann.files_of(whole, size, probed, 4 * (k + 1))):
        for f in files.tolist():
            visitors.setdefault(f, []).append(q)
    by = np.argsort(order[:, 0], kind="stable")
    start = np.searchsorted(order[by, 0], np.arange(len(pivots) + 1))
    for f, who in visitors.items():
        own = by[start[f] : start[f + 1]]
        if len(own):
            which, vec, far = ann.searched(x[own], order[own], x[asked[who]], whole[who, : ann.NEAREST], len(pivots), k + 1, gain)
            for a, b, c in zip(np.array(who)[which].tolist(), own[vec].tolist(), far.tolist(), strict=True):
                found.setdefault(a, []).append((c, b))
    took = time.perf_counter() - began
    for f, who in visitors.items():
        own = by[start[f] : start[f + 1]]
        gains = ann.footrule(order[own], whole[who, : ann.NEAREST], len(pivots))
        reranked += int(np.maximum((gains >= gain).sum(axis=1), min(k + 1, len(own))).sum())
    began = time.perf_counter()
    far = np.stack([np.sqrt(((x - x[i]) ** 2).sum(axis=1)) for i in asked])
    plain = time.perf_counter() - began
    far[np.arange(len(asked)), asked] = np.inf
    true = np.argsort(far, axis=1, kind="stable")[:, :k]
    hits = [len({b for _, b in sorted(r for r in found[q] if r[1] != asked[q])[:k]} & set(true[q].tolist())) / k for q in range(len(asked))]
    assert np.mean(hits) >= 0.9 and reranked <= 0.05 * len(asked) * len(x) and took < plain, (np.mean(hits), reranked / len(asked) / len(x), took, plain)


def test_prefixes_of_like_sets_meet():
    """Whatever shingles count as frequent: two sets that resemble each other by 0.8 or more have a prefix shingle in common."""
    rng = np.random.default_rng(12)
    met = unlike = 0
    for _ in range(400):
        base = rng.integers(0, 400, int(rng.integers(1, 80)))
        a, b = np.unique(base), np.unique(np.concatenate([base[: int(len(base) * rng.uniform(0.7, 1))], rng.integers(0, 400, int(rng.integers(0, 9)))]))
        some = np.unique(rng.integers(0, 400, int(rng.integers(0, 300))))
        times = rng.integers(16, 99, len(some))
        own = lambda x: simhash.prefix(x, some[np.isin(some, x)], times[np.isin(some, x)], 0.8)  # noqa: B023, E731
        common = len(np.intersect1d(a, b))
        meet = len(np.intersect1d(own(a), own(b))) > 0
        if common >= 0.8 * (len(a) + len(b) - common):
            met += 1
            assert meet
        else:
            unlike += not meet
    assert met > 50 and unlike


def test_pairs_by_prefix_equal_all_pairs(spark):
    """Texts with one frequent passage: those that are alike are found, and the others make few pairs."""
    rng = np.random.default_rng(13)
    wide = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)  # noqa: E731  half of them are negative as signed numbers
    passage = wide(80)
    sets = []
    for k in range(120):
        own = wide(60)
        sets += [np.unique(np.concatenate([passage, own])), np.unique(np.concatenate([passage, own[:50], wide(4)]))] if k % 4 == 0 else [np.unique(np.concatenate([passage, own]))]
    alike = {(i, j) for i in range(len(sets)) for j in range(i) if simhash.resembling(0.8, sets[i].astype(np.uint64).tobytes(), sets[j].astype(np.uint64).tobytes())}
    df = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, shingles binary")
    members = spark.createDataFrame([(7, i, i) for i in range(len(sets))], "bucket long, node long, group long")
    got = {(r["u"], r["v"]) for r in simhash._by_prefix(members, df, 0.8).collect()}
    assert len(alike) >= 25 and alike <= got and len(got) <= len(alike) + 20
    apart = members.withColumn("bucket", members.node % 2)  # only pairs that share a bucket
    assert {(r["u"], r["v"]) for r in simhash._by_prefix(apart, df, 0.8).collect()} == {(u, v) for u, v in got if (u - v) % 2 == 0}


def test_texts_of_frequent_words_only_make_few_pairs(spark):
    """2,000 texts of 40 out of 240 frequent shingles, some with a copy of a word or two changed: candidates grow with the texts, not with their
    square, and the copies are found."""
    rng = np.random.default_rng(21)
    words = [f"w{i}" for i in range(240)]
    texts = [[words[i] for i in rng.permutation(240)[:40]] for _ in range(2_000)]
    for k in range(0, 200):
        t = list(texts[k])
        t[rng.integers(0, 40)] = "changed"
        texts.append(t)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = []
    plain = simhash._by_prefix
    simhash._by_prefix = lambda *a: made.append(out := plain(*a)) or out
    try:
        kept = {r["doc_id"] for r in simhash.one_of_each(docs, width=1).collect()}
    finally:
        simhash._by_prefix = plain
    assert set(range(2_000)) <= kept and len(kept) <= 2_004, len(kept)
    assert sum(x.count() for x in made) < 20_000
