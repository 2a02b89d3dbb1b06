"""Operators on texts against brute force, on fixtures with nulls, copies, ties and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexmesh.llm import lm, ngrams, packing, pieces, quality, suffixes, toxicity

SCHEMA = "doc_id long, text string, n_words string, score string, id string, label string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(rng, n):
    return " ".join(rng.choice(["the", "Café", "of", "tion", "heit", "más", "x1", "ing,", "re.\n", "日本", "and\t"]) + str(rng.randint(0, 30)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [words(rng, rng.randint(1, 120)) for _ in range(30)]
    out = [*base, *base[:6]]  # exact copies
    for b in base[:12]:  # near copies
        w = b.split(" ")
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    passage = words(rng, 60)
    out += [words(rng, 20) + passage + words(rng, 20) for _ in range(4)]
    out += [None, "", " \n\t", "one", "a b c d", "a b c d", "é" * 400, "ab" * 300, words(rng, 6000), "Released under the MIT License. MIT license", "<|endoftext|> ~ \x00 ﻿"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "x", "y", "z", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------------ n-gram join


def shingle_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def test_jaccard_join_is_the_brute_force_join(docs, texts):
    sets = shingle_sets(texts)
    near = [{j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9} for i, a in enumerate(sets)]
    root = list(range(len(sets)))
    for _ in root:
        root = [min([root[i], *(root[j] for j in near[i])]) for i in range(len(root))]
    got = {r.doc_id: r for r in ngrams.jaccard_join(docs).collect()}
    assert len(got) == len(texts)
    for i in got:
        assert (got[i].n_links, got[i].class_id, got[i].kept) == (len(near[i]), root[i], root[i] == i)


def test_jaccard_join_of_a_large_group_splits_blocks(spark):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = f"v{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    sets = shingle_sets([t for _, t in rows])
    want = {i: sum(j != i and len(a & b) >= 0.8 * len(a | b) - 1e-9 for j, b in enumerate(sets)) for i, a in enumerate(sets)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in ngrams.jaccard_join(df, small=8, block=40).collect()}
    assert sum(got.values()) >= 0.999 * sum(want.values())
    assert all(got[i] <= want[i] for i in want)


def test_jaccard_join_edges(spark, none):
    assert ngrams.jaccard_join(none).collect() == []
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b, c d e f")], "doc_id long, text string")
    got = {(r.doc_id, r.class_id, r.n_links, r.kept) for r in ngrams.jaccard_join(df).collect()}
    assert got == {(None, None, 0, True), (1, 1, 1, True), (2, 1, 1, False)}
    assert sorted(r.doc_id or 0 for r in ngrams.one_of_each(df).collect()) == [0, 1]


def test_rows_that_repeat_beside_near_copies_count_once(spark):
    words = [f"w{i}" for i in range(100)]
    near = " ".join([*words[:99], "other"])
    rows = [(1, " ".join(words))] * 3 + [(2, near), (2, near), (3, " ".join(reversed(words))), (None, near), (None, near)]
    got = sorted(map(tuple, ngrams.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 3, 0, True), (None, None, 0, True), (None, None, 0, True)]


def test_runs_follow_from_the_recall():
    assert ngrams.runs_for(0.9) < ngrams.runs_for(0.9999) <= 5


# ------------------------------------------------------------------ suffixes


def removed(texts, width=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + width] for r in raw for i in range(len(r) - width + 1))
    for r in raw:
        hit = np.zeros(len(r), bool)
        for i in range(len(r) - width + 1):
            if seen[r[i : i + width]] > 1:
                hit[i : i + width] = True
        kept = bytes(b for b, h in zip(r, hit, strict=True) if not h)
        yield len(r), int(hit.sum()), int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffixes_are_the_brute_force_ones(docs, texts, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", hot)
    want = list(removed(texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeated_spans(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_suffixes_edges(spark, none):
    assert suffixes.repeated_spans(none).collect() == []
    t = "".join(map(str, range(200)))
    df = spark.createDataFrame([(1, t, "k"), (1, t, "k"), (None, t[:150], "k"), (3, "q" * 199, "k")], "doc_id long, text string, extra string")
    got = sorted((r.doc_id or 0, r.n_removed, r.n_spans, r.kept_text, r.extra) for r in suffixes.repeated_spans(df, keep_cols=("extra",), with_text=True).collect())
    assert got == [(0, 0, 0, t[:150], "k"), (1, len(t), 1, "", "k"), (1, len(t), 1, "", "k"), (3, 0, 0, "q" * 199, "k")]


def test_anchor_chunks_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(suffixes, "MOST", 1000)
    starts = [p for i, j in suffixes._chunks(0, 5321, 200) for p in range(i, j - 199)]
    assert starts == list(range(5321 - 199))


# ------------------------------------------------------------------ packing


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def check_pieces(rows, ids_of):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, ids in ids_of.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for ps in by_seq.values():
        at = 0
        for r in sorted(ps, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_packing_is_exact_and_unpadded(docs, texts):
    tok = tokenizer()
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert check_pieces(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect(), want) == 0


@pytest.mark.parametrize("lengths", [[1], [2048], [2049] * 3, [700] * 500, list(range(1, 3000, 7)), [1025] * 9])
def test_plan_places_every_token_once(lengths):
    p = packing.plan(np.array(lengths))
    for d, n in enumerate(lengths):
        mine = sorted((s, k) for doc, s, k, _, _ in p.tolist() if doc == d)
        assert sum(k for _, k in mine) == n and all(a + k == b for (a, k), (b, _) in zip(mine, mine[1:]))
    total = Counter()
    for _, _, k, q, _ in p.tolist():
        total[q] += k
    assert all(t == 2048 or t & (t - 1) == 0 for t in total.values())


def test_nnls_meets_its_optimality_conditions():
    rng = np.random.default_rng(1)
    a, b = rng.random((20, 40)), rng.random(20)
    x = packing.nnls(a, b)
    g = a.T @ (a @ x - b)
    assert (x >= 0).all() and (g > -1e-6).all() and abs(g @ x) < 1e-6


def test_packing_edges(none, spark):
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json")).collect() == []
    df = spark.createDataFrame([(None, None), (1, "a"), (1, "a")], "doc_id long, text string")
    assert sorted(r.doc_tokens for r in packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).collect()) == [1, 2, 2]


# ------------------------------------------------------------------ pieces


def test_pieces_equal_the_library_and_come_back(docs, texts):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = pieces.encode(docs, path)
    for r in rows.collect():
        assert list(r.ids) == m.encode(texts[r.doc_id] or ""), texts[r.doc_id]
        assert r.round_trip
    back = {r.doc_id: r.text for r in pieces.decode(rows, path).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}


def test_unigram_forward_pass_is_viterbi():
    vocabulary = {"a": -1.0, "b": -1.5, "ab": -2.0, "aba": -2.2, "ba": -1.4, "▁": -0.5, "▁a": -1.2}
    voc = pieces.Vocabulary([f"<{i}>" for i in range(256)] + list(vocabulary), [0.0] * 256 + list(vocabulary.values()), [False] * 256 + [True] * len(vocabulary), list(range(256)), merges=False)
    rng = random.Random(2)
    ws = sorted({"▁" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(60)})
    ids, n = pieces.encode_words(ws, voc)
    at = 0
    for w, k in zip(ws, n.tolist(), strict=True):
        best = [0.0] + [-1e9] * len(w)
        for e in range(1, len(w) + 1):
            best[e] = max(best[s] + vocabulary[w[s:e]] for s in range(e) if w[s:e] in vocabulary)
        assert sum(voc.scores[i] for i in ids[at : at + k]) == pytest.approx(best[-1])
        assert "".join(voc.pieces[i] for i in ids[at : at + k]) == w
        at += k


def test_pieces_edges(none):
    assert pieces.encode(none, public_tokenizers.path("piece_bpe_32k.model")).collect() == []


# ------------------------------------------------------------------ toxicity


def labelled(spark, n=400):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 80))]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "nasty", "gruffish" + str(rng.randrange(50))]))
        docs.append((i, " ".join(w), "c"))
        labels.append((i, int(not bad), int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    got = toxicity.score(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50
    assert sum(r.predicted == r.toxic for r in got) >= 0.95 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_segments_are_all_maximal():
    other, rng = -0.3, np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(1, 30))
        at = np.sort(rng.choice(n, int(rng.integers(0, n + 1)), replace=False))
        s = rng.random(len(at)) * 2
        full = np.full(n, other)
        full[at] = s
        got = toxicity.segments(at, s, other)

        def brute(a, b):
            if a >= b:
                return []
            sums = {(i, j): full[i:j].sum() for i in range(a, b) for j in range(i + 1, b + 1)}
            (i, j), v = max(sums.items(), key=lambda x: x[1])
            return [] if v <= 0 else [*brute(a, i), (i, j, v), *brute(j, b)]

        want = brute(0, n)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_toxicity_edges(spark, none, docs, texts):
    empty = toxicity.learn(none, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.score(none, empty).collect() == []
    got = toxicity.score(docs, empty).collect()
    assert len(got) == len(texts) and {r.predicted for r in got} == {0} and all(0 <= r.score <= 1 for r in got)


def test_without_telling_words_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(i, f"plain words of text {i} here") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}
    toxicity._calibrate(model, np.zeros(60), np.arange(60) % 6 == 0)
    assert model.probability(np.zeros(1))[0] < 0.5


# ------------------------------------------------------------------ language model


def test_base_scores_are_the_brute_force_ones(docs, texts):
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None] for t in texts]
    train = [zlib.crc32(str(i).encode()) % 10 != 0 for i in range(len(texts))]
    c = Counter(w for t, ok in zip(tokens, train, strict=True) if ok for w in t)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in lm.score(docs, items=40, frequent=60).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(tokens):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].held_out) == (len(t), sum(c[w] > 0 for w in t), n, not train[i])
        assert got[i].base_score == pytest.approx(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
        assert got[i].score < 0


def test_item_probabilities_sum_to_one_and_learn():
    rng = np.random.default_rng(0)
    n = 12
    one = rng.integers(0, n, 30_000)
    item = (one + 1) % n  # a token follows from the one before it
    two = np.roll(one, 1)
    noise = np.full(n, 1 / n)
    t = lm.tables(*lm.train_items(two, one, item, noise, size=8))
    p = np.exp(t[0][:n, None, :] + t[1][None, :n, :] - t[2][:n, :n, None])
    assert np.allclose(p.sum(2), 1, atol=1e-4)
    assert np.log(p[two, one, item]).mean() > np.log(1 / n) + 1


def test_sequences_outside_the_start_sample_train(spark):
    rng = random.Random(5)
    cycle = [f"w{i}" for i in range(8)]
    rows = [(i, " ".join(cycle[(j + k) % 8] for j in range(1000))) for i in range(400) for k in [rng.randrange(8)]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = [(r.score - r.base_score) / r.n_tokens for r in lm.score(df, train_tokens=1).where("held_out").collect()]
    assert min(got) > 0.3  # each word follows from the one before it; no document is in the sample


def test_language_model_edges(none, spark):
    assert lm.score(none).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    (r,) = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0)


@pytest.mark.parametrize(("copies", "kinds", "others"), [(300, 60, 60), (0, 40, 400)])
def test_toxic_words_survive_copies_and_saturation(spark, copies, kinds, others):
    rng = random.Random(4)
    plain = lambda: [f"p{rng.randrange(60)}" for _ in range(12)]
    texts = [(1, "what a total idiot went home")] * copies
    texts += [(1, " ".join([*plain(), f"k{i % kinds}", "idiot", *plain()])) for i in range(others)]
    texts += [(0, " ".join([*plain(), f"k{i % kinds}", *plain()])) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame([(i, y) for i, (y, _) in enumerate(texts)], "doc_id long, toxic int"))
    ask = spark.createDataFrame([(1, "p1 p2 p3 idiot p4 p5"), (2, "p1 p2 home total p4 p5")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score(ask, model).collect()} == {1: 1, 2: 0}


# ------------------------------------------------------------------ quality


def counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    cover = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_statistics_are_the_brute_force_ones(spark, texts):
    more = [*texts, "a b a b a b a b c", "x\nx\n\nx\n y", "# * a|b <c> $5 & %", " lead and trail \n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(more)], "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in quality.COUNTS) for r in quality.statistics(df).collect()}
    assert [got[i] for i in range(len(more))] == [counts(t) for t in more]


def test_rules_find_planted_conjunctions_and_keep_the_rest():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.8) & (x[:, 1] <= 0.5)).astype(int)
    rules = quality.learn_rules(x, y, ["a", "b", "c"])
    fired = np.zeros(len(x), bool)
    for r in rules:
        fired |= quality._covers(r, x, ["a", "b", "c"])
    assert (fired == y).mean() > 0.98 and {c.name for c in rules[0]} == {"a", "b"}
    assert quality.learn_rules(x[:0], y[:0], ["a", "b", "c"]) == []


def test_quality_verdicts(spark, none):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good + " " + " ".join(f"x{i}a{j}" for j in range(10)) if i % 4 else " ".join(f"w{i}c{j}***" for j in range(60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    rules = quality.learn(docs, labels)
    got = {r.doc_id: r.kept for r in quality.judge(docs, rules).collect()}
    assert all(got[i] == (i % 4 > 0) for i in got)
    assert quality.passing(docs, rules, "doc_id").count() == 150
    assert quality.judge(none, []).collect() == []
    assert [r.base_failed for r in quality.judge(spark.createDataFrame([(1, None)], "doc_id long, text string"), []).collect()] == [True]
