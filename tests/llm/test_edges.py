"""Nulls, repeats, clashing names, very long texts, scores and the pipeline against plain computations."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexmesh.llm import common, licenses, lm, ngrams, packing, pieces, quality, suffixes, toxicity, urls

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, n_words string, score double, kept string, host string, _text string, ids string, n_bytes int"
LONG = " ".join(f"palabra{i % 997} x{i}" for i in range(12_000))  # about 190 kB


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, repeated rows, a long text, and columns with the names of results."""
    t = [(1, "mit license one two three four five"), (1, "mit license one two three four five"), (None, "mit license"), (None, None), (2, None), (2, ""), (3, LONG), (4, " \n\t ")]
    return spark.createDataFrame([(i, x, "a", 1.0, "b", "c", "d", "e", 7) for i, x in t], ODD).repartition(2)


def test_every_operator_takes_odd_rows(odd, spark):
    n = odd.count()
    model = toxicity.learn(odd, spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None)], "doc_id long, toxic int"))
    rules = quality.learn(odd, spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int"))
    assert toxicity.score(odd, model).count() == n and {r.predicted for r in toxicity.score(odd, model).collect()} == {0}
    judged = quality.judge(odd, rules).collect()
    assert len(judged) == n and sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in judged)[-2:] == [(3, 24_000, False, True), (4, 0, True, False)]
    assert sorted((r.doc_id or 0, r.n_words) for r in licenses.scan(odd).collect()) == [(0, 0), (0, 2), (1, 7), (1, 7), (2, 0), (2, 0), (3, 24_000), (4, 0)]
    spans = suffixes.repeated_spans(odd, keep_cols=("n_words", "n_bytes", "_text"), with_text=True)
    assert spans.columns == ["doc_id", "n_words", "_text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    got = {(r.doc_id, r.n_bytes): r for r in spans.collect()}
    assert got[3, len(LONG)].kept_text == LONG and got[3, len(LONG)].n_words == "a" and got[2, 0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    coded = pieces.encode(odd, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(coded) == n and all(r.round_trip for r in coded) and sorted(r.n_tokens for r in coded)[:3] == [0, 0, 0]
    scored = lm.score(odd, items=16, frequent=32).collect()
    assert len(scored) == n and sorted(r.n_tokens for r in scored)[-1] == 24_001
    packed = packing.pack(odd, public_tokenizers.path("word_bpe_49k.json"), with_ids=True).collect()
    assert sum(r.length for r in packed) == sum({(r.doc_id, r.doc_tokens, r.sequence_id if r.doc_tokens < 2048 else 0): r.doc_tokens for r in packed if r.start == 0}.values())
    joined = ngrams.jaccard_join(odd).collect()
    assert sorted((r.doc_id or 0, r.n_links) for r in joined) == [(0, 0), (0, 0), (1, 0), (2, 0), (3, 0), (4, 0)]


def test_pages_repeat_and_lack_ids(spark):
    rows = [(1, "http://a.com/x", ""), (1, "http://a.com/x", ""), (None, "http://b.net/es/1", None), (None, None, None)]
    got = sorted((r.page_id or 0, r.host, r.verdict) for r in urls.judge(spark.createDataFrame([(*r, "v", 1.0) for r in rows], "page_id long, url string, html string, verdict string, trust double")).collect())
    assert got == [(0, "", "allow"), (0, "b.net", "block"), (1, "a.com", "allow"), (1, "a.com", "allow")]


def test_long_words_are_encoded_like_the_library_does(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["日本語のテキスト" * 400, "a" * 5000, "abc" * 3000 + "é" * 50, "日本語のテキスト" * 400 + "終"]
    got = {r.doc_id: list(r.ids) for r in pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()}
    assert [got[i] for i in range(len(texts))] == [library.encode(t) for t in texts]


def test_labels_that_clash_teach_nothing_and_samples_are_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)] + [(3, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    got = common.labelled_sample(labels, "toxic", 10_000).collect()
    assert {r.doc_id for r in got} == set(range(500)) - {3}
    assert common.labelled_sample(labels, "toxic", 50).count() == 50


# ------------------------------------------------------------------ scores


def plain_segments(scores):
    """All maximal segments by their definition (the best one, then both sides)."""
    if not scores:
        return []
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    return [*plain_segments(scores[: at[0]]), best, *plain_segments(scores[at[1] :])]


def plain_surprise(model, found, n):
    x = sorted((model.rate * s - math.log(n + 1) - model.log_k for s in found), reverse=True)
    if not x:
        return 0.0
    out = x[0] if x[0] > 30 else -math.log(max(1 - math.exp(-math.exp(-x[0])), 1e-300))
    for r in range(2, len(x) + 1):
        if x[r - 1] <= 0:
            break
        t = sum(x[:r])
        if t > r:
            out = max(out, -math.log(math.exp(-t) * t ** (r - 1) / (math.factorial(r) * math.factorial(r - 1)) * 2 ** (r - 1)))
    return out


def test_toxicity_scores_are_the_plain_ones(spark):
    larger = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{larger}/documents.parquet"), spark.read.parquet(f"{larger}/labels.parquet")
    model = toxicity.learn(docs, labels)
    assert 0 < model.rate < 50 and len(model.keys)
    known = dict(zip(model.keys.tolist(), model.scores.tolist(), strict=True))
    hash_of = lambda w: int(toxicity._features(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0][0])

    def score_of(word):
        w = word.encode()
        found = [known.get(hash_of(w), 0.0)] + [known.get(hash_of(w[:k]) ^ k, 0.0) for k in toxicity.STEMS if len(w) > k]
        return max(found) or model.other

    text_of, seen = {r.doc_id: r.text for r in docs.collect()}, 0
    for r in toxicity.score(docs, model).collect():
        text = text_of[r.doc_id]
        if len(text) > 1500 or not (r.predicted or r.doc_id < 50):
            continue
        seen += r.predicted
        words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        found = plain_segments([score_of(w) for w in words])
        a, b = model.weights
        want = 1 / (1 + math.exp(-(a + b * min(60.0, plain_surprise(model, found, float(len(words)))))))
        assert r.score == pytest.approx(want, rel=1e-6)
    assert seen > 5


def test_neural_scores_are_the_plain_ones(spark):
    texts = [f"w{i % 5} w{(i * 3) % 7} fin w{i % 2}" for i in range(60)] + ["nunca visto", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    tokens = [[*t.split(), None] for t in texts]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    train = docs.where(~F.coalesce(common.crc_mod("doc_id", 10) == 0, F.lit(False)))
    counts = common.materialize(lm.count_tokens(train.select("text"), 4), "counts")
    model = lm.fit(train, "text", counts, items=6)
    got = {r.doc_id: r.score for r in lm.score(docs, items=6).collect()}

    def key(w):
        h, k, _ = lm.tokens(np.frombuffer((w or "").encode(), np.uint8), np.array([0, len((w or "").encode())]))
        return (h[:1], k[:1])

    item_of = {w: int(model.items(*key(w))[0]) for t in tokens for w in t}
    class_of = {w: int(key(w)[1][0]) for w in item_of}
    inside = [w for w in c if item_of[w] >= model.words]
    for i in (0, 7, 33, 60, 61):
        two = one = model.start
        total = 0.0
        for w in tokens[i]:
            item = item_of[w]
            z = sum(math.exp(model.first[two, j] + model.second[one, j]) for j in range(model.start))
            total += math.log10(math.exp(model.first[two, item] + model.second[one, item]) / z)
            if item >= model.words:
                mates = [x for x in inside if class_of[x] == class_of[w]]
                total += math.log10((c[w] + lm.SMOOTH) / (sum(c[x] for x in mates) + lm.SMOOTH * (len(mates) + 1)))
            two, one = one, item
        assert got[i] == pytest.approx(total, abs=1e-3 * max(1, abs(total)))


def test_quality_verdicts_are_the_rules_ones(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rules = quality.learn(docs, labels)
    for r in quality.judge(docs, rules).collect():
        values = r.asDict()
        fired = any(all((values[c.name] > c.threshold) == c.above for c in rule) for rule in rules)
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert (r.base_failed, r.kept) == (failed, not failed and not fired)


# ------------------------------------------------------------------ pipeline


def plain_pipeline(spark, docs, labels):
    """What the stages should leave of documents (id: text), by the plainest means."""
    frame = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    model, kept = toxicity.learn(frame, labels), {}
    for r in toxicity.score(frame, model).collect():
        if r.score < 0.5:
            kept[r.doc_id] = docs[r.doc_id]
    frame = spark.createDataFrame(sorted(kept.items()), "doc_id long, text string")
    kept = {r.doc_id: kept[r.doc_id] for r in quality.judge(frame, quality.learn(frame, labels)).collect() if r.kept}
    sets = {}
    for i, t in kept.items():
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    kept = {i: t for i, t in kept.items() if root[i] == i}
    raw = {i: t.encode() for i, t in kept.items()}
    seen = Counter(r[k : k + 200] for r in raw.values() for k in range(len(r) - 199))
    out = {}
    for i, r in raw.items():
        cover = np.zeros(len(r) + 1, int)
        for k in range(len(r) - 199):
            if seen[r[k : k + 200]] > 1:
                cover[k] += 1
                cover[k + 200] -= 1
        out[i] = bytes(np.frombuffer(r, np.uint8)[np.cumsum(cover[:-1]) == 0]).decode("utf-8", "replace")
    return out


def test_pipeline_is_the_plain_one(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(5).select((F.col("doc_id") + 100_000).alias("doc_id"), "text", "lang", "source", "n_chars")
    every = docs.unionByName(extra).withColumn("_row", F.lit("r")).withColumn("kept_text", F.lit(1)).withColumn("score", F.lit(None).cast("double"))
    every.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    want = plain_pipeline(spark, {r.doc_id: r.text for r in every.collect()}, spark.read.parquet(f"{SF}/labels.parquet"))
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.materialize(stage(spark, now, str(tmp_path)), name)
        assert now.columns == every.columns
    assert {r.doc_id: r.text for r in now.collect()} == want
    assert all(r.n_chars == len(want[r.doc_id]) for r in now.collect())
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    found = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert set(found) == set(want)
    for i, t in list(want.items())[:60]:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for start, length, crc in sorted(found[i]):
            assert start == at and zlib.crc32(ids[start : start + length].tobytes()) == crc
            at += length
        assert at == len(ids)


def test_pipeline_stages_take_empty_tables(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), name)
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0


def test_hub_edges_are_joined_where_they_are(spark):
    from lexmesh.llm.components import components, with_value

    edges = spark.createDataFrame([(0, i) for i in range(1, 400)] + [(500, 501)], "u long, v long")
    values = spark.createDataFrame([(0, "a", 399), (500, "b", 1)], "u long, x string, n long")
    got = with_value(edges, values, 10, ["u"])
    assert got.groupBy("x").count().orderBy("x").collect() == [("a", 399), ("b", 1)]
    for hot in (10, 1000):  # edges are parted by a filter; an anti join would pass on all but the hubs' once more
        assert "LeftAnti" not in with_value(edges, values, hot, ["u"])._jdf.queryExecution().toString()
    assert with_value(edges, values, 1000, ["u"]).count() == 400
    found = {r.v: r.root for r in components(edges.toDF("a", "b")).collect()}
    assert set(found.values()) == {0, 500} and found[399] == 0
