"""Encoding, license scans, fingerprints and the classifier against brute-force versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirewave.llm import licenses, quality, sketch
from hirewave.llm import sentencepiece_bpe as bpe

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=bpe.default_model())


def odd_texts():
    r = random.Random(4)
    parts = ["a", "the", " ", "  ", "▁", "\n", "\t", "é", "你", "\x00", "ﬁ", "😀", "aaaa", "==", "http://", "23", "İ", "ß", "<s>", "<0x41>", "\x7f"]
    return ["", " ", "   ", "a" * 900, " " * 300, "=" * 333, "ab" * 200, "▁", "\n"] + [
        "".join(r.choice(parts) for _ in range(r.randint(0, 50))) for _ in range(400)]


def test_encoding_and_decoding_equal_the_library(spark, library):
    texts = odd_texts() + [None]
    got = {r.id: r for r in bpe.encode_decode(frame(spark, list(enumerate(texts))), bpe.default_model()).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded == library.decode(ids)


def test_decoding_any_ids_equals_the_library(library):
    v, r = bpe.Vocabulary.load(bpe.default_model()), random.Random(5)
    for _ in range(1500):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), 0, 1, 2]) for _ in range(r.randint(0, 10))]
        assert v.decode(np.array(ids, dtype="<u4")) == library.decode(ids)


def test_a_small_cache_changes_nothing(library):
    v = bpe.Vocabulary.load(bpe.default_model())
    texts = odd_texts()
    assert bpe.Encoder(v, 50)(texts) == bpe.Encoder(v)(texts)


LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    hits = [(i, x) for p, x in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_license_places_match_brute_force(spark):
    r = random.Random(6)
    bits = ["cc", "by", "CC BY", "general", "public", "license", "General-Public_License", "all", "rights", "reserved", "all rights reserved",
            "É", "x", "\n", "2", "\x00"]
    texts = [(i, " ".join(r.choice(bits) for _ in range(r.randint(0, 60)))) for i in range(80)]
    texts += [(80, None), (81, ""), (82, "--"), (83, "cc"), (84, "cc by cc by"), (84, "cc by cc by"), (84, "no"), (None, "cc by"), (85, "cc by " * 4000)]
    docs = frame(spark, texts).withColumn("template", F.lit("clash")).withColumn("pos", F.lit(1)).withColumn("id", F.lit(5))
    got = sorted(((r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()), key=repr)
    assert got == sorted(((i, *plain_places(t)) for i, t in texts), key=repr)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_license_notices_allow_small_changes(spark):
    texts = [(1, "Permission is hereby granted, free of charge, to any one person obtaining a copy of this software"),
             (2, "Permission is hereby granted to fish"), (3, "Licensed under the Apache License, Version 2.0"), (4, "plain words")]
    got = {r.id: r for r in licenses.scan(frame(spark, texts)).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4)] == ["mit", "", "apache-2.0", ""]
    assert 0 < got[2].score < licenses.MIN_COVER <= got[1].score <= 1 and got[3].score == 1 and got[4].score == 0


def test_fingerprints_of_edited_texts(spark):
    r = random.Random(7)
    texts = [(i * i, " ".join(r.choice(["a", "bé", "c😀", "dd"]) for _ in range(r.choice([0, 1, 3, 40, 400])))) for i in range(60)]
    texts += [(5000, None), (5001, "same text " * 30), (5002, "same text " * 30)]
    docs = frame(spark, texts).withColumn("stretch", F.lit(1)).withColumn("guest", F.lit(2))
    got = {r.id: r for r in sketch.compare_with_next(docs).collect()}
    for k, (i, t) in enumerate(texts):
        t, after = t or "", texts[(k + 1) % len(texts)][1] or ""
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        assert (got[i].n_chars, got[i].edited) == (len(t), edited)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (t == edited)
    assert got[5001].fingerprint == got[5002].fingerprint and got[5001].near_next == 1
    assert sketch.compare_with_next(docs.limit(0)).count() == 0


def test_fingerprint_order_with_repeats_nulls_and_one_row(spark):
    one = sketch.compare_with_next(frame(spark, [(1, "abcd")])).first()
    assert one.edited == "abab" and one.near_next == 1
    rows = sketch.compare_with_next(frame(spark, [(None, "zzzz"), (1, "aaaa"), (1, "aaaa"), (2, "bbbb")])).collect()
    assert sorted((r.id or 0, r.edited) for r in rows) == [(0, "zzaa"), (1, "aaaa"), (1, "aabb"), (2, "bbzz")]


def test_sketch_estimates_containment(spark):
    r = random.Random(8)
    big = [f"w{r.randrange(10**6)}" for _ in range(8000)]
    df = spark.createDataFrame([(" ".join(big), " ".join(big[:2000] + [f"v{i}" for i in range(2000)]))], "a string, b string")
    got = df.select(sketch.likeness(sketch.sketch(F.col("a")), sketch.sketch(F.col("b")), F.lit(False)).alias("x")).first().x
    assert abs(got - 0.5) < 0.06


def junk_and_prose(n):
    r = random.Random(9)
    vocab = [f"{a}{b}" for a in ("ta", "mo", "re", "li", "con") for b in ("der", "ning", "s", "ble", "ra")]
    rows = []
    for i in range(n):
        w = [r.choice(vocab) for _ in range(r.randint(20, 200))]
        bad = i % 6 == 0
        text = " ".join(x.upper() + "!!" for x in w) if bad and i % 12 else " ".join([w[0]] * len(w)) if bad else " ".join(w).capitalize() + "."
        rows.append((i, text, "en", f"s{i % 3}", len(text), 0 if bad else 1))
    return rows


def test_classifier_on_held_out_rows(spark):
    rows = junk_and_prose(600)
    docs = spark.createDataFrame([x[:5] for x in rows], DOCS)
    labels = spark.createDataFrame([(x[0], x[5], 0) for x in rows[:400]] + [(9999, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.keep for r in quality.scores(docs, quality.train(docs, labels)).select("d.doc_id", "keep").collect()}
    held = [(got[x[0]], bool(x[5])) for x in rows[400:]]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert sum(a for a, b in held if b) / sum(b for _, b in held) > 0.99


def test_classifier_edges(spark):
    docs = frame(spark, [(1, None), (2, ""), (2, ""), (None, "x" * 9000)]).withColumn("keep", F.lit("clash")).withColumn("d", F.lit(1))
    docs = docs.withColumn("lang", F.lit(None).cast("string"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.keep_good(docs, none)
    assert out.columns == docs.columns and out.count() == 4
    model = quality.co_train(np.random.default_rng(0).random((40, quality.N_TEXT)), np.zeros((40, 4), int), np.arange(40) % 2,
                             np.zeros((0, quality.N_TEXT)), np.zeros((0, 4), int))
    assert quality.scores(docs, model).count() == 4
    assert quality.scores(docs.limit(0), model).count() == 0


def test_repeated_and_missing_ids_do_not_swell_the_fit(spark, monkeypatch):
    rows = junk_and_prose(300)
    hot = [rows[0]] * 400 + [(None, *x[1:]) for x in rows]
    labels = spark.createDataFrame([(x[0], x[5]) for x in rows[:200]], "doc_id long, quality int")
    sizes = []

    def seen(x, m, y, pool_x, pool_m):
        sizes.append((len(y), len(pool_x)))
    monkeypatch.setattr(quality, "co_train", seen)
    for more in ([], hot):
        quality.train(spark.createDataFrame([x[:5] for x in rows + more], DOCS), labels)
    assert sizes == [(200, 100)] * 2


def test_pseudo_labels_come_from_all_rows(spark, monkeypatch):
    rows = junk_and_prose(600)
    docs = spark.createDataFrame([x[:5] for x in rows], DOCS)
    labels = spark.createDataFrame([(x[0], x[5]) for x in rows[:200]], "doc_id long, quality int")
    given, real = [], quality.co_train

    def spy(x, m, y, px, pm, edges=None, pick=None):
        text = np.zeros(quality._one_hot(x, edges).shape[1])
        text[quality.BINS - 1], text[-1] = 10, -5  # sure of the longest sixteenth, and of all others the other way
        given.append((edges, pick(quality.Model(edges, text, np.zeros(quality.META_BUCKETS + 1), np.zeros(3)), .5, .98)))
        return real(x, m, y, px, pm, edges=edges, pick=pick)
    monkeypatch.setattr(quality, "co_train", spy)
    model = quality.train(docs, labels, pool_rows=100)
    edges, (x, m, taught) = given[0]
    size = np.array([quality.text_features(r[1])[0] for r in rows])
    assert np.abs(edges[0] - np.quantile(size, np.linspace(0, 1, quality.BINS + 1)[1:-1])).max() < 0.1
    assert (taught["meta"] == 1).sum() == 5 and (taught["meta"] == 0).sum() == 5 and (taught["text"] >= 0).sum() == 0
    assert (x[taught["meta"] == 1, 0] > edges[0, -1]).all() and (x[taught["meta"] == 0, 0] <= edges[0, -1]).all()
    got = {r.doc_id: r.keep for r in quality.scores(docs, model).select("d.doc_id", "keep").collect()}
    assert sum(got[x[0]] == bool(x[5]) for x in rows[200:]) / 400 > 0.97


def test_classifier_reads_the_words(spark):
    r = random.Random(10)
    good, bad = ([f"{c}{a}{b}" for a in "aeiou" for b in ("ld", "rn", "st", "mp")] for c in "kv")
    rows = []
    for i in range(500):
        w = [r.choice((good, bad)[i % 2]) for _ in range(40)]
        rows.append((i, " ".join(w).capitalize() + ".", "en", "s", 160, 1 - i % 2))
    docs = spark.createDataFrame([x[:5] for x in rows], DOCS)
    labels = spark.createDataFrame([(x[0], x[5]) for x in rows[:300]], "doc_id long, quality int")
    got = {x.doc_id: x.keep for x in quality.scores(docs, quality.train(docs, labels)).select("d.doc_id", "keep").collect()}
    assert sum(got[x[0]] == bool(x[5]) for x in rows[300:]) / 200 > 0.95


def test_views_teach_each_other():
    r = np.random.default_rng(1)
    y = (r.random(300) < .5).astype(int)
    x = np.repeat(y[:, None], quality.N_TEXT, axis=1) + 0.3 * r.standard_normal((300, quality.N_TEXT))
    m = np.repeat(y[:, None] * 7, 4, axis=1)
    model = quality.co_train(x[:60], m[:60], y[:60], x[60:], m[60:])
    score = model.score(x[60:], m[60:])
    assert all(((s > .5) == y[60:]).mean() > .95 for s in score)


def test_query_digest(spark, tmp_path, library):
    frame(spark, [(1, "Hello world"), (2, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in bpe.query(spark, str(tmp_path)).collect()}
    ids = library.encode("Hello world", add_bos=True, add_eos=True)
    assert got[1].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert got[2].n_tokens == 2 and got[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
