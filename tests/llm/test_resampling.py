"""Importance resampling against a plain version; heads of any size give the same rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hirewave.llm import resampling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall((text or "").translate(LOW))
    return len(w), [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def plain(docs, target, percent=25):
    """[(id, n_features, weight, score, rank)] in the order of ``docs``' ranks."""
    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = percent * len(able) // 100
    return sorted([(r[0], *r[2:], k + 1 if k < drawn else None) for k, r in enumerate(able)]
                  + [(r[0], *r[2:], None) for r in rows if r[1] < 20], key=str)


def made_up(n):
    r = random.Random(3)
    vocabulary = ["the", "The", "of", "x1", "éclair", "ÉCLAIR", "straße", "word" * 5, "你好", "a", "I", "0", "zz9"] + [f"w{i}" for i in range(40)]
    gaps = [" ", "  ", ", ", "\n", "-", "\x00", "_", " "]
    return ["".join(r.choice(vocabulary) + r.choice(gaps) for _ in range(r.randint(0, 60))) for _ in range(n)]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("sizes", [(8_000, 16_000), (3, 2), (0, 0)])
def test_resampling_equals_the_plain_version(spark, sizes):
    docs = list(enumerate(made_up(120))) + [(900, None), (901, ""), (902, " ,.- "), (903, "one"), (904, " lead and trail "),
                                            (905, "b" * 300_000 + " " + "c d " * 30_000)]
    target = made_up(7) + [None, ""]
    got = resampling.resample(frame(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"),
                              head_words=sizes[0], head_pairs=sizes[1])
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, target)


def test_repeated_rows_and_ids_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(resampling, "COPIES_STEP", 4)
    texts = made_up(20)
    docs = list(enumerate(texts)) + [(5, texts[5])] * 11 + [(6, texts[7]), (None, texts[8]), (None, texts[8]), (None, None)]
    target = made_up(3)
    got = resampling.resample(frame(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"), percent=60)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, target, 60)


def test_empty_tables(spark):
    none = frame(spark, [(1, "a b")]).where("false")
    assert resampling.resample(none, none).count() == 0
    docs = list(enumerate(made_up(30)))
    assert sorted((tuple(r) for r in resampling.resample(frame(spark, docs), none).collect()), key=str) == plain(docs, [])


def test_other_columns_may_have_any_name(spark):
    docs = list(enumerate(made_up(40)))
    target = made_up(3)
    odd = frame(spark, docs).selectExpr("doc_id as `my.id`", "text as `a text`", "'x' as w", "1 as nxt", "2 as id", "3 as copies", "4 as rank", "5 as _w")
    aim = spark.createDataFrame([(t,) for t in target], "text string").selectExpr("text", "1 as nxt", "2 as bucket")
    got = resampling.resample(odd, aim, id_col="my.id", text_col="a text")
    want = plain(docs, target)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    drawn = resampling.drawn_documents(odd, aim, "my.id", text_col="a text")
    assert sorted(r[0] for r in drawn.collect()) == sorted(w[0] for w in want if w[4]) and drawn.columns == odd.columns


def test_the_state_of_a_word_goes_on_over_the_next(spark):
    words = ["a", "éclair", "x" * 40]
    rows = spark.createDataFrame([(" ".join([a, b, b, a]),) for a in words for b in words], "text string")
    table, pairs = resampling.head(rows, n_words=100, n_pairs=0, share=1.0)
    assert sorted(r.h_word for r in table.collect()) == sorted(words) and pairs.count() == 0
    got = resampling.with_buckets(resampling.runs(rows), table, pairs)
    want = Counter(b for r in rows.collect() for b in features(r.text)[1])
    assert {r.bucket: r.n for r in resampling.bucket_counts(got).collect()} == dict(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "Python" not in plan and "InArrow" not in plan


def test_no_python_in_the_plan(spark):
    docs = frame(spark, list(enumerate(made_up(20))))
    plan = resampling.weights(docs, docs.select("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "Cartesian" not in plan


def test_texts_without_pairs_in_many_partitions(spark):
    docs = [(i, ["one", "", None, ".", "two words", "x" * 9][i % 6]) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(100)
    table, pairs = resampling.head(df, share=1.0)
    assert sorted(r.h_word for r in table.collect()) == ["one", "two", "words", "x" * 9] and [tuple(r)[:2] for r in pairs.collect()] == [("two", "words")]
    alone = df.where("text = 'one'")
    assert [t.count() for t in resampling.head(alone, share=1.0)] == [1, 0]
    got = resampling.resample(df, alone.select("text"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, ["one"] * 20)
