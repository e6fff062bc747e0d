"""SimHash, substring and embedding dedup against brute-force versions."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

from hirewave.llm import embedding, simhash, substring
from hirewave.llm.common import connected_components, global_rank

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], DOCS)


def corpus(seed=0, n=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    passage = [r.choice(vocab) for _ in range(30)]
    out = []
    for i in range(n):
        w = [r.choice(vocab) for _ in range(r.choice([0, 1, 2, 12, 13, 14, 60, 200]))]
        if r.random() < .4:
            w[len(w) // 2:len(w) // 2] = passage
        if out and r.random() < .3:
            w = (out[r.randrange(len(out))][1] or "").split()
            if w and r.random() < .5:
                w[r.randrange(len(w))] = "changed"
        out.append((i, r.choice([" ", "\n", " \t "]).join(w)))
    return out + [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "a " * 3000), (n + 4, "a " * 40), (n + 5, "x" * 5000)]


def closure(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = (text or "").translate(low).encode().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_matches_brute_force(spark):
    texts = corpus(1)
    fps = [plain_fingerprint(t) for _, t in texts]
    n = len(texts)
    want = closure(n, [(i, j) for i in range(n) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    got = {r.id: (r.fp & (1 << 64) - 1, r.component) for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == {i: (fps[i], want[i]) for i in range(n)}


@pytest.mark.parametrize("bits,blocks,group", [(2, 5, 2), (2, 5, 1000), (2, 3, 3), (1, 4, 2), (3, 6, 2)])
def test_close_pairs_connect_like_all_pairs(spark, bits, blocks, group):
    r = random.Random(bits)
    base = [r.getrandbits(64) for _ in range(6)]
    vals = sorted({b ^ sum(1 << x for x in r.sample(range(64), r.randrange(5))) for b in base for _ in range(25)})
    signed = [v - (1 << 64) if v >> 63 else v for v in vals]
    edges = simhash.close_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"), bits, blocks, group)
    at = {v: i for i, v in enumerate(signed)}
    found = [(at[e.a], at[e.b]) for e in edges.collect()]
    assert all((vals[a] ^ vals[b]).bit_count() <= bits for a, b in found)
    n = len(vals)
    assert closure(n, found) == closure(n, [(i, j) for i in range(n) for j in range(i) if (vals[i] ^ vals[j]).bit_count() <= bits])


def test_simhash_keeps_one_row_of_each_group_and_takes_extra_columns(spark):
    texts = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words stand here now"), (3, "other words stand here now"), (None, "a b c d e f")]
    docs = frame(spark, texts).withColumn("fp", F.lit("clash")).withColumn("id", F.lit(0)).withColumn("component", F.lit(1))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs).count() == 5


def test_simhash_judges_repeated_ids_by_their_texts(spark):
    texts = [(3, "one two three four five"), (3, "six seven eight nine ten"), (3, "six seven eight nine ten"), (7, "one two three four five"),
             (None, "alone without any id here"), (None, "alone without any id here")]
    docs = frame(spark, texts).withColumn("_id", F.lit(1)).withColumn("_n", F.lit("x")).withColumn("tag", F.lit(2)).withColumn(
        "a.b", F.create_map(F.lit("k"), F.lit(1))).withColumn("whole", F.lit(0))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted({texts[0], texts[1], texts[4]}, key=repr)


def test_hot_minimisers_are_found_however_thinly_spread(spark, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 500)
    monkeypatch.setattr(substring, "HOT_RUNS", 400)
    r = random.Random(11)
    texts = [(i, " ".join(["same phrase of thirteen words that stands once in every single text here"]
                          + [f"u{r.randrange(10**9)}" for _ in range(60)])) for i in range(1500)]
    rows = frame(spark, texts).selectExpr("doc_id id", "hash(text) tag", "cast(text as binary) text")
    hot = substring._hot_minimisers(rows, 1, 13, 2, 64)
    assert 1 <= len(hot) <= 3


def test_components_of_a_long_chain_and_empty(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {(r.node, r.root) for r in connected_components(chain).collect()} == {(i, 0) for i in range(201)}
    assert connected_components(chain.limit(0)).count() == 0


def test_global_rank(spark):
    df = spark.createDataFrame([(x,) for x in ["b", None, "a", "é", "c"]], "s string")
    got = global_rank(df, [F.col("s").asc_nulls_last()], "r", "t").collect()
    assert sorted((r.r, r.s) for r in got) == [(0, "a"), (1, "b"), (2, "c"), (3, "é"), (4, None)]


def plain_cut(texts, window=13):
    words = [(i, (t or "").encode().split()) for i, t in texts]
    first = {}
    for i, w in sorted((x for x in words if x[0] is not None)):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


@pytest.mark.parametrize("runs", [1000, 0])
def test_substring_matches_brute_force(spark, monkeypatch, runs):
    monkeypatch.setattr(substring, "HOT_RUNS", runs)
    monkeypatch.setattr(substring, "CHUNK_BYTES", 3000)
    texts = corpus(2) + [(3, "w1 w2 w3 " * 9), (None, "w1 w2 w3 " * 9), (90, "w1 w2 w3 " * 9)]
    got = sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in substring.dedup_windows(frame(spark, texts)).collect()), key=repr)
    assert got == sorted(plain_cut(texts), key=repr)


def test_substring_tells_windows_of_one_hash_apart(monkeypatch):
    monkeypatch.setattr(substring.Rolling, "__call__", lambda self, a, b: np.zeros(len(a), dtype=np.uint64))
    texts = [" ".join(f"{x}{i}" for i in range(13)) for x in "abab"]
    docs = [(i, 0, t.encode()) for i, t in enumerate(texts)]
    rec = np.zeros(4, dtype=substring._RECORD)
    rec["doc"], rec["wins"], rec["bytes"] = range(4), 1, [len(d[2]) for d in docs]
    marks = substring.marks_of([substring._pack(rec, [d[2] for d in docs], b"s")], 13)
    assert sorted(marks["doc"].tolist()) == [2, 3]


def test_cut_documents_keeps_columns_and_untouched_texts(spark):
    p = " ".join(f"p{i}" for i in range(20))
    docs = frame(spark, [(1, f"one\n{p}"), (2, f"two  {p} end"), (3, "short  text"), (4, None)]).withColumn("kept", F.lit(9)).withColumn("d", F.lit(1))
    out = substring.cut_documents(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        1: (f"one\n{p}", len(p) + 4), 2: ("two end", 7), 3: ("short  text", 11), 4: (None, 0)}
    assert substring.cut_documents(docs.limit(0)).count() == 0


def vectors(seed=3):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((12, 16))
    rows = [(c + 0.1 * r.standard_normal(16)).astype(np.float32).tolist() for c in centres for _ in range(9)]
    rows += [rows[0], rows[0], (np.array(rows[5]) * 4).tolist(), r.standard_normal(16).tolist()]
    return rows


def plain_links(rows):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in rows]
    n = len(rows)
    near = [(i, j) for i in range(n) for j in range(i) if ok[i] and ok[j] and len(rows[i]) == len(rows[j])
            and np.dot(rows[i], rows[j]) / np.sqrt(np.dot(rows[i], rows[i]) * np.dot(rows[j], rows[j])) >= 0.9]
    deg = [0] * n
    for i, j in near:
        deg[i] += 1
        deg[j] += 1
    return deg, closure(n, near)


@pytest.mark.parametrize("window", [64, 2])
def test_embedding_links_match_all_pairs(spark, monkeypatch, window):
    monkeypatch.setattr(embedding, "BLOCK", 4)
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0], [3e38] * 16, [3e38] * 16]
    rows = [[float(np.float32(x)) if x is not None else None for x in v] if v is not None else None for v in vectors() + odd]
    df = spark.createDataFrame([Row(vec_id=i, embedding=v, label=0) for i, v in enumerate(rows)], "vec_id long, embedding array<float>, label int")
    got = {r.id: (r.n_links, r.component) for r in embedding.linked(df, window=window, passes=24).collect()}
    deg, comp = plain_links([None if v is None else [None if x is None else np.float64(x) / 1e3 for x in v] for v in rows])
    assert got == {i: (deg[i], comp[i]) for i in range(len(rows))}
    assert embedding.linked(df.limit(0)).count() == 0


def test_embedding_repeated_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted((r.id, r.n_links, r.component) for r in embedding.linked(df).collect()) == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]


def _with_conf(spark, run, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return run()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("passes, parts, batch", [(None, 200, 10000), (1, 200, 10000), (1, 3, 7), (2, 1, 7)])
def test_embedding_windows_cross_borders(spark, passes, parts, batch):
    r = np.random.default_rng(3)
    base = r.standard_normal((12, 16))
    rows = [(base[i % 12] + 0.2 * r.standard_normal(16)).tolist() for i in range(36)]
    rows += [(np.ones(5) + 0.2 * r.standard_normal(5)).tolist() for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    conf = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}
    got = _with_conf(spark, lambda: {x.id: (x.n_links, x.component) for x in embedding.linked(df, passes=passes).collect()}, **conf)
    deg, comp = plain_links(rows)
    assert max(deg) > 0 and got == {i: (deg[i], comp[i]) for i in range(len(rows))}


def test_embedding_windows_do_not_depend_on_partitions(spark):
    r = np.random.default_rng(4)
    rows = r.standard_normal((500, 6))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id long, embedding array<double>").repartition(1).localCheckpoint()
    runs = [_with_conf(spark, lambda: {x.id: (x.n_links, x.component) for x in embedding.linked(df, passes=2, window=8).collect()},
                       **{"spark.sql.shuffle.partitions": n, "spark.sql.adaptive.coalescePartitions.enabled": "true"}) for n in ("1", "64")]
    assert runs[0] == runs[1]


def test_embedding_finds_pairs_in_a_dense_cone(spark):
    r = np.random.default_rng(5)
    n, pairs, d = 8000, 300, 64
    x = embedding.unit(r.standard_normal((n, d)))
    axis = embedding.unit(r.standard_normal((1, d)))
    side = r.standard_normal((n // 3, d))
    side = embedding.unit(side - (side @ axis.T) * axis)
    x[:n // 3] = 0.75 ** .5 * axis + 0.25 ** .5 * side
    x = np.concatenate([x, embedding.plant(x, pairs, 0.9, 6)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    comp = {k.id: k.component for k in embedding.linked(df).collect()}
    assert sum(comp[i] != comp[n + i] for i in range(pairs)) <= 0.03 * pairs


def test_needed_passes_follow_the_densest_region():
    hits, density = np.full(80, 8), np.arange(80)
    even = embedding.needed_passes(hits, density, 16)
    hits[-10:] = 1
    assert even < 7 and embedding.needed_passes(hits, density, 16) > 60
    hits[-10:] = 0
    assert embedding.needed_passes(hits, density, 16) == float("inf")


def test_kept_digest_of_the_query(spark, tmp_path):
    texts = corpus(5, 20)
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.kept_sha256 for r in substring.query(spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.sha256(k.encode()).hexdigest() for i, _, _, k in plain_cut(texts)}
