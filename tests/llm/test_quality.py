"""Co-training against a plain version with whole matrices; word counts of any size."""

import numpy as np

from hirewave.llm import quality


def wide_text(x, edges):
    """One 0/1 column for every bin of every shape, the roots of the word counts at length 1, and a constant."""
    n = quality.N_SHAPE
    bins = np.stack([(x[:, :n, None] > edges[None]).sum(axis=2)], axis=0)[0]
    hot = np.eye(edges.shape[1] + 1)[bins].reshape(len(x), -1)
    words = np.sqrt(x[:, n:])
    words = words / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9)
    return np.concatenate([hot, words, np.ones((len(x), 1))], axis=1)


def wide_meta(m):
    out = np.zeros((len(m), quality.META_BUCKETS + 1))
    for i, row in enumerate(m):
        out[i, row] = 1
    out[:, -1] = 1
    return out


def newton(x, y, ridge):
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ np.diag(p * (1 - p)) @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if abs(step).max() < 1e-4:
            break
    return w


def plain(x, m, y, pool_x, pool_m):
    """(text weights, metadata weights, combination) by whole matrices."""
    held = np.arange(len(y)) % 5 == 4
    both = np.concatenate([x, pool_x])[:, :quality.N_SHAPE]
    edges = np.quantile(both, np.linspace(0, 1, quality.BINS + 1)[1:-1], axis=0).T
    known = {"text": wide_text(x, edges), "meta": wide_meta(m)}
    pool = {"text": wide_text(pool_x, edges), "meta": wide_meta(pool_m)}
    taught = {v: {} for v in known}
    share = y[~held].mean()
    for r in range(quality.ROUNDS + 1):
        fits = {v: newton(np.concatenate([known[v][~held], pool[v][sorted(taught[v])]]),
                          np.concatenate([y[~held], [taught[v][i] for i in sorted(taught[v])]]), 1.0) for v in known}
        if r == quality.ROUNDS:
            break
        for v, other in (("text", "meta"), ("meta", "text")):
            p = 1 / (1 + np.exp(-np.clip(pool[v] @ fits[v], -30, 30)))
            for label, part in ((1, share), (0, 1 - share)):
                sure = [i for i in range(len(p)) if i not in taught[other] and (p[i] >= quality.CONFIDENT if label else p[i] <= 1 - quality.CONFIDENT)]
                sure.sort(key=lambda i: (-p[i] if label else p[i], i))
                taught[other].update(dict.fromkeys(sure[:int(np.ceil(len(p) / 10 * part))], label))
    a, b = (np.clip(known[v][held] @ fits[v], -15, 15) for v in ("text", "meta"))
    return edges, fits["text"], fits["meta"], newton(np.stack([np.ones(held.sum()), a, b], axis=1), y[held], 0.1)


def rows(seed, n):
    r = np.random.default_rng(seed)
    y = (r.random(n) < 0.6).astype(int)
    x = np.concatenate([y[:, None] + 0.8 * r.standard_normal((n, quality.N_SHAPE)), r.poisson(3 + 4 * y[:, None], (n, quality.WORD_BUCKETS))], axis=1)
    m = np.stack([y * 7 + r.integers(0, 3, n), r.integers(0, 200, n), r.integers(0, 9, n), y + 30], axis=1)
    return x, m, y


def test_co_training_equals_whole_matrices(monkeypatch):
    monkeypatch.setattr(quality, "CHUNK", 37)
    x, m, y = rows(1, 230)
    px, pm, _ = rows(2, 160)
    got, want = quality.co_train(x, m, y, px, pm), plain(x, m, y, px, pm)
    for a, b in zip((got.edges, got.text, got.meta, got.stack), want):
        assert a.shape == b.shape and np.abs(a - b).max() < 1e-3
    test_x, test_m, test_y = rows(3, 300)
    score = got.score(test_x, test_m)[2]
    z = np.stack([np.ones(300), np.clip(wide_text(test_x, want[0]) @ want[1], -15, 15), np.clip(wide_meta(test_m) @ want[2], -15, 15)], axis=1) @ want[3]
    assert np.abs(score - 1 / (1 + np.exp(-z))).max() < 1e-3 and ((score > 0.5) == test_y).mean() > 0.9


def test_chunks_do_not_change_the_fit(monkeypatch):
    x, _, y = rows(4, 500)
    fits = []
    for chunk in (1, 64, 1000):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        fits.append(quality.fit_logistic(x, y))
    assert max(np.abs(f - fits[0]).max() for f in fits) < 1e-8


def test_word_counts_have_no_end():
    few, many = (quality.text_features("word " * n + "other") for n in (300, 3000))
    assert max(few[quality.N_SHAPE:]) == 300 and max(many[quality.N_SHAPE:]) == 3000


def test_long_texts_keep_their_counts_through_spark(spark):
    docs = spark.createDataFrame([(i, "good words here. " * 3000 if i % 2 else "BAD!!! " * 3000, "en", "s", 9) for i in range(40)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    got = {r.doc_id: r.keep for r in quality.scores(docs, quality.train(docs, labels)).select("d.doc_id", "keep").collect()}
    assert got == {i: bool(i % 2) for i in range(40)}
