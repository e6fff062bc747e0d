"""Quality classifier by co-training of a text view and a page-metadata view."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.llm.common import materialize, table
from hirewave.session import ship_package

TRAIN_ROWS = 20_000
POOL_ROWS = 10_000
ROUNDS = 3
CONFIDENT = 0.98
THRESHOLD = 0.5
BINS = 16
WORD_BUCKETS = 256
#: rows held at full width in the fit
CHUNK = 1000
_MARKS = b"!#$%&*|.,;:?-_=/\"'()"


def text_features(text: str | None) -> list[float]:
    """Shape of a whole text (lengths, repetition, letter and mark shares), then its hashed word counts."""
    raw = (text or "").encode("utf-8", "replace")
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, m, k = max(len(raw), 1), max(len(words), 1), max(len(lines), 1)
    of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) / n
    top = max(Counter(words).values(), default=0)
    pairs = len(set(zip(words, words[1:])))
    ends = Counter(w[-1:] for w in words)
    return [np.log1p(len(raw)), np.log1p(len(words)), n / m, m / k, len(set(words)) / m, top / m,
            pairs / max(m - 1, 1), len(set(lines)) / k, max(map(len, lines), default=0) / n,
            of[65:91].sum(), of[97:123].sum(), of[48:58].sum(), of[128:].sum(), of[[9, 10, 11, 12, 13, 32]].sum(),
            sum(map(bytes.isupper, words)) / m, sum(map(bytes.istitle, words)) / m, sum(len(w) > 12 for w in words) / m,
            sum(len(w) < 4 for w in words) / m, 1 - sum(c for e, c in ends.items() if e.isalnum() or e >= b"\x80") / m,
            *(of[c] for c in _MARKS), *_word_counts(words)]


def _word_counts(words: list[bytes]) -> list[int]:
    """Words in ``WORD_BUCKETS`` buckets by the hash of their small letters."""
    out = [0] * WORD_BUCKETS
    for w, n in Counter(words).items():
        out[zlib.crc32(w.lower()) % WORD_BUCKETS] += n
    return out


N_TEXT = len(text_features(""))
N_SHAPE = N_TEXT - WORD_BUCKETS
META_BUCKETS = 256


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> list[int]:
    """Buckets that are on: source, language, length, language with length."""
    size = -1 if n_chars is None else int(max(n_chars, 0)).bit_length()
    return [zlib.crc32(repr(x).encode()) % META_BUCKETS for x in (("s", source), ("l", lang), ("n", size), ("ln", lang, size))]


def _one_hot(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Every shape feature as the bin it falls in, the word counts' roots at length 1, and a constant."""
    wide = len(edges) * (edges.shape[1] + 1)
    out = np.zeros((len(x), wide + x.shape[1] - len(edges) + 1), dtype=np.float32)
    out[:, -1] = 1
    for j in range(len(edges)):
        out[np.arange(len(x)), j * (edges.shape[1] + 1) + np.searchsorted(edges[j], x[:, j])] = 1
    words = np.sqrt(np.maximum(x[:, len(edges):], 0))
    out[:, wide:-1] = words / np.maximum(np.sqrt((words * words).sum(axis=1, keepdims=True)), 1e-9)
    return out


def _multi_hot(buckets: np.ndarray) -> np.ndarray:
    out = np.zeros((len(buckets), META_BUCKETS + 1), dtype=np.float32)
    np.put_along_axis(out, buckets, 1, axis=1)
    out[:, -1] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray | Callable, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps; ``x`` is a matrix, or gives the rows of a slice.

    Gradient and Hessian are summed over chunks of rows, so only a chunk is
    ever held as numbers of full width.
    """
    dense = x if callable(x) else x.__getitem__
    w = np.zeros(dense(slice(0, 0)).shape[1])
    for _ in range(steps):
        h, slope = ridge * np.eye(len(w)), -ridge * w
        for i in range(0, len(y), CHUNK):
            part = dense(slice(i, i + CHUNK)).astype(np.float64)
            p = _sigmoid(part @ w)
            h += (part * (p * (1 - p))[:, None]).T @ part
            slope += part.T @ (y[i:i + CHUNK] - p)
        step = np.linalg.solve(h, slope)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


@dataclass
class Model:
    """Both views, and the calibrated combination of their scores."""

    edges: np.ndarray
    text: np.ndarray
    meta: np.ndarray
    stack: np.ndarray

    def views(self, x: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _one_hot(x, self.edges) @ self.text, _multi_hot(buckets) @ self.meta

    def score(self, x: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.views(x, buckets)
        z = self.stack[0] + self.stack[1] * np.clip(a, -15, 15) + self.stack[2] * np.clip(b, -15, 15)
        return _sigmoid(a), _sigmoid(b), _sigmoid(z)


def co_train(x: np.ndarray, buckets: np.ndarray, y: np.ndarray, pool_x: np.ndarray, pool_buckets: np.ndarray,
             rounds: int = ROUNDS, confident: float = CONFIDENT, edges: np.ndarray | None = None,
             pick: Callable | None = None) -> Model:
    """Fit both views over ``rounds``: each view's confident pool rows teach the other view.

    A fifth of the labelled rows is held out to calibrate the combination.  A
    view hands over at most a tenth of the pool a round, in the class shares
    of the labels, and only rows beyond ``confident`` on either side.

    With ``pick`` the pool is a table too large for here: ``pick(model, share,
    confident)`` gives the rows each view is sure of, out of all, and ``edges``
    the bins over all rows.
    """
    held = np.arange(len(y)) % 5 == 4
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    if edges is None:
        edges = np.quantile(np.concatenate([x, pool_x])[:, :N_SHAPE], cuts, axis=0).T
    wide = {"text": lambda part: _one_hot(part, edges), "meta": _multi_hot}
    known, pool = {"text": x, "meta": buckets}, {"text": pool_x, "meta": pool_buckets}
    taught = {"text": np.full(len(pool_x), -1), "meta": np.full(len(pool_x), -1)}
    share = y[~held].mean()
    for r in range(rounds + 1):
        fits = {}
        for view in wide:
            got = taught[view] >= 0
            rows = np.concatenate([known[view][~held], pool[view][got]])
            fits[view] = fit_logistic(lambda part, rows=rows, view=view: wide[view](rows[part]), np.concatenate([y[~held], taught[view][got]]))
        if r == rounds or not (len(pool_x) or pick):
            break
        if pick:
            px, pb, new = pick(Model(edges, fits["text"], fits["meta"], np.zeros(3)), share, confident)
            pool = {"text": np.concatenate([pool["text"], px]), "meta": np.concatenate([pool["meta"], pb])}
            taught = {view: np.concatenate([taught[view], new[view]]) for view in taught}
            continue
        for view, other in (("text", "meta"), ("meta", "text")):
            p = _sigmoid(np.concatenate([wide[view](pool[view][i:i + CHUNK]) @ fits[view] for i in range(0, len(pool[view]), CHUNK)]))
            for label, rank, part in ((1, -p, share), (0, p, 1 - share)):
                sure = (p >= confident) if label else (p <= 1 - confident)
                free = np.flatnonzero(sure & (taught[other] < 0))
                most = int(np.ceil(len(pool_x) / 10 * part))
                taught[other][free[np.argsort(rank[free], kind="stable")[:most]]] = label
    model = Model(edges, fits["text"], fits["meta"], np.zeros(3))
    a, b = model.views(x[held], buckets[held])
    base = np.stack([np.ones(held.sum()), np.clip(a, -15, 15), np.clip(b, -15, 15)], axis=1)
    model.stack = fit_logistic(base, y[held], ridge=0.1) if len(set(y[held])) == 2 else np.array([0, 1, 0.0])
    return model


def _inputs(docs: DataFrame, id_col: str, text_col: str, meta: tuple[str, str, str]) -> list[Column]:
    source, lang, chars = meta
    return [F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
            F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"),
            F.col(chars).cast("long").alias("chars")]


def _featurise(b: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Both views of the rows of a batch whose text, source, language and length start at column ``at``."""
    cols = [b.column(at + i) for i in range(4)]
    x = np.array([text_features(t.as_py()) for t in cols[0]], dtype=np.float64).reshape(b.num_rows, N_TEXT)
    m = np.array([meta_features(s.as_py(), g.as_py(), c.as_py()) for s, g, c in zip(*cols[1:])], dtype=np.int64)
    return x, m.reshape(b.num_rows, 4)


def _matrices(got: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Both views of the rows of a table with shapes x, word counts w (32 bits each) and buckets m."""
    x, m = (got[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("x", "m"))
    w = np.frombuffer(b"".join(got["w"].to_pylist()), dtype="<u4")
    return (np.concatenate([x.reshape(got.num_rows, N_SHAPE), w.reshape(got.num_rows, WORD_BUCKETS)], axis=1),
            m.reshape(got.num_rows, 4))


def _pick_from(pool: DataFrame, most: int) -> Callable:
    """``pick`` of ``co_train``: every row of ``pool`` (id, x, w, m) is scored by both views in one job a round.

    Each view hands over the ``most`` rows it is surest of in all, in the class
    shares of the labels.  Rows already handed over to a view are left out.
    """
    given = {"text": {}, "meta": {}}
    kind = pool.schema["id"].dataType.simpleString()

    def pick(model: Model, share: float, confident: float) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(0, b.num_rows, 1000):
                    part = b.slice(i, 1000)
                    p = [_sigmoid(s) for s in model.views(*_matrices(pa.Table.from_batches([part])))]
                    sure = (np.maximum(*p) >= confident) | (np.minimum(*p) <= 1 - confident)
                    t = part.filter(pa.array(sure))
                    yield pa.RecordBatch.from_arrays([*t.columns, *(pa.array(s[sure]) for s in p)], names=["id", "x", "w", "m", "text", "meta"])

        scored = pool.mapInArrow(run, f"id {kind}, x array<double>, w binary, m array<bigint>, text double, meta double")
        taken = []
        for view, other in (("text", "meta"), ("meta", "text")):
            for label, part in ((1, share), (0, 1 - share)):
                sure = F.col(view) >= confident if label else F.col(view) <= 1 - confident
                rank = F.col(view).desc() if label else F.col(view)
                limit = int(np.ceil(most * part))
                got = scored.where(sure).orderBy(rank, F.xxhash64("id"), "id").limit(limit + len(given[other])).toArrow()
                rows = [i for i, k in enumerate(got["id"].to_pylist()) if k not in given[other]][:limit]
                got = got.take(pa.array(rows, pa.int64()))
                given[other].update(dict.fromkeys(got["id"].to_pylist()))
                taken.append((*_matrices(got), other, label))
        return (np.concatenate([t[0] for t in taken]), np.concatenate([t[1] for t in taken]),
                {view: np.concatenate([np.full(len(t[0]), t[3] if t[2] == view else -1) for t in taken]) for view in given})

    return pick


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          meta: tuple[str, str, str] = ("source", "lang", "n_chars"), label_id: str = "doc_id",
          label_col: str = "quality", train_rows: int = TRAIN_ROWS, pool_rows: int = POOL_ROWS) -> Model | None:
    """Co-trained model, from at most ``train_rows`` labelled rows and the surest of all others.

    The labelled rows are picked by id hash.  All other rows are scored every
    round; the fit reads at most a tenth of ``pool_rows`` from each view a
    round.  Up to ``pool_rows`` of them are held on the driver; more are
    scored by Spark jobs, with bin edges from approximate quantiles over all
    rows.  A document with several labels counts with its lowest; labels
    without a document, and null labels, are left out.  Rows that repeat an id
    count once (the one with the smallest features), rows without an id not at
    all.  With fewer than two classes there is no model (None).
    """
    ship_package(docs.sparkSession)
    marked = (labels.where(f"`{label_col}` is not null and `{label_id}` is not null").groupBy(F.col(label_id).alias("_id"))
              .agg(F.min(F.col(label_col).cast("int")).alias("y")).orderBy(F.xxhash64("_id"), "_id").limit(train_rows))
    rows = docs.select(*_inputs(docs, id_col, text_col, meta)).where("id is not null")
    known = rows.join(F.broadcast(marked), F.col("id") == F.col("_id"), "left")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                b = batch.slice(i, 1000)
                x, m = _featurise(b, 1)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.ravel()))
                         for v in (x[:, :N_SHAPE], m)]
                words = pa.array([v.tobytes() for v in x[:, N_SHAPE:].astype("<u4")], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), lists[0], words, lists[1], b.column(5)], names=["id", "x", "w", "m", "y"])

    seen = known.select("id", "text", "source", "lang", "chars", "y").mapInArrow(
        features, f"id {dict(docs.dtypes)[id_col]}, x array<double>, w binary, m array<bigint>, y int")
    seen = materialize(seen.groupBy("id").agg(F.min(F.struct("x", "w", "m", "y")).alias("f")).select("id", "f.*"), "quality-features")
    pool = seen.where("y is null").select("id", "x", "w", "m")
    whole = pool.limit(pool_rows + 1).count() <= pool_rows
    got = (seen if whole else seen.where("y is not null")).select("x", "w", "m", "y").toArrow()
    y = np.array([-1 if v is None else min(max(v, 0), 1) for v in got["y"].to_pylist()])
    x, m = _matrices(got)
    del got
    order = np.lexsort((*m.T, *x.T))  # the same order whatever task came first
    order = order[np.random.default_rng(0).permutation(len(y))]
    y, x, m = y[order], x[order], m[order]
    has = y >= 0
    if len(set(y[has])) < 2 or len(set(y[has][np.arange(has.sum()) % 5 != 4])) < 2:
        return None
    if whole:
        return co_train(x[has], m[has], y[has], x[~has], m[~has])
    cuts = ", ".join(str(c) for c in np.linspace(0, 1, BINS + 1)[1:-1])
    edges = seen.agg(*[F.expr(f"percentile_approx(x[{j}], array({cuts}), 1000)").alias(f"e{j}") for j in range(N_SHAPE)]).first()
    return co_train(x, m, y, x[:0], m[:0], edges=np.array([list(e) for e in edges]), pick=_pick_from(pool, pool_rows // 10))


def scores(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
           meta: tuple[str, str, str] = ("source", "lang", "n_chars"), threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` as struct ``d`` with text_score, meta_score, score and keep.

    Null texts count as empty; null metadata is a value of its own.  Without a
    model every score is 1 and every row is kept.
    """
    ship_package(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    rows = docs.select(whole, *_inputs(docs, id_col, text_col, meta)[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                b = batch.slice(i, 1000)
                if model is None:
                    out = [np.ones(b.num_rows)] * 3
                else:
                    out = model.score(*_featurise(b, 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array(np.asarray(s, dtype=np.float64)) for s in out], pa.array(out[2] >= threshold)],
                    names=["d", "text_score", "meta_score", "score", "keep"])

    kind = rows.select("d").schema
    for c in ("text_score", "meta_score", "score"):
        kind = kind.add(c, "double")
    return rows.mapInArrow(run, kind.add("keep", "boolean"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows the classifier rejects."""
    good = scores(docs, train(docs, labels)).where("keep")
    return good.select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("d.doc_id", "text_score", "meta_score", "score", "keep")
