"""Embedding near-dedup by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.llm.common import connected_components, materialize, table
from hirewave.session import ship_package

MIN_COSINE = 0.9
WINDOW = 64
MISS = 0.01
BLOCK = 1024
SAMPLE = 8192
PROBES = 1024
STRATA = 8


def n_passes(n: int, min_cosine: float = MIN_COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at exactly ``min_cosine`` of evenly spread vectors is missed with probability ``miss``.

    A pass puts a pair in one window when the leading log2(n / window) bits of
    its hashes agree; one bit agrees with probability 1 - angle / pi.
    """
    bits = max(0.0, math.log2(max(n, 1) / window))
    agree = (1 - math.acos(min_cosine) / math.pi) ** bits
    return 1 if agree > 0.9999 else max(4, math.ceil(math.log(miss) / math.log1p(-agree)))


def unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, flat values) of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors) of each vector length in the column."""
    widths, flat = _matrix(column)
    ends = np.cumsum(widths)
    for d in np.unique(widths):
        at = np.flatnonzero(widths == d)
        yield at, flat[(ends[at] - d)[:, None] + np.arange(d)]


def _planes(d: int, p: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, p, d]).standard_normal((d, 63))


def split_points(sample: np.ndarray, p: int, seed: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Where pass ``p`` cuts its projections: at the median of each node, deeper down of the node's leaf.

    So a bit halves the rows of a dense region too, however narrow it is.
    """
    proj = sample @ _planes(sample.shape[1], p, seed)
    depth = min(8, max(0, int(math.log2(max(len(sample), 1) / 32))))
    node, top = np.zeros(len(sample), dtype=np.int64), []
    for level in range(depth):
        cut = np.array([np.median(proj[node == k, level]) if (node == k).any() else 0.0 for k in range(1 << level)])
        node = 2 * node + (proj[:, level] > cut[node])
        top.append(cut)
    rest = [np.median(proj[node == k, depth:], axis=0) if (node == k).any() else np.zeros(63 - depth) for k in range(1 << depth)]
    return top, np.array(rest, dtype=np.float32)


def _hash_keys(x: np.ndarray, p: int, seed: int, cuts: tuple[list[np.ndarray], np.ndarray]) -> np.ndarray:
    """63 concatenated bits per vector: the sides of the pass's cuts it is on."""
    proj, (top, rest) = x @ _planes(x.shape[1], p, seed), cuts
    node = np.zeros(len(x), dtype=np.int64)
    for level, cut in enumerate(top):
        node = 2 * node + (proj[:, level] > cut[node])
    left = 63 - len(top)
    return (node << left) + (proj[:, len(top):] > rest[node]) @ (1 << np.arange(left - 1, -1, -1, dtype=np.int64))


def plant(sample: np.ndarray, count: int, min_cosine: float, seed: int) -> np.ndarray:
    """A random partner at ``min_cosine`` (a hair above) for each of the first ``count`` vectors."""
    x = sample[:count]
    u = np.random.default_rng([seed, 1]).standard_normal(x.shape)
    u = unit(u - (u * x).sum(axis=1, keepdims=True) * x)
    c = min_cosine + 1e-6
    return c * x + math.sqrt(max(0.0, 1 - c * c)) * u


def needed_passes(hits: np.ndarray, density: np.ndarray, passes: int, miss: float = MISS) -> float:
    """Passes that find all but ``miss`` of the planted pairs in the worst of ``STRATA`` density classes.

    ``hits`` is the number of ``passes`` in which each planted pair met.
    """
    worst = 0.0
    for part in np.array_split(np.argsort(density, kind="stable"), min(STRATA, len(density))):
        share = hits[part].mean() / passes
        worst = max(worst, math.inf if share == 0 else 1.0 if share >= 1 else math.log(miss) / math.log1p(-share))
        if (hits[part] == 0).mean() > 2 * miss:  # some meet less often than their class
            worst = max(worst, 1.25 * passes)
    return worst


def link_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row each of ``n`` rows reaches over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for side in (a, b):
            np.minimum.at(label, label[side], low)
            np.minimum.at(label, side, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def sweep_links(x: np.ndarray, window: int, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the windows of sorted vectors."""
    left, right = [np.zeros(0, int)], [np.zeros(0, int)]
    for k in range(1, min(window, len(x) - 1) + 1):
        at = np.flatnonzero(np.einsum("ij,ij->i", x[k:], x[:-k]) >= min_cosine)
        left.append(at)
        right.append(at + k)
    return np.concatenate(left), np.concatenate(right)


_SORTED = "pass int, width int, key long, rep long, v "
_ORDER = ["pass", "width", "key", "rep"]


def _sweep(spread: DataFrame, kind: str, window: int, min_cosine: float, origins: list[np.ndarray]) -> DataFrame:
    """Links (a, b) over the windows of all of ``spread``, put in order; whole at the borders of partitions.

    Each task also hands out the first and last ``window`` rows of its
    partition.  These rows, in order, hold every pair that is in one window
    across borders (a partition of fewer rows is handed out whole), so a second
    sweep over them finds those pairs.  Rows with a negative ``rep`` are
    planted: they link no others; (rep, pass) tells that one met its origin, or
    a row that its origin links to.
    """
    spark = spread.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0

        def edge(b: pa.RecordBatch) -> pa.RecordBatch:
            none = pa.nulls(b.num_rows, pa.int64())
            return pa.RecordBatch.from_arrays([none, none, *b.columns], names=["a", "b", *_ORDER, "v"])

        def pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), *(pa.nulls(len(a), f.type) for f in last.schema)], names=["a", "b", *_ORDER, "v"])

        for b in batches:
            if not b.num_rows:
                continue
            if total < window:
                yield edge(b.slice(0, window - total))
            total += b.num_rows
            t = b if last is None else pa.Table.from_batches([last, b]).combine_chunks().to_batches()[0]
            last = t.slice(max(0, t.num_rows - window))
            group = np.stack([t.column("pass").to_numpy(), t.column("width").to_numpy()])
            starts = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(axis=0)])
            for s, e in zip(starts, np.r_[starts[1:], t.num_rows]):
                run_rows, p = t.slice(s, e - s), int(group[0, s])
                reps = run_rows.column("rep").to_numpy()
                x = unit(_matrix(run_rows.column("v"))[1].reshape(e - s, -1))
                for i in range(0, len(x), 4096):  # blocks that overlap by one window
                    lo = max(0, i - window)
                    y, r = x[lo:i + 4096], reps[lo:i + 4096]
                    left, right = sweep_links(y, window, min_cosine)
                    real = (r[left] >= 0) & (r[right] >= 0)
                    label = link_labels(len(y), left[real], right[real])
                    own = np.flatnonzero(label != np.arange(len(label)))
                    yield pairs(r[own], r[label[own]])
                    probe, other = _met(left, right, r)
                    if len(probe):
                        near = np.array([origins[-1 - q] @ y[o] >= min_cosine - 1e-6 for q, o in zip(r[probe], other)])
                        met = np.unique(r[probe][near])
                        yield pairs(met, np.full(len(met), p, dtype=np.int64))
        if last is not None and total > window:
            yield edge(last.slice(max(0, last.num_rows - (total - window))))

    kinds = f"a long, b long, {_SORTED}{kind}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inner = materialize(spread.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(run, kinds), "vec-sweep")
    edges = inner.where("a is null").select(*_ORDER, "v").repartition("pass", "width").sortWithinPartitions(*_ORDER)
    return materialize(inner.where("a is not null").select("a", "b").unionByName(
        edges.mapInArrow(run, kinds).where("a is not null").select("a", "b")), "vec-links")


def _met(left: np.ndarray, right: np.ndarray, reps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(planted row, other row) of the links that join one planted row and one other."""
    a, b = np.r_[left, right], np.r_[right, left]
    at = (reps[a] < 0) & (reps[b] >= 0)
    return a[at], b[at]


def _dealt(members: DataFrame) -> DataFrame:
    """Pairs of blocks (bi, bj) of about ``BLOCK`` rows of each ``root``, a group of bounded size each."""
    sizes = members.groupBy("root").agg(F.count("*").alias("m"))
    placed = members.join(sizes, "root").withColumn("nb", F.ceil(F.col("m") / BLOCK).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("rep"), "nb").cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "root", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "rep", "n", "v")


def _all_links(classes: DataFrame, min_cosine: float) -> DataFrame:
    """Links (a, b) that connect what the links over all pairs of vectors of one length connect."""

    def link(t: pa.Table) -> pa.Table:
        reps, own = (t.column(c).to_numpy() for c in ("rep", "own"))
        x = unit(_matrix(t.column("v"))[1].reshape(len(reps), -1))
        first = np.flatnonzero(own == t.column("bi")[0].as_py())
        second = np.flatnonzero(own == t.column("bj")[0].as_py())
        a, b = np.nonzero(x[first] @ x[second].T >= min_cosine)
        label = link_labels(len(x), first[a], second[b])
        at = np.flatnonzero(label != np.arange(len(x)))
        return pa.table({"a": reps[at], "b": reps[label[at]]})

    return _dealt(classes.withColumn("root", F.size("v"))).groupBy("root", "bi", "bj").applyInArrow(link, "a long, b long")


def _found_links(classes: DataFrame, count: int, kind: str, min_cosine: float, window: int, passes: int | None,
                 seed: int) -> DataFrame:
    """Links (a, b) of the classes, by passes or, where these would compare as much, by all pairs."""
    if passes is None and n_passes(count, min_cosine, window) * window >= count / 2:
        return _all_links(classes, min_cosine)
    spark = classes.sparkSession
    picked = F.pmod(F.xxhash64(F.lit(seed), "v"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(count, 1)) * (1 << 30))
    drawn = classes.where(picked).select(F.xxhash64("v").alias("h"), F.col("v").cast("array<double>").alias("v")).toArrow().sort_by("h")
    samples = {x.shape[1]: unit(x) for _, x in _by_width(drawn["v"])} if drawn.num_rows else {}
    origins, density, rows = [], [], []
    if passes is None:
        for x in samples.values():
            m = math.ceil(PROBES * len(x) / drawn.num_rows) if x.shape[1] > 1 else 0
            y = plant(x, m, min_cosine, seed)
            k = min(16, len(x) - 1)
            origins += list(x[:len(y)])
            rows += y.tolist()
            density += np.partition(x[:len(y)] @ x.T, -k - 1, axis=1)[:, -k - 1].tolist()
    planted = spark.createDataFrame([(-1 - i, v) for i, v in enumerate(rows)], "rep long, v array<double>").withColumn(
        "v", F.col("v").cast(kind))
    all_rows = classes.select("rep", F.col("v").cast(kind).alias("v")).unionByName(planted)
    hits = np.zeros(len(rows), dtype=np.int64)
    done, want, links = 0, passes or math.ceil(1.1 * n_passes(count, min_cosine, window)), None
    while True:
        cuts = {d: {p: split_points(x, p, seed) for p in range(done, want)} for d, x in samples.items()}

        def key(batches: Iterator[pa.RecordBatch], lo: int = done, hi: int = want, cuts: dict = cuts) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                for at, x in _by_width(b.column("v")):
                    x, part, d = unit(x), b.take(pa.array(at)), x.shape[1]
                    for p in range(lo, hi):
                        here = cuts[d][p] if d in cuts else split_points(x[:0], p, seed)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), p, np.int32)), pa.array(np.full(len(at), d, np.int32)),
                             pa.array(_hash_keys(x, p, seed, here)), part.column("rep"), part.column("v")],
                            names=[*_ORDER, "v"])

        found = _sweep(all_rows.mapInArrow(key, f"{_SORTED}{kind}"), kind, window, min_cosine, origins)
        real = found.where("a >= 0")
        links = real if links is None else links.unionByName(real)
        if not rows:
            return links
        for r in found.where("a < 0").distinct().groupBy("a").count().collect():  # a row for each planted vector at most
            hits[-1 - r["a"]] += r["count"]
        need = needed_passes(hits, np.array(density), want)
        if need <= want:
            return links
        if need * window >= count / 2:
            return _all_links(classes, min_cosine)
        done, want = want, math.ceil(need)


def linked(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           min_cosine: float = MIN_COSINE, window: int = WINDOW, passes: int | None = None,
           seed: int = 42) -> DataFrame:
    """(id, n_links, component) for every row of ``vectors``.

    Rows with equal vectors are one class.  In each pass the classes are put in
    the order of concatenated random cuts (``split_points``) and every vector is
    compared with the next ``window``; links found in all passes are united
    into components.  A component's links are then counted over all its pairs,
    in blocks (counts, not pairs, leave a task), so a window never cuts a large
    group short.  Without ``passes`` their number is measured: partners at
    exactly ``min_cosine`` are planted beside a sample of the vectors, and
    passes are added until those in the densest regions are missed with
    probability ``MISS`` (``needed_passes``).  Where passes would compare as
    many pairs as there are, all pairs are compared.  No link below
    ``min_cosine`` is ever made.

    Null, zero and non-finite vectors, and vectors with null components, link
    with nothing; vectors of different lengths don't either.  Each is its own
    component.  Rows with a repeated id are rows of their own (linked rows of
    one id count each other); a null id is never a component's name unless its
    whole component is without ids.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    id_type, kind = dict(vectors.dtypes)[id_col], dict(vectors.dtypes)[vector_col]
    v = F.col("v")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).select(
        "id", F.when(F.coalesce(fine, F.lit(False)), F.transform(v, lambda x: x + F.lit(0).cast(kind[6:-1]))).alias("v"))
    classes = rows.where("v is not null").groupBy("v").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "vec-classes")
    near = kind if kind in ("array<float>", "array<double>") else "array<double>"
    links = _found_links(classes, classes.count(), near, min_cosine, window, passes, seed)
    roots = connected_components(links, "vec-cc")
    members = materialize(classes.join(roots, classes.rep == roots.node).select("rep", "root", "n", "low", "v"), "vec-members")
    counted = _count_links(members, min_cosine)
    lows = members.groupBy("root").agg(F.min("low").alias("component"))
    info = members.select("rep", "root").join(lows, "root").join(counted, "rep", "left").select("rep", "component", "others")
    found = classes.join(info, "rep", "left").select(
        "v", F.coalesce("component", "low").alias("component"),
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    good = rows.where("v is not null").join(found, "v").select("id", "n_links", "component")
    return good.unionByName(rows.where("v is null").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast(id_type).alias("component")))


def _count_links(members: DataFrame, min_cosine: float) -> DataFrame:
    """(rep, others): rows in the classes that a class links to, over all pairs of its component.

    Components are cut into blocks of about ``BLOCK`` vectors; each pair of
    blocks is one group of bounded size.
    """
    def count(t: pa.Table) -> pa.Table:
        reps, n, own = (t.column(c).to_numpy() for c in ("rep", "n", "own"))
        _, flat = _matrix(t.column("v"))
        x = unit(flat.reshape(len(reps), -1))
        bi, bj = t.column("bi")[0].as_py(), t.column("bj")[0].as_py()
        first = own == bi
        if bi == bj:
            near = x @ x.T >= min_cosine
            np.fill_diagonal(near, False)
            others = near @ n
        else:
            near = x[first] @ x[~first].T >= min_cosine
            others = np.empty(len(reps), dtype=np.int64)
            others[first], others[~first] = near @ n[~first], near.T @ n[first]
        return pa.table({"rep": reps, "others": others.astype(np.int64)})

    return _dealt(members).groupBy("root", "bi", "bj").applyInArrow(count, "rep long, others long").groupBy("rep").agg(
        F.sum("others").alias("others"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linked(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))
