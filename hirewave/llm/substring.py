"""Substring dedup by super-k-mer partitioning of word windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.llm.common import materialize, table
from hirewave.session import ship_package

WINDOW = 13
MINIMISER = 2
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 6 << 20
TASK_BYTES = 128 << 20
HOT_RUNS = 1000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


class Rolling:
    """Polynomial hashes (mod 2**64) of any byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray) -> None:
        n = len(buf) + 1
        powers = np.full(n, _BASE, dtype=_U)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.back = np.full(n, _U(_inverse(int(_BASE))), dtype=_U)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)
        self.sums = np.zeros(n, dtype=_U)
        np.cumsum((buf.astype(_U) + _U(1)) * powers[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.back[start])


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class Words:
    """Texts as one buffer of words, each closed by one space."""

    def __init__(self, texts: list[bytes]) -> None:
        raw = np.frombuffer(b"".join(t + b" " for t in texts), dtype=np.uint8)
        space = _SPACES[raw]
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]
        stop = np.flatnonzero(space & keep)  # in the raw buffer
        self.buf = np.where(space, np.uint8(32), raw)[keep]
        self.stop = np.flatnonzero(space[keep])  # place of each word's closing space
        self.start = np.append(0, self.stop[:-1] + 1)[:len(self.stop)]
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(ends, stop, side="right")  # text of each word
        self.count = np.bincount(self.doc, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count  # first word of each text

    def __len__(self) -> int:
        return len(self.stop)


def super_kmers(w: Words, hashes: Rolling, window: int, minimiser: int) -> tuple[np.ndarray, ...]:
    """(first word, windows, minimiser hash) of each run of windows that share a minimiser's place."""
    n = len(w) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, _U),)
    g = hashes(w.start[:len(w) - minimiser + 1], w.stop[minimiser - 1:])
    best, place = g[:n].copy(), np.arange(n)
    for k in range(1, window - minimiser + 1):
        lower = g[k:k + n] < best
        best[lower] = g[k:k + n][lower]
        place[lower] = np.flatnonzero(lower) + k
    valid = w.doc[:n] == w.doc[window - 1:]
    new = np.append(True, (place[1:] != place[:-1]) | ~valid[:-1])
    heads = np.flatnonzero(new & valid)
    run = np.cumsum(new & valid) - 1
    counts = np.bincount(run[valid], minlength=len(heads))
    return heads, counts, best[heads]


_RECORD = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("word", "<u4"), ("wins", "<u4"), ("bytes", "<u4")])
_MARK = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("word", "<u4"), ("wins", "<u4"), ("mask", "<u4")])
MAX_RUN = 31


def _pack(records: np.ndarray, strings: list[bytes], kind: bytes) -> bytes:
    columns = b"".join(records[f].tobytes() for f in records.dtype.names)
    return kind + zstandard.compress(len(records).to_bytes(4, "little") + columns + b"".join(strings), 3)


def _unpack(payload: bytes, kind: np.dtype) -> tuple[np.ndarray, bytes]:
    raw = zstandard.decompress(payload[1:])
    n = int.from_bytes(raw[:4], "little")
    out, at = np.zeros(n, dtype=kind), 4
    for f in kind.names:
        size = n * kind[f].itemsize
        out[f] = np.frombuffer(raw[at:at + size], dtype=kind[f])
        at += size
    return out, raw[at:]


class Packer:
    """Turns documents into packed rows for the buckets."""

    def __init__(self, buckets: int, hot: np.ndarray, window: int, minimiser: int) -> None:
        self.buckets, self.hot, self.window, self.minimiser = buckets, hot, window, minimiser

    def __call__(self, docs: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, bytes]]:
        docs = sorted(docs, key=lambda d: d[:2])
        w = Words([d[2] for d in docs])
        hashes = Rolling(w.buf)
        heads, wins, key = super_kmers(w, hashes, self.window, self.minimiser)
        if not len(heads):
            return
        # a hot minimiser's windows travel one by one, to the bucket of the whole window
        hot = np.isin(key, self.hot)
        if hot.any():
            spread = np.where(hot, wins, 1)
            row = np.repeat(np.arange(len(heads)), spread)
            step = np.arange(len(row)) - np.repeat(np.cumsum(spread) - spread, spread)
            heads, wins, key, hot = heads[row] + step, np.where(hot[row], 1, wins[row]), key[row], hot[row]
            key = np.where(hot, hashes(w.start[heads], w.stop[heads + self.window - 1]), key)
        ids = np.array([d[0] for d in docs], dtype=np.int64)
        tags = np.array([d[1] for d in docs], dtype=np.uint32)
        doc = w.doc[heads]
        rec = np.zeros(len(heads), dtype=_RECORD)
        rec["doc"], rec["tag"], rec["wins"] = ids[doc], tags[doc], wins
        rec["word"] = heads - w.first[doc]
        a, b = w.start[heads], w.stop[heads + wins + self.window - 2]
        rec["bytes"] = b - a
        text = w.buf.tobytes()
        strings = [text[i:j] for i, j in zip(a.tolist(), b.tolist())]
        # of equal strings only those of the smallest document here travel: the others are all marked
        lowest: dict[bytes, int] = {}
        known = np.array([lowest.setdefault(s, d) < d for s, d in zip(strings, rec["doc"].tolist())])
        bucket = (mix(key) % _U(self.buckets)).astype(np.int64)
        for mine, kind in ((~known, b"s"), (known, b"m")):
            order = np.flatnonzero(mine)
            order = order[np.lexsort((order, key[order], bucket[order]))] if kind == b"s" else order
            at = bucket[order] if kind == b"s" else np.full(len(order), int(ids[0]) % self.buckets)
            for part in np.split(order, np.flatnonzero(np.diff(at)) + 1):
                if not len(part):
                    continue
                if kind == b"s":
                    yield int(bucket[part[0]]), _pack(rec[part], [strings[i] for i in part.tolist()], kind)
                else:
                    marks = rec[part].astype(_MARK)
                    marks["wins"], marks["mask"] = wins[part], (1 << wins[part]) - 1
                    yield int(at[0]), _pack(marks, [], kind)


def marks_of(payloads: list[bytes], window: int) -> np.ndarray:
    """Marks (doc, tag, first word, window mask) of one bucket: windows that start in a smaller document."""
    rec, strings, done = [], [], []
    for p in payloads:
        if p[:1] == b"m":
            done.append(_unpack(p, _MARK)[0])
            continue
        r, text = _unpack(p, _RECORD)
        ends = np.cumsum(r["bytes"].astype(np.int64)).tolist()
        strings += [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        rec.append(r)
    if not rec:
        return np.concatenate(done) if done else np.zeros(0, dtype=_MARK)
    r = np.concatenate(rec)
    number: dict[bytes, int] = {}
    text_of = np.array([number.setdefault(s, len(number)) for s in strings])
    low = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(low, text_of, r["doc"])
    w = Words(list(number))
    n_wins = w.count - window + 1
    own = np.repeat(np.arange(len(number)), n_wins)
    step = np.arange(len(own)) - np.repeat(np.cumsum(n_wins) - n_wins, n_wins)
    first = w.first[own] + step
    a, b = w.start[first], w.stop[first + window - 1]
    order, group = _exact_groups(w.buf, Rolling(w.buf)(a, b), a, b)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    least = np.repeat(np.minimum.reduceat(low[own[order]], starts), np.diff(np.append(starts, len(order))))
    lowest = np.full((len(number), int(n_wins.max())), np.iinfo(np.int64).max)
    lowest[own[order], step[order]] = least
    marked = lowest[text_of] < r["doc"][:, None]
    mask = (marked * (1 << np.arange(marked.shape[1]))).sum(axis=1)
    out = r[mask > 0].astype(_MARK)
    out["wins"], out["mask"] = r["wins"][mask > 0], mask[mask > 0]
    return np.concatenate([out, *done])


def _exact_groups(buf: np.ndarray, code: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group) of windows [a, b): equal hashes are compared byte by byte, equal windows stand together."""
    order = np.argsort(code, kind="stable")
    code, a, b = code[order], a[order], b[order]
    same = np.append(False, code[1:] == code[:-1])
    spots, bad = np.flatnonzero(same), []
    for part in np.array_split(spots, len(spots) // 20_000 + 1):
        length, other = b[part] - a[part], b[part - 1] - a[part - 1]
        differ = length != other
        n = np.where(differ, 0, length)
        row = np.repeat(np.arange(len(part)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        differ[row[buf[a[part][row] + at] != buf[a[part - 1][row] + at]]] = True
        bad += part[differ].tolist()
    group = np.cumsum(~same)
    if not bad:
        return order, group
    text, top = buf.tobytes(), int(group[-1])
    for g in sorted({int(group[i]) for i in bad}):  # different windows of one hash
        found: dict[bytes, int] = {}
        for i in np.flatnonzero(group == g).tolist():
            group[i] = top + 1 + found.setdefault(text[a[i]:b[i]], len(found))
        top += len(found)
    again = np.argsort(group, kind="stable")
    return order[again], group[again]


def covered(text: str | None, marks: list[tuple[int, int]], window: int) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one space) of one text."""
    words = (text or "").encode("utf-8", "replace").split()
    if not marks:
        return len(words), 0, b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    spots = [word + k for word, mask in marks for k in range(mask.bit_length()) if mask >> k & 1]
    np.add.at(edge, spots, 1)
    np.add.at(edge, np.array(spots) + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


def _hot_minimisers(rows: DataFrame, n_runs: int, window: int, minimiser: int, buckets: int) -> list[int]:
    """Minimisers that would fill a bucket; they decide how rows are dealt, never the result.

    Every chunk of every document is counted.  A count below ``step`` is
    reported as ``step`` with probability count / step (by a hash of minimiser
    and chunk), so a minimiser's sum is right on average however thinly it is
    spread, and there are about runs / step reports.  At most one minimiser
    per bucket can have a bucket's share of all runs, which bounds the list.
    """
    limit = max(HOT_RUNS, n_runs // buckets)
    step = max(1, limit // 50)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _chunks(batches):
            w = Words([d[2] for d in docs])
            _, _, key = super_kmers(w, Rolling(w.buf), window, minimiser)
            names, count = np.unique(key, return_counts=True)
            chunk = mix(np.array([docs[0][0] & 0xFFFFFFFFFFFFFFFF], dtype=_U) + _U(docs[0][1]))
            told = (mix(names ^ chunk) % _U(step)).astype(np.int64) < count
            yield pa.RecordBatch.from_arrays([pa.array(names[told].view(np.int64)), pa.array(np.maximum(count[told], step))], names=["k", "n"])

    found = rows.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    return [r[0] for r in found.where(F.col("n") > limit).select("k").collect()]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    docs, size = [], 0
    for b in batches:
        for i, t, x in zip(*(c for c in b.columns)):
            docs.append((i.as_py(), t.as_py() & 0xFFFFFFFF, x.as_py()))
            size += len(docs[-1][2])
            if size >= CHUNK_BYTES:
                yield docs
                docs, size = [], 0
    if docs:
        yield docs


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     minimiser: int = MINIMISER) -> DataFrame:
    """(doc, tag, word, mask): bit k of ``mask`` says that the window at word + k starts in a smaller document.

    ``tag`` is a hash of the text, so rows that repeat an id keep their own marks.
    """
    if not 0 < window - minimiser + 1 <= MAX_RUN:
        raise ValueError("window and minimiser do not fit")
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.hash(F.col(text_col)).alias("tag"),
                       F.col(text_col).cast("string").cast("binary").alias("text")).where("id is not null and text is not null")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * size // TASK_BYTES)  # what is packed is up to 3 x the texts
    buckets = max(4 * parts, 3 * size // BUCKET_BYTES)
    hot = np.array(_hot_minimisers(rows, size // 36, window, minimiser, buckets), dtype=np.int64).view(_U)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets, hot, window, minimiser)
        for chunk in _chunks(batches):
            out = list(packer(chunk))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                              pa.array([x[1] for x in out], pa.binary())], names=["bucket", "payload"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(payloads: list[bytes]) -> pa.RecordBatch:
            m = marks_of(payloads, window)
            return pa.RecordBatch.from_arrays(
                [pa.array(m["doc"]), pa.array(m["tag"].view(np.int32)), pa.array(m["word"].astype(np.int32)),
                 pa.array(m["mask"].astype(np.int32))], names=["doc", "tag", "word", "mask"])

        bucket, payloads = None, []
        for b in batches:
            for k, p in zip(b.column(0).to_pylist(), b.column(1)):
                if k != bucket and payloads:
                    yield close(payloads)
                    payloads = []
                bucket = k
                payloads.append(p.as_py())
        if payloads:
            yield close(payloads)

    packed = rows.mapInArrow(pack, "bucket long, payload binary")
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(unpack, "doc long, tag int, word int, mask int")


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  minimiser: int = MINIMISER) -> DataFrame:
    """(id, n_words, n_removed, kept) for every row of ``docs``.

    Words are runs without ASCII white space.  A word is removed when a window
    of ``window`` words covers it whose words also start in a document with a
    smaller id; windows are judged on the input.  ``kept`` is the other words
    joined by one space.  Null texts have no words; texts with fewer words
    than a window keep all; rows with a null id keep all and remove nothing
    elsewhere.  Rows that repeat an id are judged each by its own text and do
    not count against one another.

    Runs of windows with a common minimiser (the lowest hash of ``minimiser``
    words) travel as one string to the minimiser's bucket.  A bucket's windows
    are sorted by hash, equal hashes compared byte by byte, and the smallest
    document of each window found.  Equal strings of one chunk travel once;
    the windows of very frequent minimisers travel alone, by their own hash,
    so that no bucket holds more than its share.
    """
    out = _cut(docs.select(id_col, text_col), id_col, text_col, window, minimiser, whole=False)
    return out.select(F.col(f"d.{id_col}").alias("id"), "n_words", "n_removed", "kept")


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                  window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """``docs`` with the repeated words taken out of the texts (``dedup_windows``).

    Texts that lose nothing stay as they are; a text that loses all its words becomes empty.
    """
    out = _cut(docs, id_col, text_col, window, minimiser, whole=True)
    new = {text_col: F.col("kept")}
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col(f"d.{chars_col}")).cast(
            dict(docs.dtypes)[chars_col])
    return out.select(*[new.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns])


def _cut(docs: DataFrame, id_col: str, text_col: str, window: int, minimiser: int, whole: bool) -> DataFrame:
    """(d, n_words, n_removed, kept): the other columns of ``docs`` as a struct, and what is left of each text.

    With ``whole`` a text that loses nothing comes back as it was.  Texts are
    compressed one by one on their way to their marks.
    """
    marks = repeated_windows(docs, id_col, text_col, window, minimiser)
    by_doc = materialize(marks.groupBy("doc", "tag").agg(F.collect_list(F.struct("word", "mask")).alias("marks")), "marks")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(others.alias("d"), F.col(id_col).cast("long").alias("doc"), F.hash(F.col(text_col)).alias("tag"),
                       F.col(text_col).cast("string").alias("text"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(3)
        for b in batches:
            small = [c.compress(t.as_py().encode()) if t.is_valid else None for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(small, pa.binary())], names=["d", "doc", "tag", "z"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                b, done = batch.slice(i, 500), []
                for z, m in zip(b.column(1), b.column(2)):
                    text = d.decompress(z.as_py()).decode() if z.is_valid else None
                    n, gone, kept = covered(text, [(x["word"], x["mask"]) for x in m.as_py() or ()], window)
                    done.append((n, gone, text if whole and not gone else kept.decode()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.int64()),
                     pa.array([x[2] for x in done], pa.string())], names=["d", "n_words", "n_removed", "kept"])

    small = rows.mapInArrow(squeeze, rows.drop("text").schema.add("z", "binary"))
    both = small.join(by_doc, ["doc", "tag"], "left").select("d", "z", "marks")
    kind = both.select("d").schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return both.mapInArrow(cut, kind)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_windows(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
