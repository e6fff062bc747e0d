"""Token-id files: independent zstandard frames, a trailing seek table with checksums, read document by document.

A shard is a sequence of zstandard frames, each of up to ``FRAME_IDS``
little-endian unsigned 32-bit ids; then a skippable frame with the documents'
ids and lengths; then the seek table of the public seekable zstandard format
(a skippable frame: compressed size, plain size and the low 32 bits of XXH64 of
the plain bytes for each frame, then the number of frames, flags and magic).
Any zstandard reader gives the ids of the whole shard; a reader with the table
decompresses only the frames that hold the documents it wants.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirewave.llm.common import materialize, table
from hirewave.session import scratch_path, ship_package

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
FRAME_IDS = 1 << 18
#: a shard is closed after so many ids or documents
SHARD_IDS = 1 << 26
SHARD_DOCS = 1 << 20
#: ids that one reading task takes from a shard
READ_IDS = 1 << 23
#: pieces whose ids a Python worker keeps, from task to task
CACHE_WORDS = 1_000_000

#: fixed values of the seekable format: magic numbers and sizes
SEEK_MAGIC = 0x8F92EAB1
SKIP_SEEK = 0x184D2A5E
SKIP_INDEX = 0x184D2A50
CHECKSUMS = 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")
SKIP_HEAD = struct.Struct("<II")


# encoding

#: the vocabulary's pattern of words, for ASCII and the letters of Latin-1 (single characters that normalise to themselves)
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+", re.ASCII)
NOT_PLAIN = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]|<\|")
WORD_END = "</w>"


def _plain(part: str) -> bool:
    return NOT_PLAIN.search(part) is None


class Encoder:
    """The library's ids of whole texts, with the end id after each.

    Texts are cut at blanks and line feeds, which no token, normalisation or
    pattern of the vocabulary reaches across.  Parts of ASCII and Latin-1
    letters, where the normalisation is lower case, are cut further into the
    pattern's words; all others, and those that may hold special tokens, stay
    whole.  The
    library encodes every different piece once (words side by side in one
    text, parted by the tokens that end a word), and the ids of pieces seen (a
    bounded number) are kept.
    """

    def __init__(self, tokenizer: str, end_id: int = END_ID, cache_words: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.limit, self.known = Tokenizer.from_str(tokenizer), cache_words, {}
        self.end = np.array([end_id], dtype="<u4").tobytes()
        self.closes = np.zeros(self.library.get_vocab_size(), dtype=bool)
        self.closes[[i for t, i in self.library.get_vocab().items() if t.endswith(WORD_END)]] = True

    @staticmethod
    def _cut(text: str) -> tuple[list[str], set[str]]:
        """Pieces of a text, and which of them are not plain words."""
        if _plain(text):
            return PLAIN_WORDS.findall(text.lower()), set()
        out, odd = [], set()
        for plain, parts in groupby(text.replace("\n", " ").split(" "), _plain):
            some = PLAIN_WORDS.findall(" ".join(parts).lower()) if plain else list(parts)
            out += some
            if not plain:
                odd.update(some)
        return out, odd

    def _words(self, fresh: list[str]) -> Iterator[tuple[str, bytes]]:
        for i in range(0, len(fresh), 4096):
            words = fresh[i:i + 4096]
            ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
            if len(ends) != len(words) or (len(ends) and ends[-1] != 4 * len(ids)):
                raise ValueError("the vocabulary does not end every word with a token of its own")
            raw, at = ids.tobytes(), 0
            for word, end in zip(words, ends.tolist()):
                yield word, raw[at:end]
                at = end

    def _learn(self, pieces: set[str], odd: set[str]) -> None:
        self.known.update(self._words(list(pieces - odd)))
        rest = list(odd & pieces)
        for piece, found in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False)):
            self.known[piece] = np.array(found.ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self._cut(t or "") for t in texts]
        found = [[*map(self.known.get, words)] for words, _ in split]
        gaps = [(got, k, words[k]) for (words, _), got in zip(split, found) for k, ids in enumerate(got) if ids is None]
        fresh = {word for _, _, word in gaps}
        if len(self.known) + len(fresh) > self.limit:
            self.known = {}
        self._learn(fresh, set().union(*(odd for _, odd in split)))
        for got, k, word in gaps:
            got[k] = self.known[word]
        return [np.frombuffer(b"".join([*got, self.end]), dtype="<u4") for got in found]


@lru_cache(maxsize=1)
def encoder(tokenizer: str, end_id: int) -> Encoder:
    """The encoder of this Python worker."""
    return Encoder(tokenizer, end_id)


# one shard

class ShardWriter:
    """Frames, document index and seek table on an output stream."""

    def __init__(self, out, id_type: pa.DataType, frame_ids: int = FRAME_IDS) -> None:
        import zstandard

        self.out, self.id_type, self.frame_ids = out, id_type, frame_ids
        self.zip = zstandard.ZstdCompressor(level=3, write_checksum=False)
        self.open, self.filled, self.table, self.keys, self.sizes, self.n_ids, self.bytes = [], 0, [], [], [], 0, 0

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.bytes += len(raw)

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.sizes.append(len(ids))
        self.n_ids += len(ids)
        while len(ids):
            part = ids[:self.frame_ids - self.filled]
            self.open.append(part)
            self.filled += len(part)
            ids = ids[len(part):]
            if self.filled == self.frame_ids:
                self._frame()

    def _frame(self) -> None:
        import xxhash

        raw = np.concatenate(self.open).tobytes()
        packed = self.zip.compress(raw)
        self._put(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.open, self.filled = [], 0

    def close(self) -> int:
        """Index and seek table; the number of bytes written in all."""
        if self.filled:
            self._frame()
        sink = pa.BufferOutputStream()
        docs = pa.table({"id": pa.array(self.keys, self.id_type), "n": pa.array(self.sizes, pa.uint64())})
        with pa.ipc.new_stream(sink, docs.schema) as stream:
            stream.write_table(docs)
        index = self.zip.compress(sink.getvalue().to_pybytes())
        self._put(SKIP_HEAD.pack(SKIP_INDEX, len(index)) + index)
        self.table.append((SKIP_HEAD.size + len(index), 0, 0))
        body = b"".join(ENTRY.pack(*x) for x in self.table) + FOOTER.pack(len(self.table), CHECKSUMS, SEEK_MAGIC)
        self._put(SKIP_HEAD.pack(SKIP_SEEK, len(body)) + body)
        return self.bytes


class Shard:
    """Reads a shard through ``read(at, n)``: the tables first, then only the frames asked for."""

    def __init__(self, read, size: int) -> None:
        import zstandard

        self.read, self.unzip, self.last = read, zstandard.ZstdDecompressor(), (-1, None)
        if size < FOOTER.size + SKIP_HEAD.size:
            raise ValueError("no seek table")
        n, flags, magic = FOOTER.unpack(read(size - FOOTER.size, FOOTER.size))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums")
        length = n * ENTRY.size + FOOTER.size
        raw = read(size - length - SKIP_HEAD.size, length + SKIP_HEAD.size)
        if SKIP_HEAD.unpack(raw[:SKIP_HEAD.size]) != (SKIP_SEEK, length):
            raise ValueError("broken seek table")
        entries = np.frombuffer(raw[SKIP_HEAD.size:-FOOTER.size], dtype="<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(entries[:, 0])])        # place of each frame in the file
        self.ids_at = np.concatenate([[0], np.cumsum(entries[:-1, 1] // 4)])  # ids before each data frame
        self.sums = entries[:, 2]
        if self.at[-1] + length + SKIP_HEAD.size != size:
            raise ValueError("frames and file differ in length")
        packed = read(int(self.at[-2]), int(self.at[-1] - self.at[-2]))
        if packed[:4] != struct.pack("<I", SKIP_INDEX):
            raise ValueError("no document index")
        docs = pa.ipc.open_stream(self.unzip.decompress(packed[SKIP_HEAD.size:])).read_all()
        self.keys = docs["id"]
        self.starts = np.concatenate([[0], np.cumsum(docs["n"].to_numpy().astype(np.int64))])
        if self.starts[-1] != self.ids_at[-1]:
            raise ValueError("index and frames differ in their ids")

    def frame(self, k: int) -> np.ndarray:
        """The ids of frame ``k``; raises where its checksum differs."""
        if self.last[0] != k:
            import xxhash

            raw = self.unzip.decompress(self.read(int(self.at[k]), int(self.at[k + 1] - self.at[k])),
                                        max_output_size=int(self.ids_at[k + 1] - self.ids_at[k]) * 4)
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"checksum of frame {k} differs")
            self.last = (k, np.frombuffer(raw, dtype="<u4"))
        return self.last[1]

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi`` (without) of the shard."""
        first, last = np.searchsorted(self.ids_at, lo, "right") - 1, np.searchsorted(self.ids_at, hi, "left")
        return np.concatenate([self.frame(k)[max(lo - self.ids_at[k], 0):hi - self.ids_at[k]] for k in range(first, last)])


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_shard(path: str) -> Shard:
    store, name = _store(path)
    f = store.open_input_file(name)
    return Shard(lambda at, n: f.read_at(n, at), f.size())


# jobs

def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID, frame_ids: int = FRAME_IDS, shard_ids: int = SHARD_IDS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Encode every whole text and write the ids in ascending order of ``id_col``; the list of shards.

    The list has shard (0..), path, base (ids in all shards before it),
    n_docs, n_ids and bytes.  Rows are range partitioned and sorted, nulls
    first, rows of one id by their text; a null text counts as empty (the end
    id alone), repeated rows are written as often as they come.  A task
    streams its rows into shards under names of its own, so a task that runs
    again never touches another attempt's files; only listed shards count.  An
    empty table gives an empty list.  Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())  # a vocabulary file of fixed size
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(tokenizer.value, end_id), TaskContext.get().partitionId()
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        writer, path, done = None, None, 0

        def listed() -> pa.RecordBatch:
            nonlocal done
            size = writer.close()
            writer.out.close()
            done += 1
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [done], "path": [path], "n_docs": [len(writer.keys)],
                                               "n_ids": [writer.n_ids], "bytes": [size]})

        for whole in batches:
            for i in range(0, whole.num_rows, 64):
                b = whole.slice(i, 64)
                for key, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist())):
                    if writer is None:
                        path = f"{folder}/{uuid.uuid4().hex}.ids.zst"
                        out = store.open_output_stream(f"{root}/{path.rpartition('/')[2]}", compression=None)
                        writer = ShardWriter(out, b.column(0).type, frame_ids)
                    writer.add(key, ids)
                    if writer.n_ids >= shard_ids or len(writer.keys) >= shard_docs:
                        yield listed()
                        writer = None
        if writer is not None:
            yield listed()

    listed = materialize(placed.mapInArrow(run, "part long, seq long, path string, n_docs long, n_ids long, bytes long"), "ids-listed")
    earlier = Window.orderBy("part", "seq")  # one row for each shard
    return materialize(listed.select((F.row_number().over(earlier) - 1).cast("long").alias("shard"), "path", (F.coalesce(F.sum("n_ids").over(
        earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("base"), "n_docs", "n_ids", "bytes"), "ids-shards")


def read_ids(shards: DataFrame, id_type: str = "bigint", read_ids: int = READ_IDS) -> DataFrame:
    """(id, start, n_tokens, ids) of every document in the listed shards.

    ``start`` is the number of ids of all documents before it.  A shard is
    read by several tasks: each takes the documents that begin in its stretch of
    ``read_ids`` ids, and decompresses only their frames.
    """
    spark = shards.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = F.expr(f"(n_ids - 1) div {read_ids}")
    parts = shards.select("path", "base", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k")).repartition(n, "path", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base, k in zip(*(b.column(i).to_pylist() for i in range(3))):
                shard = open_shard(path)
                lo, hi = np.searchsorted(shard.starts[:-1], [k * read_ids, (k + 1) * read_ids])
                yield from _documents(shard, base, range(lo, hi))

    return parts.mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids binary")


def _documents(shard: Shard, base: int, wanted) -> Iterator[pa.RecordBatch]:
    """Batches with the ``wanted`` documents (ascending places) of a shard."""
    rows, held = [], 0
    wanted = list(wanted)
    for j, i in enumerate(wanted):
        lo, hi = int(shard.starts[i]), int(shard.starts[i + 1])
        rows.append((i, base + lo, hi - lo, shard.ids(lo, hi).astype("<u4").tobytes()))
        held += hi - lo
        if held >= 1 << 20 or j == len(wanted) - 1:
            place, start, size, ids = zip(*rows)
            yield pa.RecordBatch.from_arrays([shard.keys.take(pa.array(place, pa.int64())).combine_chunks(), pa.array(start, pa.int64()),
                                              pa.array(size, pa.int64()), pa.array(ids, pa.binary())], names=["id", "start", "n_tokens", "ids"])
            rows, held = [], 0


def document_index(shards: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(id, shard, path, base, place): where each document stands; only the tables at the shards' ends are read."""
    ship_package(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, path, base in zip(*(b.column(i).to_pylist() for i in range(3))):
                keys = open_shard(path).keys.combine_chunks()
                for i in range(0, len(keys), 10_000):
                    some = keys.slice(i, 10_000)
                    k = len(some)
                    yield pa.RecordBatch.from_arrays([some, pa.array([number] * k, pa.int64()), pa.array([path] * k), pa.array([base] * k, pa.int64()),
                                                      pa.array(range(i, i + k), pa.int64())], names=["id", "shard", "path", "base", "place"])

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.select("shard", "path", "base").repartition(n, "path").mapInArrow(
        run, f"id {id_type}, shard long, path string, base long, place long")


def read_documents(shards: DataFrame, wanted: DataFrame, id_col: str = "id", id_type: str = "bigint") -> DataFrame:
    """The rows of ``read_ids`` whose id is in ``wanted``; frames without such documents are not decompressed."""
    keys = wanted.select(F.col(f"`{id_col}`").alias("_want")).distinct()
    index = document_index(shards, id_type)
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = (index.join(keys, F.col("id").eqNullSafe(F.col("_want")), "left_semi")
            .select("path", "base", "place").repartition(n, "path", F.expr("place div 1024")).sortWithinPartitions("path", "place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for b in batches:
            path, base, place = (b.column(i).to_pylist() for i in range(3))
            at = 0
            while at < len(path):
                end = at
                while end < len(path) and path[end] == path[at]:
                    end += 1
                if path[at] != name:
                    name, shard = path[at], open_shard(path[at])
                yield from _documents(shard, base[at], place[at:end])
                at = end

    return hits.mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids binary")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shards = write_ids(docs, scratch_path(spark, "token-ids"), default_tokenizer())
    return read_ids(shards, dict(docs.dtypes)["doc_id"]).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
