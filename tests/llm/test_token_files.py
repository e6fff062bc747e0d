"""Token-id files: ids equal the library's, files read back whole, in part, and by any zstandard reader."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from hirewave.llm import token_files as tf
from hirewave.session import scratch_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tf.default_tokenizer())


def made_up(n):
    r = random.Random(9)
    parts = ["The", "cat's", " ", "  ", "\n", "\t", "é", "é", "你好", "\x00", "ﬁ", "😀", "<|endoftext|>", "<|startoftext|>", "don't", "123", "İ", "ΣΑΣ", "ß", "==", " ", "Å"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(n)]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(6)


def expect(library, docs):
    """[(id, start, n_tokens, ids)] in file order."""
    out, start = [], 0
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def written(spark, docs, **options):
    return tf.write_ids(frame(spark, docs), scratch_path(spark, "test-ids"), tf.default_tokenizer(), **options)


def rows(df):
    return sorted(((r.id, r.start, r.n_tokens, bytes(r.ids)) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("sizes", [{}, {"frame_ids": 7, "shard_ids": 50}, {"frame_ids": 64, "shard_docs": 3}])
def test_files_read_back_equal_the_library(spark, library, sizes):
    docs = list(enumerate(made_up(90))) + [(500, None), (501, ""), (None, "no id"), (-3, "below zero")]
    shards = written(spark, docs, **sizes)
    want = expect(library, docs)
    assert rows(tf.read_ids(shards)) == want
    assert rows(tf.read_ids(shards, read_ids=40)) == want
    listed = shards.orderBy("shard").collect()
    assert sum(s.n_docs for s in listed) == len(docs) and sum(s.n_ids for s in listed) == want[-1][1] + want[-1][2]
    assert [s.base for s in listed] == [sum(x.n_ids for x in listed[:i]) for i in range(len(listed))]


def test_only_wanted_documents_are_decompressed(spark, library):
    docs = list(enumerate(made_up(80)))
    shards = written(spark, docs, frame_ids=16)
    wanted = spark.createDataFrame([(3,), (3,), (41,), (79,), (1000,), (None,)], "id long")
    assert rows(tf.read_documents(shards, wanted)) == [w for w in expect(library, docs) if w[0] in (3, 41, 79)]
    s = tf.open_shard(shards.where("n_docs > 3").first().path)
    seen, frame_of = [], s.frame
    s.frame = lambda k: (seen.append(k), frame_of(k))[1]
    s.ids(int(s.starts[2]), int(s.starts[3]))
    assert seen == list(range(s.starts[2] // 16, (s.starts[3] - 1) // 16 + 1)) and len(seen) < len(s.sums)


def test_any_zstandard_reader_gives_the_ids(spark, library):
    import zstandard

    docs = list(enumerate(made_up(30)))
    shards = written(spark, docs, frame_ids=32).orderBy("shard").collect()
    got = b""
    for s in shards:
        store, name = tf._store(s.path)
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(store.open_input_file(name).read()), read_across_frames=True) as z:
            got += z.read()
    assert got == b"".join(w[3] for w in expect(library, docs))


def shard_bytes(texts=((1, [5, 6, 7]), (2, [8]), (2, [9, 10])), frame_ids=2):
    out = io.BytesIO()
    w = tf.ShardWriter(out, pa.int64(), frame_ids)
    for key, ids in texts:
        w.add(key, np.array(ids, "<u4"))
    assert w.close() == len(out.getvalue())
    return out.getvalue()


def opened(raw):
    return tf.Shard(lambda at, n: raw[at:at + n], len(raw))


def test_broken_files_raise():
    raw = shard_bytes()
    s = opened(raw)
    assert s.keys.to_pylist() == [1, 2, 2] and [s.ids(int(a), int(b)).tolist() for a, b in zip(s.starts, s.starts[1:])] == [[5, 6, 7], [8], [9, 10]]
    for bad in (raw[:-1], raw[1:], raw[:-40], b"", raw[:len(raw) // 2] + b"x" + raw[len(raw) // 2:]):
        with pytest.raises(Exception):  # noqa: B017
            opened(bad)
    import zstandard

    swapped = zstandard.ZstdCompressor(level=3).compress(np.array([5, 9], "<u4").tobytes())
    size = int(s.at[1])
    if len(swapped) == size:
        with pytest.raises(ValueError, match="checksum of frame 0"):
            opened(swapped + raw[size:]).frame(0)


def test_checksums_are_checked():
    raw = bytearray(shard_bytes())
    at = len(raw) - tf.FOOTER.size - 4 * tf.ENTRY.size + 8   # checksum of the first of three data frames and the index
    raw[at] ^= 1
    with pytest.raises(ValueError, match="checksum of frame 0"):
        opened(bytes(raw)).frame(0)


def test_word_by_word_equals_the_whole_text(library):
    r = random.Random(2)
    words = ["Hello", "WORLD", "it's", "naïve", "é", "\u0301", "12", "<|endoftext|>", "<|start", "你好", "a", "'s", "ΣΑΣ", "Σ", "ﬁ", "\u2000", "\x1c", "\x85", "\xa0", "\u0345", "\u1100\u1161", "\u11a8", "Ärger", "ÑÑ", "ÿ", "Ÿ", "×", "÷", "µ", "ª", "ẞ", "Æ'S", "ó\u0301", "A\u0308", "_", "½"]
    with open(tf.default_tokenizer(), encoding="utf-8") as f:
        text = f.read()
    encode, small = tf.Encoder(text, 2), tf.Encoder(text, 2, cache_words=20)
    texts = ["".join(r.choice(words) + r.choice([" ", "  ", "\n", "\r\n", "\t", "", ""]) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    want = [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    for i in range(0, len(texts), 50):
        for e in (encode, small):
            assert [x.tolist() for x in e(texts[i:i + 50])] == want[i:i + 50]


def test_a_batch_does_not_go_over_all_words_kept(library):
    class Kept(dict):
        def keys(self):
            raise AssertionError("goes over all words kept")

        __iter__ = items = values = keys

    with open(tf.default_tokenizer(), encoding="utf-8") as f:
        encode = tf.Encoder(f.read(), 2)
    encode.known = Kept(encode.known)
    for texts in (["some words", "Some more, 你好"], ["words some more", None], ["words <|endoftext|> new", "你好 ﬁ"]):
        assert [x.tolist() for x in encode(texts)] == [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert type(encode.known) is Kept and {"some", "words", "new", "你好"} <= set(dict.keys(encode.known))


def test_long_texts_repeated_rows_and_odd_columns(spark, library):
    docs = [(1, "some words " * 30_000), (2, "z" * 100_000), (2, "same"), (2, "same"), (2, "other"), (7, None)]
    df = frame(spark, docs).selectExpr("cast(doc_id as string) as `the.id`", "text as body", "1 as id", "2 as path", "3 as start")
    shards = tf.write_ids(df, scratch_path(spark, "test-ids"), tf.default_tokenizer(), "the.id", "body", frame_ids=1000)
    got = rows(tf.read_ids(shards, "string"))
    want = expect(library, docs)
    assert sorted((int(g[0]), *g[2:]) for g in got) == sorted((w[0], *w[2:]) for w in want)
    assert [g[1] for g in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]
    assert [int(g[0]) for g in got] == [1, 2, 2, 2, 2, 7]


def test_empty_table(spark):
    shards = written(spark, [(1, "a")][:0] or spark.createDataFrame([], "doc_id long, text string").collect())
    assert shards.count() == 0 and tf.read_ids(shards).count() == 0
    assert tf.read_documents(shards, spark.createDataFrame([(1,)], "id long")).count() == 0


def test_query_on_the_given_table(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in tf.query(spark, sf).collect()), key=lambda r: r[1])
    assert got == [(k, a, n, zlib.crc32(ids)) for k, a, n, ids in expect(library, docs)]
