"""SimHash near-dedup over pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirewave.llm.common import connected_components, materialize, table
from hirewave.session import ship_package

SHINGLE_WORDS = 3
MAX_BITS = 2
BLOCKS = 5
PAIR_GROUP = 32
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = 42) -> int:
    """64-bit SimHash of one text (unsigned); 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends[k - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], dtype=">u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(octets) < 512:
        ones = np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(ones * 2 > len(octets)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, tag, fp long) for every row; a null text counts as empty.  ``tag`` is a hash of the text."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle_words) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fp.view(np.int64))], names=["id", "tag", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tag"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, tag long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _blocks(n: int) -> list[int]:
    cuts = [64 * i // n for i in range(n + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]


def close_pairs(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                pair_group: int = PAIR_GROUP) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` values within ``max_bits`` bits.

    Pigeonhole: of ``blocks`` blocks, two fingerprints that differ in at most
    ``max_bits`` bits agree on at least ``blocks - max_bits``, so every choice
    of that many blocks is one join key.  Groups of up to ``pair_group``
    fingerprints are joined and verified pair by pair.  Larger groups are not
    expanded into pairs: their members meet on a common midpoint instead.  Two
    values within 2r bits have a point within r bits of both, so values listed
    under a point reached by flipping at most r bits are linked to the smallest
    of that list, whose distance is verified; with an odd ``max_bits`` one
    side may flip one bit more.  Both ways are exact.
    """
    keep = blocks - max_bits
    if keep < 1:
        raise ValueError("blocks must exceed max_bits")
    masks = [_signed(sum(c)) for c in combinations(_blocks(blocks), keep)]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                               for i, m in enumerate(masks)])).alias("k")
    rows = fps.select("fp", keys).select("k.c", "k.key", "fp")
    sizes = rows.groupBy("c", "key").agg(F.count("*").alias("n")).where("n > 1")
    cand = materialize(rows.join(sizes, ["c", "key"]), "simhash-blocks")
    few = cand.where(F.col("n") <= pair_group)
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (few.select("c", "key", F.col("fp").alias("a"))
             .join(few.select("c", "key", F.col("fp").alias("b")), ["c", "key"])
             .where((F.col("a") < F.col("b")) & (far <= max_bits)).select("a", "b"))
    many = cand.where(F.col("n") > pair_group).select("fp").distinct()
    return pairs.unionByName(_midpoint_edges(many, max_bits)).distinct()


def _midpoint_edges(fps: DataFrame, max_bits: int) -> DataFrame:
    near, wide = max_bits // 2, (max_bits + 1) // 2
    flips = [_signed(sum(1 << b for b in c)) for k in range(wide + 1) for c in combinations(range(64), k)]
    spots = fps.select("fp", F.explode(F.array(*[F.lit(f) for f in flips])).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("spot"), F.bit_count("flip").alias("bits"))
    if near == wide:  # everything under a spot is within max_bits of everything else
        first = F.min("fp").over(Window.partitionBy("spot"))
        return spots.select(F.col("fp").alias("b"), first.alias("a")).where("a <> b").select("a", "b").distinct()
    # odd distance: link the wider flips with the narrower ones; the smallest narrow one stands for the rest
    w = Window.partitionBy("spot")
    first = F.min(F.when(F.col("bits") <= near, F.col("fp"))).over(w)
    return spots.select(F.col("fp").alias("b"), first.alias("a")).where("a is not null and a <> b").select("a", "b").distinct()


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(id, tag, fp) of every row, and (fp, root, component) of every fingerprint; ``root`` names the group."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    classes = prints.groupBy("fp").agg(F.min("id").alias("low"))
    roots = connected_components(close_pairs(classes.select("fp"), max_bits), "simhash-cc")
    placed = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component"))
    return prints, placed.join(lows, "root").select("fp", "root", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component) for every row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased; ``fp`` is the
    SimHash of the word shingles; ``component`` the smallest id that can be
    reached over links of at most ``max_bits`` bits.  Null and empty texts
    have fingerprint 0 and link like any other.  Equal fingerprints are one
    class from the start, so groups of copies cost one row.  Repeated ids and
    rows come back as often as they came; ids may be null (a class of null
    ids only has a null component).  An empty table gives an empty result.
    """
    prints, by_fp = _groups(docs, id_col, text_col, shingle_words, max_bits)
    return prints.join(by_fp, "fp").select("id", "fp", "component")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (then the smallest text hash).

    Rows that repeat both its id and its text are folded into one (the smallest
    by the hash of all columns); rows without an id stay only where no row of
    their group has one.  Rows of one id with texts of different groups are
    judged apart.
    """
    prints, by_fp = _groups(docs, id_col, text_col, shingle_words, max_bits)
    stay = prints.join(by_fp, "fp").groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "tag")).alias("k")).select(
        F.col("k.id").alias("stay_id"), F.col("k.tag").alias("stay_tag"))
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.col(id_col).alias("id"),
                       F.xxhash64(F.col(text_col)).alias("tag"), F.xxhash64(*plain).alias("whole"))
    order = Window.partitionBy("id", "tag").orderBy("whole")
    kept = rows.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("tag") == F.col("stay_tag")))
    kept = kept.withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return kept.select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
