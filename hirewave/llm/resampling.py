"""Target-distribution importance resampling over hashed word runs; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirewave.llm.common import materialize, table
from hirewave.llm.urls import ascii_lower

BUCKETS = 10_000
HEAD_WORDS = 8_000
HEAD_PAIRS = 16_000
#: share of rows whose words the frequency sketches see, and entries they track; only speed depends on them
HEAD_SHARE = 0.05
TRACKED = 50_000
GROUPS = 64
#: bytes of blank and second word over which a head word's CRC state is continued
MAX_TAIL = 16
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: identical rows are written out by tasks of at most this many
COPIES_STEP = 100_000


def low(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; null counts as empty."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(ascii_lower(t))


def runs(docs: DataFrame, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """One row (``keep``, n_parts, w, nxt) for every part of every whole text.

    A part is a word or, at the text's ends, empty; a text without words has
    one empty part, so no row of ``docs`` is lost.  ``nxt`` is the next part,
    null after the last.
    """
    parts = docs.select(*(keep or []), F.split(low(F.col(f"`{text_col}`")), SEPARATORS).alias("_w"))
    names = parts.columns[:-1]
    shifted = F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 1, F.lit(0)))
    return parts.select(*names, F.size("_w").alias("n_parts"), F.inline(F.arrays_zip(F.col("_w").alias("w"), shifted.alias("nxt"))))


def head(docs: DataFrame, text_col: str = "text", n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS,
         share: float = HEAD_SHARE, tracked: int = TRACKED) -> tuple[DataFrame, DataFrame]:
    """(words with their CRC states, pairs with their CRC) of about the most frequent ones.

    Both lists have a fixed size.  A word or pair that is missing from them is
    hashed directly to the same bucket, so the choice (sketches of fixed size
    over a share of the rows) decides only speed.  ``h_states[k]`` is the word's CRC32 state moved on by k zero
    bytes; exclusive-or with the CRC32 of k more bytes gives the CRC32 of both.
    """
    tokens = runs(docs.sample(share, seed=0), text_col)
    word = F.when(F.col("w") != "", F.col("w"))
    pair = F.when((F.col("w") != "") & (F.col("nxt") != ""), F.concat("w", F.lit(" "), "nxt"))
    items = tokens.select(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("_g"), F.explode(F.array(
        F.struct(F.lit("word").alias("kind"), word.alias("item")), F.struct(F.lit("pair").alias("kind"), pair.alias("item")))).alias("_i"))
    # the tasks' sketches are merged by GROUPS tasks for each kind, then by one; no sketch is empty
    parts = items.where("_i.item is not null").groupBy("_g", "_i.kind").agg(
        F.call_function("approx_top_k_accumulate", F.col("_i.item"), F.lit(tracked)).alias("sketch"))
    merged = F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(tracked))
    found = materialize(parts.groupBy("kind").agg(
        F.call_function("approx_top_k_estimate", merged, F.lit(max(n_words, n_pairs, 1))).alias("top")), "resampling-head")
    top = lambda kind, k: found.where(F.col("kind") == kind).select(F.explode(F.slice("top.item", 1, k)).alias(f"h_{kind}"))
    zeros = [b"\x00" * k for k in range(MAX_TAIL + 1)]
    states = F.array(*[F.crc32(F.concat(F.col("h_word").cast("binary"), F.lit(z))).bitwiseXOR(F.crc32(F.lit(z))) for z in zeros])
    words = top("word", n_words).withColumns({"h_states": states})
    pairs = top("pair", n_pairs).select(
        F.substring_index("h_pair", " ", 1).alias("p_first"), F.substring_index("h_pair", " ", -1).alias("p_second"),
        F.crc32("h_pair").alias("p_crc"))
    return materialize(words, "resampling-words"), materialize(pairs, "resampling-pairs")


def with_buckets(tokens: DataFrame, words: DataFrame, pairs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``tokens`` with the bucket of the word (``b1``) and of the pair it begins (``b2``), null where there is none.

    Frequent pairs and words are looked up (two broadcasts of fixed size); a
    pair after a frequent word continues that word's state over the blank and
    the second word; all else is hashed directly.
    """
    tail = F.concat(F.lit(" "), F.col("nxt"))
    continued = F.get("h_states", F.octet_length("nxt") + 1).bitwiseXOR(F.crc32(tail))
    b1 = F.when(F.col("w") != "", F.coalesce(F.get("h_states", F.lit(0)), F.crc32("w")))
    b2 = F.when((F.col("w") != "") & (F.col("nxt") != ""),
                F.coalesce("p_crc", continued, F.crc32(F.concat("w", tail))))
    known = (tokens.join(F.broadcast(words), F.col("w") == F.col("h_word"), "left")
             .join(F.broadcast(pairs), (F.col("w") == F.col("p_first")) & (F.col("nxt") == F.col("p_second")), "left"))
    rest = [c for c in tokens.columns if c not in ("w", "nxt")]
    return known.select(*rest, (b1 % buckets).cast("int").alias("b1"), (b2 % buckets).cast("int").alias("b2"))


def bucket_counts(hashed: DataFrame) -> DataFrame:
    """(bucket, n) over all features; summed in every task before the shuffle."""
    return (hashed.select(F.explode(F.array("b1", "b2")).alias("bucket")).where("bucket is not null")
            .groupBy("bucket").agg(F.count("*").alias("n")))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with an array: the gain of every bucket out of its counts (bucket, n) in both tables."""
    spark = source.sparkSession
    both = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(F.broadcast(source.withColumnRenamed("n", "s")), "bucket", "left")   # at most one row a bucket
            .join(F.broadcast(target.withColumnRenamed("n", "t")), "bucket", "left").na.fill(0, ["s", "t"]))
    total = both.agg(F.sum("s").alias("S"), F.sum("t").alias("T"))
    d = lambda c: c.cast("double")
    ratio = (d(F.col("t") + 1) * d(total.select("S").scalar() + buckets)) / (d(F.col("s") + 1) * d(total.select("T").scalar() + buckets))
    each = both.select("bucket", F.floor(F.ln(ratio) * 1000).cast("bigint").alias("gain"))
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "gain")))  # `buckets` entries
    return each.agg(F.transform(ordered, lambda x: x["gain"]).alias("gains"))


def weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
            buckets: int = BUCKETS, head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(id, copies, n_words, n_features, weight): one row for each different (id, text) of ``docs``.

    Features are all words and pairs of neighbouring words of the whole text.
    ``copies`` says how many rows of ``docs`` are equal in both; they are put
    together in every task before the shuffle.  ``weight`` is the floored mean
    of the features' gains, 0 without features (null and empty texts).  Empty
    tables give no rows; an empty ``target`` counts as no features.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    marks = [F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]
    tokens = runs(docs, text_col, marks)
    words, pairs = head(docs, text_col, head_words, head_pairs)
    source = materialize(bucket_counts(with_buckets(runs(docs, text_col), words, pairs, buckets)), "resampling-source")
    wanted = materialize(bucket_counts(with_buckets(runs(target, target_text), words, pairs, buckets)), "resampling-target")
    gain = materialize(gains(source, wanted, buckets), "resampling-gains").select("gains").scalar()
    hashed = with_buckets(tokens, words, pairs, buckets).withColumns({"g1": F.get(gain, F.col("b1")), "g2": F.get(gain, F.col("b2"))})
    summed = hashed.groupBy("id", "_h1", "_h2").agg(
        F.count("*").alias("_rows"), F.max("n_parts").alias("_parts"), F.count("b1").alias("_words"), F.count("b2").alias("_pairs"),
        F.sum(F.coalesce("g1", F.lit(0)) + F.coalesce("g2", F.lit(0))).alias("_sum")).withColumns(
        {"_n": F.expr("_words + _pairs"), "copies": F.expr("_rows div _parts")})
    return summed.select("id", "copies", F.expr("_words div copies").alias("n_words"), F.expr("_n div copies").alias("n_features"),
                         F.expr("case when _n > 0 then (_sum - pmod(_sum, _n)) div _n else 0 end").cast("bigint").alias("weight"))


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of the SHA-256 of ``seed:id``; a null id counts as empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))) * -1000).cast("bigint")


def running(df: DataFrame, order: list[Column], size: Column, name: str) -> DataFrame:
    """``df`` with ``_before``: the sum of ``size`` over all rows earlier in ``order``.

    Rows are range partitioned, sorted and written; sums run inside each
    stretch and over the stretches (one number for each partition).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.withColumn("_size", size).repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("_place", F.monotonically_increasing_id())
                         .withColumn("_part", F.shiftright("_place", 33)), name)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.sum("_size").alias("_n")).select(
        F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
            .join(F.broadcast(starts), F.col("_part") == F.col("_p"))    # one row for each partition
            .withColumn("_before", F.col("_start") + F.col("_in"))
            .drop("_place", "_part", "_p", "_start", "_in", "_size"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS,
             head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(id, n_features, weight, score, rank) for every row of ``docs``; rank is null where it is not drawn.

    Of the N rows with at least ``min_words`` words the floor(percent * N /
    100) with the highest scores (weight plus seeded noise) are drawn, ties to
    the smaller id (null last); equal rows have ranks of their own.
    """
    scored = materialize(weights(docs, target, id_col, text_col, target_text, buckets, head_words, head_pairs)
                         .withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "resampling-scored")
    able = scored.where(F.col("n_words") >= min_words)
    n = F.coalesce(able.agg(F.sum("copies")).scalar(), F.lit(0))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("copies")]
    ranked = running(able, order, F.col("copies"), "resampling-order").withColumn("_drawn", F.floor(n * percent / 100))
    rows = ranked.unionByName(scored.where(F.col("n_words") < min_words).withColumns(
        {"_before": F.lit(0).cast("bigint"), "_drawn": F.lit(0).cast("bigint")}))
    steps = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES_STEP).cast("bigint")))
    some = rows.withColumn("_from", steps)
    many = some.where(F.col("copies") > COPIES_STEP).repartition("id", "_from").unionByName(some.where(F.col("copies") <= COPIES_STEP))
    last = F.least(F.col("_from") + COPIES_STEP, F.col("copies")) - 1
    every = many.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
    rank = F.col("_before") + F.col("_copy") + 1
    return every.select("id", "n_features", "weight", "score", F.when(rank <= F.col("_drawn"), rank).cast("bigint").alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, with all their columns (all rows of a drawn id)."""
    ids = resample(docs, target, id_col, **options).where("rank is not null").select(F.col("id").alias("_drawn_id")).distinct()
    return docs.join(ids, F.col(f"`{id_col}`").eqNullSafe(F.col("_drawn_id")), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")
