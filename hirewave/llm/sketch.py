"""Document fingerprints: threshold-scaled sketches of word shingles; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirewave.llm.common import table

SHINGLE_WORDS = 5
FRACTION = 0.25
STRETCHES = 4


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(text, r"[\x09-\x0D\x20]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def sketch(text: Column, fraction: float = FRACTION, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Sorted distinct hashes of the word shingles, all of those below ``fraction`` of the hash range.

    Texts with fewer words than a shingle have one shingle, their whole
    sequence; texts without words none.  Sketches of parts merge by union.
    """
    limit = int(-(1 << 63) + fraction * (1 << 64))
    w = _words(text)

    def hashes(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - shingle_words, F.lit(0)))
        code = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(shingle_words)]))
        return F.when(F.size(words) > 0, F.filter(code, lambda h: h < F.lit(limit))).otherwise(F.array().cast("array<bigint>"))

    # one evaluation of the word list: it is bound as the only element of an array
    return F.array_sort(F.array_distinct(F.element_at(F.transform(F.array(w), hashes), 1)))


def fingerprint(text: Column, hashes: Column) -> Column:
    """Hash of the whole text, then the sketch, in hexadecimal; the same for equal texts."""
    digits = F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")
    return F.concat(F.lower(F.lpad(F.hex(F.xxhash64(text)), 16, "0")), F.lit(":"), digits)


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Containment of the smaller sketch in the larger; with an empty sketch only equal texts are alike."""
    least = F.least(F.size(a), F.size(b))
    return F.when(same, 1.0).when(least == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / least)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION,
                      shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The next document is the one with the next larger id (rows of one id in
    the order of their text hash; null ids first); after the last comes the
    first, and a single document is its own next.  The edited text has its last
    floor(n / 2) code points replaced by the next document's first as many (or
    all).  Null texts count as empty.  Repeated rows are documents of their own.

    Texts are shuffled once, to stretches of ids between approximate
    quantiles.  A document that opens a stretch also goes, as a guest, to the
    end of the stretch before it (the first of all to the last), so every row
    finds its next one in its own stretch.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / (STRETCHES * parts) for i in range(1, STRETCHES * parts)]
    low, nulls, marks = rows.agg(F.min("id"), F.count(F.when(F.col("id").isNull(), 1)),
                                 F.percentile_approx("id", steps, 50 * len(steps))).first()
    opens = sorted({m for m in marks or [] if nulls or m > low})
    bounds = F.array(*[F.lit(m) for m in opens]).cast(f"array<{dict(docs.dtypes)[id_col]}>")
    own = F.size(F.filter(bounds, lambda m: m <= F.col("id")))
    first = F.col("id").isNull() if nulls else F.col("id") == F.lit(low)
    guest = F.when(F.coalesce(first, F.lit(False)), F.lit(len(opens))).when(F.array_contains(bounds, F.col("id")), F.col("own") - 1)
    rows = rows.withColumn("own", own).withColumn("guest", guest).withColumn("place", F.explode(F.when(
        F.col("guest").isNull(), F.array(F.struct(F.col("own").alias("stretch"), F.lit(False).alias("guest")))).otherwise(
        F.array(F.struct(F.col("own").alias("stretch"), F.lit(False).alias("guest")),
                F.struct(F.col("guest").alias("stretch"), F.lit(True).alias("guest"))))))
    dealt = rows.select("id", "text", F.col("place.stretch").alias("stretch"), F.col("place.guest").alias("guest")).repartition(
        parts, "stretch")
    dealt = dealt.withColumn("n", F.length("text").cast("long")).withColumn("tag", F.xxhash64("text")).withColumn(
        "mine", sketch(F.col("text"), fraction, shingle_words))
    w = Window.partitionBy("stretch").orderBy("guest", "id", "tag")
    both = dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in ("text", "tag", "mine")]).where(~F.col("guest"))
    edited = F.expr("concat(substring(text, 1, cast(n - floor(n / 2) as int)), substring(next_text, 1, cast(floor(n / 2) as int)))")
    both = both.withColumn("edited", edited).withColumn("theirs", sketch(F.col("edited"), fraction, shingle_words))
    return both.select(
        "id", F.col("n").alias("n_chars"), "edited", fingerprint(F.col("text"), F.col("mine")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("theirs")).alias("edited_fingerprint"),
        likeness(F.col("mine"), F.col("theirs"), F.col("text") == F.col("edited")).alias("near_edited"),
        likeness(F.col("mine"), F.col("next_mine"), F.col("tag") == F.col("next_tag")).alias("near_next"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare_with_next(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        "fingerprint", "edited_fingerprint", "near_edited", "near_next")
