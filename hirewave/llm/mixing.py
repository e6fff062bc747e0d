"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirewave.llm.common import global_rank, materialize, table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_TOKENS = 32
SHARD_TOKENS = 100_000
MAX_SHARDS = 65_536


def n_words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(src, source_size, weight, target) out of (src, source_size).

    Sources take the weights in turn, by code point, null last.  Targets share
    the total by weight; a target above ``max_repeats`` times its source's
    size stops there and the excess is shared again among the others, until
    none is above.  Each round is one aggregate of three sums, whatever the
    number of sources.
    """
    ranked = global_rank(sizes, [F.col("src").asc_nulls_last()], "_rank", "mix-sources")
    turn = F.pmod("_rank", F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).drop("_rank")
    cap = F.col("source_size") * max_repeats
    total, level, capped = None, None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        t, held, w, n = ranked.agg(
            F.sum("source_size"), F.sum(F.when(full, cap).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.sum(full.cast("long"))).first()
        total = t or 0
        if n == capped or not w:
            break
        capped, level = n, (total - held) / w
    share = F.least(F.col("weight") * F.lit(float(level or 0.0)), cap.cast("double"))
    return ranked.withColumn("target", share)


def _rounded(target: Column, unit: Column | float) -> Column:
    return F.floor(target / unit + 0.5).cast("long")


def source_quotas(targets: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Add ``blocks``: the seats of each source among all blocks.

    Sainte-Lague gives every next block to the source with the highest
    quotient target / (2 * blocks + 1).  Rounding target / block_tokens gives
    all seats but a few; the missing (or surplus) ones go by the highest
    (lowest) quotients among at most ``source's share of them + 2`` candidates
    each, ties by source.
    """
    base = targets.withColumn("_seats", _rounded(F.col("target"), float(block_tokens)))
    t, seats, n = base.agg(F.sum("target"), F.sum("_seats"), F.count("*")).first()
    if not n or not t:
        return base.withColumn("blocks", F.lit(0).cast("long")).drop("_seats")
    gap = int(t / block_tokens + 0.5) - seats
    if gap == 0:
        return base.withColumnRenamed("_seats", "blocks")
    reach = F.ceil(F.col("target") / t * (n / 2 + 1)).cast("long") + 1
    if gap > 0:
        step = F.explode(F.sequence(F.col("_seats"), F.col("_seats") + reach - 1))
    else:
        step = F.explode(F.sequence(F.greatest(F.col("_seats") - reach, F.lit(0)), F.col("_seats") - 1))
    may = (base if gap > 0 else base.where("_seats > 0")).select("src", "target", step.alias("_k")).withColumn(
        "_q", F.col("target") / (2 * F.col("_k") + 1))
    order = [F.desc("_q") if gap > 0 else F.asc("_q"), F.col("src").asc_nulls_last(), F.col("_k")]
    won = global_rank(may, order, "_rank", "mix-seats").where(F.col("_rank") < abs(gap)).groupBy("src").agg(
        F.count("*").alias("_more")).withColumnRenamed("src", "_src")
    more = F.coalesce("_more", F.lit(0)) * (1 if gap > 0 else -1)
    return (base.join(won, F.col("src").eqNullSafe(F.col("_src")), "left")
            .withColumn("blocks", F.col("_seats") + more).drop("_seats", "_more", "_src"))


def shard_quotas(shards: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Split each source's ``blocks`` over its shards, again by Sainte-Lague.

    A source has at most ``MAX_SHARDS`` shards, so a window holds that many
    rows.  ``shards`` has src, shard, shard_size, source_size, blocks.
    """
    part = Window.partitionBy("src")
    exact = F.col("blocks") * F.col("shard_size") / F.greatest(F.col("source_size"), F.lit(1))
    seats = _rounded(exact, F.lit(1.0))
    base = (shards.withColumn("_exact", exact).withColumn("_seats", seats)
            .withColumn("_gap", F.col("blocks") - F.sum("_seats").over(part))
            .withColumn("_n", F.count("*").over(part)))
    reach = F.ceil(F.col("_exact") / F.greatest(F.col("blocks"), F.lit(1)) * (F.col("_n") / 2 + 1)).cast("long") + 1
    steps = F.when(F.col("_gap") > 0, F.sequence(F.col("_seats"), F.col("_seats") + reach - 1)).when(
        (F.col("_gap") < 0) & (F.col("_seats") > 0),
        F.sequence(F.greatest(F.col("_seats") - reach, F.lit(0)), F.col("_seats") - 1))
    may = base.select("src", "shard", "_exact", "_gap", F.explode(steps).alias("_k"))
    quotient = F.col("_exact") / (2 * F.col("_k") + 1) * F.signum("_gap")
    won = (may.withColumn("_at", F.row_number().over(part.orderBy(quotient.desc(), "shard", "_k")))
           .where(F.col("_at") <= F.abs("_gap")).groupBy("src", "shard")
           .agg(F.sum(F.signum("_gap").cast("long")).alias("_more"))
           .select(F.col("src").alias("_src"), F.col("shard").alias("_shard"), "_more"))
    return (base.join(won, F.col("src").eqNullSafe(F.col("_src")) & (F.col("shard") == F.col("_shard")), "left")
            .select("src", "shard", "shard_size", (F.col("_seats") + F.coalesce("_more", F.lit(0))).alias("quota")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
        block_tokens: int = BLOCK_TOKENS, seed: int = 42) -> DataFrame:
    """(id, src, size, source_size, target, taken, row_key) for every row of ``docs``.

    Each source is cut into shards of about ``SHARD_TOKENS`` words (by a seeded
    hash, so a hot source is many shards).  A shard's documents stand in a
    seeded order on one line of words, which is cut into blocks of
    ``block_tokens`` words; the shard's quota takes its blocks from the start,
    round after round, at most ``max_repeats`` rounds.  ``taken`` is the number
    of a document's words inside the taken blocks, repeats counted.

    Null texts and texts without words have size 0 and take nothing; a null
    source is a source of its own.  Rows with equal id and text share one
    place in the order and are told apart by a running number; reruns give the
    same result.  An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("src"),
                       n_words(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("text_key"))
    rows = materialize(rows, "mix-sizes")
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    quotas = materialize(source_quotas(source_targets(sizes, weights, max_repeats), block_tokens), "mix-quotas")
    n_shards = F.least(F.ceil(F.col("source_size") / SHARD_TOKENS) + 1, F.lit(MAX_SHARDS))
    # the sources' table joins without a size promise: a hot source is split by the adaptive skew join
    info = quotas.select(F.col("src").alias("_src"), "source_size", "target", "blocks")
    placed = rows.join(info, F.col("src").eqNullSafe(F.col("_src"))).drop("_src").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed), "id", "text_key"), n_shards))
    shards = placed.groupBy("src", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"), F.first("blocks").alias("blocks"))
    quota = shard_quotas(shards, block_tokens).select(
        F.col("src").alias("_src"), F.col("shard").alias("_shard"), "shard_size", "quota")
    line = Window.partitionBy("src", "shard").orderBy(
        F.xxhash64(F.lit(seed + 1), "id", "text_key"), "id", "text_key", "size")
    laid = placed.withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))).join(
        quota, F.col("src").eqNullSafe(F.col("_src")) & (F.col("shard") == F.col("_shard")))
    words = F.least(F.col("quota") * block_tokens, F.col("shard_size") * max_repeats)
    rounds = F.floor(F.col("_words") / F.greatest(F.col("shard_size"), F.lit(1)))
    rest = F.col("_words") - F.col("_rounds") * F.col("shard_size")
    part = F.greatest(F.least(F.col("_end"), F.col("_rest")) - (F.col("_end") - F.col("size")), F.lit(0))
    taken = laid.withColumn("_words", words).withColumn("_rounds", rounds).withColumn("_rest", rest).withColumn(
        "taken", (F.col("_rounds") * F.col("size") + part).cast("long"))
    return taken.select("id", "src", "size", "source_size", "target", "taken", "text_key")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", chars_col: str | None = "n_chars", **params) -> DataFrame:
    """The mix itself, in the columns of ``docs``.

    A document comes once for every whole time it is taken; the rest of its
    taken words, if any, comes as one more row with that many words from its
    start, joined by one space.  A document that is not taken is left out.
    """
    found = mix(docs, id_col, text_col, source_col, **params)
    per_key = Window.partitionBy("id", "src", "text_key").orderBy("taken")
    found = found.withColumn("nth", F.row_number().over(per_key)).where("taken > 0").select(
        F.col("id").alias("mix_id"), F.col("src").alias("mix_src"), F.col("text_key").alias("mix_key"), F.col("nth").alias("mix_nth"),
        "size", "taken")
    mine = Window.partitionBy("id", "src", "text_key").orderBy(F.lit(0))
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    keyed = docs.select(others.alias("d"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("src"),
                        F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")).withColumn(
        "nth", F.row_number().over(mine))
    same = (F.col("id").eqNullSafe(F.col("mix_id")) & F.col("src").eqNullSafe(F.col("mix_src"))
            & (F.col("text_key") == F.col("mix_key")) & (F.col("nth") == F.col("mix_nth")))
    copies = keyed.join(found, same).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)),
                                F.lit(1), left.cast("int")), " ")
    out = copies.withColumn("part", left < F.col("size")).withColumn("text", F.when(F.col("part"), head).otherwise(F.col("text")))
    new = {text_col: F.col("text")}
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.col("part"), F.length("text").cast(dict(docs.dtypes)[chars_col])).otherwise(F.col(f"d.`{chars_col}`"))
    return out.select(*[new.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
