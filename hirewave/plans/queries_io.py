"""Registered queries: scans, partitions, date sync, sinks, catalog, streaming."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from hirewave import fixtures
from hirewave.functions import rules
from hirewave.operators import clean
from hirewave.plans import jobs, silver
from hirewave.plans import oracle as O
from hirewave.plans.queries_clean import FUNNEL_SQL, flat
from hirewave.plans.registry import register
from hirewave.session import scratch_path
from hirewave.sinks import publish, writers
from hirewave.sources import catalog, crawl, ledger, listing, partitions
from hirewave.streaming import incremental

P = rules.PARTITION_COLUMNS
_LANDED: dict[tuple[str, str], str] = {}

# destination holds every source date except the newest three (portable SQL)
DEST_SQL = """select distinct year, month, day from postings
where concat(year, month, day) < (select min(k) from
  (select distinct concat(year, month, day) as k from postings order by k desc limit 3) t)"""

_LATEST = "concat(year, month, day) = (select max(concat(year, month, day)) from postings)"
_BOARD_A = "job_type < '3'"


def landed_raw(spark, sf: str) -> str:
    """Raw postings landed once per session and scale factor under the shared folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED:
        path = scratch_path(spark, "raw_postings")
        writers.write_partitioned(fixtures.postings(spark, sf), path)
        _LANDED[key] = path
    return _LANDED[key]


# ------------------------------------------------------------------ SNK-05 / SRC-03
@register("raw_landing", O.with_stages("select * from postings", "postings"))
def q_raw_landing(spark, sf):
    return partitions.read_partitioned(spark, landed_raw(spark, sf))


# ------------------------------------------------------------------ SRC-01
@register("scan_partition", O.with_stages(f"select * from postings where {_LATEST}", "postings"))
def q_scan_partition(spark, sf):
    root = landed_raw(spark, sf)
    return partitions.scan_partition(spark, root, *listing.latest_date(spark, root))


# ------------------------------------------------------------------ SRC-04 (directory listing: no data file opened)
@register("list_partitions", O.with_stages("select distinct year, month, day from postings", "postings"))
def q_list_partitions(spark, sf):
    return listing.list_dates(spark, landed_raw(spark, sf))


@register("list_partitions_scan", O.with_stages("select distinct year, month, day from postings", "postings"))
def q_list_partitions_scan(spark, sf):
    return partitions.list_partitions(partitions.read_partitioned(spark, landed_raw(spark, sf)))


# ------------------------------------------------------------------ SRC-05
@register("latest_partition", O.with_stages(
    "select year, month, day from postings order by year desc, month desc, day desc limit 1", "postings"))
def q_latest(spark, sf):
    return partitions.latest_partition(listing.list_files(spark, landed_raw(spark, sf)))


# ------------------------------------------------------------------ SRC-09
@register("single_partition", O.with_stages(
    f"select year, month, day, count(*) as n_rows from postings where {_LATEST} group by year, month, day", "postings"))
def q_single_partition(spark, sf):
    p = fixtures.postings(spark, sf)
    key = F.concat(*P)
    path = scratch_path(spark, "single")
    date = writers.write_single(p.where(key == p.select(F.max(key)).scalar()), path)
    back = partitions.read_partitioned(spark, path)
    return back.groupBy(*P).agg(F.count("*").alias("n_rows")).where(partitions.date_filter(*date))


# ------------------------------------------------------------------ SRC-06 / JON-04 / SET-03
@register("remaining_dates", O.with_stages(
    "select distinct year, month, day from postings except select * from dest", "postings",
    extra={"dest": DEST_SQL}))
def q_remaining(spark, sf):
    fixtures.postings(spark, sf).createOrReplaceTempView("postings")
    return partitions.remaining_dates(listing.list_dates(spark, landed_raw(spark, sf)), spark.sql(DEST_SQL))


@register("remaining_dates_none_left", O.with_stages(
    "select year, month, day from (select distinct year, month, day from postings) "
    "order by year desc, month desc, day desc limit 1", "postings"))
def q_remaining_none(spark, sf):
    src = listing.list_dates(spark, landed_raw(spark, sf))
    return partitions.remaining_dates(src, src)


@register("remaining_dates_no_dest", O.with_stages("select distinct year, month, day from postings", "postings"))
def q_remaining_no_dest(spark, sf):
    src = listing.list_dates(spark, landed_raw(spark, sf))
    dest = catalog.table_partitions_or_none(spark, "silver_zone.postings_clean_missing")
    return partitions.remaining_dates(src, dest)


# files that land in a date already synced: these rows come after the first sync, the last year is new altogether
_LATE = "job_url like '%7'"


@register("remaining_dates_late_files", O.with_stages(
    f"select distinct year, month, day from postings where {_LATE} or year = '2001'", "postings", postings=fixtures.MONTHLY_SQL))
def q_remaining_late(spark, sf):
    rows = fixtures.monthly_postings(spark, sf)
    root, book = scratch_path(spark, "raw_late"), scratch_path(spark, "ledger")
    writers.write_partitioned(rows.where(f"not ({_LATE}) and year <> '2001'"), root)
    ledger.commit(listing.date_states(listing.list_files(spark, root)), book, "first run")
    writers.write_partitioned(rows.where(f"{_LATE} or year = '2001'"), root, mode="append")
    return ledger.due_dates(listing.date_states(listing.list_files(spark, root)), ledger.synced(spark, book))


# ------------------------------------------------------------------ SRC-02 / SRC-07
@register("raw_zone_inventory", O.with_stages(
    f"select distinct 'board_a' as table_name, year, month, day from postings where {_BOARD_A} "
    f"union all select distinct 'board_b' as table_name, year, month, day from postings where not ({_BOARD_A})",
    "postings"))
def q_raw_zone(spark, sf):
    """Two landings and two crawls of each board; the second crawl reads new footers only."""
    p = fixtures.postings(spark, sf)
    prefix = scratch_path(spark, "raw_zone")
    boards = dict(zip(rules.SOURCE_TABLES, (p.where(_BOARD_A), p.where(f"not ({_BOARD_A})"))))
    for some in ("year < '1997'", "year >= '1997'"):
        for name, rows in boards.items():
            writers.write_partitioned(rows.where(some), f"{prefix}/{name}")
            crawl.register(spark, name, f"{prefix}/{name}", f"{prefix}/_{name}_footers", database=f"raw_zone_{prefix[-12:]}")
    out = None
    # per-table dispatch over the (few) catalog tables, sorted
    for name in catalog.list_tables(spark, f"raw_zone_{prefix[-12:]}"):
        part = catalog.show_partitions(spark, f"raw_zone_{prefix[-12:]}.{name}").select(F.lit(name).alias("table_name"), *P)
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ SRC-10 (f): mixed producers, one scan
def _mixed_oracle() -> str:
    # producer B stored true arrays: its lists are deduped like any array
    b_parse = O.parse_stage("titled", "auto")
    body = ("select * replace (array_to_string(hard_skills, '|') as hard_skills) from silver")
    parsed = (f"select * replace (case when {_BOARD_A} then hard_skills "
              f"else {O.distinct_sql('hard_skills')} end as hard_skills) from ({b_parse})")
    return O.with_stages(body, "titled", "kept_companies", extra={
        "parsed": parsed, "joined": O.STAGES["joined"], "enriched": O.STAGES["enriched"],
        "silver": O.STAGES["silver"]})


@register("silver_mixed_producers", _mixed_oracle())
def q_silver_mixed(spark, sf):
    """Producer A wrote ``HARD SKILLS`` as printed text, producer B wrote
    ``HARD_SKILLS#0`` as a true array; one mergeSchema scan reads both."""
    from hirewave.operators import skills as sk
    p = fixtures.postings(spark, sf)
    root = scratch_path(spark, "raw_mixed")
    a = p.where(_BOARD_A).withColumnRenamed("hard_skills", "HARD SKILLS")
    b = (p.where(f"not ({_BOARD_A})")
          .withColumn("hard_skills", sk.parse_auto(F.col("hard_skills")))
          .withColumnRenamed("hard_skills", "HARD_SKILLS#0"))
    a.write.mode("overwrite").parquet(f"{root}/producer=a")
    b.write.mode("overwrite").parquet(f"{root}/producer=b")
    raw = partitions.read_partitioned(spark, root, merge_schema=True).drop("producer")
    return flat(silver.silver_unexploded(raw, fixtures.companies(spark, sf)))


# ------------------------------------------------------------------ SNK-01 (write twice, read back)
@register("silver_roundtrip", O.with_stages(
    "select * replace (array_to_string(hard_skills, '|') as hard_skills) from silver", "silver"))
def q_silver_roundtrip(spark, sf):
    u = silver.silver_unexploded(fixtures.postings(spark, sf), fixtures.companies(spark, sf)).persist(StorageLevel.MEMORY_AND_DISK)
    path = scratch_path(spark, "silver_clean")
    try:  # built once, saved twice
        writers.save_table(u, path, table="silver_postings_clean")
        writers.save_table(u, path, table="silver_postings_clean")  # re-run: same table
    finally:
        u.unpersist()
    return flat(spark.table("silver_postings_clean"))


# ------------------------------------------------------------------ SNK-01 (publish through the catalog)
_SILVER = "select * replace (array_to_string(hard_skills, '|') as hard_skills) from silver"


@register("silver_republish", O.with_stages(_SILVER, "silver", postings=fixtures.MONTHLY_SQL))
def q_silver_republish(spark, sf):
    """An older state of both tables, with a date that has no rows any more, then all dates published anew."""
    p = fixtures.monthly_postings(spark, sf)
    base = scratch_path(spark, "published")
    tables = [f"published_{base[-12:]}.clean", f"published_{base[-12:]}.exploded"]
    old = p.where("year < '1996'").unionByName(p.where("year = '1996'").withColumn("year", F.lit("1990")))
    dates = [tuple(r) for r in old.unionByName(p).select(*P).distinct().collect()]  # bounded by the calendar
    for rows in (old, p):
        u = silver.silver_unexploded(rows, fixtures.companies(spark, sf))
        clean_rows = publish.stage(u, tables[0], f"{base}/{tables[0]}")
        # the exploded table is made of the rows just written, which are not visible yet
        written = partitions.read_partitioned(spark, clean_rows.path, u.schema).select(*u.columns)
        publish.publish(spark, [clean_rows, publish.stage(silver.silver_exploded(written), tables[1], f"{base}/{tables[1]}")], dates)
    return flat(spark.table(tables[0]))


# ------------------------------------------------------------------ SRC-10 (all tables of a raw database)
@register("silver_all_tables", O.with_stages(
    f"select *, case when {_BOARD_A} then 'board_a' else 'board_b' end as table_name from ({_SILVER})", "silver", postings=fixtures.MONTHLY_SQL))
def q_silver_all_tables(spark, sf):
    """A database with two tables of postings, the companies and a table of another kind."""
    p = fixtures.monthly_postings(spark, sf)
    base = scratch_path(spark, "raw_database")
    name = f"raw_database_{base[-12:]}"
    dated = {c: F.lit(v) for c, v in zip(P, ("2024", "01", "03"))}
    tables = {"board_a": p.where(_BOARD_A), "board_b": p.where(f"not ({_BOARD_A})"),
              "companies": fixtures.companies(spark, sf).withColumns(dated),
              "events": fixtures.table(spark, sf, "events").withColumns(dated)}
    for t, rows in tables.items():
        writers.write_partitioned(rows, f"{base}/{t}")
        crawl.register(spark, t, f"{base}/{t}", f"{base}/_{t}_footers", database=name)
    out = None
    for t, dates in sorted(jobs.sync_all(spark, name, None, f"{base}/out").items()):
        part = partitions.read_partitioned(spark, f"{base}/out/{t}/unexploded").withColumn("table_name", F.lit(t))
        out = part if out is None else out.unionByName(part)
    return flat(out)


@register("stringify_all", O.with_stages("select cast(columns(*) as varchar) from titled", "titled"))
def q_stringify(spark, sf):
    return writers.stringify_all(clean.clean_rows(fixtures.postings(spark, sf)))


# ------------------------------------------------------------------ SNK-03 / SNK-04
@register("csv_roundtrip", O.with_stages("select cast(columns(*) as varchar) from titled", "titled"))
def q_csv(spark, sf):
    rows = clean.clean_rows(fixtures.postings(spark, sf))
    path = scratch_path(spark, "csv")
    writers.write_csv(rows, path)
    return writers.read_csv(spark, path)


@register("csv_append", O.with_stages("select cast(columns(*) as varchar) from titled", "titled"))
def q_csv_append(spark, sf):
    rows = clean.clean_rows(fixtures.postings(spark, sf)).withColumn("_half", F.pmod(F.xxhash64("job_url"), F.lit(2)))
    path = scratch_path(spark, "csv_append")
    writers.write_csv(rows.where("_half = 0").drop("_half"), path)
    writers.append_csv(rows.where("_half = 1").drop("_half"), path)
    return writers.read_csv(spark, path)


# ------------------------------------------------------------------ SNK-05
@register("land_by_run_date", "select o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y') as year, "
          "strftime(o_orderdate, '%m') as month, strftime(o_orderdate, '%d') as day from orders")
def q_land_by_run_date(spark, sf):
    root = scratch_path(spark, "landed_orders")
    orders = fixtures.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    writers.land_raw(orders, root, F.col("o_orderdate"))
    return partitions.read_partitioned(spark, root).select("o_orderkey", "o_orderstatus", *P)


# ------------------------------------------------------------------ SNK-06 (the job's own table)
def _landed(spark, sf: str, postings) -> tuple[str, str]:
    """Postings and companies, landed."""
    base = scratch_path(spark, "raw_landed")
    writers.write_partitioned(postings, f"{base}/postings")
    writers.write_partitioned(fixtures.companies(spark, sf).withColumns(
        {c: F.lit(v) for c, v in zip(P, ("2024", "01", "03"))}), f"{base}/companies")
    return f"{base}/postings", f"{base}/companies"


def _outputs(spark) -> list[str]:
    base = scratch_path(spark, "job")
    return [f"{base}/{n}" for n in ("unexploded", "exploded", "validation")]


@register("validation_table", O.with_stages(FUNNEL_SQL, "silver", "kept_companies"))
def q_validation_table(spark, sf):
    """Every day of the postings landed, then the daily job over all of them."""
    raw, companies = _landed(spark, sf, fixtures.postings(spark, sf))
    out = _outputs(spark)
    jobs.sync_silver(spark, raw, companies, *out)
    return partitions.read_partitioned(spark, out[2])


# ------------------------------------------------------------------ SNK-07
@register("partition_cols", "select o_orderkey, strftime(o_orderdate, '%Y') as year, "
          "strftime(o_orderdate, '%m') as month, strftime(o_orderdate, '%d') as day from orders")
def q_partition_cols(spark, sf):
    return fixtures.table(spark, sf, "orders").select(
        "o_orderkey", *[v.alias(k) for k, v in writers.partition_columns(F.col("o_orderdate")).items()])


# ------------------------------------------------------------------ §2.9 streaming variant
@register("incremental_silver", O.with_stages(
    "select * replace (array_to_string(hard_skills, '|') as hard_skills) from silver", "silver"))
def q_incremental(spark, sf):
    raw = landed_raw(spark, sf)
    schema = partitions.read_partitioned(spark, raw).schema
    out = incremental.sync_once(spark, raw, schema, fixtures.companies(spark, sf),
                                scratch_path(spark, "silver_stream"), scratch_path(spark, "stream_ckpt"))
    return flat(out)


@register("incremental_then_batch", O.with_stages(_SILVER, "silver", postings=fixtures.MONTHLY_SQL))
def q_incremental_then_batch(spark, sf):
    """The stream syncs the first dates, the batch job the later ones and a late file; one ledger for both."""
    late = "(year >= '1996' or job_url like '%3')"
    raw, companies = _landed(spark, sf, fixtures.monthly_postings(spark, sf).where(f"not {late}"))
    out = _outputs(spark)
    schema = partitions.read_partitioned(spark, raw).schema
    incremental.sync_once(spark, raw, schema, fixtures.companies(spark, sf), out[0], scratch_path(spark, "stream_ckpt"), out[1],
                          validation_root=out[2])
    writers.write_partitioned(fixtures.monthly_postings(spark, sf).where(late), raw, mode="append")
    jobs.sync_silver(spark, raw, companies, *out)
    return flat(partitions.read_partitioned(spark, out[0]))
