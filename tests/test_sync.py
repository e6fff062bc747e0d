"""Listing without opening files, ledger, incremental crawl, atomic publish, dispatch by kind, stream and batch together."""

import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from hirewave import fixtures
from hirewave.plans import jobs, silver
from hirewave.sinks import publish, writers
from hirewave.sources import catalog, crawl, kinds, ledger, listing, partitions
from hirewave.streaming import incremental

SF = "/root/testdata/sf0.001"
P = ["year", "month", "day"]


def monthly(spark):
    """All postings, by month (day 01): few folders."""
    return fixtures.postings(spark, SF).withColumn("month", F.lit("01")).withColumn("day", F.lit("01"))


def land(spark, tmp_dir, rows, name="raw"):
    raw, companies = os.path.join(tmp_dir, name), os.path.join(tmp_dir, "companies")
    writers.write_partitioned(rows, raw)
    for day in ("02", "03"):
        some = fixtures.companies(spark, SF).selectExpr("*", "'2024' as year", "'01' as month", f"'{day}' as day")
        writers.write_partitioned(some if day == "03" else some.limit(3), companies)
    return raw, companies


def roots(tmp_dir, base=""):
    return [os.path.join(tmp_dir, base, n) for n in ("silver", "exploded", "validation")]


def dates_of(df):
    return sorted(tuple(r)[:3] for r in df.select(*P).distinct().collect())


def bag(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def spoil(root):
    """Every data file under ``root`` becomes unreadable, in place and at its size and time."""
    n = 0
    for base, _, names in os.walk(root):
        for f in names:
            if f.endswith(".parquet"):
                path = os.path.join(base, f)
                at = os.stat(path)
                with open(path, "r+b") as out:
                    out.write(b"x" * at.st_size)
                os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
                crc = os.path.join(base, f".{f}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
                n += 1
    return n


# listing

def test_listing_opens_no_file(spark, tmp_dir):
    rows = monthly(spark)
    raw, companies = land(spark, tmp_dir, rows)
    want = dates_of(rows)
    assert spoil(raw) >= len(want) and spoil(companies) == 2
    with pytest.raises(Exception):  # noqa: B017  (the files are broken indeed)
        partitions.read_partitioned(spark, raw, rows.schema).count()
    assert [tuple(r) for r in listing.list_dates(spark, raw).collect()] == want
    assert listing.latest_date(spark, raw) == want[-1] and listing.latest_date(spark, companies) == ("2024", "01", "03")
    files = listing.list_files(spark, raw)
    assert {r.bytes for r in files.collect()} == {os.path.getsize(r.path.removeprefix("file:")) for r in files.collect()}
    assert len(listing.date_states(files).collect()) == len(want)


def test_listing_of_missing_and_empty_folders(spark, tmp_dir):
    assert listing.list_files(spark, os.path.join(tmp_dir, "nothing")).count() == 0
    assert listing.latest_date(spark, tmp_dir) is None
    os.makedirs(os.path.join(tmp_dir, "year=2024", "month=01", "day=02"))
    assert listing.list_dates(spark, tmp_dir).count() == 0
    raw, _ = land(spark, tmp_dir, monthly(spark).where("year = '1995'"))
    there, gone = ("1995", "01", "01"), ("2030", "01", "01")
    assert dates_of(listing.list_files(spark, raw, [there, gone])) == [there]
    assert listing.list_files(spark, raw, [gone]).count() == 0 and listing.list_files(spark, raw, []).count() == 0


def test_companies_come_from_the_latest_folder_only(spark, tmp_dir):
    _, companies = land(spark, tmp_dir, monthly(spark).limit(1))
    spoil(os.path.join(companies, "year=2024", "month=01", "day=02"))
    assert jobs.read_latest_companies(spark, companies).count() == fixtures.companies(spark, SF).count()
    with pytest.raises(ValueError, match="no companies"):
        jobs.read_latest_companies(spark, os.path.join(tmp_dir, "none"))


# ledger

def test_late_files_make_their_date_due_again(spark, tmp_dir):
    rows = monthly(spark)
    raw, companies = land(spark, tmp_dir, rows)
    out = roots(tmp_dir)
    assert dates_of(jobs.sync_silver(spark, raw, companies, *out)) == dates_of(rows)
    late = rows.where("year = '1996'").limit(4).withColumn("job_url", F.concat("job_url", F.lit("#late"))).withColumn("title", F.lit("late rust developer"))
    writers.write_partitioned(late, raw, mode="append")
    assert dates_of(jobs.sync_silver(spark, raw, companies, *out)) == [("1996", "01", "01")]
    assert dates_of(jobs.sync_silver(spark, raw, companies, *out)) == dates_of(rows)[-1:]     # nothing new: the latest
    want = silver.silver_unexploded(partitions.read_partitioned(spark, raw), fixtures.companies(spark, SF))
    got = partitions.read_partitioned(spark, out[0])
    assert bag(got) == bag(want.select(*got.columns))


def test_a_replaced_file_of_equal_size_is_a_change(spark):
    old = spark.createDataFrame([("2024", "01", "01", "a", 5, None)], listing.FILES)
    new = old.withColumn("path", F.lit("b"))
    states, done = listing.date_states(new), listing.date_states(old)
    assert dates_of(ledger.changed_dates(states, done)) == [("2024", "01", "01")] and ledger.changed_dates(done, listing.date_states(old)).count() == 0


def test_ledger_holds_the_newest_state_and_the_runs(spark, tmp_dir):
    root = os.path.join(tmp_dir, "ledger")
    assert ledger.synced(spark, root) is None and not ledger.has_run(spark, root, "a")
    one = listing.date_states(spark.createDataFrame([("2024", "01", "01", "a", 5, None)], listing.FILES))
    two = listing.date_states(spark.createDataFrame([("2024", "01", "01", "a", 6, None), ("2024", "01", "02", "c", 6, None)], listing.FILES))
    ledger.commit(one, root, "a")
    ledger.commit(two, root, "b")
    ledger.commit(two.limit(0), root, "none")
    assert all(ledger.has_run(spark, root, r) for r in ("a", "b", "none")) and not ledger.has_run(spark, root, "c")
    known = ledger.synced(spark, root)
    assert sorted(r.bytes for r in known.where("year is not null").collect()) == [6, 6]
    assert dates_of(ledger.due_dates(two, known)) == [("2024", "01", "02")]
    assert dates_of(ledger.due_dates(one, known)) == [("2024", "01", "01")]


def test_a_run_is_not_done_twice(spark, tmp_dir):
    rows = monthly(spark).where("year < '1996'")
    raw, companies = land(spark, tmp_dir, rows)
    out = roots(tmp_dir)
    assert dates_of(jobs.sync_silver(spark, raw, companies, *out, run="day 1")) == dates_of(rows)
    files = sorted(r.path for r in listing.list_files(spark, out[0]).collect())
    assert jobs.sync_silver(spark, raw, companies, *out, run="day 1").count() == 0
    assert sorted(r.path for r in listing.list_files(spark, out[0]).collect()) == files


# crawl

def test_a_second_crawl_reads_only_new_footers(spark, tmp_dir):
    rows = monthly(spark)
    raw, _ = land(spark, tmp_dir, rows.where("year < '1997'"))
    reg = os.path.join(tmp_dir, "registry")
    first = crawl.crawl(spark, raw, reg)
    assert first.agg(F.sum("n_rows")).first()[0] == rows.where("year < '1997'").count()
    spoil(raw)                                               # a footer read again would raise
    writers.write_partitioned(rows.where("year >= '1997'").withColumn("extra", F.lit(1)), raw)
    second = crawl.crawl(spark, raw, reg)
    assert dates_of(second) == dates_of(rows) and second.agg(F.sum("n_rows")).first()[0] == rows.count()
    assert crawl.registry(spark, reg).count() == second.count()
    schema, torn = crawl.merged_schema(crawl.kinds(second))
    assert set(schema.names) == set(rows.columns) - set(P) | {"extra"} and torn == []
    assert {tuple(r)[:3]: r.n_rows for r in crawl.rows_by_date(second).collect()} == {
        tuple(r)[:3]: r["count"] for r in rows.groupBy(*P).count().collect()}


def test_groups_read_mixed_dates_by_file_and_others_by_folder(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    text = spark.createDataFrame([("a", "['x']", "2024", "01", d) for d in ("01", "02")], "k string, s string, year string, month string, day string")
    lists = text.where("day = '02'").withColumn("s", F.array(F.lit("y")))
    writers.write_partitioned(text, raw)
    writers.write_partitioned(lists, raw, mode="append")
    files = crawl.crawl(spark, raw, os.path.join(tmp_dir, "registry"))
    assert crawl.merged_schema(crawl.kinds(files))[1] == ["s"]
    some = crawl.groups(spark, raw, files)
    assert sorted(len(p) for _, p in some) == [1, 2]
    rows = sorted(str(r.s) for schema, paths in some for r in crawl.read_group(spark, raw, schema, paths).collect())
    assert rows == ["['x']", "['x']", "['y']"]
    assert any(p.endswith("day=01") for _, paths in some for p in paths)


def test_register_adds_and_drops_what_changed(spark, tmp_dir):
    rows = monthly(spark)
    raw, reg = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "registry")
    try:
        writers.write_partitioned(rows.where("year < '1997'"), raw)
        name = crawl.register(spark, "postings", raw, reg, "crawl_test")
        assert dates_of(catalog.show_partitions(spark, name)) == dates_of(rows.where("year < '1997'"))
        writers.write_partitioned(rows.where("year >= '1997'").withColumn("extra", F.lit("e")), raw)
        for r in listing.list_files(spark, raw).where("year = '1995'").collect():
            os.remove(r.path.removeprefix("file:"))
        crawl.register(spark, "postings", raw, reg, "crawl_test")
        assert dates_of(catalog.show_partitions(spark, name)) == dates_of(rows.where("year <> '1995'"))
        got = spark.table(name)
        assert got.count() == rows.where("year <> '1995'").count() and "extra" in got.columns
        assert got.where("extra = 'e'").count() == rows.where("year >= '1997'").count()
    finally:
        spark.sql("DROP DATABASE IF EXISTS crawl_test CASCADE")


# publish

def _rows(spark, rows):
    return spark.createDataFrame(rows, "v long, year string, month string, day string")


def test_readers_see_the_old_tables_while_a_run_fails(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    d = [("2024", "01", f"{i:02}") for i in range(1, 5)]
    old, new = _rows(spark, [(1, *d[0]), (2, *d[1]), (3, *d[2])]), _rows(spark, [(20, *d[1]), (40, *d[3])])
    try:
        publish.publish(spark, [publish.stage(old, "pub_test.a", a), publish.stage(old, "pub_test.b", b)], d[:3])
        assert bag(spark.table("pub_test.a")) == bag(spark.table("pub_test.b")) == bag(old)
        broken = new.withColumn("v", F.when(F.col("v") == 40, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("long"))
        with pytest.raises(Exception, match="broken"):
            publish.publish(spark, [publish.stage(new, "pub_test.a", a), publish.stage(broken, "pub_test.b", b)], d[1:])
        assert bag(spark.table("pub_test.a")) == bag(spark.table("pub_test.b")) == bag(old)
        reader = spark.table("pub_test.a")
        reader._jdf.queryExecution().executedPlan()             # planned before the publish
        publish.publish(spark, [publish.stage(new, "pub_test.a", a), publish.stage(new, "pub_test.b", b)], d[1:])
        want = [(1, *d[0]), (20, *d[1]), (40, *d[3])]           # day 3 was redone and has no rows any more
        assert bag(spark.table("pub_test.a")) == bag(spark.table("pub_test.b")) == bag(_rows(spark, want))
        assert bag(reader) in (bag(old), bag(_rows(spark, want)))
        assert dates_of(catalog.show_partitions(spark, "pub_test.b")) == [d[0], d[1], d[3]]
    finally:
        spark.sql("DROP DATABASE IF EXISTS pub_test CASCADE")


def test_vacuum_keeps_what_is_in_use(spark, tmp_dir):
    a = os.path.join(tmp_dir, "a")
    d = [("2024", "01", f"{i:02}") for i in range(1, 4)]
    try:
        assert publish.vacuum(spark, a) == []
        for k in range(4):
            rows = _rows(spark, [(k, *x) for x in (d if k < 3 else d[:1])])
            publish.publish(spark, [publish.stage(rows, "vac_test.a", a)], [])
        before = bag(spark.table("vac_test.a"))
        assert len(publish.vacuum(spark, a, keep=1)) == 2
        spark.catalog.refreshTable("vac_test.a")
        assert bag(spark.table("vac_test.a")) == before == bag(_rows(spark, [(3, *d[0]), (2, *d[1]), (2, *d[2])]))
    finally:
        spark.sql("DROP DATABASE IF EXISTS vac_test CASCADE")


def test_the_job_publishes_both_tables(spark, tmp_dir):
    rows = monthly(spark).where("year < '1997'")
    raw, companies = land(spark, tmp_dir, rows)
    out, tables = roots(tmp_dir), ("job_test.clean", "job_test.exploded")
    try:
        jobs.sync_silver(spark, raw, companies, *out, tables=tables)
        want = silver.silver_unexploded(rows, fixtures.companies(spark, SF))
        assert bag(spark.table(tables[0])) == bag(want)
        assert spark.table(tables[1]).count() == silver.silver_exploded(want).count()
        gone = rows.where("year = '1996'").withColumn("extract_date", F.lit("no date"))
        writers.write_partitioned(gone, raw)                   # redone without any row left
        assert dates_of(jobs.sync_silver(spark, raw, companies, *out, tables=tables)) == dates_of(gone)
        assert bag(spark.table(tables[0])) == bag(want.where("year < '1996'"))
        assert spark.table(tables[1]).where("year = '1996'").count() == 0
        row = partitions.read_partitioned(spark, out[2]).where("year = '1996'").first()
        assert (row.initial_scrapped_data_count, row.scrapped_data_count_after_removing_managerial_post) == (gone.count(), 0)
    finally:
        spark.sql("DROP DATABASE IF EXISTS job_test CASCADE")


# dispatch

def test_kinds_are_told_by_columns(spark):
    assert kinds.kind_of(fixtures.postings(spark, SF).columns) == kinds.POSTINGS
    assert kinds.kind_of(fixtures.companies(spark, SF).columns) == kinds.COMPANIES
    assert kinds.kind_of(["a"]) == kinds.OTHER


def test_a_database_with_companies_others_and_a_broken_table(spark, tmp_dir):
    rows = monthly(spark).where("year < '1996'")
    raw, companies = land(spark, tmp_dir, rows, "good")
    broken, other = os.path.join(tmp_dir, "broken"), os.path.join(tmp_dir, "other")
    writers.write_partitioned(rows, broken)
    writers.write_partitioned(_rows(spark, [(1, "2024", "01", "01")]), other)
    try:
        for name, root in (("a_broken", broken), ("b_companies", companies), ("c_other", other), ("d_good", raw)):
            catalog.register_table(spark, name, root, database="kinds_test")
        spoil(broken)
        done = jobs.sync_tables(spark, "kinds_test", os.path.join(tmp_dir, "out"))
        assert {k: v.kind for k, v in done.items()} == {"a_broken": "postings", "b_companies": "companies", "c_other": "other", "d_good": "postings"}
        assert done["a_broken"].error and done["a_broken"].dates is None and not done["d_good"].error
        assert dates_of(done["d_good"].dates) == dates_of(rows) and done["c_other"].dates is None
        got = partitions.read_partitioned(spark, os.path.join(tmp_dir, "out", "d_good", "unexploded"))
        assert got.count() == silver.silver_unexploded(rows, fixtures.companies(spark, SF)).count() > 0
        with pytest.raises(RuntimeError, match="a_broken"):
            jobs.sync_all(spark, "kinds_test", None, os.path.join(tmp_dir, "out2"))
        catalog.register_table(spark, "e_companies", companies, database="kinds_test")
        with pytest.raises(ValueError, match="2 tables of companies"):
            jobs.sync_tables(spark, "kinds_test", os.path.join(tmp_dir, "out3"))
    finally:
        spark.sql("DROP DATABASE IF EXISTS kinds_test CASCADE")


# stream and batch

def test_batch_after_stream_redoes_only_the_latest_date(spark, tmp_dir):
    rows = monthly(spark)
    raw, companies = land(spark, tmp_dir, rows.where("year < '1997'"))
    out, mark = roots(tmp_dir), os.path.join(tmp_dir, "stream")
    schema, comp = partitions.read_partitioned(spark, raw).schema, fixtures.companies(spark, SF)
    incremental.sync_once(spark, raw, schema, comp, out[0], mark, out[1], validation_root=out[2])
    assert dates_of(partitions.read_partitioned(spark, out[2])) == dates_of(rows.where("year < '1997'"))
    assert dates_of(jobs.sync_silver(spark, raw, companies, *out)) == dates_of(rows.where("year < '1997'"))[-1:]
    writers.write_partitioned(rows.where("year >= '1997'"), raw)
    assert dates_of(jobs.sync_silver(spark, raw, companies, *out)) == dates_of(rows.where("year >= '1997'"))
    files = sorted(r.path for r in listing.list_files(spark, out[0]).collect())
    incremental.sync_once(spark, raw, schema, comp, out[0], mark, out[1], validation_root=out[2])   # the batch has them
    assert sorted(r.path for r in listing.list_files(spark, out[0]).collect()) == files
    got, want = partitions.read_partitioned(spark, out[0]), silver.silver_unexploded(rows, comp)
    assert bag(got) == bag(want.select(*got.columns))


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    rows = monthly(spark).where("year < '1996'")
    raw, _ = land(spark, tmp_dir, rows)
    out, mark = roots(tmp_dir), os.path.join(tmp_dir, "stream")
    schema, comp = partitions.read_partitioned(spark, raw).schema, fixtures.companies(spark, SF)
    incremental.sync_once(spark, raw, schema, comp, out[0], mark, out[1], validation_root=out[2])
    files = sorted(r.path for root in out for r in listing.list_files(spark, root).collect())
    for name in os.listdir(os.path.join(mark, "commits")):      # as after a crash between the ledger and the stream's commit
        os.remove(os.path.join(mark, "commits", name))
    incremental.sync_once(spark, raw, schema, comp, out[0], mark, out[1], validation_root=out[2])
    assert sorted(r.path for root in out for r in listing.list_files(spark, root).collect()) == files


# one scan

ONE_SCAN = """
    import os, sys
    sys.path.insert(0, {repo!r})
    from hirewave.session import build_session
    spark = build_session("local[4]", extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file:" + {log!r},
                                              "spark.eventLog.compress": "false", "spark.checkpoint.dir": {ckpt!r}}})
    from hirewave.plans import jobs
    jobs.sync_silver(spark, {raw!r}, {companies!r}, *{out!r})
    spark.stop()
"""


def test_raw_dates_are_scanned_once(spark, tmp_dir):
    rows = monthly(spark)
    raw, companies = land(spark, tmp_dir, rows)
    log, ckpt = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ckpt")
    os.makedirs(log)
    code = textwrap.dedent(ONE_SCAN).format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), log=log, ckpt=ckpt, raw=raw,
                                            companies=companies, out=roots(tmp_dir))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    read, scans = {}, {}
    for base, _, names in os.walk(log):
        for name in names:
            if not name.startswith(("appstatus", ".")):
                with open(os.path.join(base, name)) as f:
                    for line in f:
                        event = json.loads(line)
                        if event["Event"] == "SparkListenerTaskEnd":
                            metrics = event.get("Task Metrics") or {}
                            read[event["Stage ID"]] = read.get(event["Stage ID"], 0) + metrics.get("Input Metrics", {}).get("Records Read", 0)
                        elif event["Event"] == "SparkListenerStageCompleted":
                            info = event["Stage Info"]
                            scans[info["Stage ID"]] = any(r["Name"] == "FileScanRDD" for r in info["RDD Info"])
    full = [k for k, n in read.items() if scans.get(k) and n == rows.count()]
    assert len(full) == 1
    got = partitions.read_partitioned(spark, roots(tmp_dir)[2])
    assert got.agg(F.sum("initial_scrapped_data_count")).first()[0] == rows.count()


# one promised date

def test_several_dates_where_one_is_promised_raise(spark, tmp_dir):
    rows = monthly(spark)
    with pytest.raises(ValueError, match="several"):
        writers.write_single(rows, os.path.join(tmp_dir, "x"))
    with pytest.raises(ValueError, match="none"):
        partitions.single_partition(rows.limit(0))
    assert not os.path.exists(os.path.join(tmp_dir, "x"))
    one = rows.where("year = '1996'")
    for _ in range(2):
        assert writers.write_single(one, os.path.join(tmp_dir, "x")) == ("1996", "01", "01")
    assert partitions.read_partitioned(spark, os.path.join(tmp_dir, "x")).count() == one.count()
