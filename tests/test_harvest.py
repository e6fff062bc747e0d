"""Harvest operators on literal pages and count tables."""

import datetime

from pyspark.sql import functions as F

from hirewave.operators import harvest, pages

PAGE = ('<html><body><h2> Data Engineer &amp; Lead </h2>'
        '<span data-testid="viewJobCompanyName">Acme</span>'
        '<span data-testid="viewJobBodyJobPostingTimestamp"><span data-testid="detailText">3 days ago</span></span>'
        '<div data-testid="viewJobQualificationsContainer"><ul><li>SQL</li><li>Spark</li></ul></div>'
        '<ul><li><a href="/j1">one</a></li><li><a href="/j2">two</a><a href="/x">x</a></li></ul>'
        '<a class="chakra-link css-1wxsdwr" aria-label="page 2" href="?p=2">2</a>'
        '</body></html>')


def _page(spark):
    return spark.createDataFrame([(1, "https://b.example/s?q=x", PAGE, "Java")],
                                 "page_id bigint, url string, html string, keyword string")


def test_page_fields_missing_is_blank(spark):
    r = harvest.page_fields(_page(spark), "h2").first()
    assert r["job_title"] == "Data Engineer & Lead"
    assert r["company"] == "Acme" and r["posted_on"] == "3 days ago"
    assert r["location"] == "" and r["salary"] == ""


def test_lists_and_links(spark):
    p = _page(spark)
    h = F.col("html")
    q = harvest.first_ul(harvest.testid_block(h, "viewJobQualificationsContainer"))
    lists = harvest.page_lists(p, q, harvest.testid_block(h, "missingContainer")).first()
    assert lists["job_qualification"] == ["SQL", "Spark"] and lists["job_description"] == []
    items = harvest.list_items(p)
    hrefs = [r["href"] for r in items.collect()]
    assert hrefs == ["", "", "/j1", "/j2"]            # first href per li; the qualification li have none
    links = [r["job_link"] for r in harvest.detail_links(items.where("href <> ''")).collect()]
    assert links == ["https://b.example/s?q=x&job=j1", "https://b.example/s?q=x&job=j2"]


def test_next_link(spark):
    p = _page(spark)
    got = p.select(harvest.next_link(p, F.lit(1)).alias("a"), harvest.next_link(p, F.lit(2)).alias("b")).first()
    assert got["a"] == "?p=2" and got["b"] is None


def test_result_count(spark):
    labels = ["1,234 new jobs", "  87 new", "No results", "", None, "12abc new"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    got = [r["n"] for r in df.select(harvest.result_count(F.col("label")).alias("n")).collect()]
    assert got == [1234, 87, 0, 0, 0, 12]


def test_page_plan_guards_zero(spark):
    df = spark.createDataFrame([("a", 0), ("b", 26), ("c", 25)], "keyword string, total bigint")
    out = sorted((r["keyword"], r["page"], r["start"]) for r in harvest.page_plan(df).collect())
    assert out == [("b", 1, 0), ("b", 2, 25), ("c", 1, 0)]


def test_facet_plan_three_grains(spark):
    rows = ([("small", "1", "1")] * 10 + [("big", "1", "1")] * 900 + [("big", "2", "1")] * 700
            + [("big", "2", "2")] * 700 + [("big", "3", "3")] * 50)
    df = spark.createDataFrame(rows, "keyword string, experience string, work_type string")
    plan = sorted((r["keyword"], r["experience"] or "-", r["work_type"] or "-", r["total"])
                  for r in harvest.facet_plan(df, cap=1000).collect())
    assert plan == [("big", "1", "-", 900), ("big", "2", "1", 700), ("big", "2", "2", 700),
                    ("big", "3", "-", 50), ("small", "-", "-", 10)]


def test_search_url(spark):
    df = spark.createDataFrame([("Data Engineer", "2", None, 25), ("Go", None, None, 0)],
                               "keyword string, experience string, work_type string, start int")
    urls = [r["u"] for r in df.select(harvest.search_url("https://a.example/s", F.col("keyword"), F.col("experience"),
                                                          F.col("work_type"), F.col("start")).alias("u")).collect()]
    assert urls[0] == ("https://a.example/s?keywords=Data+Engineer&location=United+States&f_TPR=r86400"
                       "&f_E=2&f_WT=&start=25")
    assert urls[1] == "https://a.example/s?keywords=Go&location=United+States&f_TPR=r86400&start=0"


def test_posted_date(spark):
    ts = datetime.datetime(2024, 1, 3, 2, 0, 0)
    texts = ["3 days ago", "1 day ago", "5 hours ago", "Just now", "1 hour ago"]
    df = spark.createDataFrame([(t, ts) for t in texts], "t string, ts timestamp_ntz")
    got = {r["t"]: r["d"] for r in df.select("t", harvest.posted_date(F.col("t"), F.col("ts")).alias("d")).collect()}
    assert got == {"3 days ago": datetime.date(2023, 12, 31), "1 day ago": datetime.date(2024, 1, 2),
                   "5 hours ago": datetime.date(2024, 1, 2), "Just now": datetime.date(2024, 1, 3),
                   "1 hour ago": datetime.date(2024, 1, 3)}
    strict = {r["t"]: r["d"] for r in
              df.select("t", harvest.posted_date(F.col("t"), F.col("ts"), True).alias("d")).collect()}
    assert strict["1 day ago"] == datetime.date(2024, 1, 3)     # the original plural-only rule


def test_last_day(spark):
    base = datetime.datetime(2024, 1, 30, 12, 0, 0)
    rows = [(1, base), (2, base - datetime.timedelta(hours=23)), (3, base - datetime.timedelta(hours=25))]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz")
    assert sorted(r["event_id"] for r in harvest.last_day(df).collect()) == [1, 2]


def test_comma_rules_join_lists_union(spark):
    b = spark.createDataFrame([("Acme, Inc", "A, B", "$1,000", "Dev", "kw", ["x", "y"], ["d1"])],
                              "company string, location string, salary string, job_title string, "
                              "search_keyword_for_job string, job_qualification array<string>, "
                              "job_description array<string>")
    r = harvest.comma_rules(b).first()
    assert (r["company"], r["location"], r["salary"]) == ("Acme- Inc", "A- B", "$1000")
    j = harvest.join_lists(b).first()
    assert j["job_qualification"] == "x, y"
    a = spark.createDataFrame([("Dev2", "c")], "title string, company string")
    u = harvest.union_boards(a, b)
    assert u.count() == 2 and "search_title" in u.columns and "description" in u.columns


def test_page_plan_chunks_equal_whole(spark):
    df = spark.createDataFrame([("a", 26), ("b", 1000), ("c", 0)], "keyword string, total bigint")
    small = sorted((r["keyword"], r["page"], r["start"]) for r in harvest.page_plan(df, chunk=3).collect())
    whole = sorted((r["keyword"], r["page"], r["start"]) for r in harvest.page_plan(df, chunk=10**6).collect())
    assert small == whole and len(small) == 2 + 40


def test_parsed_fields_follow_nested_markup(spark):
    html = ('<h2>T</h2><span data-testid="viewJobCompanyName"><b>Ac</b>me &eacute;</span>'
            '<span data-testid="viewJobBodyJobPostingTimestamp"><span data-testid="detailText">2 days ago</span></span>')
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    r = harvest.page_fields_parsed(df, "h2").first()
    assert (r["job_title"], r["company"], r["posted_on"], r["salary"]) == ("T", "Acme é", "2 days ago", "")


def test_list_items_pass_over_link_tags_and_counts_take_any_blank(spark):
    page = spark.createDataFrame([(1, "u", "k", '<link rel="icon" href="/i"><ul><li class="c"><a href="/j1">x</a></li><li><a href="/j2">y</a></li></ul>')],
                                 "page_id int, url string, keyword string, html string")
    assert [r.href for r in harvest.list_items(page).collect()] == ["/j1", "/j2"]
    labels = spark.createDataFrame([("\n   1,234 new",), ("5\tnew",), ("none",), (None,)], "label string")
    assert [r.n for r in labels.select(harvest.result_count(F.col("label")).alias("n")).collect()] == [1234, 5, 0, 0]


def test_parser_follows_markup_the_patterns_cannot(spark):
    html = ('<link href="/i"><ul id="job-list"><li class="a css-0"><div data-jobkey="k1"><a href=\'/j?a=1&amp;b=2\'>x</a></div></li>'
            '<li class="css-0"><p>no key</p></li></ul><a aria-label="page 2" href="?p=2&amp;q" class="chakra-link css-1wxsdwr">2</a>'
            '<span class="z results-context-header__new-jobs">\n  1,234 new</span>'
            '<div data-testid="viewJobBodyJobFullDescriptionContent"><div>a &lt; b</div><script>no</script>c</div>')
    df = spark.createDataFrame([(1, "u", html), (2, "u", ""), (3, "u", None)], "page_id int, url string, html string")
    parsed = pages.parse_pages(df).cache()
    items = pages.list_items(parsed)
    assert [(r.listed, r.job_key, r.href) for r in items.collect()] == [(True, "k1", "/j?a=1&b=2"), (True, None, "")]
    assert [r.job_link for r in pages.detail_links(items).collect()] == ["u&job=k1"]
    got = parsed.select("page_id", pages.next_link(F.lit(1)).alias("next"), pages.result_count().alias("n"),
                        "found.job_description", "found.job_qualification").orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(1, "?p=2&q", 1234, ["a < b", "c"], []), (2, None, 0, [], []), (3, None, 0, [], [])]


def test_plain_route_gives_the_library_parsers_rows():
    plain = ('<!DOCTYPE html><title>t &amp; u</title><ul id="job-list"><li class=\'css-0\'><div data-jobkey="k"><A HREF="/j?a=1&amp;b">x</a></div></li></ul>'
             '<h2 class="t"> <em>A &amp; B&#33;</em> </h2><SPAN DATA-TESTID="viewJobCompanyName" data-testid="no"><b>Ac<!-- c -->me</b></SPAN></p>'
             '<div data-testid="viewJobQualificationsContainer"><ul><li>one<br></li><li>two</ul></div>a<script>x = 1</script>')
    odd = ["a < b", "<br/>", "<a href=bare>", "<a title='x'href='y'>", "<script>'</p>'</script>", "<title>", "<!-- a-b -->", "<textarea>&lt;</textarea>",
           "<a href='&copy=1'>", "</div a='b'>", "<", "<?x?>"]
    assert pages._Page("h2").read_plain(plain) and not any(pages._Page("h2").read_plain(o) for o in odd)
    for html in [plain, *(f"<h2>T{o}</h2>{plain}" for o in odd)]:
        library = pages._Page("h2")
        library.feed(html)
        library.close()
        library._flush()
        assert pages.parse_page(html, "h2") == library.row(), html


def test_pages_of_a_one_file_table_are_parsed_by_many_tasks(spark):
    from hirewave.plans import queries_harvest as q

    sf, n = "/root/testdata/sf0.001", int(spark.conf.get("spark.sql.shuffle.partitions"))
    for query in (q.q_marked_fields, q.q_marked_text_lists, q.q_detail_fields_parsed, q.q_marked_result_count):
        assert query(spark, sf).select(F.spark_partition_id().alias("p")).distinct().count() == n, query.__name__


def test_fixed_schemas_without_rows(spark):
    empty = harvest.fixed_schema(spark.createDataFrame([], harvest.LINK_SCHEMA), harvest.LINK_SCHEMA)
    assert empty.columns == ["extract_date", "department", "main_title", "job_title", "url"] and empty.count() == 0
    board = spark.createDataFrame([], harvest.BOARD_B_SCHEMA)
    assert dict(harvest.fixed_schema(board, harvest.BOARD_B_SCHEMA).dtypes)["job_qualification"] == "array<string>"
