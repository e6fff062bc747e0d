"""Registered queries: harvest operators over stored pages, counts and events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hirewave import fixtures
from hirewave.functions import exprs, rules
from hirewave.operators import enrich, harvest, pages
from hirewave.plans import oracle as O
from hirewave.plans.registry import register

RUN_DATE = "2024-01-03"  # when the stored pages of the queries were fetched; the library takes it as an argument
BASE_URL = "https://board-a.example/search"


# ---------------------------------------------------------------- DuckDB helpers
def d_decode(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), "
            f"'&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&')")


def d_text(x: str) -> str:
    return d_decode(f"regexp_replace({x}, '<[^>]*>', '', 'g')")


def d_nodes(frag: str) -> str:
    return f"list_transform(regexp_extract_all({frag}, '>([^<]+)<', 1), lambda t: {d_decode('t')})"


def d_span(testid: str) -> str:
    return d_text(f"regexp_extract(html, '(?s)<span[^>]*data-testid=\"{testid}\"[^>]*>(.*?)</span>', 1)")


def d_heading(tag: str) -> str:
    return f"trim({d_text(f'regexp_extract(html, {exprs.sql_str(f"(?s)<{tag}[^>]*>(.*?)</{tag}>")}, 1)')})"


def _map_values(mapping: list[tuple[str, list[str]]]) -> str:
    seen: dict[str, str] = {}
    for target, keys in mapping:
        for k in keys:
            seen.setdefault(k.lower(), target)
    return "select * from (values " + ", ".join(
        f"({exprs.sql_str(k)}, {exprs.sql_str(v)})" for k, v in seen.items()) + ") v(k, v)"


TITLE_MAP = _map_values(rules.TITLE_MAPPING)
DEPT_MAP = _map_values(rules.DEPARTMENT_MAPPING)
_KW = {"pages_kw": fixtures.PAGES_KW_SQL, "title_map": TITLE_MAP, "dept_map": DEPT_MAP}

_LINKS_SQL = (
    f"select '{RUN_DATE}' as extract_date, d.v as department, t.main_title, t.keyword as job_title, t.url from ("
    "select l.page_id, l.keyword, coalesce(m.v, l.keyword) as main_title, "
    "regexp_extract(l.li, 'href=\"([^\"]*)\"', 1) as url from ("
    "select page_id, keyword, unnest(regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1)) as li from pages_kw) l "
    "left join title_map m on lower(l.keyword) = m.k) t left join dept_map d on lower(t.main_title) = d.k")


# ------------------------------------------------------------------ HRV-01
@register("page_fields", fixtures.with_ctes(
    f"select page_id, {d_heading('h1')} as job_title, "
    + ", ".join(f"{d_span(t)} as {n}" for n, t in rules.DETAIL_SPANS) + " from pages"))
def q_page_fields(spark, sf):
    return harvest.page_fields(fixtures.table(spark, sf, "pages"), "h1")


@register("detail_fields", O.with_stages(
    f"select page_id, {d_heading('h2')} as job_title, "
    + ", ".join(f"{d_span(t)} as {n}" for n, t in rules.DETAIL_SPANS) + " from detail_pages",
    "postings", extra={"detail_pages": fixtures.DETAIL_PAGES_SQL}))
def q_detail_fields(spark, sf):
    return harvest.page_fields(fixtures.detail_pages(spark, sf), "h2")


@register("detail_fields_parsed", O.with_stages(
    f"select page_id, {d_heading('h2')} as job_title, "
    + ", ".join(f"{d_span(t)} as {n}" for n, t in rules.DETAIL_SPANS) + " from detail_pages",
    "postings", extra={"detail_pages": fixtures.DETAIL_PAGES_SQL}))
def q_detail_fields_parsed(spark, sf):
    """Same fields through the HTML parser (mapInArrow, Arrow batches)."""
    return harvest.page_fields_parsed(fixtures.detail_pages(spark, sf), "h2")


# ------------------------------------------------------------------ HRV-02 / HRV-13
def _lists_sql(src: str, q_frag: str, d_frag: str) -> str:
    return (f"select page_id, array_to_string(q, ', ') as job_qualification, len(q) as n_qualification, "
            f"array_to_string(d, '|') as job_description, len(d) as n_description from ("
            f"select page_id, case when {q_frag} <> '' then {d_nodes(q_frag)} else [] end as q, "
            f"case when {d_frag} <> '' then {d_nodes(d_frag)} else [] end as d from {src})")


def _lists_out(df):
    return df.select("page_id",
                     F.array_join("job_qualification", ", ").alias("job_qualification"),
                     F.size("job_qualification").cast("bigint").alias("n_qualification"),
                     F.array_join("job_description", "|").alias("job_description"),
                     F.size("job_description").cast("bigint").alias("n_description"))


@register("page_paragraphs", _lists_sql(
    "pages", "regexp_extract(html, '(?s)(<ul[^>]*>.*?</ul>)', 1)",
    "regexp_extract(html, '(?s)(<article[^>]*>.*?</article>)', 1)"))
def q_page_paragraphs(spark, sf):
    p = fixtures.table(spark, sf, "pages")
    h = F.col("html")
    return _lists_out(harvest.page_lists(p, harvest.first_ul(h), harvest.article(h)))


_Q_BLOCK = f"regexp_extract(regexp_extract(html, '(?s)(<div[^>]*data-testid=\"{rules.QUALIFICATIONS_TESTID}\"[^>]*>.*?</div>)', 1), '(?s)(<ul[^>]*>.*?</ul>)', 1)"
_D_BLOCK = f"regexp_extract(html, '(?s)(<div[^>]*data-testid=\"{rules.DESCRIPTION_TESTID}\"[^>]*>.*?</div>)', 1)"


@register("detail_lists", O.with_stages(_lists_sql("detail_pages", _Q_BLOCK, _D_BLOCK), "postings",
                                         extra={"detail_pages": fixtures.DETAIL_PAGES_SQL}))
def q_detail_lists(spark, sf):
    p = fixtures.detail_pages(spark, sf)
    h = F.col("html")
    q = harvest.first_ul(harvest.testid_block(h, rules.QUALIFICATIONS_TESTID))
    return _lists_out(harvest.page_lists(p, q, harvest.testid_block(h, rules.DESCRIPTION_TESTID)))


# ------------------------------------------------------------------ HRV-03 + JON-02 + JON-03
def _page_links(spark, sf):
    items = harvest.list_items(fixtures.pages_kw(spark, sf))
    linked = enrich.add_department(enrich.add_main_title(items, "keyword"), "main_title")
    return linked.select(F.lit(RUN_DATE).alias("extract_date"), "department", "main_title",
                         F.col("keyword").alias("job_title"), F.col("href").alias("url"))


@register("page_links", fixtures.with_ctes(_LINKS_SQL, **_KW))
def q_page_links(spark, sf):
    return _page_links(spark, sf)


@register("main_title", fixtures.with_ctes(
    "select p.page_id, p.keyword, coalesce(m.v, p.keyword) as main_title from pages_kw p "
    "left join title_map m on lower(p.keyword) = m.k", **_KW))
def q_main_title(spark, sf):
    return enrich.add_main_title(fixtures.pages_kw(spark, sf), "keyword").select("page_id", "keyword", "main_title")


@register("department", fixtures.with_ctes(
    "select t.page_id, t.main_title, d.v as department from (select p.page_id, coalesce(m.v, p.keyword) as main_title "
    "from pages_kw p left join title_map m on lower(p.keyword) = m.k) t "
    "left join dept_map d on lower(t.main_title) = d.k", **_KW))
def q_department(spark, sf):
    t = enrich.add_main_title(fixtures.pages_kw(spark, sf), "keyword")
    return enrich.add_department(t, "main_title").select("page_id", "main_title", "department")


# ------------------------------------------------------------------ AGG-02
@register("dedup_urls", fixtures.with_ctes(
    "select url, job_title, main_title, department, extract_date, n_links from (select *, "
    "row_number() over (partition by url order by job_title nulls first, main_title nulls first, "
    "department nulls first) as rn, count(*) over (partition by url) as n_links from page_links) where rn = 1",
    **_KW, page_links=_LINKS_SQL))
def q_dedup_urls(spark, sf):
    links = _page_links(spark, sf)
    keep = F.min(F.struct("job_title", "main_title", "department", "extract_date")).alias("s")
    return (links.groupBy("url").agg(keep, F.count(F.lit(1)).alias("n_links"))
                 .select("url", "s.*", "n_links"))


# ------------------------------------------------------------------ HRV-04
@register("detail_links", fixtures.with_ctes(
    "select page_id, concat(url, '&job=', regexp_replace(regexp_extract(li, 'href=\"([^\"]*)\"', 1), '^/', '')) "
    "as job_link from (select page_id, url, unnest(regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1)) as li "
    "from pages_kw)", pages_kw=fixtures.PAGES_KW_SQL))
def q_detail_links(spark, sf):
    return harvest.detail_links(harvest.list_items(fixtures.pages_kw(spark, sf)))


# ------------------------------------------------------------------ HRV-05
_PAGER = f'<a class="{rules.PAGER_LINK_CLASS}" aria-label="page '


@register("next_link", fixtures.with_ctes(
    "select page_id, current_page, nullif(regexp_extract(list_filter(regexp_extract_all(html, "
    f"'{_PAGER}[0-9]+\" href=\"[^\"]*\"', 0), lambda x: starts_with(x, '{_PAGER}' || "
    "cast(current_page + 1 as varchar) || '\"'))[1], 'href=\"([^\"]*)\"', 1), '') as next_url from list_pages",
    list_pages=fixtures.LIST_PAGES_SQL))
def q_next_link(spark, sf):
    lp = fixtures.list_pages(spark, sf)
    return lp.select("page_id", "current_page", harvest.next_link(lp, F.col("current_page")).alias("next_url"))


# ------------------------------------------------------------------ HRV-06
@register("result_count", fixtures.with_ctes(
    "select keyword, experience, label, coalesce(try_cast(regexp_replace(split_part(trim(label), ' ', 1), "
    "'[^0-9]', '', 'g') as integer), 0) as total from result_labels",
    result_rows=fixtures.RESULT_ROWS_SQL, result_labels=fixtures.RESULT_LABELS_SQL))
def q_result_count(spark, sf):
    lab = fixtures.result_labels(spark, sf)
    return lab.select("keyword", "experience", "label", harvest.result_count(F.col("label")).alias("total"))


# ------------------------------------------------------------------ HRV-07
def _page_plan_sql(size: int) -> str:
    return fixtures.with_ctes(
        f"select keyword, total, page, (page - 1) * {size} as start from (select keyword, total, "
        f"unnest(generate_series(1, cast(ceil(total / {size}) as bigint))) as page from "
        "(select keyword, count(*) as total from result_rows group by keyword))",
        result_rows=fixtures.RESULT_ROWS_SQL)


def _page_plan(spark, sf, size):
    counts = fixtures.result_rows(spark, sf).groupBy("keyword").agg(F.count(F.lit(1)).alias("total"))
    out = harvest.page_plan(counts, "total", size)
    return out.select("keyword", "total", F.col("page").cast("bigint").alias("page"),
                      F.col("start").cast("bigint").alias("start"))


@register("page_plan", _page_plan_sql(rules.PAGE_SIZE_A))
def q_page_plan(spark, sf):
    return _page_plan(spark, sf, rules.PAGE_SIZE_A)


@register("page_plan_b", _page_plan_sql(rules.PAGE_SIZE_B))
def q_page_plan_b(spark, sf):
    return _page_plan(spark, sf, rules.PAGE_SIZE_B)


# ------------------------------------------------------------------ HRV-08
_FACET_SQL = (
    "select keyword, experience, work_type, total, greatest(total - 1000, 0) as overflow from ("
    "select *, max(case when gid = 3 then total end) over (partition by keyword) as k_total, "
    "max(case when gid = 1 then total end) over (partition by keyword, experience) as e_total from ("
    "select keyword, experience, work_type, count(*) as total, grouping(keyword, experience, work_type) as gid "
    "from result_rows group by rollup(keyword, experience, work_type)) g where gid <> 7) h "
    "where (gid = 3 and total <= 1000) or (gid = 1 and k_total > 1000 and total <= 1000) or (gid = 0 and e_total > 1000)")


@register("facet_plan", fixtures.with_ctes(_FACET_SQL, result_rows=fixtures.RESULT_ROWS_SQL))
def q_facet_plan(spark, sf):
    return harvest.facet_plan(fixtures.result_rows(spark, sf))


_SOME_NULL = f"select case when experience = '2' then null else keyword end as keyword, experience, work_type from ({fixtures.RESULT_ROWS_SQL})"


@register("facet_plan_null_keywords", fixtures.with_ctes(_FACET_SQL, result_rows=_SOME_NULL))
def q_facet_plan_null(spark, sf):
    rows = fixtures.result_rows(spark, sf)
    return harvest.facet_plan(rows.withColumn("keyword", F.when(F.col("experience") != "2", F.col("keyword"))))


# ------------------------------------------------------------------ HRV-09
def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


@register("search_urls", fixtures.with_ctes(
    f"select keyword, experience, work_type, page, concat('{BASE_URL}?', concat_ws('&', "
    f"'keywords=' || {_enc('keyword')}, 'location=' || {_enc(exprs.sql_str(rules.SEARCH_LOCATION))}, "
    f"'f_TPR={rules.RECENCY_PARAM}', case when experience is not null then 'f_E=' || experience end, "
    "case when experience is not null then 'f_WT=' || coalesce(work_type, '') end, "
    f"'start=' || cast((page - 1) * {rules.PAGE_SIZE_A} as varchar))) as url from ("
    f"select *, unnest(generate_series(1, cast(ceil(total / {rules.PAGE_SIZE_A}) as bigint))) as page from facet) p",
    result_rows=fixtures.RESULT_ROWS_SQL, facet=_FACET_SQL))
def q_search_urls(spark, sf):
    plan = harvest.page_plan(harvest.facet_plan(fixtures.result_rows(spark, sf)), "total", rules.PAGE_SIZE_A)
    return plan.select("keyword", "experience", "work_type", F.col("page").cast("bigint").alias("page"),
                       harvest.search_url(BASE_URL, F.col("keyword"), F.col("experience"), F.col("work_type"),
                                          F.col("start")).alias("url"))


# ------------------------------------------------------------------ HRV-10
@register("last_day", f"select * from events where ts >= (select max(ts) from events) - "
          f"interval {rules.RECENCY_SECONDS} second")
def q_last_day(spark, sf):
    return harvest.last_day(fixtures.table(spark, sf, "events"))


# ------------------------------------------------------------------ HRV-11
def _posted_sql(strict: bool) -> str:
    d, h = ("days", "hours") if strict else ("day", "hour")
    return fixtures.with_ctes(
        f"select event_id, posted_text, case when contains(posted_text, '{d}') and n is not null "
        "then cast(scraped_at as date) - n "
        f"when contains(posted_text, '{h}') and n is not null then cast(scraped_at - to_hours(n) as date) "
        "else cast(scraped_at as date) end as posted_on from (select *, "
        "try_cast(split_part(trim(posted_text), ' ', 1) as integer) as n from posted_ages)",
        posted_ages=fixtures.POSTED_AGES_SQL)


@register("posted_date", _posted_sql(False))
def q_posted_date(spark, sf):
    a = fixtures.posted_ages(spark, sf)
    return a.select("event_id", "posted_text",
                    harvest.posted_date(F.col("posted_text"), F.col("scraped_at")).alias("posted_on"))


@register("posted_date_strict", _posted_sql(True))
def q_posted_date_strict(spark, sf):
    a = fixtures.posted_ages(spark, sf)
    return a.select("event_id", "posted_text",
                    harvest.posted_date(F.col("posted_text"), F.col("scraped_at"), True).alias("posted_on"))


# ------------------------------------------------------------------ HRV-12
_BOARD_B = {"board_b_raw": fixtures.BOARD_B_SQL}


def _board_b_lists_sql() -> str:
    t = "job_qualification_text"
    q = (f"coalesce(case when contains({t}, chr(39) || ' ' || chr(39)) then {O.space_sql(t)} "
         f"else {O.distinct_sql(O.comma_sql(t))} end, [])")
    return (f"select * exclude (job_qualification_text, job_description_text), {q} as job_qualification, "
            "string_split(job_description_text, ' ') as job_description from board_b_raw")


@register("comma_rules", O.with_stages(
    "select job_url, replace(company, ',', '-') as company, replace(location, ',', '-') as location, "
    "replace(salary, ',', '') as salary from board_b_raw", "postings", extra=_BOARD_B))
def q_comma_rules(spark, sf):
    return harvest.comma_rules(fixtures.board_b(spark, sf)).select("job_url", "company", "location", "salary")


# ------------------------------------------------------------------ HRV-13
@register("join_lists", O.with_stages(
    "select job_url, array_to_string(job_qualification, ', ') as job_qualification, "
    "array_to_string(job_description, ', ') as job_description from board_b", "postings",
    extra={**_BOARD_B, "board_b": _board_b_lists_sql()}))
def q_join_lists(spark, sf):
    return harvest.join_lists(fixtures.board_b(spark, sf)).select("job_url", "job_qualification", "job_description")


# ------------------------------------------------------------------ SET-01 / SET-02
@register("union_boards", O.with_stages(
    "select * replace (cast(rid as varchar) as rid) from (select * from postings union all by name "
    "select * exclude (job_qualification, job_description) rename (job_title as title, "
    "search_keyword_for_job as search_title), array_to_string(job_description, ', ') as description, "
    "array_to_string(job_qualification, ', ') as job_qualification from board_b)", "postings",
    extra={**_BOARD_B, "board_b": _board_b_lists_sql()}))
def q_union_boards(spark, sf):
    u = harvest.union_boards(fixtures.postings(spark, sf), fixtures.board_b(spark, sf))
    # board B has no rid: a nullable integer, returned as text for a type-stable compare
    return u.withColumn("rid", F.col("rid").cast("string"))


# ------------------------------------------------------------------ LIM-01 (top-k is the feature)
@register("first_100_links", O.with_stages(
    "select row_number() over (order by job_url) as n, title, job_url from "
    "(select title, job_url from postings order by job_url limit 100)", "postings"))
def q_first_100(spark, sf):
    top = fixtures.postings(spark, sf).select("title", "job_url").orderBy("job_url").limit(100)
    # 100 rows after the top-k: the running number needs no partition key
    return top.select(F.row_number().over(Window.orderBy("job_url")).cast("bigint").alias("n"), "title", "job_url")


# ------------------------------------------- HRV-01 .. 06, 14 by the page parser
# the oracles read the columns that the pages were made of, not the pages
def _marked(spark, sf):
    return pages.parse_pages(fixtures.marked_lists(spark, sf))


_MARKED_ROWS = ("select p.*, k.k from (select *, page_id % 3 + 1 as current_page from pages_kw) p "
                "join (select unnest([1, 2, 3]) as k) k on page_id % 4 >= k.k")
_MARKED = {"pages_kw": fixtures.PAGES_KW_SQL, "marked_rows": _MARKED_ROWS}


@register("marked_fields", O.with_stages(
    "select rid as page_id, trim(title) as job_title, company, coalesce(location, '') as location, job_type, "
    "concat('$', rid % 150 + 50, ',000 & up ', chr(8211), ' yearly') as salary, "
    "concat(rid % 9 + 1, ' days ago') as posted_on from postings", "postings"))
def q_marked_fields(spark, sf):
    return pages.fields(pages.parse_pages(fixtures.marked_detail(spark, sf)))


@register("marked_text_lists", O.with_stages(
    "select rid as page_id, case when rid % 4 = 0 then '' else concat(org, ', ', role, ', ', domain) end as job_qualification, "
    "cast(case when rid % 4 = 0 then 0 else 3 end as bigint) as n_qualification, "
    "concat(description, '|', department, ' |team') as job_description, cast(3 as bigint) as n_description from postings", "postings"))
def q_marked_text_lists(spark, sf):
    return _lists_out(pages.lists(pages.parse_pages(fixtures.marked_detail(spark, sf))))


# the navigation entry, then a posting and an advertisement for each number
_MARKED_LINKS = ("select page_id, keyword, '/home' as url from pages_kw union all "
                 "select page_id, keyword, concat('/job?id=', k, '&p=', page_id) from marked_rows union all "
                 "select page_id, keyword, '' from marked_rows")


@register("marked_page_links", fixtures.with_ctes(
    f"select '{RUN_DATE}' as extract_date, d.v as department, t.main_title, t.keyword as job_title, t.url from ("
    "select l.*, coalesce(m.v, l.keyword) as main_title from marked_links l left join title_map m on lower(l.keyword) = m.k) t "
    "left join dept_map d on lower(t.main_title) = d.k", **_MARKED, marked_links=_MARKED_LINKS, title_map=TITLE_MAP, dept_map=DEPT_MAP))
def q_marked_page_links(spark, sf):
    items = pages.list_items(_marked(spark, sf))
    linked = enrich.add_department(enrich.add_main_title(items, "keyword"), "main_title")
    named = linked.select(F.lit(RUN_DATE).alias("extract_date"), "department", "main_title",
                          F.col("keyword").alias("job_title"), F.col("href").alias("url"))
    return harvest.fixed_schema(named, harvest.LINK_SCHEMA)


@register("marked_detail_links", fixtures.with_ctes(
    "select page_id, concat(url, '&job=k', page_id, '-', k) as job_link from marked_rows", **_MARKED))
def q_marked_detail_links(spark, sf):
    return pages.detail_links(pages.list_items(_marked(spark, sf)))


@register("marked_next_link", fixtures.with_ctes(
    "select page_id, cast(page_id % 3 + 1 as integer) as current_page, case when page_id % 5 + 1 >= page_id % 3 + 2 "
    "then concat(url, '&pn=', page_id % 3 + 2) end as next_url from pages", **_MARKED))
def q_marked_next_link(spark, sf):
    return _marked(spark, sf).select("page_id", "current_page", pages.next_link(F.col("current_page")).alias("next_url"))


@register("marked_result_count", fixtures.with_ctes(
    "select page_id, cast(case when page_id % 7 = 0 then 0 else (page_id % 9 + 1) * 1000 + page_id % 1000 end as integer) as total "
    "from pages", **_MARKED))
def q_marked_result_count(spark, sf):
    return _marked(spark, sf).select("page_id", pages.result_count().alias("total"))
