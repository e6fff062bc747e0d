"""Input views shaped out of the driver tables.

The driver tables hold no job postings.  ``POSTINGS_SQL`` and
``COMPANIES_SQL`` (FIXTURES.md §4-5) shape them deterministically; each
text runs unchanged in Spark SQL and in DuckDB, so every Spark query and
its oracle start from the same rows.  All work grows with ``orders`` /
``customer`` / ``pages`` / ``events`` / ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

POSTINGS_SQL = """with b as (
 select o_orderkey as rid,
  case when o_orderkey % 97 = 0 then 'nan' when o_orderkey % 101 = 0 then 'extract_date'
       else cast(cast(o_orderdate as date) as string) end as extract_date,
  split_part('Data Engineering|Service Engineering|DevOps|QC', '|', cast(o_orderkey % 4 as int) + 1) as department,
  split_part('data|web|cloud', '|', cast(o_orderkey % 3 as int) + 1) as domains,
  split_part('senior backend engineer|Frontend Developer (Remote)|Data Engineer ($120,000 - $150,000)|AWS Data Engineer|Security Analyst|VP Engineering|Business Analyst|Machine Learning Engineer|hybrid DevOps Engineer|React JS Developer|C++ Developer|Project Manager|Nurse|QA Tester|Full Stack Developer $95,000|Plumber', '|', cast((o_orderkey * 5 + o_custkey) % 16 as int) + 1) as title,
  concat('  ', c_name, ' ') as company,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 7 = 0 then 'United States'
       when o_orderkey % 13 = 0 then concat('Metro, ', n_name, ', ', r_name)
       else concat(n_name, ', ', r_name) end as location,
  o_orderpriority as job_type,
  concat('about ', c_mktsegment) as description,
  c_mktsegment as org, r_name as domain, o_orderstatus as role,
  case when o_orderkey % 29 = 0 then null
       when o_orderkey % 3 = 0 then concat('[', chr(39), s1, chr(39), ' ', chr(39), s2, chr(39), chr(10), ' ', chr(39), s3, chr(39), ']')
       else concat('[', chr(39), s1, chr(39), ', ', chr(39), s2, chr(39), ', ', chr(39), s3, chr(39), ']') end as hard_skills,
  substr(cast(cast(o_orderdate as date) as string), 1, 4) as year,
  substr(cast(cast(o_orderdate as date) as string), 6, 2) as month,
  substr(cast(cast(o_orderdate as date) as string), 9, 2) as day
 from (select *,
   split_part(lex, '|', cast(o_orderkey % 15 as int) + 1) as s1,
   split_part(lex, '|', cast((o_orderkey * 7 + 3) % 15 as int) + 1) as s2,
   split_part(lex, '|', cast((o_orderkey * 3 + 1) % 15 as int) + 1) as s3
  from (select *, 'PySpark|Python 3|Java|JavaScript|AWS Glue|aws cloud services|PostgreSQL|Azure Data Factory|REST API|API design|netlify|Power BI|llm tuning|git|Excel' as lex from orders) o0) o
 join customer on o_custkey = c_custkey
 join nation on c_nationkey = n_nationkey
 join region on n_regionkey = r_regionkey)
select *, concat('https://jobs.example/', cast(rid as string)) as job_url from b
union all
select *, concat('https://jobs.example/dup/', cast(rid as string)) as job_url from b where rid % 20 = 0"""

# Spark plan of the same rows: one pass over the joined orders; every 20th
# posting is emitted twice (its copy has another url) by an explode instead
# of a second scan and join of the inlined CTE.
POSTINGS_ONE_PASS_SQL = POSTINGS_SQL[:POSTINGS_SQL.index("select *, concat('https://jobs.example/'")] + (
    "select b.*, u.job_url from b lateral view explode(case when rid % 20 = 0 then "
    "array(concat('https://jobs.example/', cast(rid as string)), concat('https://jobs.example/dup/', cast(rid as string))) "
    "else array(concat('https://jobs.example/', cast(rid as string))) end) u as job_url")

# the same postings dated by month (day 01): few folders where a query lands tables
MONTHLY_SQL = f"select * replace ('01' as day) from ({POSTINGS_SQL})"

COMPANIES_SQL = """select c_name as company_name,
 split_part('Oil and Gas|Hospitals and Health Care|Software Development|Banking|Aerospace|robotics|Restaurants|IT Services and IT Consulting', '|', cast(c_custkey % 8 as int) + 1) as company_industry
from customer where c_custkey % 10 <> 0"""

# Postings and companies with every column that silver can take; name -> expression, in both dialects.
FULL_POSTING_COLUMNS = {
    "search_title": "concat('  search ', cast(rid % 7 as string), ' ')",
    "salary": "concat(' $', cast(rid % 90 + 40 as string), 'k ')",
    "seniority_level": "split_part('Entry level|Associate|Director', '|', cast(rid % 3 as int) + 1)",
    "industries": "concat('industry ', cast(rid % 11 as string))",
    "job_function": "case when rid % 5 = 0 then null else concat('function ', cast(rid % 5 as string)) end",
    "posted_on": "concat(' ', cast(rid % 28 + 1 as string), ' days ago')",
    "DATE": "concat('date ', cast(rid % 3 as string))", "DEG": "concat('degree ', cast(rid % 4 as string))",
    "EMAIL": "concat('jobs', cast(rid % 6 as string), '@example.org')", "EXP": "concat(cast(rid % 9 as string), ' years')",
    "LOC": "case when rid % 6 = 0 then null else concat('loc ', cast(rid % 6 as string)) end", "PER": "concat('person ', cast(rid % 8 as string))",
    "PHONE": "concat('555-', cast(rid % 100 as string))", "PROJECT": "concat('project ', cast(rid % 10 as string))",
    "UNI": "concat('university ', cast(rid % 12 as string))",
    "SOFT SKILLS": "concat('[teamwork, skill ', cast(rid % 13 as string), ']')",
}
FULL_COMPANY_COLUMNS = {
    "company_url": "concat('https://companies.example/', company_name)", "website": "concat('www.', company_name)",
    "company size": "concat(cast(length(company_name) as string), '-', cast(length(company_industry) * 100 as string))",
    "headquarters": "concat('hq of ', company_name)", "type": "case when company_industry = 'Banking' then 'public' else 'private' end",
    "founded": "cast(1900 + length(company_industry) as string)", "specialties": "concat('doing ', company_industry)",
}

# Derived inputs (FIXTURES.md §7).  Each text is portable Spark SQL / DuckDB.

# board B rows: one per posting, salary and qualification list made from the order
BOARD_B_SQL = """select title as job_title,
 department as search_keyword_for_job,
 concat(job_url, '&job=', cast(rid as string)) as job_url,
 concat(trim(company), ', Inc') as company,
 location,
 job_type,
 concat('$', cast(cast(floor(rid * 37 % 90000 / 1000) + 40 as bigint) as string), ',', lpad(cast(rid * 37 % 1000 as string), 3, '0'), ' a year') as salary,
 extract_date as posted_on,
 year, month, day,
 description as job_description_text,
 hard_skills as job_qualification_text
from postings"""

# relative posting ages read at each event's own time (never the clock)
POSTED_AGES_SQL = """select event_id, ts as scraped_at,
 case when event_id % 5 = 0 then concat(cast(event_id % 9 + 2 as string), ' days ago')
      when event_id % 5 = 1 then '1 day ago'
      when event_id % 5 = 2 then concat(cast(event_id % 23 + 1 as string), ' hours ago')
      when event_id % 5 = 3 then '1 hour ago'
      else 'Just now' end as posted_text
from events"""

_SCANS: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one driver table; the DataFrame (file listing, footer
    schema) is reused within a session — the driver tables are read-only."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _SCANS[key]


def register_base_tables(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> None:
    """Register the driver tables of ``sf_dir`` as temp views (lazy scans)."""
    for name in tables or BASE_TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_base_tables(spark, sf_dir, ["orders", "customer", "nation", "region"])
    return spark.sql(POSTINGS_ONE_PASS_SQL)


def full_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings as the first producer spells them, with all optional columns."""
    rows = postings(spark, sf_dir).withColumnRenamed("hard_skills", "HARD SKILLS")
    return rows.withColumns({k: F.expr(v) for k, v in FULL_POSTING_COLUMNS.items()})


def full_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies of two dates with all columns; the older date has other values and is not the one to join."""
    rows = companies(spark, sf_dir).withColumns({k: F.expr(v) for k, v in FULL_COMPANY_COLUMNS.items()})
    new = rows.withColumns({c: F.lit(v) for c, v in zip(("year", "month", "day"), ("2024", "01", "10"))})
    old = new.withColumns({"day": F.lit("09"), "website": F.lit("old"), "company_industry": F.lit("Old Software")})
    return new.unionByName(old)


def monthly_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).withColumn("day", F.lit("01"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_base_tables(spark, sf_dir, ["customer"])
    return spark.sql(COMPANIES_SQL)


def board_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board B shaped rows: string fields plus two list fields."""
    from hirewave.operators.skills import parse_auto
    postings(spark, sf_dir).createOrReplaceTempView("postings")
    raw = spark.sql(BOARD_B_SQL)
    return (raw
            .withColumn("job_qualification", F.coalesce(parse_auto(F.col("job_qualification_text")),
                                                        F.array().cast("array<string>")))
            .withColumn("job_description", F.split(F.col("job_description_text"), " "))
            .drop("job_qualification_text", "job_description_text"))


def posted_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_base_tables(spark, sf_dir, ["events"])
    return spark.sql(POSTED_AGES_SQL)


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_base_tables(spark, sf_dir, ["lineitem"])
    return spark.sql(RESULT_ROWS_SQL)


def with_ctes(body: str, **ctes: str) -> str:
    """``WITH name AS (text), ... body`` — composes oracle texts."""
    if not ctes:
        return body
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in ctes.items()) + "\n" + body


# ---------------------------------------------------------------- harvest inputs
def _search_keywords() -> list[str]:
    from hirewave.functions import rules
    kws = [kw for _, kws in rules.TITLE_MAPPING for kw in kws]
    # plus: a department-only title, an unknown keyword, a lower-case spelling
    return kws + ["Full Stack", "Plumber", "data scientist"]


SEARCH_KEYWORDS = _search_keywords()

# each stored list page is the result of searching one keyword
PAGES_KW_SQL = ("select page_id, url, html, split_part('" + "|".join(SEARCH_KEYWORDS)
                + "', '|', cast(page_id % " + str(len(SEARCH_KEYWORDS)) + " as int) + 1) as keyword from pages")

# detail pages (board B markup) wrapped around postings rows
DETAIL_PAGES_SQL = """select rid as page_id, job_url as url, concat('<html><body><h2> ', title, ' </h2>',
 '<span data-testid="viewJobCompanyName">', company, '</span>',
 case when location is null then '' else concat('<span data-testid="viewJobCompanyLocation">', location, '</span>') end,
 '<span data-testid="viewJobBodyJobDetailsJobType">', job_type, '</span>',
 '<span data-testid="viewJobBodyJobCompensation">$', cast(rid % 150 + 50 as string), ',000 &amp; up</span>',
 '<span data-testid="viewJobBodyJobPostingTimestamp"><span data-testid="detailText">', cast(rid % 9 + 1 as string), ' days ago</span></span>',
 case when rid % 4 = 0 then '' else concat('<div data-testid="viewJobQualificationsContainer"><ul><li>', org, '</li><li>', role, '</li><li>', domain, '</li></ul></div>') end,
 '<div data-testid="viewJobBodyJobFullDescriptionContent"><p>', description, '</p><p>', department, '</p></div>',
 '</body></html>') as html from postings"""

# list pages with a pager: page_id % 5 + 1 pages, the current one is page_id % 3 + 1
LIST_PAGES_SQL = ("select page_id, url, cast(page_id % 3 + 1 as int) as current_page, concat(html, '<nav class=\"pager\">', "
                  + ", ".join(
                      f"case when page_id % 5 + 1 >= {k} then concat('<a class=\"chakra-link css-1wxsdwr\" "
                      f"aria-label=\"page {k}\" href=\"', url, '&pn={k}\">{k}</a>') else '' end"
                      for k in range(1, 6))
                  + ", '</nav>') as html from pages")

# pages as sites write them: nested tags, <link>, shuffled attributes, either quote, entities.
# Only Spark builds them; the oracles start from the columns they are made of.
MARKED_DETAIL_SQL = """select rid as page_id, job_url as url, concat('<html><head><link rel="icon" href="/i.png"></head><body><h2 class="t"> ',
 '<em>', title, '</em> </h2><h2>Similar jobs</h2>',
 '<div><span class="n" data-testid="viewJobCompanyName"><b>', company, '</b></span></div>',
 case when location is null then '' else concat('<SPAN title="a > b" DATA-TESTID=', chr(39), 'viewJobCompanyLocation', chr(39), '>', location, '</SPAN>') end,
 '<span data-testid="viewJobBodyJobDetailsJobType">', job_type, '<!-- span --></span>',
 '<span data-testid="viewJobBodyJobCompensation">$', cast(rid % 150 + 50 as string), ',000 &amp; up &#8211; <i>yearly</i></span>',
 '<span data-testid="viewJobBodyJobPostingTimestamp"><span data-testid="detailText">', cast(rid % 9 + 1 as string), ' days ago</span></span>',
 case when rid % 4 = 0 then '' else concat('<div class="q" data-testid="viewJobQualificationsContainer"><div><h3>Needs</h3></div><ul><li><div>',
   org, '</div></li><li>', role, '<br></li><li>', domain, '</li></ul><ul><li>other</li></ul></div>') end,
 '<div data-testid="viewJobBodyJobFullDescriptionContent"><div><p>', description, '</p></div><p>', department, ' <b>team</b></p></div><p>foot</p>',
 '</body></html>') as html from postings"""

_MARKED_ITEMS = ", ".join(
    f"""case when page_id % 4 >= {k} then concat('<li class="x css-0"><div class="c" data-jobkey="k', cast(page_id as string), '-{k}"><div><a title="t" href=',
 chr(39), '/job?id={k}&amp;p=', cast(page_id as string), chr(39), '>T{k}</a><a href="/x">x</a></div></div></li><li class="ad"><div data-jobkey="ad"></div></li>') else '' end"""
    for k in range(1, 4))
_MARKED_PAGER = ", ".join(
    f"""case when page_id % 5 + 1 >= {k} then concat('<a aria-label="page {k}" href="', replace(url, '&', '&amp;'), '&amp;pn={k}" class="chakra-link css-1wxsdwr"><b>{k}</b></a>') else '' end"""
    for k in range(1, 6))
MARKED_LIST_SQL = f"""select page_id, url, keyword, cast(page_id % 3 + 1 as int) as current_page,
 concat('<html><head><link rel="next" href="/n"></head><body><nav><ul><li class="css-0"><div data-jobkey="nav"><a href="/home">Home</a></div></li></ul></nav>',
 case when page_id % 7 = 0 then '' else concat('<span id="r" class="h results-context-header__new-jobs">', chr(10), '   <b>',
   cast(page_id % 9 + 1 as string), ',', lpad(cast(page_id % 1000 as string), 3, '0'), '</b> new jobs </span>') end,
 '<ul class="l" id="job-list">', {_MARKED_ITEMS}, '</ul><nav>', {_MARKED_PAGER}, '</nav></body></html>') as html from pages_kw"""

RESULT_ROWS_SQL = """select concat(l_returnflag, l_linestatus, cast(l_linenumber as string)) as keyword,
 cast(least(l_partkey % 8, 4) + 1 as string) as experience,
 cast(l_suppkey % 3 + 1 as string) as work_type
from lineitem"""

_FMT = ("case when n >= 1000 then concat(cast(cast(floor(n / 1000) as bigint) as string), ',', "
        "lpad(cast(n % 1000 as string), 3, '0')) else cast(n as string) end")
# result labels per (keyword, experience) as the search page shows them
RESULT_LABELS_SQL = f"""select keyword, experience, n,
 case when n % 10 = 0 then 'No new jobs' when n % 10 = 1 then concat('  ', {_FMT}, ' new jobs')
      else concat({_FMT}, ' new jobs') end as label
from (select keyword, experience, count(*) as n from result_rows group by keyword, experience) c"""


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows over ``spark.sql.shuffle.partitions`` tasks, before wide and costly work on each: a table
    in one file, or in a few large row groups, is otherwise read by as few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def pages_kw(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_base_tables(spark, sf_dir, ["pages"])
    return spark.sql(PAGES_KW_SQL)


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread(postings(spark, sf_dir), "rid", "job_url").createOrReplaceTempView("postings")
    return spark.sql(DETAIL_PAGES_SQL)


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_base_tables(spark, sf_dir, ["pages"])
    return spark.sql(LIST_PAGES_SQL)


def marked_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread(postings(spark, sf_dir), "rid", "job_url").createOrReplaceTempView("postings")
    return spark.sql(MARKED_DETAIL_SQL)


def marked_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread(pages_kw(spark, sf_dir), "page_id", "url").createOrReplaceTempView("pages_kw")
    return spark.sql(MARKED_LIST_SQL)


def result_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    result_rows(spark, sf_dir).createOrReplaceTempView("result_rows")
    return spark.sql(RESULT_LABELS_SQL)
