"""Harvest operators: the scrapers' data steps as Spark jobs over stored pages.

Fetching is not built.  Captured pages (page_id, url, html), keyword lists
and result counts are tables; field extraction, link lists, page plans and
facet plans are column expressions and aggregates over them, so they run
in parallel over any number of pages.  Extraction here is JVM-side
(``regexp_extract`` / ``regexp_extract_all``) and fits flat markup;
``operators.pages`` is the parser form for pages as they come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from hirewave.functions import rules


# ---------------------------------------------------------------- text helpers
def decode_entities(c: Column) -> Column:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def tag_text(c: Column) -> Column:
    """Text of a markup fragment: tags removed, entities decoded."""
    return decode_entities(F.regexp_replace(c, "<[^>]*>", ""))


def text_nodes(fragment: Column) -> Column:
    """List of the text nodes of a fragment (like iterating ``.strings``)."""
    return F.transform(F.regexp_extract_all(fragment, F.lit(">([^<]+)<"), 1), decode_entities)


def _first(html: Column, pattern: str) -> Column:
    return F.regexp_extract(html, pattern, 1)


def heading(html: Column, tag: str = "h1") -> Column:
    return F.trim(tag_text(_first(html, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>")))


def testid_span(html: Column, testid: str) -> Column:
    """Text of the first span with this data-testid; '' when missing."""
    return tag_text(_first(html, rf'(?s)<span[^>]*data-testid="{testid}"[^>]*>(.*?)</span>'))


def _whole(html: Column, pattern: str) -> Column:
    # group 0 keeps the literal start of the pattern, which the JVM regex
    # engine searches for directly (a leading '(' would defeat that: ~2x slower)
    return F.regexp_extract(html, pattern, 0)


def testid_block(html: Column, testid: str) -> Column:
    """The whole first <div data-testid=...> element ('' when missing)."""
    return _whole(html, rf'(?s)<div[^>]*data-testid="{testid}"[^>]*>.*?</div>')


# HRV-01
def page_fields(pages: DataFrame, heading_tag: str = "h1") -> DataFrame:
    """Heading text and the five labelled spans of each page; missing -> ''."""
    h = F.col("html")
    return pages.select("page_id", heading(h, heading_tag).alias("job_title"),
                        *[testid_span(h, tid).alias(name) for name, tid in rules.DETAIL_SPANS])


# HRV-02
def page_lists(pages: DataFrame, list_fragment: Column, text_fragment: Column) -> DataFrame:
    """(job_qualification, job_description) string lists; missing container -> []."""
    empty = F.array().cast("array<string>")
    q = F.when(list_fragment != "", text_nodes(list_fragment)).otherwise(empty)
    d = F.when(text_fragment != "", text_nodes(text_fragment)).otherwise(empty)
    return pages.select("page_id", q.alias("job_qualification"), d.alias("job_description"))


def first_ul(html: Column) -> Column:
    return _whole(html, r"(?s)<ul[^>]*>.*?</ul>")


def article(html: Column) -> Column:
    return _whole(html, r"(?s)<article[^>]*>.*?</article>")


# HRV-03
def list_items(pages: DataFrame) -> DataFrame:
    """One row per <li>: its markup and the first href inside it ('' when none)."""
    li = F.explode(F.regexp_extract_all(F.col("html"), F.lit(r"(?s)<li(?:\s[^>]*)?>(.*?)</li>"), 1)).alias("li")
    return (pages.select("page_id", "url", "keyword", li)
                 .withColumn("href", F.regexp_extract("li", r'href="([^"]*)"', 1)))


# HRV-04
def detail_links(items: DataFrame) -> DataFrame:
    """Detail link = list-page url + '&job=' + job key (href without leading '/')."""
    key = F.regexp_replace(F.col("href"), "^/", "")
    return items.select("page_id", F.concat(F.col("url"), F.lit(rules.DETAIL_LINK_JOIN), key).alias("job_link"))


# HRV-05
def next_link(pages: DataFrame, current_page: Column) -> Column:
    """Href of the pager link labelled 'page n+1', else NULL."""
    cls = rules.PAGER_LINK_CLASS
    label = rules.PAGER_LABEL
    links = F.regexp_extract_all(F.col("html"), F.lit(rf'<a class="{cls}" aria-label="{label}[0-9]+" href="[^"]*"'), 0)
    want = F.concat(F.lit(f'<a class="{cls}" aria-label="{label}'), (current_page + 1).cast("string"), F.lit('"'))
    hit = F.try_element_at(F.filter(links, lambda x: x.startswith(want)), F.lit(1))
    return F.nullif(F.regexp_extract(hit, r'href="([^"]*)"', 1), F.lit(""))


# HRV-06
def result_count(label: Column) -> Column:
    """Digits of the first word of the label ('1,234 new' -> 1234); any failure -> 0."""
    first = F.regexp_extract(label, r"(\S+)", 1)
    return F.coalesce(F.regexp_replace(first, "[^0-9]", "").try_cast("int"), F.lit(0))


# HRV-07
PAGE_CHUNK = 100_000


def page_plan(counts: DataFrame, total_col: str = "total", page_size: int = rules.PAGE_SIZE_A,
              chunk: int = PAGE_CHUNK) -> DataFrame:
    """One row per result page: pages = ceil(total / size), start = (page - 1) * size.

    total = 0 gives no page (``sequence(1, 0)`` would count down, so it is
    guarded).  An uncapped total can ask for millions of pages from one input
    row; pages are therefore generated in chunks of ``chunk``: one row per
    chunk is spread over the tasks first, then each chunk expands, so no
    task expands more than ``chunk`` pages of one keyword.
    """
    pages = F.ceil(F.col(total_col) / F.lit(page_size)).cast("long")
    n_chunks = F.ceil(pages / F.lit(chunk)).cast("long")
    chunks = (counts.withColumn("_pages", pages)
                    .withColumn("_chunk", F.explode(F.when(n_chunks > 0, F.sequence(F.lit(0).cast("long"), n_chunks - 1))
                                                     .otherwise(F.array().cast("array<long>")))))
    # one small row per chunk: hash them over the tasks before expanding
    chunks = chunks.repartition(F.col("_chunk"), *[F.col(c) for c in counts.columns])
    lo = F.col("_chunk") * chunk + 1
    hi = F.least((F.col("_chunk") + 1) * chunk, F.col("_pages"))
    return (chunks.withColumn("page", F.explode(F.sequence(lo, hi)))
                  .withColumn("start", (F.col("page") - 1) * F.lit(page_size))
                  .drop("_pages", "_chunk"))


# HRV-08
def facet_plan(rows: DataFrame, cap: int = rules.RESULT_CAP, cut: bool = False) -> DataFrame:
    """Which searches to page through, given result counts per (keyword, experience, work_type).

    Counts at three grains come from one ROLLUP aggregate (map-side combined).
    A keyword with total <= cap is searched as is; above the cap it is split by
    experience level; a level still above the cap is split by work type.  ``total`` is
    the real count and ``overflow`` what lies beyond the cap; only with
    ``cut`` is ``total`` held at the cap.  The choice is made with windows over the aggregated
    rollup (at most 21 rows per keyword), no joins.
    """
    g = (rows.rollup("keyword", "experience", "work_type")
             .agg(F.count(F.lit(1)).alias("total"), F.grouping_id().alias("gid"))
             .where(F.col("gid") != 7))  # without the grand total; a null keyword is a keyword like others
    by_kw = Window.partitionBy("keyword")
    by_exp = Window.partitionBy("keyword", "experience")
    k_total = F.max(F.when(F.col("gid") == 3, F.col("total"))).over(by_kw)
    e_total = F.max(F.when(F.col("gid") == 1, F.col("total"))).over(by_exp)
    g = g.withColumns({"k_total": k_total, "e_total": e_total})
    pick = (((F.col("gid") == 3) & (F.col("total") <= cap))
            | ((F.col("gid") == 1) & (F.col("k_total") > cap) & (F.col("total") <= cap))
            | ((F.col("gid") == 0) & (F.col("e_total") > cap)))
    return (g.where(pick)
             .select("keyword", "experience", "work_type",
                     (F.least(F.col("total"), F.lit(cap)) if cut else F.col("total")).cast("bigint").alias("total"),
                     F.greatest(F.col("total") - cap, F.lit(0)).cast("bigint").alias("overflow")))


# HRV-09
def search_url(base: str, keyword: Column, experience: Column, work_type: Column, start: Column) -> Column:
    """Query string in parameter order: keywords, location, f_TPR[, f_E, f_WT], start.

    When split by experience the work-type parameter is sent empty, as the
    original request did.  ``url_encode`` writes a blank as '+'.
    """
    kw, loc, tpr, exp, wt, st = rules.SEARCH_PARAMS
    return F.concat(F.lit(base + "?"), F.concat_ws(
        "&",
        F.concat(F.lit(f"{kw}="), F.url_encode(keyword)),
        F.concat(F.lit(f"{loc}="), F.url_encode(F.lit(rules.SEARCH_LOCATION))),
        F.lit(f"{tpr}={rules.RECENCY_PARAM}"),
        F.when(experience.isNotNull(), F.concat(F.lit(f"{exp}="), experience)),
        F.when(experience.isNotNull(), F.concat(F.lit(f"{wt}="), F.coalesce(work_type, F.lit("")))),
        F.concat(F.lit(f"{st}="), start.cast("string"))))


# HRV-10
def last_day(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Rows of the last 24 hours before the latest timestamp (a scalar subquery)."""
    asof = events.select(F.max(ts_col)).scalar()
    return events.where(F.col(ts_col) >= asof - F.expr(f"INTERVAL {rules.RECENCY_SECONDS} SECONDS"))


# HRV-11
def posted_date(text: Column, scraped_at: Column, strict_plural: bool = False) -> Column:
    """'n days ago' / 'n hours ago' read at ``scraped_at`` -> DATE; else that day.

    Singular forms count too unless ``strict_plural`` (the original rule).
    """
    n = F.split_part(F.trim(text), F.lit(" "), F.lit(1)).try_cast("int")
    day_word, hour_word = ("days", "hours") if strict_plural else ("day", "hour")
    return (F.when(text.contains(day_word) & n.isNotNull(), F.date_sub(F.to_date(scraped_at), n))
             .when(text.contains(hour_word) & n.isNotNull(),
                   F.to_date(F.timestamp_add("HOUR", -n, scraped_at)))
             .otherwise(F.to_date(scraped_at)))


# HRV-12
def comma_rules(df: DataFrame) -> DataFrame:
    """company and location: ',' -> '-'; salary: ',' removed (literal replace)."""
    return df.withColumns({
        "company": F.replace(F.col("company"), F.lit(","), F.lit("-")),
        "location": F.replace(F.col("location"), F.lit(","), F.lit("-")),
        "salary": F.replace(F.col("salary"), F.lit(","), F.lit("")),
    })


# HRV-13
def join_lists(df: DataFrame, sep: str = ", ") -> DataFrame:
    """List columns -> text joined by ', '; other columns unchanged (schema-driven)."""
    return df.withColumns({f.name: F.array_join(F.col(f.name), sep)
                           for f in df.schema.fields if isinstance(f.dataType, ArrayType)})


# SET-01 / SET-02
def union_boards(board_a: DataFrame, board_b: DataFrame) -> DataFrame:
    """Board B mapped onto board A names, lists joined, bag union by name."""
    b = join_lists(board_b).withColumnsRenamed(rules.BOARD_B_RENAMES)
    return board_a.unionByName(b, allowMissingColumns=True)


# HRV-14
LINK_SCHEMA = StructType([StructField(c, StringType()) for c in rules.LINK_COLUMNS])
BOARD_B_SCHEMA = StructType([StructField(c, ArrayType(StringType()) if c in rules.BOARD_B_LISTS else StringType())
                             for c in rules.BOARD_B_COLUMNS])


def fixed_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name, in its order and types, also when there are no rows; absent ones raise."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def page_fields_parsed(pages: DataFrame, heading_tag: str = "h1") -> DataFrame:
    """HRV-01 by the HTML parser (``operators.pages``), for nested markup."""
    from hirewave.operators import pages as parser
    return parser.fields(parser.parse_pages(pages.select("page_id", "html"), heading_tag))
