"""URL filters: sort-merge range join of reversed-host keys with nested rules."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.llm.common import table
from hirewave.session import ship_package

#: host, path, action
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
DEFAULT = "allow"
SAMPLE_KEYS = 20_000
_OUT = "id {id}, host string, path string, rule string, verdict string"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    at = F.locate("://", url)
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substr(url, at + 3)).otherwise("")
    return (ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by U+0001: subdomains sort inside their parent's interval."""
    return F.when(host == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "\x01"), F.lit("\x01")))


class Sweep:
    """Stack of the rule groups whose interval holds the current key."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str, dict[str, str], list[int]]] = []

    def enter(self, key: str, host: str, path: str, action: str) -> None:
        self._leave(key)
        if not self.stack or self.stack[-1][0] != key or self.stack[-1][1] != host:
            self.stack.append((key, host, {}, []))
        _, _, paths, lengths = self.stack[-1]
        paths[path] = min(action, paths.get(path, action), key=lambda a: (a != "block", a))
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def _leave(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def judge(self, key: str, host: str, path: str) -> tuple[str, str] | None:
        self._leave(key)
        best = None
        for _, rule_host, paths, lengths in reversed(self.stack):
            if not (rule_host == "" or host == rule_host or host.endswith("." + rule_host)):
                continue
            for n in lengths:
                action = paths.get(path[:n]) if n <= len(path) else None
                if action is not None:
                    rank = (len(rule_host) + n, len(rule_host))
                    if best is None or rank > best[0]:
                        best = (rank, rule_host + path[:n], action)
                    break
        return best and (best[1], best[2])


def apply_rules(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = DEFAULT) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``urls``.

    ``rules`` has host, path and action.  A rule fits its host and all
    subdomains when the path starts with the rule's path; the longest rule
    (host and path together, then host) wins; of equal rules with two actions
    ``block`` wins.  Null urls and urls without ``://`` have empty host and
    path.  Rules with a null host, path or action are ignored; a rule with an
    empty host fits every host.  Repeated rows come back as often as they came.

    Rows and rules are dealt by the order of their keys: split points come
    from a sample of the keys and decide the balance only, never the result.
    A key that fills several splits is spread over them by row hash; a rule
    goes to every split its interval touches (those that cross a split point
    are ancestors of it, so few).  Each task sorts its split and sweeps it
    once with a stack of the open rules.
    """
    spark = urls.sparkSession
    ship_package(spark)
    kind = dict(urls.dtypes)[id_col]
    host, path = host_and_path(F.col("_url"))
    rows = (urls.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("_url"))
            .select("id", host.alias("host"), path.alias("path"))
            .withColumn("key", F.concat(host_key(F.col("host")), F.lit("\x00"), F.col("path"))))
    rule = (rules.select("host", "path", "action").dropna().distinct()
            .withColumn("host", ascii_lower(F.col("host")))
            .withColumn("key", host_key(F.col("host"))))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(rows, parts)
    cuts_of = spark.sparkContext.broadcast(cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = cuts_of.value
        for b in batches:
            lo_hi = [(bisect_left(c, k), bisect_right(c, k)) for k in b.column("key").to_pylist()]
            salt = b.column("salt").to_pylist()
            split = [lo + s % (hi - lo + 1) for (lo, hi), s in zip(lo_hi, salt)]
            yield b.append_column("split", pa.array(split, pa.int32()))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = cuts_of.value
        for b in batches:
            at, splits = [], []
            for i, k in enumerate(b.column("key").to_pylist()):
                last = bisect_right(c, k + "\U0010ffff" * 4)
                found = range(bisect_left(c, k), last + 1)
                at += [i] * len(found)
                splits += found
            yield b.take(pa.array(at, pa.int64())).append_column("split", pa.array(splits, pa.int32()))

    rows = rows.withColumn("salt", F.shiftrightunsigned(F.xxhash64("id", "key"), 1)).mapInArrow(
        place, f"id {kind}, host string, path string, key string, salt long, split int").drop("salt")
    rule = rule.mapInArrow(spread, "host string, path string, action string, key string, split int")
    both = rule.select(F.lit(None).cast(kind).alias("id"), "host", "path", "action", "key", "split").unionByName(
        rows.select("id", "host", "path", F.lit(None).cast("string").alias("action"), "key", "split"))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, split = Sweep(), None
        for b in batches:
            ids, out = [], []
            cols = [b.column(n).to_pylist() for n in ("host", "path", "action", "key", "split")]
            for i, (h, p, a, k, s) in enumerate(zip(*cols)):
                if s != split:
                    state, split = Sweep(), s
                if a is not None:
                    state.enter(k, h, p, a)
                    continue
                hit = state.judge(k, h, p)
                ids.append(i)
                out.append((h, p, hit[0] if hit else None, hit[1] if hit else default))
            got = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(ids, pa.int64())), *[pa.array(list(x), pa.string()) for x in got]],
                names=["id", "host", "path", "rule", "verdict"])

    dealt = both.repartition(max(parts, 1), "split").sortWithinPartitions(
        "split", "key", F.col("action").isNull(), "host", "path")
    return dealt.mapInArrow(sweep, _OUT.format(id=kind))


def _cuts(rows: DataFrame, parts: int) -> list[str]:
    """Up to ``4 * parts - 1`` sorted split points out of a bounded sample of the keys."""
    n = rows.count()
    if not n:
        return []
    share = min(1.0, SAMPLE_KEYS / n)
    picked = rows.where(F.pmod(F.xxhash64("id", "key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    keys = sorted(r[0] for r in picked.select(F.substring("key", 1, 200)).limit(4 * SAMPLE_KEYS).collect())
    k = 4 * parts
    return [keys[len(keys) * i // k] for i in range(1, k)] if len(keys) >= k else keys


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    found = apply_rules(table(spark, sf_dir, "pages"), rules)
    return found.withColumnRenamed("id", "page_id")


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
ORACLE = f"""
WITH rules(rhost, rpath, action) AS (VALUES {_RULE_ROWS}),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
u AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
m AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(action, length(rhost || rpath)) AS action
      FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(action, '{DEFAULT}') AS verdict FROM u LEFT JOIN m USING (page_id)
"""
