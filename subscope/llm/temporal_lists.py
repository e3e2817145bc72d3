"""Temporal join of captures with dated URL lists.

List files say on which day an entry was added or removed. The events of an
entry become validity intervals, and a capture is judged by the entries that
were active when it was fetched: for each key of its URL (the host and the
domains above it, the path and the directories above it) the last event at or
before the fetch must be an addition.

The as-of join is an equality join on key and period: time is cut into periods
of PERIOD days, an interval is written once for each period it touches, and
only the few intervals of one key in one period meet a capture. Captures that
agree in URL and day are judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

PERIOD = 28
_HOST = r"^[a-zA-Z][^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[a-zA-Z][^:/?#]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def url_keys(url: Column) -> Column:
    """All keys under which a list may name a URL: ``d:`` domains of two labels or more, ``p:`` path prefixes."""
    labels = F.split(url_host(url), r"\.")
    n = F.size(labels)
    domains = F.when(n >= 2, F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, n), "."))))
    parts = F.split(url_path(url), "/")
    depth = F.size(parts)
    folders = F.transform(
        F.sequence(F.lit(1), F.greatest(depth - 1, F.lit(1))),
        lambda i: F.concat(F.lit("p:"), url_host(url), F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    whole = F.array(F.concat(F.lit("p:"), url_host(url), url_path(url)))
    return F.array_distinct(F.concat(F.coalesce(domains, F.array().cast("array<string>")), folders, whole))


def intervals(events: DataFrame) -> DataFrame:
    """list, key, valid_from, valid_to (exclusive, null: still active) of list, key, action, day.

    Events without a list, key or day say nothing. On one day a removal wins
    over an addition. Rows are reduced to one for each entry and day first, so
    the window holds a calendar's days at most.
    """
    known = events.where("list IS NOT NULL AND key IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
    days = known.groupBy("list", "key", "day").agg(F.max("action").alias("action"))
    after = F.lead("day").over(Window.partitionBy("list", "key").orderBy("day"))
    return days.withColumn("valid_to", after).where("action = 'add'").select(
        "list", "key", F.col("day").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (url, day and any other columns) with lists, n_entries, blocked.

    ``entries``: the intervals. ``lists``: the names of lists with an active
    entry, sorted, joined by commas; ``n_entries``: such entries. A capture
    without a URL or a day matches nothing. Rows stay as they are, repeated
    ones too; columns of the new names are replaced.
    """
    captures = captures.drop("asked_url", "asked_day", "lists", "n_entries", "blocked")
    asked = captures.select(F.col("url").alias("asked_url"), F.col("day").alias("asked_day")).where(
        "asked_url IS NOT NULL AND asked_day IS NOT NULL").distinct()
    entries = stage(entries)
    span = asked.agg(F.min("asked_day"), F.max("asked_day")).first()
    low, high = (0, -1) if span[0] is None else span
    live = entries.where((F.col("valid_from") <= high) & (F.coalesce(F.col("valid_to") > low, F.lit(True))))
    first = F.greatest(F.col("valid_from"), F.lit(low))
    last = F.least(F.coalesce(F.col("valid_to") - 1, F.lit(high)), F.lit(high))
    period = lambda c: F.floor(c / PERIOD).cast("int")
    cut = live.withColumn("period", F.explode(F.sequence(period(first), period(last))))
    keys = asked.withColumn("key", F.explode(url_keys(F.col("asked_url")))).withColumn("period", period(F.col("asked_day")))
    hits = keys.join(cut, ["key", "period"]).where(
        (F.col("valid_from") <= F.col("asked_day"))
        & F.coalesce(F.col("asked_day") < F.col("valid_to"), F.lit(True)))
    told = hits.groupBy("asked_url", "asked_day").agg(
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.count(F.lit(1)).alias("n_entries"))
    out = captures.join(told, (F.col("url") == F.col("asked_url")) & (F.col("day") == F.col("asked_day")), "left")
    return out.drop("asked_url", "asked_day").withColumns({
        "lists": F.coalesce("lists", F.lit("")), "n_entries": F.coalesce("n_entries", F.lit(0)).cast("long"),
        "blocked": F.col("n_entries").isNotNull()})


# The test tables hold neither lists nor fetch days: both are derived from pages.

def capture_days(pages: DataFrame) -> DataFrame:
    """page_id, url, day: a fetch day within a year from the page's number."""
    return pages.select("page_id", "url", F.pmod(F.col("page_id") * 37, F.lit(365)).alias("day"))


def list_events(pages: DataFrame) -> DataFrame:
    """Every fifth page reports its host, domain, folder or address to a list, or takes it off."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    n = F.col("page_id")
    kind = F.pmod(F.floor(n / 5), F.lit(4))
    domain = F.array_join(F.slice(F.split(host, r"\."), -2, 2), ".")
    key = (F.when((kind == 1) & (F.size(F.split(host, r"\.")) >= 2), F.concat(F.lit("d:"), domain))
           .when(kind == 2, F.concat(F.lit("p:"), host, F.regexp_extract(path, "^(/[^/]*/)?", 1)))
           .when(kind == 3, F.concat(F.lit("p:"), host, path))
           .otherwise(F.concat(F.lit("d:"), host)))
    return pages.where((F.pmod(n, F.lit(5)) == 0) & F.col("url").isNotNull()).select(
        F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")), (F.pmod(n, F.lit(3)) + 1).cast("int")).alias("list"),
        key.alias("key"),
        F.when(F.pmod(F.floor(n / 7), F.lit(3)) == 0, "remove").otherwise("add").alias("action"),
        F.pmod(n * 91, F.lit(365)).alias("day"))


ORACLE = rf"""
WITH p AS (
  SELECT page_id, url, ((page_id * 37) % 365 + 365) % 365 AS day,
         lower(regexp_extract(url, '{_HOST}', 1)) AS host, regexp_extract(url, '{_PATH}', 1) AS path
  FROM pages),
ev AS (
  SELECT ['adult', 'malware', 'spam'][(page_id % 3 + 1)::INT] AS list,
         CASE WHEN floor(page_id / 5.0)::BIGINT % 4 = 1 AND len(string_split(host, '.')) >= 2
                THEN 'd:' || array_to_string(string_split(host, '.')[-2:], '.')
              WHEN floor(page_id / 5.0)::BIGINT % 4 = 2 THEN 'p:' || host || regexp_extract(path, '^(/[^/]*/)?', 1)
              WHEN floor(page_id / 5.0)::BIGINT % 4 = 3 THEN 'p:' || host || path
              ELSE 'd:' || host END AS key,
         CASE WHEN floor(page_id / 7.0)::BIGINT % 3 = 0 THEN 'remove' ELSE 'add' END AS action,
         (page_id * 91) % 365 AS day
  FROM p WHERE page_id % 5 = 0 AND url IS NOT NULL),
days AS (SELECT list, key, day, max(action) AS action FROM ev GROUP BY ALL),
spans AS (
  SELECT *, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS upto FROM days),
keys AS (
  SELECT DISTINCT page_id, url, day, unnest(list_concat(
    CASE WHEN len(string_split(host, '.')) >= 2 THEN
      [('d:' || array_to_string(string_split(host, '.')[i:], '.')) FOR i IN range(1, len(string_split(host, '.')))]
      ELSE [] END,
    [('p:' || host || array_to_string(string_split(path, '/')[1:i], '/') || '/')
      FOR i IN range(1, greatest(len(string_split(path, '/')), 2))],
    ['p:' || host || path])) AS key
  FROM p WHERE url IS NOT NULL),
hits AS (
  SELECT k.page_id, k.url, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(*) AS n
  FROM keys k JOIN spans s ON s.key = k.key AND s.action = 'add' AND s.day <= k.day AND (s.upto IS NULL OR k.day < s.upto)
  GROUP BY ALL)
SELECT p.page_id, p.url, p.day, coalesce(h.lists, '') AS lists, coalesce(h.n, 0)::BIGINT AS n_entries,
       h.n IS NOT NULL AS blocked
FROM p LEFT JOIN hits h ON h.page_id = p.page_id AND h.url = p.url
"""
