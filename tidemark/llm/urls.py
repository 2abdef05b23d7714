"""URL filters with dated lists: every capture against the entries active when it was fetched.

A list entry says that from a day on a domain (with its subdomains) or a path (with
all below it) is on a list, or off it again. Entries become intervals of validity. A
capture is looked up by all domains and paths that cover its URL; equal look-ups of
one day are made once, so a host with a third of all captures is one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import load

FOREVER = "9999-12-31"
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and a closing dot; '' if there is none."""
    return F.rtrim(F.regexp_extract(F.lower(url), HOST, 1), F.lit("."))


def cover(url: Column) -> Column:
    """All (scope, key) that cover a URL: its host and the domains above it down to two
    labels, and its path and the folders above it, below the host."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    up_to = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    domains = F.transform(up_to, lambda i: F.struct(F.lit("domain").alias("scope"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")))
    parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda p: p != "")
    depth = F.filter(F.sequence(F.lit(0), F.size(parts)), lambda i: i > 0)
    paths = F.transform(depth, lambda i: F.struct(F.lit("path").alias("scope"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")).alias("key")))
    return F.when(host != "", F.concat(domains, paths))


def intervals(entries: DataFrame) -> DataFrame:
    """scope, key, list, since, until (exclusive) from entries (scope, key, list, dated, listed).

    ``listed`` is true when the entry puts the key on the list, false when it takes it
    off. Of entries of one day, taking off wins; entries with a null in scope, key,
    list or day say nothing, and a null ``listed`` takes off. Repeats change nothing. A state is one row per key and
    day before anything is ordered, so an ordered group has at most a row per day.
    """
    states = (
        entries.where("scope IS NOT NULL AND key IS NOT NULL AND list IS NOT NULL AND dated IS NOT NULL")
        .groupBy("scope", "key", "list", F.col("dated").cast("date").alias("since"))
        .agg(F.min(F.coalesce("listed", F.lit(False))).alias("listed"))
    )
    by_day = Window.partitionBy("scope", "key", "list").orderBy("since")
    return (
        states.withColumn("until", F.coalesce(F.lead("since").over(by_day), F.lit(FOREVER).cast("date")))
        .where("listed").drop("listed")
    )


def active(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(url, fetched, entries, lists, since) for each distinct capture that an active entry covers."""
    looked = captures.where("url IS NOT NULL AND fetched IS NOT NULL").select("url", "fetched").distinct()
    keyed = looked.select("url", "fetched", F.explode_outer(cover(F.col("url"))).alias("k")).select("url", "fetched", "k.scope", "k.key")
    # As of each day on which a key was met: the interval that holds the day.
    asked = keyed.select("scope", "key", "fetched").distinct()
    hits = (
        asked.join(intervals(entries), ["scope", "key"]).where("since <= fetched AND fetched < until")
        .select("scope", "key", "fetched", "list", "since")
    )
    return keyed.join(hits, ["scope", "key", "fetched"]).groupBy("url", "fetched").agg(
        F.count(F.lit(1)).alias("entries"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), F.min("since").alias("since")
    )


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (url, fetched) with blocked, entries (active ones that cover it), lists
    (their names, in order) and since (day of the earliest).

    A null or malformed URL, and a null day, is covered by nothing: blocked is false,
    entries 0, lists empty, since null. Repeated captures are judged alike. Other
    columns pass through, also those named like an added one, which comes in their place.
    """
    added = ("blocked", "entries", "lists", "since")
    found = active(captures.select("url", F.col("fetched").cast("date").alias("fetched")), entries)
    found = found.select(F.col("url").alias("met"), F.col("fetched").alias("on"), F.struct(*added[1:]).alias("found"))
    rows = captures.select("url", F.col("fetched").cast("date").alias("day"), F.struct("*").alias("row"))
    out = rows.join(found, (F.col("url") == F.col("met")) & (F.col("day") == F.col("on")), "left")
    return out.select(
        *[F.col("row")[c].alias(c) for c in captures.columns if c.lower() not in added],
        F.col("found").isNotNull().alias("blocked"), F.coalesce("found.entries", F.lit(0)).cast("long").alias("entries"),
        F.coalesce("found.lists", F.lit("")).alias("lists"), F.col("found.since").alias("since"),
    )


# ---- the query's lists --------------------------------------------------------------

LISTS = ("adult", "malware", "spam")
FIRST_DAY = "2024-01-01"


def _lot(text: Column, at: int) -> Column:
    """A number below 65536 that a text draws: four hexadecimal digits of its digest."""
    return F.conv(F.substring(F.md5(text.cast("binary")), at, 4), 16, 10).cast("int")


def _day(offset: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), offset)


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures; the day follows from the page's number, 400 days in turn."""
    return pages.select("page_id", "url", _day(F.pmod(F.col("page_id") * 37, F.lit(400)).cast("int")).alias("fetched"))


def dated_lists(pages: DataFrame) -> DataFrame:
    """Lists over the domains and folders that the pages have: a share of them is put on
    a list on some day, taken off 60 days later, and half of those put on again."""
    keys = pages.where("url IS NOT NULL").select(F.explode(cover(F.col("url"))).alias("k")).select("k.*").distinct()
    text = F.concat(F.col("scope"), F.lit(":"), F.col("key"))
    drawn = (
        keys.withColumn("lot", _lot(text, 1)).where("lot % 16 < CASE scope WHEN 'domain' THEN 3 ELSE 1 END")
        .withColumn("list", F.element_at(F.array(*[F.lit(x) for x in LISTS]), _lot(text, 5) % 3 + 1))
        .withColumn("start", _lot(text, 9) % 300)
    )
    steps = F.array(
        F.struct(F.lit(0).alias("after"), F.lit(True).alias("listed")), F.struct(F.lit(60).alias("after"), F.lit(False).alias("listed")),
        F.struct(F.lit(90).alias("after"), (F.col("lot") % 32 < 16).alias("listed")),
    )
    return drawn.withColumn("step", F.explode(steps)).select(
        "scope", "key", "list", _day(F.col("start") + F.col("step.after")).alias("dated"), F.col("step.listed").alias("listed")
    )


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    """All pages as captures, against lists dated before and after them."""
    pages = load(spark, sf_dir, "pages", "page_id", "url")
    out = filter_urls(page_captures(pages), dated_lists(pages))
    return out.withColumns({c: F.col(c).cast("string") for c in ("fetched", "since")})


ORACLE_OP7 = r"""
WITH parsed AS (
  SELECT page_id, url, DATE '2024-01-01' + ((page_id * 37) % 400)::INT AS fetched,
    rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1), '.') AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda p: p <> '') AS parts
  FROM pages
), labelled AS (
  SELECT *, string_split(host, '.') AS l FROM parsed WHERE host <> ''
), covers AS (
  SELECT page_id, url, fetched, 'domain' AS scope, array_to_string(l[i:], '.') AS key
  FROM (SELECT *, unnest(range(1, greatest(len(l) - 1, 1) + 1)) AS i FROM labelled)
  UNION ALL
  SELECT page_id, url, fetched, 'path', host || '/' || array_to_string(parts[1:i], '/')
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM labelled)
), lots AS (
  SELECT DISTINCT scope, key, md5(scope || ':' || key) AS d FROM covers
), drawn AS (
  SELECT scope, key, ('0x' || d[1:4])::INT AS lot, ['adult', 'malware', 'spam'][('0x' || d[5:8])::INT % 3 + 1] AS list,
    ('0x' || d[9:12])::INT % 300 AS start
  FROM lots WHERE ('0x' || d[1:4])::INT % 16 < CASE scope WHEN 'domain' THEN 3 ELSE 1 END
), spans AS (
  SELECT scope, key, list, start AS since, start + 60 AS until FROM drawn
  UNION ALL SELECT scope, key, list, start + 90, 10000000 FROM drawn WHERE lot % 32 < 16
), hits AS (
  SELECT c.page_id, count(*) AS entries, array_to_string(list_sort(list(DISTINCT s.list)), ',') AS lists,
    DATE '2024-01-01' + min(s.since)::INT AS since
  FROM covers c JOIN spans s USING (scope, key)
  WHERE c.fetched - DATE '2024-01-01' >= s.since AND c.fetched - DATE '2024-01-01' < s.until
  GROUP BY c.page_id
)
SELECT p.page_id, p.url, CAST(p.fetched AS VARCHAR) AS fetched, h.page_id IS NOT NULL AS blocked, coalesce(h.entries, 0)::BIGINT AS entries,
  coalesce(h.lists, '') AS lists, CAST(h.since AS VARCHAR) AS since
FROM parsed p LEFT JOIN hits h USING (page_id)
"""
