"""URL lists as of the day a page was fetched.

Dated entries (block, allow, remove) of one value become validity intervals: each day's state
holds until the value's next entry. Intervals are cut at the edges of BIN days, so that the
as-of join is an equality of value and bin with a range inside it. Hosts are judged once per
day, whatever number of pages they have; of all entries active at fetch time the most
specific decides: the url, then the host, then its parent domains from the longest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessaudit.llm.common import hinted

BIN = 32
START, DAYS = "2024-01-01", 730
KINDS = ("url", "host", "domain")
#: On one day the stronger entry of a value holds.
STRENGTH = {"block": 3, "allow": 2, "remove": 1}

_URL = r"^\s*([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case without port and closing dots; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)), F.lit("."))


def key_of(url: Column) -> Column:
    """The url as lists spell it: scheme and host in lower case, no user, no port, no fragment; empty without a host."""
    text = F.coalesce(url, F.lit(""))
    part = lambda n: F.regexp_extract(text, _URL, n)
    return F.when(host_of(url) == "", F.lit("")).otherwise(
        F.concat(F.lower(part(1)), F.lit("://"), host_of(url), F.rtrim(part(4), F.lit(" ")))
    )


def _day(column: str) -> Column:
    return F.datediff(F.col(column).cast("date"), F.lit("1970-01-01").cast("date"))


def intervals(entries: DataFrame) -> DataFrame:
    """kind, value, action, since and until (days since 1970, until excluded, null: open) of block and allow entries.

    Of the entries of a value on one day the strongest holds. `remove` ends what was before.
    """
    strength = F.create_map(*[x for name, n in STRENGTH.items() for x in (F.lit(name), F.lit(n))])
    known = entries.select(
        F.lower("kind").alias("kind"), F.lower(F.trim("value")).alias("lower"), F.col("value"), strength[F.lower("action")].alias("n"), _day("dated").alias("since")
    )
    value = F.when(F.col("kind") == "url", key_of(F.col("value"))).otherwise(F.rtrim(F.col("lower"), F.lit(".")))
    known = known.select("kind", value.alias("value"), "n", "since").where(F.col("kind").isin(*KINDS))
    known = known.where("value is not null and value <> '' and n is not null and since is not null")
    days = known.groupBy("kind", "value", "since").agg(F.max("n").alias("n"))  # a value has one row per day at most
    until = F.lead("since").over(Window.partitionBy("kind", "value").orderBy("since"))
    action = F.when(F.col("n") == STRENGTH["block"], "block").otherwise("allow")
    return days.withColumn("until", until).where("n > 1").select("kind", "value", action.alias("action"), "since", "until")


def _binned(spans: DataFrame, last: int) -> DataFrame:
    """Intervals once for every bin they touch, up to the day `last`."""
    end = F.least(F.coalesce(F.col("until") - 1, F.lit(last)), F.lit(last))
    bins = F.sequence(F.floor(F.col("since") / BIN), F.floor(end / BIN))
    return spans.where(F.col("since") <= end).withColumn("bin", F.explode(bins))


def _domains(host: Column) -> Column:
    """The host's suffixes, the longest first: itself to its last label."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per row of `captures` (page_id, url, fetched): page_id, url, fetched, list_kind, list_value, since, action, blocked.

    `entries` have kind (url, host, domain: itself and all below), value, action and dated.
    A domain of one label ("com", "localhost") holds for itself and all below like any other.
    Defined cases: a capture without a url, host or date, or without an active entry, has null
    list columns and is not blocked; entries of other kinds or actions, without a value or a date
    are not read; repeated entries count once. Other columns are not read. Captures on the
    very day of an entry are judged by it.
    """
    rows = captures.select("page_id", "url", F.col("fetched").cast("date").alias("fetched"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "key": key_of(F.col("url")), "day": _day("fetched")})
    rows = rows.withColumn("bin", F.floor(F.col("day") / BIN))
    last = rows.agg(F.max("day")).first()[0]
    spans = _binned(intervals(entries), -1 if last is None else last)
    inside = "span_since <= day and (span_until is null or day < span_until)"

    def of(*kinds: str) -> DataFrame:
        names = {"since": "span_since", "until": "span_until", "bin": "span_bin"}
        return spans.where(F.col("kind").isin(*kinds)).withColumnsRenamed(names)

    hosts = rows.where("host <> '' and day is not null").select("host", "day", "bin").distinct()
    levels = F.transform(_domains(F.col("host")), lambda v: F.struct(F.lit("domain").alias("kind"), v.alias("value")))
    levels = F.concat(F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("value"))), levels)
    asked = hosts.select("host", "day", "bin", F.posexplode(levels).alias("rank", "level"))
    asked = asked.select("host", "day", "bin", "rank", F.col("level.kind").alias("asked_kind"), F.col("level.value").alias("asked"))
    match = F.expr(f"asked_kind = kind and asked = value and bin = span_bin and {inside}")
    found = asked.join(hinted(of("host", "domain")), match)
    best = F.min_by(F.struct("kind", "value", "action", F.col("span_since").alias("since")), "rank")
    decided = found.groupBy("host", "day").agg(best.alias("by_host")).withColumnsRenamed({"host": "h", "day": "d"})

    urls = of("url").select(
        F.struct("kind", "value", "action", F.col("span_since").alias("since")).alias("by_url"), "value", "span_bin", "span_since", "span_until"
    )
    out = rows.join(hinted(decided), F.expr("host = h and day = d"), "left")
    out = out.join(hinted(urls), F.expr(f"key = value and bin = span_bin and {inside}"), "left")
    chosen = F.coalesce("by_url", "by_host")
    return out.select(
        "page_id",
        "url",
        "fetched",
        chosen["kind"].alias("list_kind"),
        chosen["value"].alias("list_value"),
        F.date_add(F.lit("1970-01-01").cast("date"), chosen["since"]).alias("since"),
        chosen["action"].alias("action"),
        F.coalesce(chosen["action"] == "block", F.lit(False)).alias("blocked"),
    )


def _drawn(salt: str, of: int) -> Column:
    """A number below `of` that depends on the page alone."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), F.col("page_id").cast("string"))), 1, 6)
    return F.conv(digits, 16, 10).cast("int") % of


def fetches(pages: DataFrame) -> DataFrame:
    """page_id, url and the day each page is taken to be fetched."""
    return pages.select("page_id", "url", F.date_add(F.lit(START).cast("date"), _drawn("fetched", DAYS)).alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A list that grows with the pages: every page puts its url, host or domain on it, or takes it off, on some day."""
    kind = F.element_at(F.array(*map(F.lit, KINDS)), _drawn("kind", 3) + 1)
    labels = F.split(host_of(F.col("url")), r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 2), 3), ".")
    value = F.when(kind == "url", F.col("url")).when(kind == "host", host_of(F.col("url"))).otherwise(domain)
    action = F.element_at(F.array(*map(F.lit, ("block", "block", "allow", "remove"))), _drawn("action", 4) + 1)
    dated = F.date_add(F.lit(START).cast("date"), _drawn("dated", DAYS))
    return pages.select(kind.alias("kind"), value.alias("value"), action.alias("action"), dated.alias("dated"))


SQL = r"""
with u as (
  select page_id, url,
    rtrim(lower(regexp_extract(coalesce(url, ''), '^\s*([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^#]*)', 2)), '.') as host,
    lower(regexp_extract(coalesce(url, ''), '^\s*([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^#]*)', 1)) as scheme,
    rtrim(regexp_extract(coalesce(url, ''), '^\s*([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^#]*)', 4), ' ') as path,
    ('0x' || substr(md5('fetched' || page_id), 1, 6))::int % 730 as f, ('0x' || substr(md5('dated' || page_id), 1, 6))::int % 730 as e,
    ('0x' || substr(md5('kind' || page_id), 1, 6))::int % 3 as k, ('0x' || substr(md5('action' || page_id), 1, 6))::int % 4 as a
  from pages),
p as (select *, case when host = '' then '' else scheme || '://' || host || path end as key, string_split(host, '.') as labels,
             row_number() over () as rid from u),
entry as (
  select ['url', 'host', 'domain'][k + 1] as kind,
         case k when 0 then key when 1 then host else array_to_string(labels[greatest(1, len(labels) - 2) :], '.') end as value,
         e as since, max([3, 3, 2, 1][a + 1]) as n
  from p group by all having value <> '' and since is not null),
span as (select *, lead(since) over (partition by kind, value order by since) as until from entry),
asked as (
  select rid, f, 'url' as kind, key as value, 0 as rank from p
  union all select rid, f, 'host', host, 1 from p
  union all select rid, f, 'domain', array_to_string(labels[i :], '.'), 1 + i
            from (select rid, f, labels, unnest(generate_series(1, len(labels))) as i from p)),
best as (
  select rid, min_by(span, rank) as s from asked join span
    on asked.kind = span.kind and asked.value = span.value and since <= f and (until is null or f < until) and n > 1
  group by rid)
select page_id, url, (date '2024-01-01' + f)::date as fetched, s.kind as list_kind, s.value as list_value,
       (date '2024-01-01' + s.since)::date as since, case s.n when 3 then 'block' when 2 then 'allow' end as action,
       coalesce(s.n = 3, false) as blocked
from p left join best using (rid)
"""
