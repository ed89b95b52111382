"""URL filters by a temporal list join, in DataFrame functions only.

Dated list entries (add or remove a pattern) become validity intervals. A capture is judged by
the entries active when it was fetched: an as-of join of its keys (the URL, its host and every parent
domain) with the intervals. Both sides carry a time slice: an interval is dealt to each
slice it overlaps and a capture to the one it was fetched in, so
a pattern's long history is not compared as a whole. Keys are counted first: a key of a slice that holds more than ``hot_rows`` captures
(or a thousandth of all keys) is one of at most a thousand, which are broadcast; if no entry names it, like most top-level domains,
it leaves before the join, and otherwise its captures are dealt over as many places as it takes, its intervals copied to each.

Defined cases: an interval includes its start and excludes its end; of entries of one pattern and time
a removal wins; repeated entries count once; a removal of what was not added does nothing; entries with a
NULL pattern or time are ignored; a NULL URL or fetch time matches nothing; rows that repeat a capture
are rows of their own. Capture columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import quoted, spare_name, staged

SLICE_DAYS = 14
#: Captures of one key and slice that one task joins.
HOT_ROWS = 100_000
_DAY = 86400


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a trailing dot; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+?)\.?(?:[:/?#]|$)", 1))


def plain_url(url: Column) -> Column:
    """The URL without scheme, query and fragment, its host in lower case."""
    host = host_of(url)
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(host != "", F.concat(host, rest))


def capture_keys(url: Column) -> Column:
    """(kind, pattern) structs that entries can name: the plain URL, the host, and the host with each of its parent domains."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
                          lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    return F.when(host != "", F.concat(
        F.array(F.struct(F.lit("url").alias("kind"), plain_url(url).alias("pattern")),
                F.struct(F.lit("host").alias("kind"), host.alias("pattern"))), domains))


def validity(entries: DataFrame) -> DataFrame:
    """``entries(list_name, kind, pattern, action, effective_at)`` -> disjoint ``(list_name, kind, pattern, valid_from, valid_to)``.

    ``valid_to`` is NULL for an entry still active.
    """
    key = ["list_name", "kind", "pattern"]
    clean = entries.where(F.col("pattern").isNotNull() & F.col("effective_at").isNotNull() & F.col("action").isin("add", "remove"))
    state = clean.groupBy(*key, "effective_at").agg(F.max((F.col("action") == "remove").cast("int")).alias("gone"))
    history = Window.partitionBy(*key).orderBy("effective_at")
    turn = state.withColumn("before", F.lag("gone", 1, 1).over(history)).where(F.col("before") != F.col("gone"))
    return (turn.withColumn("valid_to", F.lead("effective_at").over(history)).where("gone = 0")
            .select(*key, F.col("effective_at").alias("valid_from"), "valid_to"))


def _slice(t: Column, days: int) -> Column:
    return F.floor(F.unix_timestamp(t) / (days * _DAY)).cast("long")


def active_entries(captures: DataFrame, entries: DataFrame, row_col: str, url_col: str, time_col: str,
                   slice_days: int = SLICE_DAYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(row, list_name, kind, pattern, valid_from)`` of every entry active at a capture's fetch."""
    when = F.col("fetched")
    keyed = captures.select(quoted(row_col).alias("row"), quoted(time_col).cast("timestamp").alias("fetched"),
                            F.explode(capture_keys(quoted(url_col))).alias("k")).where(when.isNotNull())
    keyed = keyed.select("row", "fetched", "k.kind", "k.pattern", _slice(when, slice_days).alias("slice"))
    # Open intervals end with the last capture, so the slices of an interval are bounded by the span of the captures.
    span = captures.agg(F.min(quoted(time_col).cast("timestamp")).alias("lo"), F.max(quoted(time_col).cast("timestamp")).alias("hi")).first()
    if span["lo"] is None:
        return keyed.where(F.lit(False)).select("row", F.lit("").alias("list_name"), "kind", "pattern", F.col("fetched").alias("valid_from"))
    lo, hi = _slice(F.lit(span["lo"]), slice_days), _slice(F.lit(span["hi"]), slice_days)
    first = F.greatest(_slice(F.col("valid_from"), slice_days), lo)
    last = F.least(F.coalesce(_slice(F.col("valid_to"), slice_days), hi), hi)
    spans = staged(validity(entries).where(first <= last).withColumn("slice", F.explode(F.sequence(first, last))), "url-intervals")
    keyed, spans = _parted(keyed, spans, hot_rows)
    inside = (keyed["fetched"] >= spans["valid_from"]) & (spans["valid_to"].isNull() | (keyed["fetched"] < spans["valid_to"]))
    same = [keyed[c] == spans[c] for c in (*_KEY, "part")]
    return keyed.join(spans, same[0] & same[1] & same[2] & same[3] & inside).select(
        "row", "list_name", keyed["kind"], keyed["pattern"], "valid_from")


_KEY = ("kind", "pattern", "slice")


def _parted(keyed: DataFrame, spans: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the ``part`` of a frequent key that a row belongs to (0 for the others); frequent keys that no interval has are gone."""
    counts = keyed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n")).first()[0] or 0
    # at most a thousand keys, so broadcast
    listed = spans.select(*_KEY).distinct().withColumn("listed", F.lit(True))
    hot = staged(counts.where(F.col("n") > max(hot_rows, whole // 1000)).join(listed, list(_KEY), "left")
                 .select(*_KEY, F.when(F.col("listed"), F.ceil(F.col("n") / hot_rows).cast("int")).otherwise(0).alias("parts")), "url-hot-keys")
    hot = F.broadcast(hot)
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("row"), F.greatest(F.col("parts"), F.lit(1))).cast("int"))
    left = keyed.join(hot, list(_KEY), "left").where("parts IS NULL OR parts > 0").withColumn("part", part).drop("parts")
    places = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    right = spans.join(hot, list(_KEY), "left").withColumn("part", F.explode(places)).drop("parts")
    return left, right


def with_verdict(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at",
                 out_col: str = "url_filter", slice_days: int = SLICE_DAYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``captures`` with a struct (blocked, n_active, lists, listed_since)."""
    row = spare_name(captures, "_url_row")
    numbered = staged(captures.withColumn(row, F.monotonically_increasing_id()), "url-captures")
    hits = active_entries(numbered, entries, row, url_col, time_col, slice_days, hot_rows)
    found = hits.groupBy(F.col("row").alias(row)).agg(F.struct(
        F.lit(True).alias("blocked"), F.count(F.lit(1)).alias("n_active"),
        F.array_join(F.sort_array(F.collect_set("list_name")), ",").alias("lists"), F.min("valid_from").alias("listed_since")).alias(out_col))
    none = F.struct(F.lit(False).alias("blocked"), F.lit(0).cast("long").alias("n_active"), F.lit("").alias("lists"),
                    F.lit(None).cast("timestamp").alias("listed_since"))
    return numbered.join(found, row, "left").withColumn(out_col, F.coalesce(F.col(out_col), none)).drop(row)
