"""Operator 8: URL filters by a temporal list join. DataFrame functions only: no Python runs on rows.

List entries are dated (list, rule, action, listed_on). A rule is a domain (it covers its subdomains) or a domain with
the first path segment. The entries of one rule and day are reduced to the last one before anything is sorted, so a
rule with very many entries stays small; `lead` turns the rest into validity intervals [since, until). Captures are
reduced to distinct (host, segment, day), so a host with a third of all captures is a few rows a day; each asks its
candidate rules (host suffixes of two or more labels, with and without the segment) in an equi-join on the rule, as of
its day. An allow entry beats a block entry, a longer rule a shorter one. Verdicts go back by (host, segment, day).

Defined results: a null URL or one without a host, and a null fetch day, are `unlisted` with null rule; an entry acts
from its own day on; of several entries of one list, rule and day the one of greatest seq acts (of equal seq `remove`
wins); entries with a null part are ignored; repeated captures repeat; extra columns of captures stay, clashing ones
are replaced; empty tables give an empty result or `unlisted`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
SEGMENT = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([^/?#]+)"


def host_of(url: Column) -> Column:
    host = F.regexp_replace(F.lower(F.regexp_extract(url, AUTHORITY, 1)), r"\.+$", "")
    return F.when(host != "", host)


def segment_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SEGMENT, 1), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """list, rule, since, until (null: still valid) of the times in which an `add` entry acts."""
    whole = entries.dropna(subset=["list", "rule", "action", "listed_on"])
    last = whole.groupBy("list", F.lower("rule").alias("rule"), "listed_on").agg(F.max(F.struct("seq", "action")).alias("last"))
    ahead = F.lead("listed_on").over(W.partitionBy("list", "rule").orderBy("listed_on"))
    dated = last.select("list", "rule", F.col("listed_on").alias("since"), F.col("last.action").alias("action"), ahead.alias("until"))
    return dated.where("action = 'add'").drop("action")


def candidate_rules(host: Column, segment: Column) -> Column:
    """Suffixes of the host of two or more labels, each also with the segment."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    starts = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array(F.lit(1)))
    suffixes = F.transform(starts, lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.when(segment == "", suffixes).otherwise(F.concat(suffixes, F.transform(suffixes, lambda s: F.concat(s, F.lit("/"), segment))))


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "fetched_on") -> DataFrame:
    """captures with host, verdict (blocked, allowed, unlisted), rule (that decided) and listed_since."""
    made = ("host", "verdict", "rule", "listed_since")
    kept = [c for c in captures.columns if c not in made]
    url = F.col(f"`{url_col}`")
    placed = captures.select(*(F.col(f"`{c}`") for c in kept), host_of(url).alias("host"), segment_of(url).alias("__segment"), F.col(f"`{day_col}`").alias("__day"))
    units = placed.where("host is not null and __day is not null").select("host", "__segment", "__day").distinct()
    asked = units.withColumn("rule", F.explode(F.array_distinct(candidate_rules(F.col("host"), F.col("__segment")))))
    listed = asked.join(intervals(entries), "rule").where((F.col("__day") >= F.col("since")) & (F.col("until").isNull() | (F.col("__day") < F.col("until"))))
    best = F.max(F.struct((F.col("list") == "allow").alias("allow"), F.length("rule").alias("n"), "rule", "since")).alias("best")
    verdicts = listed.groupBy("host", "__segment", "__day").agg(best)
    joined = placed.join(verdicts, ["host", "__segment", "__day"], "left")
    verdict = F.when(F.col("best").isNull(), "unlisted").when(F.col("best.allow"), "allowed").otherwise("blocked")
    return joined.select(*(F.col(f"`{c}`") for c in kept), "host", verdict.alias("verdict"), F.col("best.rule").alias("rule"), F.col("best.since").alias("listed_since"))
