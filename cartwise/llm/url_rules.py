"""URL filters: pattern rules indexed by their rarest literal token.

A rule (host, path, verdict) fits its host and all subdomains if the url's path starts with the rule's. Its literal
tokens are the labels of its host and the whole segments of its path. Tokens are counted over all distinct
(host, path) of the pages, and a rule is posted under its rarest one; a rule without a token is posted under one that
every url has. The tokens of a url fetch the rules posted under them, and only those rules run their regular
expressions. The longest fitting rule decides.

Equal (host, path) are judged once and joined back to the pages, where AQE splits a frequent url. The index
is broadcast only within a counted bound; beyond it tokens join it by shuffle.

Defined results: a null url, or one without ``://``, has an empty host and path. Of fitting rules of one length, block
wins, then the larger rule text. A rule's null host or path is an empty one, and its host has no case; a rule with a null verdict is left out.
Repeated pages each come back. Columns named like the results are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import ascii_lower, broadcast_if_small, quoted, without, written

RESULTS = ("host", "path", "rule", "verdict")
EVERY = "*"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _literal(text: Column) -> Column:
    """``text`` as a literal of a regular expression."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _tokens(host: Column, segments: Column) -> Column:
    labels = F.transform(F.split(host, r"\.", -1), lambda x: F.concat(F.lit("host "), x))
    return F.array_distinct(F.concat(labels, F.transform(segments, lambda x: F.concat(F.lit("path "), x))))


def _url_tokens(host: Column, path: Column) -> Column:
    return F.concat(_tokens(host, F.split(path, "/", -1)), F.array(F.lit(EVERY)))


def _rule_rows(rules: DataFrame) -> DataFrame:
    """Rules with their text, regular expressions of host and path, and literal tokens."""
    given, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    host = ascii_lower(given)  # as that of a url
    pieces = F.split(path, "/", -1)
    rows = rules.where(F.col("verdict").isNotNull()).select(
        F.concat(given, path).alias("rule"), "verdict",
        F.struct(
            F.concat(F.lit(r"(?s)^(?:.*\.)?"), _literal(host), F.lit(r"\z")).alias("host"),
            F.concat(F.lit("^"), _literal(path)).alias("path"),
        ).alias("patterns"),
        # What follows the last slash may be the beginning of a longer segment, and is no token.
        F.when(host == "", F.array().cast("array<string>"))
        .otherwise(_tokens(host, F.slice(pieces, F.lit(1), F.size(pieces) - 1))).alias("tokens"),
    ).distinct()
    return rows.withColumn(
        "tokens", F.when(F.size("tokens") == 0, F.array(F.lit(EVERY))).otherwise(F.col("tokens"))
    )


def rule_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """The rules, each under its rarest token among ``urls`` (distinct host, path)."""
    rows = _rule_rows(rules).select("rule", "verdict", "patterns", F.explode("tokens").alias("token"))
    wanted = broadcast_if_small(written(rows.select("token").distinct(), "rule_tokens"))
    counts = (
        urls.select(F.explode(_url_tokens(F.col("host"), F.col("path"))).alias("token"))
        .join(wanted, "token").groupBy("token").agg(F.count("*").alias("found"))
    )
    return rows.join(counts, "token", "left").groupBy("rule", "verdict", "patterns").agg(
        F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "token"))["token"].alias("token")
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (with ``url``) with host, path, the deciding rule or null, and the verdict."""
    pages = pages.select(
        *(quoted(c) for c in without(pages, *RESULTS)),
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
    )
    urls = pages.select("host", "path").distinct()
    index = broadcast_if_small(written(rule_index(rules, urls), "rule_index"))
    fetched = urls.withColumn("token", F.explode(_url_tokens(F.col("host"), F.col("path")))).join(index, "token")
    fitting = fetched.where(F.rlike("host", F.col("patterns.host")) & F.rlike("path", F.col("patterns.path")))
    judged = fitting.groupBy("host", "path").agg(
        F.max(F.struct(F.char_length("rule").alias("chars"), "verdict", "rule")).alias("best")
    )
    return pages.join(judged, ["host", "path"], "left").select(
        *(quoted(c) for c in without(pages, *RESULTS)), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
