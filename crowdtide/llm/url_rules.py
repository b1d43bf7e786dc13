"""URLs judged by rules on hosts and paths, looked up by hash prefix.

Each distinct (host, path) is expanded into every host suffix and every path prefix that ends in ``/``,
as deep as some rule goes. An expansion meets the rules on the first ``PREFIX`` hex digits of its digest;
then the full digest, and the rest of the rule's path, are confirmed, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 8
RULE = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?`` or ``#``, with A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _stem(path: Column) -> Column:
    """A rule's path up to and with its last ``/``; the rest is compared afterwards."""
    return F.regexp_extract(path, r"(?s)\A(.*/)?", 1)


def _digest(host: Column, stem: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), stem), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", url: str = "url") -> DataFrame:
    """The rows of ``pages``, all their columns as they are, with a struct ``judged`` of (host, path, rule, verdict).

    A column of ``pages`` that is called ``judged``, in any case, is replaced; no other name matters.

    A rule fits its host and all subdomains, where the path starts with the rule's. The longest rule wins,
    counting host and path; of equal ones that with the longer host, then a block before an allow. Without
    a fitting rule, and for a url that is null or has no ``://``, ``rule`` is null and the verdict is
    ``otherwise``. Rules with a null host or path are left out; repeated rules count once. Empty tables are
    fine on either side, and a page that repeats is judged each time.
    """
    rules = rules.where("host is not null and path is not null").select("host", "path", "verdict").distinct()
    keyed = rules.select("host", "path", "verdict", _digest(F.col("host"), _stem(F.col("path"))).alias("digest"))
    keyed = keyed.withColumn("prefix", F.substring("digest", 1, PREFIX))
    # Two numbers: no expansion goes deeper than the deepest rule.
    labels, steps = rules.agg(
        F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0)), F.coalesce(F.max(F.length(F.regexp_replace("path", "[^/]", ""))), F.lit(0))
    ).first()

    # The caller's columns lie in one struct, so that none of their names meets one of these.
    own = [F.col(f"`{c.replace('`', '``')}`") for c in pages.columns if c.lower() != "judged"]
    parsed = pages.select(F.struct(*own).alias("page"), F.struct(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).alias("judged"))
    distinct = parsed.select("judged.host", "judged.path").distinct()
    names = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.least(F.size(names), F.lit(labels))), lambda n: F.array_join(F.slice(names, F.size(names) - n + 1, n), "."))
    pieces = F.split("path", "/")
    stem = F.transform(
        F.sequence(F.lit(0), F.least(F.size(pieces) - 1, F.lit(steps))),
        lambda n: F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(pieces, 1, n), "/"), F.lit("/"))),
    )
    if not labels:
        suffix = F.array().cast("array<string>")
    expanded = distinct.withColumn("s", F.explode(suffix)).withColumn("t", F.explode(stem)).withColumn("full", _digest(F.col("s"), F.col("t")))
    expanded = expanded.select(F.col("host").alias("h"), F.col("path").alias("p"), "full", F.substring("full", 1, PREFIX).alias("prefix"))
    hit = expanded.join(keyed, "prefix").where((F.col("full") == F.col("digest")) & F.startswith("p", "path"))
    length = F.length("host") + F.length("path")
    ranked = F.struct(length.alias("n"), F.length("host").alias("m"), (F.col("verdict") == "block").alias("b"), F.concat("host", "path").alias("rule"), "verdict")
    best = hit.groupBy("h", "p").agg(F.max(ranked).alias("best"))
    judged = parsed.join(best, (parsed["judged.host"] == best["h"]) & (parsed["judged.path"] == best["p"]), "left")
    full = F.struct("judged.host", "judged.path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
    return judged.select("page.*", full.alias("judged"))
