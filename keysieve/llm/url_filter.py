"""URL allow/block rules as a sort-merge range join.

A canonical key writes the host backwards, label by label, so that "this host
and all its subdomains" and "this path and all below" become key prefixes, and
a prefix is the interval ``[prefix, prefix + FF)`` of the binary order (byte FF
never occurs in UTF-8). Intervals of prefixes nest or are disjoint, so a sweep
over keys and interval ends in sorted order keeps a stack of active rules: the
running sum of starts minus ends is the stack's height, and the top is the
latest start at that height. Both are window functions.

The sweep runs twice: over hosts, which finds the innermost rule host and with
it the chain of rule hosts around it; then, for every rule host of the chain,
over paths. Each sweep is split into independent ones by a hash of the row,
of at most about ``PER_SALT`` rows (the number follows the table), so a host with a third of all pages is spread over tasks; the rules
(not the pages) are repeated for each.

Defined results: a url that is null or has no ``://`` has an empty host and
path; a url without a fitting rule gets ``default`` and a null rule; of rules
with the same host and path, block wins; a rule's length is that of host plus
path, and of equal lengths the longer host wins; rules with a null part or an empty
host are no rules; repeated rows come back each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keysieve.llm.common import ascii_lower

#: Rows of one independent sweep, and the fewest sweeps.
PER_SALT, SALTS = 500_000, 64
END = b"\xff"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.org`` -> ``org.example.www.`` (empty stays empty)."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def path_key(host: Column, path: Column) -> Column:
    """Host key, a byte below all others, path."""
    return F.concat(host_key(host), F.lit("\x00"), path)


def sweep(rows: DataFrame, key: str, salt: str, intervals: DataFrame, salts: int) -> DataFrame:
    """``rows`` with ``top``: the ``name`` of the innermost interval whose
    ``prefix`` (distinct, binary) starts the row's binary ``key``, else null."""
    cols = rows.columns
    each = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt")
    marks = intervals.select(each, "prefix", "name").select(
        "__salt", "name", F.explode(F.array(
            F.struct(F.col("prefix").alias("k"), F.lit(1).alias("d")),
            F.struct(F.concat("prefix", F.lit(END)).alias("k"), F.lit(-1).alias("d")))).alias("m")).select(
        "__salt", F.col("m.k").alias("__key"), F.col("m.d").alias("__step"), "name",
        F.lit(None).cast(rows.select(F.struct(*cols).alias("r")).schema["r"].dataType).alias("__row"))
    probes = rows.select(
        F.pmod(F.col(salt), F.lit(salts)).cast("int").alias("__salt"), F.col(key).alias("__key"),
        F.lit(0).alias("__step"), F.lit(None).cast("string").alias("name"), F.struct(*cols).alias("__row"))
    # A start (1) comes before the rows with its key, hence the descending step.
    line = Window.partitionBy("__salt").orderBy("__key", F.desc("__step"))
    height = F.sum("__step").over(line.rowsBetween(Window.unboundedPreceding, 0))
    level = Window.partitionBy("__salt", "__height").orderBy("__key", F.desc("__step"))
    started = F.when(F.col("__step") == 1, F.col("name"))
    return (marks.unionByName(probes).withColumn("__height", height)
            .withColumn("top", F.last(started, ignorenulls=True).over(
                level.rowsBetween(Window.unboundedPreceding, 0)))
            .where(F.col("__row").isNotNull())
            .select("__row.*", F.when(F.col("__height") > 0, F.col("top")).alias("top")))


def rules_frame(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules as ``(verdict, host, path)`` rows."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def clean_rules(rules: DataFrame) -> DataFrame:
    return (rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").dropna().where("host <> ''")
            .groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("__block"))
            .select("host", "path", F.when(F.col("__block"), "block").otherwise("allow").alias("verdict")))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", salts: int | None = None, per_salt: int = PER_SALT) -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict``."""
    salts = salts or max(SALTS, math.ceil(pages.count() / per_salt))
    r = clean_rules(rules)
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.groupBy("page_id", "host", "path").agg(F.count(F.lit(1)).alias("__copies"))
    urls = urls.select("*", F.xxhash64("page_id", "path", "host").alias("__h"),
                       host_key(F.col("host")).cast("binary").alias("__hk"))

    # Rule hosts and, of each, the chain of rule hosts that it lies in (itself included):
    # those of its own label prefixes that are rule hosts.
    hosts = r.select("host").distinct().select("host", host_key(F.col("host")).alias("hk"))
    labels = F.split("hk", r"\.")
    inside = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.reverse(F.slice(labels, 1, i)), "."))).alias("outer"))
    known = r.select(F.col("host").alias("outer")).distinct()
    chain = (inside.join(known, "outer").groupBy("host")
             .agg(F.array_join(F.sort_array(F.collect_set("outer")), "\x00").alias("chain")))
    intervals = hosts.join(chain, "host").select(F.col("hk").cast("binary").alias("prefix"),
                                                 F.col("chain").alias("name"))
    placed = sweep(urls, "__hk", "__h", intervals, salts)

    asked = placed.select("*", F.explode_outer(F.split("top", "\x00")).alias("__rule_host")).drop("top")
    asked = asked.withColumn("__pk", F.when(F.col("__rule_host").isNotNull(), path_key(
        F.col("__rule_host"), F.col("path"))).otherwise(F.lit("")).cast("binary"))
    ranked = r.select(path_key(F.col("host"), F.col("path")).cast("binary").alias("prefix"),
                      F.concat_ws("\x00", "verdict", "host", "path").alias("name"))
    found = sweep(asked, "__pk", "__h", ranked, salts)
    part = F.split("top", "\x00")
    fits = found.select("page_id", "host", "path", "__copies", F.when(
        F.col("top").isNotNull(), F.struct(
            F.length(F.concat(part[1], part[2])).alias("n"), F.length(part[1]).alias("n_host"),
            F.concat(part[1], part[2]).alias("rule"), part[0].alias("verdict"))).alias("fit"))
    best = fits.groupBy("page_id", "host", "path", "__copies").agg(F.max("fit").alias("fit"))
    return best.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__copy")).drop("__copy")
