"""URL filters as a sort-merge range join, in DataFrame operations only.

A host's canonical key is its labels in reverse, each followed by a dot: ``a.example.net`` becomes ``net.example.a.``.
A rule for a host and all subdomains is then the interval of keys that start with its own key, and such intervals nest
or are apart. A sweep over rule starts and urls in key order keeps the stack of the last rule that began: itself and the
rules that enclose it. What of that stack has not ended at a url's key is exactly what fits its host; of these, rules
whose path starts the url's path fit the url, and the longest rule (host plus path; then the longer host) decides.

Urls are dealt evenly into buckets, whatever their hosts, and each bucket sweeps all rules; a hot host or a repeated url
therefore cannot gather in one task. Null urls and urls without ``://`` have an empty host and path and get the default
verdict, as do hosts that no rule fits. Rules with a null or empty host take no part. Of rules with the same host and
path one decides: block before allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"
# The rules of the registered query (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def stacks(rules: DataFrame) -> DataFrame:
    """For each rule host its key and the stack there: rules of this host and of those that enclose it, longest first."""
    named = rules.where("length(host) > 0").select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rule = F.struct(
        (-F.length(F.concat("host", "path"))).alias("order"), (-F.length("host")).alias("host_order"),
        F.when(F.col("verdict") == "block", 0).otherwise(1).alias("blocks_first"), "host", "path", "verdict",
        # A dot is the last character of a key, and a slash is the next after a dot.
        F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/")).alias("until"))
    frames = named.withColumn("key", key_of(F.col("host"))).select(F.col("host").alias("outer"), rule.alias("rule"))
    labels = F.split("host", r"\.")
    within = named.select("host").distinct().select(
        "host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
            F.slice(labels, i, F.size(labels)), "."))).alias("outer"))
    return (within.join(frames, "outer").groupBy("host").agg(F.array_sort(F.collect_list("rule")).alias("stack"))
            .select(key_of(F.col("host")).alias("key"), "stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, buckets: int | None = None) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every row of ``pages``."""
    spark = pages.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = stacks(rules)
    urls = (pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
            .select(F.pmod(F.monotonically_increasing_id(), F.lit(buckets)).cast("int").alias("bucket"),
                    key_of(F.col("host")).alias("key"), F.lit(1).alias("kind"), "*"))
    events = (starts.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "key",
                            F.lit(0).alias("kind"), "stack")
              .unionByName(urls, allowMissingColumns=True))
    sweep = Window.partitionBy("bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    active = F.filter("began", lambda r: (F.col("key") < r["until"]) & F.col("path").startswith(r["path"]))
    return (events.withColumn("began", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
            .withColumn("rule", F.get(active, F.lit(0)))
            .select("page_id", "url", "host", "path", F.concat("rule.host", "rule.path").alias("rule"),
                    F.coalesce("rule.verdict", F.lit(default)).alias("verdict")))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    listed = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
                       for h, p, v in rules])
    return spark.range(1).select(F.inline(listed))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def _sql(rules=RULES, default: str = DEFAULT) -> str:
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v)
            for h, p, v in longest]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    return f"""
WITH u AS (SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE '{default}' END AS verdict FROM u"""


QUERIES = {"op3_url_filters": op3_url_filters}
SQL = {"op3_url_filters": _sql()}
