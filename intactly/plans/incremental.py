"""Incremental ingest query (J1, J2): q70.

Lineitem arrives as two waves of files in a landing folder; the stream is
run after each wave and once more with nothing new. The committed zone must
then hold every accepted row exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions.rules import Rule
from intactly.plans.ingest import LINE_STATUSES, RETURN_FLAGS, SPLIT_AT
from intactly.session import scratch_path
from intactly.sources.tables import month_of, read_table
from intactly.streaming import incremental, pairing
from intactly.operators import zone
from intactly.operators.ordered import staged


def line_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("quantity_range", c("l_quantity").between(1, 50)),
        Rule("discount_range", c("l_discount").between(0, 0.1)),
        Rule("tax_range", c("l_tax").between(0, 0.08)),
        Rule("returnflag_domain", c("l_returnflag").isin(*RETURN_FLAGS)),
        Rule("linestatus_domain", c("l_linestatus").isin(*LINE_STATUSES)),
        Rule("price_positive", c("l_extendedprice") > 0),
    ]


def q70_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    base = scratch_path(spark, "q70")
    landing, checkpoint = f"{base}/landing", f"{base}/checkpoint"
    zone_root, rejects_root = f"{base}/zone", f"{base}/rejects"
    split = F.col("l_shipdate") < F.lit(SPLIT_AT).cast("timestamp_ntz")

    def run() -> int:
        return incremental.ingest_available(
            spark, landing, li.schema, checkpoint, zone_root, rejects_root, line_rules(),
            lambda df: df.withColumn("month", month_of("l_shipdate")))

    li.where(split).write.mode("append").parquet(landing)
    run()
    li.where(~F.coalesce(split, F.lit(False))).write.mode("append").parquet(landing)
    run()
    if run() != 0:
        raise RuntimeError("a run with no new files must not deliver a batch")
    return (zone.read_all_committed(spark, zone_root)
            .groupBy("month").agg(F.count(F.lit(1)).alias("rows")))


# Arrival times of q71 (documents within ten minutes of the start, sidecars a little before or after them,
# late ones hours later, a heartbeat a day later) and which sidecars record another digest.
START, LATE_EVERY, OTHER_EVERY = "2026-05-01 00:00:00", 5, 7


def q71_stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their labels as data files and sidecars, landing in either order.

    Even documents land before their sidecars, odd ones after. Sidecars that
    are hours late, and documents without one, stay alone. Equal texts under
    several names are ingested once.
    """
    # Texts are read and hashed once; every landing below takes its rows from the digests.
    docs = staged(read_table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256")), "digests")
    labels = read_table(spark, sf_dir, "labels").select("doc_id").distinct().join(docs, "doc_id", "left")
    key = F.format_string("%09d", "doc_id").alias("key")
    at = F.lit(START).cast("timestamp") + F.make_dt_interval(secs=F.pmod("doc_id", F.lit(600)))
    delay = F.when(F.pmod("doc_id", F.lit(LATE_EVERY)) == 0, 180).when(F.pmod("doc_id", F.lit(2)) == 0, 10).otherwise(-10)
    other = F.pmod("doc_id", F.lit(OTHER_EVERY)) == 0
    data = docs.select("doc_id", key, "sha256", at.alias("arrived_at"))
    sides = labels.select("doc_id", key, F.when(other, F.sha2(F.col("sha256"), 256)).otherwise(F.col("sha256"))
                          .alias("rec_sha256"), (at + F.make_dt_interval(mins=delay)).alias("arrived_at"))
    base = scratch_path(spark, "q71")
    even = F.pmod("doc_id", F.lit(2)) == 0
    beat = spark.range(1).select(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("digest"),
                                 (F.lit(START).cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("arrived_at"))
    for first, second in ((data.where(even), sides.where(~even)), (data.where(~even), sides.where(even)), (beat, beat)):
        first.drop("doc_id").withColumnRenamed("digest", "sha256").write.mode("append").parquet(f"{base}/data")
        second.drop("doc_id").withColumnRenamed("digest", "rec_sha256").write.mode("append").parquet(f"{base}/sidecars")
        pairing.pair_available(spark, f"{base}/data", f"{base}/sidecars", f"{base}/out", f"{base}/checkpoint")
    return pairing.verdicts(spark, f"{base}/out").select("key", "status")


QUERIES = {"q70_incremental": q70_incremental, "q71_stream_pairs": q71_stream_pairs}

SQL = {
    "q70_incremental": """
SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS rows FROM lineitem
WHERE coalesce(l_quantity BETWEEN 1 AND 50, false) AND coalesce(l_discount BETWEEN 0 AND 0.1, false)
  AND coalesce(l_tax BETWEEN 0 AND 0.08, false) AND coalesce(l_returnflag IN ('A', 'N', 'R'), false)
  AND coalesce(l_linestatus IN ('O', 'F'), false) AND coalesce(l_extendedprice > 0, false)
GROUP BY 1""",
}

SQL["q71_stream_pairs"] = f"""
WITH d AS (SELECT doc_id, sha256(text) AS sha FROM documents),
p AS (SELECT d.doc_id, sha, l.doc_id IS NOT NULL AS labelled, l.doc_id % {LATE_EVERY} = 0 AS late,
             l.doc_id % {OTHER_EVERY} = 0 AS other
      FROM d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)),
f AS (SELECT sha, min(doc_id) AS first FROM p WHERE labelled AND NOT late AND NOT other GROUP BY sha)
SELECT printf('%09d', doc_id) AS key,
       CASE WHEN NOT labelled OR late THEN 'data_only' WHEN other THEN 'digest_mismatch'
            WHEN doc_id = first THEN 'ingested' ELSE 'duplicate' END AS status
FROM p LEFT JOIN f USING (sha)
UNION ALL SELECT printf('%09d', doc_id), 'sidecar_only' FROM p WHERE late
UNION ALL SELECT DISTINCT printf('%09d', doc_id), 'sidecar_only' FROM labels ANTI JOIN documents USING (doc_id)"""
