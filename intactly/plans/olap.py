"""Warehouse and indicator queries (M4 branch 2, M5): q40–q42, q44–q49.

Customer nation plays the pick-up zone, supplier nation the drop-off zone:
the same ``nation`` dimension joined twice under two roles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.operators import olap, warehouse
from intactly.operators.ordered import staged
from intactly.plans.ingest import revenue
from intactly.session import scratch_path
from intactly.sources.tables import month_of, read_table, trips

# Size of the top-k report.
TOP_K = 5


def _geo(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    return warehouse.geography(read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))


def enriched_trips(spark: SparkSession, sf_dir: str, roles: tuple[str, ...] = ("cust", "supp")) -> DataFrame:
    """Trips with the geography of the wanted roles (role-playing lookups, D6/D7); other lookups are not joined."""
    geo, small = _geo(spark, sf_dir)
    hint = F.broadcast if small else (lambda d: d)
    t = trips(spark, sf_dir) if "cust" in roles else _lines(spark, sf_dir)
    for name, table, fact_key in (("cust", "customer", "o_custkey"), ("supp", "supplier", "l_suppkey")):
        if name in roles:
            c = name[0]
            member = read_table(spark, sf_dir, table).select(f"{c}_{name}key", f"{c}_nationkey")
            t = (t.join(member, F.col(fact_key) == F.col(f"{c}_{name}key"), "left")
                 .join(hint(warehouse.role(geo, name)), F.col(f"{c}_nationkey") == F.col(f"{name}_n_nationkey"), "left"))
    return t.withColumn("revenue", revenue())


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips without their orders: an order's key is unique, so it neither adds nor drops a line."""
    return read_table(spark, sf_dir, "lineitem").withColumn("month", month_of("l_shipdate"))


def q40_zone_roleplay(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = enriched_trips(spark, sf_dir)
    return (t.groupBy(F.col("cust_n_name").alias("cust_nation"), F.col("supp_n_name").alias("supp_nation"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum("revenue").cast("decimal(38,4)").alias("revenue")))


def q41_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return warehouse.date_dimension(li.select(F.col("l_shipdate").alias("d")))


def q42_fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = enriched_trips(spark, sf_dir)
    # Dimensions come from narrow scans of the base tables, not from the joined facts.
    li = read_table(spark, sf_dir, "lineitem")
    dates = warehouse.date_dimension(li.select(F.col("l_shipdate").alias("d"))).select("date_key", "date_sk")
    geo = warehouse.surrogate(read_table(spark, sf_dir, "nation"), ["n_nationkey"], "nation_sk")
    flags = warehouse.surrogate(li, ["l_returnflag", "l_linestatus"], "flag_sk")
    fact = t.withColumn("date_key", F.date_format("l_shipdate", "yyyyMMdd").cast("int"))
    fact = warehouse.lookup(fact, dates, "date_key", "date_sk")
    fact = warehouse.lookup(fact, geo.select(F.col("n_nationkey").alias("c_nationkey"),
                                             F.col("nation_sk").alias("cust_nation_sk")),
                            "c_nationkey", "cust_nation_sk", warehouse.NATION_BOUND)
    fact = warehouse.lookup(fact, geo.select(F.col("n_nationkey").alias("s_nationkey"),
                                             F.col("nation_sk").alias("supp_nation_sk")),
                            "s_nationkey", "supp_nation_sk", warehouse.NATION_BOUND)
    fact = warehouse.lookup(fact, flags, ["l_returnflag", "l_linestatus"], "flag_sk")
    return fact.select("l_orderkey", "l_linenumber", "date_sk", "cust_nation_sk", "supp_nation_sk",
                       "flag_sk", "revenue")


# Fixed value: days of the month that are missing from q43's first load.
LATE_DAYS = 7


def q43_stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date keys after a load without every 7th day of a month, and after a second load of all days."""
    days = read_table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    path = scratch_path(spark, "q43-date-keys")
    early = days.where(F.coalesce(F.dayofmonth("d") % LATE_DAYS != 0, F.lit(False)))
    first = staged(warehouse.assign_keys(early, ["d"], path, "date_sk"), "q43-first")
    second = warehouse.assign_keys(days, ["d"], path, "date_sk")
    return (second.join(first.select("d", F.col("date_sk").alias("first_sk")), "d", "left")
            .select(F.date_format("d", "yyyy-MM-dd").alias("date"), "first_sk", "date_sk"))


def q44_month_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _lines(spark, sf_dir).withColumn("revenue", revenue())
    return (t.rollup("month")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("decimal(38,4)").alias("revenue"),
                 F.grouping("month").alias("is_total"))
            .select(F.when(F.col("is_total") == 1, F.lit("TOTAL")).otherwise(F.col("month")).alias("month"),
                    "rows", "revenue"))


def _cube_measures():
    return [F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("decimal(38,4)").alias("revenue")]


def q45_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = enriched_trips(spark, sf_dir, ("cust",)).withColumnRenamed("cust_r_name", "region")
    return t.cube("region", "l_returnflag").agg(*_cube_measures(), *[
        F.grouping(c).alias(f"g_{c}") for c in ("region", "l_returnflag")]).select(
        *[F.when(F.col(f"g_{c}") == 1, F.lit(olap.ALL)).otherwise(F.col(c)).alias(c)
          for c in ("region", "l_returnflag")], "rows", "revenue")


def q46_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = enriched_trips(spark, sf_dir, ("cust",)).withColumnRenamed("cust_r_name", "region")
    dims = ("region", "l_linestatus", "l_returnflag")
    sets = [[F.col("region"), F.col("l_linestatus")], [F.col("l_returnflag")], []]
    out = t.groupingSets(sets, *dims).agg(*_cube_measures(), *[F.grouping(c).alias(f"g_{c}") for c in dims])
    return out.select(*[F.when(F.col(f"g_{c}") == 1, F.lit(olap.ALL)).otherwise(F.col(c)).alias(c)
                        for c in dims], "rows", "revenue")


def q47_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Summed by supplier first: suppliers meet their nations with one row each.
    by_supplier = _lines(spark, sf_dir).groupBy("l_suppkey").agg(F.sum(revenue()).cast("decimal(38,4)").alias("r"))
    suppliers = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    per = (by_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
           .join(warehouse.checked_broadcast(nations, warehouse.NATION_BOUND),
                 F.col("s_nationkey") == F.col("n_nationkey"), "left")
           .groupBy("nation").agg(F.sum("r").cast("decimal(38,4)").alias("revenue")))
    return olap.top_k(per, [F.col("revenue").desc(), F.col("nation").asc()], TOP_K)


def q48_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = enriched_trips(spark, sf_dir, ("cust",))
    per = t.groupBy("month", F.col("cust_n_name").alias("nation")).agg(
        F.sum("revenue").cast("decimal(38,4)").alias("revenue"))
    return olap.rank_within(per, "month", [F.col("revenue").desc()])


def q49_share_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = enriched_trips(spark, sf_dir, ("cust",))
    per = t.groupBy("month", F.col("cust_r_name").alias("region")).agg(
        F.sum("revenue").cast("decimal(38,4)").alias("revenue"))
    return olap.share_trend(per, "month", "region", "revenue", 4)


QUERIES = {
    "q40_zone_roleplay": q40_zone_roleplay,
    "q41_dim_date": q41_dim_date,
    "q42_fact_build": q42_fact_build,
    "q43_stable_keys": q43_stable_keys,
    "q44_month_totals": q44_month_totals,
    "q45_cube": q45_cube,
    "q46_grouping_sets": q46_grouping_sets,
    "q47_topk": q47_topk,
    "q48_rank": q48_rank,
    "q49_share_trend": q49_share_trend,
}

_REV = ("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) "
        "AS DECIMAL(18,4))")
_GEO = ("(SELECT n_nationkey, n_name, coalesce(r_name, 'UNKNOWN') AS r_name FROM nation "
        "LEFT JOIN region ON n_regionkey = r_regionkey)")
ENRICHED_SQL = f"""(
  SELECT l.*, o.*, strftime(l.l_shipdate, '%Y-%m') AS month, {_REV} AS revenue,
         c.c_nationkey, s.s_nationkey, cg.n_name AS cust_n_name, cg.r_name AS cust_r_name,
         sg.n_name AS supp_n_name, sg.r_name AS supp_r_name
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN {_GEO} cg ON c.c_nationkey = cg.n_nationkey
  LEFT JOIN {_GEO} sg ON s.s_nationkey = sg.n_nationkey)"""

SQL = {
    "q40_zone_roleplay": f"""
SELECT cust_n_name AS cust_nation, supp_n_name AS supp_nation, count(*) AS rows,
       CAST(sum(revenue) AS DECIMAL(38,4)) AS revenue
FROM {ENRICHED_SQL} t GROUP BY 1, 2""",
    "q41_dim_date": """
WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)
SELECT CAST(dense_rank() OVER (ORDER BY date) AS INTEGER) AS date_sk,
       CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, strftime(date, '%Y-%m-%d') AS date,
       CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
       CAST(isodow(date) AS INTEGER) AS iso_dow, isodow(date) >= 6 AS is_weekend
FROM d""",
    "q42_fact_build": f"""
WITH t AS {ENRICHED_SQL},
dates AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
                 CAST(dense_rank() OVER (ORDER BY d) AS INTEGER) AS date_sk
          FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)),
geo AS (SELECT n_nationkey, CAST(dense_rank() OVER (ORDER BY n_nationkey) AS INTEGER) AS nation_sk FROM nation),
flags AS (SELECT l_returnflag, l_linestatus,
                 CAST(dense_rank() OVER (ORDER BY l_returnflag, l_linestatus) AS INTEGER) AS flag_sk
          FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem))
SELECT t.l_orderkey, t.l_linenumber, coalesce(dates.date_sk, -1) AS date_sk,
       coalesce(cg.nation_sk, -1) AS cust_nation_sk, coalesce(sg.nation_sk, -1) AS supp_nation_sk,
       coalesce(flags.flag_sk, -1) AS flag_sk, t.revenue
FROM t
LEFT JOIN dates ON dates.date_key = CAST(strftime(t.l_shipdate, '%Y%m%d') AS INTEGER)
LEFT JOIN geo cg ON cg.n_nationkey = t.c_nationkey
LEFT JOIN geo sg ON sg.n_nationkey = t.s_nationkey
LEFT JOIN flags ON flags.l_returnflag = t.l_returnflag AND flags.l_linestatus = t.l_linestatus""",
    "q44_month_totals": f"""
SELECT CASE WHEN GROUPING(month) = 1 THEN 'TOTAL' ELSE month END AS month, count(*) AS rows,
       CAST(sum({_REV}) AS DECIMAL(38,4)) AS revenue
FROM (SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey) t
GROUP BY ROLLUP (month)""",
    "q45_cube": f"""
SELECT CASE WHEN GROUPING(cust_r_name) = 1 THEN 'ALL' ELSE cust_r_name END AS region,
       CASE WHEN GROUPING(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS l_returnflag,
       count(*) AS rows, CAST(sum(revenue) AS DECIMAL(38,4)) AS revenue
FROM {ENRICHED_SQL} t GROUP BY CUBE (cust_r_name, l_returnflag)""",
    "q46_grouping_sets": f"""
SELECT CASE WHEN GROUPING(cust_r_name) = 1 THEN 'ALL' ELSE cust_r_name END AS region,
       CASE WHEN GROUPING(l_linestatus) = 1 THEN 'ALL' ELSE l_linestatus END AS l_linestatus,
       CASE WHEN GROUPING(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS l_returnflag,
       count(*) AS rows, CAST(sum(revenue) AS DECIMAL(38,4)) AS revenue
FROM {ENRICHED_SQL} t GROUP BY GROUPING SETS ((cust_r_name, l_linestatus), (l_returnflag), ())""",
    "q47_topk": f"""
SELECT supp_n_name AS nation, CAST(sum(revenue) AS DECIMAL(38,4)) AS revenue
FROM {ENRICHED_SQL} t GROUP BY 1 ORDER BY revenue DESC, nation ASC LIMIT {TOP_K}""",
    "q48_rank": f"""
WITH p AS (SELECT month, cust_n_name AS nation, CAST(sum(revenue) AS DECIMAL(38,4)) AS revenue
           FROM {ENRICHED_SQL} t GROUP BY 1, 2)
SELECT month, nation, revenue, CAST(dense_rank() OVER (PARTITION BY month ORDER BY revenue DESC) AS INTEGER) AS rank
FROM p""",
    "q49_share_trend": f"""
WITH p AS (SELECT month, cust_r_name AS region, CAST(sum(revenue) AS DECIMAL(38,4)) AS revenue
           FROM {ENRICHED_SQL} t GROUP BY 1, 2),
u AS (SELECT *, CAST(revenue * 10000 AS HUGEINT) AS units FROM p)
SELECT month, region, revenue,
       CAST((units * 1000000) // sum(units) OVER (PARTITION BY month) AS BIGINT) AS share_ppm,
       lag(revenue) OVER (PARTITION BY region ORDER BY month) AS prev_revenue,
       CAST(sum(units) OVER w // count(*) OVER w AS BIGINT) AS ma3_units
FROM u WINDOW w AS (PARTITION BY region ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
}

SQL["q43_stable_keys"] = f"""
WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
e AS (SELECT d, row_number() OVER (ORDER BY d) AS sk FROM d WHERE day(d) % {LATE_DAYS} <> 0),
l AS (SELECT d, (SELECT count(*) FROM e) + row_number() OVER (ORDER BY d NULLS FIRST) AS sk
      FROM d WHERE coalesce(day(d) % {LATE_DAYS} = 0, true))
SELECT strftime(d, '%Y-%m-%d') AS date, sk AS first_sk, sk AS date_sk FROM e
UNION ALL SELECT strftime(d, '%Y-%m-%d'), NULL, sk FROM l"""
