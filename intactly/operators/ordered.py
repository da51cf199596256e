"""Global order without a global window: range partitions, local positions, carried offsets.

``repartitionByRange`` deals rows by sampled ranges of the order columns and
sorts each range in its own task. The sorted rows are written to the shared
folder together with their partition and place, because sampling a second
time may cut elsewhere. What crosses partitions is then one row per
partition (its count), never the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intactly.session import scratch_path

PART, AT = "_part", "_at"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps restart from the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def range_sorted(df: DataFrame, order: Sequence[Column], keep: Sequence[Column | str] = ("*",),
                 partitions: int | None = None) -> DataFrame:
    """``keep`` of ``df`` with ``_part`` (range partition) and ``_at`` (1-based place in it), in ``order``.

    Rows that tie in ``order`` are dealt by an arbitrary row number, so a run
    of equal rows never has to fit into one task.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col("_range_tie")]
    dealt = (df.withColumn("_range_tie", F.monotonically_increasing_id())
             .repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_range_tie"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return staged(dealt.select(*keep, F.spark_partition_id().alias(PART), place.alias(AT)), "ranges")


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position",
             keep: Sequence[Column | str] = ("*",), partitions: int | None = None) -> DataFrame:
    """``keep`` of ``df`` with a dense 1-based ``name`` over all rows in ``order``.

    The counts per partition (one row each) are summed up on the driver and
    joined back by broadcast; their number is the number of partitions.
    """
    rows = range_sorted(df, order, keep, partitions)
    counts = sorted((r[PART], r["n"]) for r in rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect())
    before = [0, *accumulate(n for _, n in counts)]
    offsets = df.sparkSession.createDataFrame(
        [(part, before[i]) for i, (part, _) in enumerate(counts)], f"{PART} int, _before long")
    return (rows.join(F.broadcast(offsets), PART)
            .withColumn(name, F.col("_before") + F.col(AT)).drop(PART, AT, "_before"))


def sequenced(df: DataFrame, key: str, order: Sequence[str], flag: Column | None = None,
              lead_of: str | None = None, partitions: int | None = None) -> DataFrame:
    """Adds exact per-key sequence facts, however many rows a key has.

    * ``_idx``: 1-based position of the row within its key in ``order`` (nulls first).
    * ``_last_flag_idx`` (when ``flag`` is given): position of the last earlier
      row of the key where ``flag`` held, else null.
    * ``_next`` and ``_has_next`` (when ``lead_of`` is given): value of
      ``lead_of`` on the next row of the key, and whether there is one.

    Rows are dealt by ranges of (key, order), so a hot key is spread over as
    many partitions as its rows need. Windows run within a partition and key.
    Only keys at a partition's edges go on elsewhere: their counts, last flags
    and first rows (two groups a partition at most) are carried along the
    partitions and broadcast back. Null keys are a key of their own.
    """
    src = df if flag is None else df.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    rows = range_sorted(src, [F.col(c).asc_nulls_first() for c in (key, *order)], partitions=partitions)
    ends = rows.groupBy(PART).agg(F.array(*[f(F.struct(F.col(key).alias("_k")), F.col(AT))
                                            for f in (F.min_by, F.max_by)]).alias("_ends"))
    edges = ends.select(F.col(PART).alias("_p"), F.explode("_ends").alias("_e")).select("_p", "_e._k").distinct()
    on_edge = (F.col(PART) == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k"))
    facts = [F.count(F.lit(1)).alias("_n"), F.min(AT).alias("_lo")]
    if flag is not None:
        facts.append(F.max(F.when(F.col("_flag"), F.col(AT))).alias("_hi_flag"))
    if lead_of is not None:
        facts.append(F.min_by(F.struct(F.col(lead_of).alias("v")), F.col(AT)).alias("_first"))
    groups = rows.join(F.broadcast(edges), on_edge, "left_semi").groupBy(PART, key).agg(*facts)
    across = Window.partitionBy(key).orderBy(PART)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = groups.withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    keep = [F.col(PART).alias("_p"), F.col(key).alias("_k"), "_off"]
    if flag is not None:
        carried = (carried.withColumn("_flag_at", F.col("_off") + F.col("_hi_flag") - F.col("_lo") + 1)
                   .withColumn("_flag_before", F.max("_flag_at").over(earlier)))
        keep.append("_flag_before")
    if lead_of is not None:
        carried = carried.withColumn("_after", F.lead("_first").over(across))
        keep.append("_after")

    local = Window.partitionBy(PART, key).orderBy(AT)
    rows = rows.withColumn("_lidx", F.row_number().over(local))
    if flag is not None:
        rows = rows.withColumn("_lprev", F.max(F.when(F.col("_flag"), F.col("_lidx"))).over(
            local.rowsBetween(Window.unboundedPreceding, -1)))
    if lead_of is not None:
        rows = rows.withColumn("_lnext", F.lead(F.struct(F.col(lead_of).alias("v"))).over(local))
    out = rows.join(F.broadcast(carried.select(*keep)), on_edge, "left")
    off = F.coalesce("_off", F.lit(0))
    out = out.withColumn("_idx", off + F.col("_lidx"))
    if flag is not None:
        out = out.withColumn("_last_flag_idx", F.coalesce(off + F.col("_lprev"), F.col("_flag_before")))
    if lead_of is not None:
        following = F.coalesce("_lnext", "_after")
        out = out.withColumn("_next", following["v"]).withColumn("_has_next", following.isNotNull())
    return out.drop(PART, AT, "_p", "_k", "_off", "_lidx", "_flag", "_lprev", "_flag_before", "_lnext", "_after")


def carried_forward(df: DataFrame, key: str, order: Sequence[Column], value: str, name: str = "_last",
                    partitions: int | None = None) -> DataFrame:
    """Adds the last non-null ``value`` at or before each row of its key, in ``order``; the key sorts first, nulls too.

    As in ``sequenced``, a hot key is spread over ranges; the last value of
    the keys at a range's edges (two groups a range at most) is carried on.
    """
    rows = range_sorted(df, [F.col(key).asc_nulls_first(), *order], partitions=partitions)
    ends = rows.groupBy(PART).agg(F.array(*[f(F.struct(F.col(key).alias("_k")), F.col(AT))
                                            for f in (F.min_by, F.max_by)]).alias("_ends"))
    edges = ends.select(F.col(PART).alias("_p"), F.explode("_ends").alias("_e")).select("_p", "_e._k").distinct()
    on_edge = (F.col(PART) == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k"))
    held = F.when(F.col(value).isNotNull(), F.col(AT))
    groups = rows.join(F.broadcast(edges), on_edge, "left_semi").groupBy(PART, key).agg(
        F.max_by(F.col(value), held).alias("_v"))
    earlier = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = groups.select(F.col(PART).alias("_p"), F.col(key).alias("_k"),
                          F.last("_v", ignorenulls=True).over(earlier).alias("_before"))
    local = Window.partitionBy(PART, key).orderBy(AT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = rows.withColumn("_here", F.last(value, ignorenulls=True).over(local))
    return (here.join(F.broadcast(carry), on_edge, "left").withColumn(name, F.coalesce("_here", "_before"))
            .drop(PART, AT, "_p", "_k", "_here", "_before"))
