"""Per-key history operators that stay parallel when one key is huge.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task,
so a key holding a third of the data would serialise the job. Here the
rows of a key are split into buckets of the ordering column (a monotone
function such as the hour of a timestamp); windows run per
``(key, bucket)``, and a small per-bucket table (one row per bucket, built
by a partial aggregate) supplies the prefix offsets that stitch the buckets
back into one exact order. "Latest" and "first writer" use ``max_by`` /
``min_by`` aggregates, which combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intactly.functions import rules
from intactly.operators import ordered

_B = "_bucket"


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where null matches null, so rows with a null key are kept."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = term if cond is None else cond & term
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def latest_version(df: DataFrame, key: str, order: str, keep: Sequence[str]) -> DataFrame:
    """Current version per key from an append-only history.

    Earlier versions stay in ``df``; the count of versions is reported.
    """
    payload = F.struct(*[F.col(c) for c in [order, *keep]])
    latest = (df.groupBy(key)
              .agg(F.max_by(payload, F.col(order)).alias("_latest"),
                   F.count(F.lit(1)).alias("versions")))
    return latest.select(key, *[F.col(f"_latest.{c}").alias(c) for c in [order, *keep]], "versions")


# Quantile bucketing of ordering values.
ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 100_000


def order_value(df: DataFrame, col: str) -> Column:
    """The ordering column as a double that never reverses its order (timestamps as epoch micros).

    Only numeric, boolean, date and timestamp columns qualify: a cast to
    double is monotone for them. Other types (strings sort differently from
    any number) are refused rather than bucketed out of order.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    raise TypeError(f"cannot bucket by {col} of type {dtype.simpleString()}; order by a numeric, "
                    "date or timestamp column")


def with_quantile_bucket(df: DataFrame, col: str, rows_per_bucket: int = ROWS_PER_BUCKET,
                         name: str = "_qbucket") -> DataFrame:
    """Adds a bucket column that is non-decreasing in ``col`` and holds ~``rows_per_bucket`` rows.

    Split points are approximate quantiles of ``col`` over the whole input
    (one sketch pass; only the split points reach the driver, at most
    ``MAX_BUCKETS`` of them). Wherever values concentrate, say one key with
    a third of all rows in one hour, proportionally many split points fall
    there, so no bucket of any key grows past the target by much.
    """
    from pyspark.ml.feature import Bucketizer
    total = df.count()
    buckets = max(1, min(MAX_BUCKETS, -(-total // rows_per_bucket)))
    staged = df.withColumn("_oval", order_value(df, col))
    if buckets == 1:
        return staged.withColumn(name, F.when(F.col("_oval").isNotNull(), F.lit(0.0))).drop("_oval")
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(staged.approxQuantile("_oval", probs, 1.0 / (4 * buckets))))
    if not cuts:  # no non-null ordering value at all: everything is the null bucket
        return staged.withColumn(name, F.lit(None).cast("double")).drop("_oval")
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_oval", outputCol=name,
                          handleInvalid="keep").transform(staged)
    # null ordering values sort first and form their own (null) bucket
    return (bucketed.withColumn(name, F.when(F.col("_oval").isNotNull(), F.col(name)))
            .drop("_oval"))


def _zero(dtype: T.DataType) -> Column:
    """A non-null stand-in of the column's type (paired with an is-null flag)."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    if isinstance(dtype, T.TimestampType):
        return F.expr("TIMESTAMP'1970-01-01 00:00:00 UTC'")
    if isinstance(dtype, T.DateType):
        return F.expr("DATE'1970-01-01'")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(dtype)


def ordered_scan(df: DataFrame, key: str, order: Sequence[str], bucket: Column,
                 flag: Column | None = None, lead_of: str | None = None) -> DataFrame:
    """Adds exact per-key sequence facts without gathering a key in one task.

    * ``_idx``: 1-based position of the row within its key in ``order``.
    * ``_last_flag_idx`` (when ``flag`` is given): position of the last earlier
      row of the key where ``flag`` held, else null.
    * ``_next`` (when ``lead_of`` is given): value of ``lead_of`` on the next row.

    ``bucket`` must be non-decreasing in ``order`` within a key. Key and
    bucket are carried as (is-null flag, non-null value) pairs, so rows with
    a null key or bucket are kept while the join back stays a plain
    equi-join on the windows' own partitioning (no second shuffle).
    """
    staged = df.withColumn(_B, bucket)
    kt, bt = staged.schema[key].dataType, staged.schema[_B].dataType
    staged = (staged.withColumn("_kn", F.col(key).isNull())
              .withColumn("_kv", F.coalesce(F.col(key), _zero(kt)))
              .withColumn("_bn", F.col(_B).isNull())
              .withColumn("_bv", F.coalesce(F.col(_B), _zero(bt))))
    parts = ["_kn", "_kv", "_bn", "_bv"]
    order_cols = [F.col(c) for c in order]
    local = Window.partitionBy(*parts).orderBy(*order_cols)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    rows = staged.drop(_B).withColumn("_lidx", F.row_number().over(local))
    bucket_aggs = [F.count(F.lit(1)).alias("_n")]
    if flag is not None:
        rows = (rows.withColumn("_lflag", F.when(flag, F.col("_lidx")))
                .withColumn("_lprev", F.max("_lflag").over(before)))
        bucket_aggs.append(F.max("_lflag").alias("_bflag"))
    if lead_of is not None:
        rows = rows.withColumn("_lnext", F.lead(lead_of).over(local))
        bucket_aggs.append(F.min(lead_of).alias("_bmin"))

    per_bucket = rows.groupBy(*parts).agg(*bucket_aggs)
    # null buckets (null ordering values) sort first, as they do in the row order
    across = Window.partitionBy("_kn", "_kv").orderBy(F.col("_bn").desc(), F.col("_bv"))
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if flag is not None:
        per_bucket = (per_bucket.withColumn("_gflag", F.col("_off") + F.col("_bflag"))
                      .withColumn("_pflag", F.max("_gflag").over(earlier)))
    if lead_of is not None:
        per_bucket = per_bucket.withColumn("_nextmin", F.lead("_bmin").over(across))
    per_bucket = per_bucket.drop("_n", "_bflag", "_gflag", "_bmin")

    out = rows.join(per_bucket, parts, "inner").withColumn("_idx", F.col("_off") + F.col("_lidx"))
    if flag is not None:
        out = out.withColumn("_last_flag_idx",
                             F.coalesce(F.col("_off") + F.col("_lprev"), F.col("_pflag")))
    if lead_of is not None:
        out = out.withColumn("_next", F.coalesce(F.col("_lnext"), F.col("_nextmin")))
    return out.drop(*parts, "_lidx", "_lflag", "_lprev", "_off", "_pflag", "_lnext", "_nextmin")


def validity_intervals(df: DataFrame, key: str, order: str, bucket: Column | None = None) -> DataFrame:
    """Each version with the start of the next one; the last version is open (F2).

    Without ``bucket`` rows are scanned in ranges (``ordered.sequenced``):
    versions without a start come first, and only the last version is open.
    """
    if bucket is None:
        return (ordered.sequenced(df, key, [order], lead_of=order).withColumnRenamed("_next", f"next_{order}")
                .withColumn("is_open", ~F.col("_has_next")).drop("_idx", "_has_next"))
    out = ordered_scan(df, key, [order], bucket, lead_of=order)
    return (out.withColumnRenamed("_next", f"next_{order}")
            .withColumn("is_open", F.col(f"next_{order}").isNull())
            .drop("_idx"))


# Retry policy of the fetch client.
MAX_ATTEMPTS = 3
BACKOFF_MILLIS = 1000
BACKOFF_CAP_MILLIS = 30000


def attempt_audit(log: DataFrame, key: str, order: Sequence[str], bucket: Column | None,
                  status: Column, error_kind: Column,
                  max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Replays the bounded-retry policy over an attempt log.

    Per key, attempts are numbered from 1; a run stops at the first success,
    at a permanent error, or after ``max_attempts`` transient failures; the
    wait before attempt n+1 is min(cap, backoff × n). Without ``bucket`` rows
    are scanned in ranges (``ordered.sequenced``).
    """
    outcome = (F.when(status == rules.OK_STATUS, F.lit("success"))
               .when(rules.fetch_retryable(status, error_kind), F.lit("transient"))
               .otherwise(F.lit("permanent")))
    classified = log.withColumn("outcome", outcome)
    stops = F.col("outcome") != "transient"
    scanned = (ordered.sequenced(classified, key, order, flag=stops) if bucket is None
               else ordered_scan(classified, key, order, bucket, flag=stops))
    since_stop = F.col("_idx") - F.coalesce(F.col("_last_flag_idx"), F.lit(0))
    attempt = (F.pmod(since_stop - 1, F.lit(max_attempts)) + 1).cast("int")
    stop = (F.when(F.col("outcome") != "transient", F.col("outcome"))
            .when(F.col("attempt_no") == max_attempts, F.lit("exhausted")))
    return (scanned.withColumn("attempt_no", attempt)
            .withColumn("wait_ms", rules.backoff_millis(F.col("attempt_no"), BACKOFF_MILLIS,
                                                        BACKOFF_CAP_MILLIS))
            .withColumn("stop_reason", stop)
            .drop("_idx", "_last_flag_idx"))


def first_writer(df: DataFrame, keys: Sequence[str], order: Sequence[str], writer: str,
                 digest: Column) -> DataFrame:
    """First writer wins per key; later writers are 'reused' when their bytes match, else 'conflict' (F4).

    The winner per key is a ``min`` aggregate (partial, one row per key
    per task); it is joined back on the key, and AQE splits a skewed key.
    """
    tagged = df.withColumn("_digest", digest)
    # Writer and digest settle equal order values, so the winner is one write, not one writer.
    tagged = tagged.withColumn("_rank", F.struct(*[F.col(c) for c in order], F.col(writer).alias("_w"),
                                                 F.col("_digest").alias("_d")))
    winners = tagged.groupBy(*keys).agg(F.min("_rank").alias("_win"))
    return (_join_null_safe(tagged, winners, list(keys), "inner")
            .withColumn("winner", F.col("_win._w"))
            .withColumn("write_status",
                        F.when(F.col("_rank").eqNullSafe(F.col("_win")), F.lit("created"))
                        .when(F.col("_digest") == F.col("_win._d"), F.lit("reused"))
                        .otherwise(F.lit("conflict")))
            .drop("_win", "_rank", "_digest"))
