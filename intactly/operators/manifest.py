"""Manifests are tables; reconciliation is joins on keys plus ordered rules.

Inputs of ``reconcile`` (each keyed by the same item key):

* ``requests``  — what the caller asked for (key, refresh flag)
* ``files``     — what is stored (key, observed bytes, observed digest, identity)
* ``sidecars``  — recorded provenance (key, recorded bytes/digest/identity, metadata_ok)
* ``markers``   — keys with an unfinished promotion

All joins are on the key, so every input shuffles once on it and the chain
of joins reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intactly.functions import rules
from intactly.functions.schema import same_schema
from intactly.operators.ordered import staged

# Pair statuses in precedence order, and actions.
PAIR_STATUSES = ("pending", "absent", "incomplete", "duplicate", "bad_metadata",
                 "identity_mismatch", "size_mismatch", "digest_mismatch", "verification_mismatch",
                 "accepted")


def _per_key(df: DataFrame, key: str, keep: Sequence[str], copies: str) -> DataFrame:
    """One row per key (a partial aggregate), so joins never pair up copies of a key."""
    aggs = [F.count(F.lit(1)).alias(copies)]
    if keep:
        row = F.struct(*[F.col(c) for c in keep])
        aggs.append(F.min(row).alias("_row"))
    out = df.groupBy(key).agg(*aggs)
    return out.select(key, copies, *[F.col(f"_row.{c}").alias(c) for c in keep]) if keep else out


def pair(files: DataFrame, sidecars: DataFrame, key: str) -> DataFrame:
    """Data file ↔ sidecar pairing by key, both sides optional.

    Each side is first reduced to one row per key with its number of copies.
    """
    f = _per_key(files, key, [], "data_copies")
    s = _per_key(sidecars, key, [], "sidecar_copies")
    joined = f.join(s, key, "full_outer")
    has_file = F.col("data_copies").isNotNull()
    has_sidecar = F.col("sidecar_copies").isNotNull()
    return (joined.withColumn("has_data", has_file).withColumn("has_sidecar", has_sidecar)
            .withColumn("pairing", F.when(has_file & has_sidecar, F.lit("paired"))
                        .when(has_file, F.lit("data_only")).otherwise(F.lit("sidecar_only"))))


def pair_status(marker: Column, has_data: Column, has_sidecar: Column, metadata_ok: Column,
                identity_ok: Column, size_ok: Column, digest_ok: Column,
                unique: Column | None = None, verification_ok: Column | None = None) -> Column:
    """Status with fixed precedence: the marker wins even when no file exists.

    ``unique`` (false when a key has several data files or sidecars) fails
    closed as 'duplicate' before any content rule is looked at.
    """
    return (F.when(marker, F.lit("pending"))
            .when(~has_data & ~has_sidecar, F.lit("absent"))
            .when(~(has_data & has_sidecar), F.lit("incomplete"))
            .when(~F.coalesce(unique if unique is not None else F.lit(True), F.lit(False)),
                  F.lit("duplicate"))
            .when(~F.coalesce(metadata_ok, F.lit(False)), F.lit("bad_metadata"))
            .when(~F.coalesce(identity_ok, F.lit(False)), F.lit("identity_mismatch"))
            .when(~F.coalesce(size_ok, F.lit(False)), F.lit("size_mismatch"))
            .when(~F.coalesce(digest_ok, F.lit(False)), F.lit("digest_mismatch"))
            .when(~F.coalesce(verification_ok if verification_ok is not None else F.lit(True),
                              F.lit(False)), F.lit("verification_mismatch"))
            .otherwise(F.lit("accepted")))


def reconcile(requests: DataFrame, files: DataFrame, sidecars: DataFrame,
              markers: DataFrame, key: str, verify: bool = False, schemas: bool = False) -> DataFrame:
    """Status and action per requested item (M2: C7–C9, D2, D5).

    ``files``: key, bytes, sha256, identity. ``sidecars``: key, rec_bytes,
    rec_sha256, rec_identity, metadata_ok. ``markers``: key. With ``verify``
    the files also carry ``rows`` (decoded now) and the sidecars ``rec_rows``
    (recorded): reuse then also needs the same decoded row count. With
    ``schemas`` they carry ``parquet_schema`` and ``spark_schema`` (and
    ``rec_`` of both) too, and reuse needs all three to agree (D4): schema
    texts are compared as JSON, times and runtime versions are ignored.
    Action: refresh → 'refreshed'; accepted → 'reused'; absent → 'downloaded';
    anything else fails closed → 'blocked'.
    """
    compared = (["rows"] if verify else []) + (["parquet_schema", "spark_schema"] if schemas else [])
    vf, vs = compared, [f"rec_{c}" for c in compared]
    agree = F.lit(True)
    for c in compared:
        a, b = F.col(c), F.col(f"rec_{c}")
        agree = agree & (same_schema(a, b) if c == "spark_schema" else a.eqNullSafe(b))
    f = _per_key(files, key, ["bytes", "sha256", "identity", *vf], "_fc")
    s = _per_key(sidecars, key, ["rec_bytes", "rec_sha256", "rec_identity", "metadata_ok", *vs], "_sc")
    m = markers.select(key).distinct().withColumn("_marker", F.lit(True))
    j = (requests.join(f, key, "left").join(s, key, "left").join(m, key, "left"))
    status = pair_status(
        marker=F.coalesce(F.col("_marker"), F.lit(False)),
        has_data=F.col("_fc").isNotNull(),
        has_sidecar=F.col("_sc").isNotNull(),
        unique=(F.coalesce(F.col("_fc"), F.lit(0)) <= 1) & (F.coalesce(F.col("_sc"), F.lit(0)) <= 1),
        verification_ok=agree,
        metadata_ok=F.col("metadata_ok"),
        identity_ok=F.col("identity").eqNullSafe(F.col("rec_identity")),
        size_ok=F.col("bytes").eqNullSafe(F.col("rec_bytes")),
        digest_ok=F.col("sha256").eqNullSafe(F.col("rec_sha256")),
    )
    action = (F.when(F.col("refresh"), F.lit("refreshed"))
              .when(F.col("status") == "accepted", F.lit("reused"))
              .when(F.col("status") == "absent", F.lit("downloaded"))
              .otherwise(F.lit("blocked")))
    return (j.withColumn("status", status).withColumn("action", action)
            .select(key, "refresh", "status", "action"))


def manifest_diff(before: DataFrame, after: DataFrame, key: str,
                  compare: Sequence[str]) -> DataFrame:
    """added / removed / changed / same per key, in one full outer join.

    Each side is reduced to one row per key first (copies, smallest and
    largest value tuple), so repeated keys never multiply; for unique keys the
    comparison is exact.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        row = F.struct(*[F.col(c) for c in compare])
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(f"{tag}_n"), F.min(row).alias(f"{tag}_lo"),
                                   F.max(row).alias(f"{tag}_hi"))
    same = (F.col("b_n").eqNullSafe(F.col("a_n")) & F.col("b_lo").eqNullSafe(F.col("a_lo"))
            & F.col("b_hi").eqNullSafe(F.col("a_hi")))
    change = (F.when(F.col("b_n").isNull(), F.lit("added"))
              .when(F.col("a_n").isNull(), F.lit("removed"))
              .when(same, F.lit("same")).otherwise(F.lit("changed")))
    return side(before, "b").join(side(after, "a"), key, "full_outer").select(key, change.alias("change"))


def verification_matches(recorded: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Recorded ↔ observed verification per key.

    Equal iff row count, physical schema and Spark schema are equal (null-safe);
    verification times and runtime versions are ignored.
    """
    cols = ("rowCount", "parquetSchema", "sparkSchema")
    r = recorded.select(key, *[F.col(c).alias(f"r_{c}") for c in cols])
    o = observed.select(key, *[F.col(c).alias(f"o_{c}") for c in cols])
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"r_{c}").eqNullSafe(F.col(f"o_{c}"))
    return r.join(o, key, "full_outer").select(key, same.alias("same_verification"))


def month_selection(requests: DataFrame, available: DataFrame, text: str = "request",
                    rid: str = "request_id") -> DataFrame:
    """Validates comma-separated month requests against the available months.

    Items are trimmed, trailing empties kept; every item must be a valid
    month present in ``available`` (columns ``month``, ``rows``); duplicates
    reject the request. Valid requests yield one row per month with its
    1-based ordinal in request order; invalid ones yield one verdict row.
    """
    # a null request is an empty one: it still gets a verdict row
    items = (requests.select(rid, F.posexplode(rules.split_list(F.coalesce(F.col(text), F.lit(""))))
                             .alias("pos", "month"))
             .withColumn("ordinal", (F.col("pos") + 1).cast("int")).drop("pos"))
    copies = F.count(F.lit(1)).over(Window.partitionBy(rid, "month"))
    # Looked at twice below: the available months are counted once.
    items = staged(items.withColumn("_copies", copies)
                   .join(available.select("month", "rows"), "month", "left"), "months")
    item_rules = [
        rules.Rule("empty_month", F.col("month") != ""),
        rules.Rule("bad_format", rules.month_format(F.col("month"))),
        rules.Rule("duplicate", F.col("_copies") == 1),
        rules.Rule("not_available", F.col("rows").isNotNull()),
    ]
    # A request fails with the first rule (in rule order) that any of its items breaks.
    failed = [F.bool_or(~F.coalesce(r.ok, F.lit(False))).alias(r.name) for r in item_rules]
    verdict = F.coalesce(*[F.when(F.col(r.name), F.lit(r.name)) for r in item_rules],
                         F.lit("valid"))
    verdicts = items.groupBy(rid).agg(*failed).select(rid, verdict.alias("verdict"))
    valid = (items.join(verdicts, rid).where(F.col("verdict") == "valid")
             .select(rid, "verdict", "ordinal", "month", "rows"))
    invalid = (verdicts.where(F.col("verdict") != "valid")
               .select(rid, "verdict", F.lit(None).cast("int").alias("ordinal"),
                       F.lit(None).cast("string").alias("month"),
                       F.lit(None).cast("bigint").alias("rows")))
    return valid.unionByName(invalid)
