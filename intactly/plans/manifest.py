"""Queries for reconciliation (M2) and history audits: q10–q13, q16–q23, q25.

The driver tables are clean, so damage is derived from each row's own
values (identically in the oracle SQL); every row of every input is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions import rules, sidecar
from intactly.operators import history, manifest, merkle, publish
from intactly.session import scratch_path
from intactly.sources.tables import month_of, read_table

# Month requests checked by q10 (valid, trimmed, trailing comma,
# duplicate, bad format, unavailable, empty, out-of-range month).
MONTH_REQUESTS = [
    (1, "1995-03,1995-01"),
    (2, " 1996-02 , 1997-11"),
    (3, "1995-03,"),
    (4, "1995-03,1995-03"),
    (5, "1995-3"),
    (6, "2030-01"),
    (7, ""),
    (8, "1995-13,1995-01"),
]

# Secret words redacted by q23.
SECRETS = ("token", "MIT License", "GNU General Public License")


def q10_month_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    available = li.groupBy(month_of("l_shipdate").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    requests = spark.createDataFrame(MONTH_REQUESTS, "request_id int, request string")
    return manifest.month_selection(requests, available)


def q11_pair_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    labels = read_table(spark, sf_dir, "labels").select("doc_id")
    return manifest.pair(docs, labels, "doc_id").select("doc_id", "has_data", "has_sidecar", "pairing")


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def sidecar_json(events: DataFrame) -> DataFrame:
    """One version-1 sidecar per event; ``k % 11`` picks which field (if any) is damaged."""
    d = F.pmod(_k(), F.lit(11))
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))  # noqa: E731 - values are plain ASCII
    version = F.when(d == 1, F.lit("2")).when(d == 2, F.lit('"1"')).otherwise(F.lit("1"))
    month = F.when(d == 4, F.lit('""')).otherwise(q(F.date_format("ts", "yyyy-MM")))
    filename = F.when(d == 10, F.lit("")).otherwise(
        F.concat(F.lit(',"filename":'), q(F.concat(F.lit("events-"), F.col("event_id").cast("string"),
                                                    F.lit(".parquet")))))
    url = q(F.concat(F.lit("https://example.org/events/"), F.col("user_id").cast("string")))
    retrieved = F.when(d == 6, F.lit('"yesterday"')).otherwise(
        q(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    size = (F.lit(1000) + _k()).cast("string")
    size = F.when(d == 3, F.concat(size, F.lit(".5"))).when(d == 9, F.lit("0")).otherwise(size)
    sha = F.sha2(F.col("event_id").cast("string"), 256)
    sha = F.when(d == 5, F.upper(sha)).otherwise(sha)
    rows = F.when(d == 7, F.lit("-1")).otherwise(_k().cast("string"))
    schema = F.when(d == 8, F.lit('"text"')).otherwise(F.lit('{"type":"struct","fields":[]}'))
    text = F.concat(
        F.lit('{"formatVersion":'), version, F.lit(',"month":'), month, filename,
        F.lit(',"sourceUrl":'), url, F.lit(',"finalUrl":'), url, F.lit(',"retrievedAt":'), retrieved,
        F.lit(',"bytes":'), size, F.lit(',"sha256":'), q(sha),
        F.lit(',"verification":{"verifiedAt":'), q(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.lit(',"parquetSchema":"message m {}","rowCount":'), rows,
        F.lit(',"sparkSchema":'), schema,
        F.lit(',"versions":{"java":"17","scala":"2.13","spark":"4.1"}}}'))
    return events.select("event_id", text.alias("sidecar"))


def q12_sidecar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sidecar.sidecar_fields(sidecar_json(read_table(spark, sf_dir, "events")), "sidecar")
    checks = sidecar.field_rules()
    aggs = [F.count_if(~F.coalesce(r.ok, F.lit(False))).alias(r.name) for r in checks]
    aggs.append(F.count_if(rules.all_pass(checks)).alias("valid"))
    names = [r.name for r in checks] + ["valid"]
    wide = docs.agg(*aggs)
    stacked = ", ".join(f"'{n}', {n}" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {stacked}) AS (rule, rows)")


def q13_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    requests = (docs.select("doc_id").unionByName(labels.select("doc_id")).distinct()
                .withColumn("refresh", F.pmod("doc_id", F.lit(19)) == 0))
    files = docs.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"),
                        F.sha2("text", 256).alias("sha256"),
                        F.concat_ws("/", "lang", "source").alias("identity"))
    recorded = labels.join(docs, "doc_id", "left")  # a sidecar outlives a deleted document
    sidecars = recorded.select(
        "doc_id",
        (F.octet_length("text") + F.when(F.pmod("doc_id", F.lit(13)) == 0, 1).otherwise(0))
        .cast("bigint").alias("rec_bytes"),
        F.when(F.pmod("doc_id", F.lit(7)) == 0, F.sha2(F.concat("text", F.lit("\n")), 256))
        .otherwise(F.sha2("text", 256)).alias("rec_sha256"),
        F.when(F.pmod("doc_id", F.lit(11)) == 0, F.concat_ws("/", "lang", F.lit("other")))
        .otherwise(F.concat_ws("/", "lang", "source")).alias("rec_identity"),
        (F.col("quality").isin(0, 1) & (F.col("toxic") == 0)).alias("metadata_ok"))
    markers = docs.where(F.pmod("doc_id", F.lit(17)) == 0).select("doc_id")
    return manifest.reconcile(requests, files, sidecars, markers, "doc_id")


def _doc_manifest(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("key"),
                       F.octet_length(text).cast("bigint").alias("bytes"),
                       F.sha2(F.col(text), 256).alias("sha256"))


def q16_manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    bench = read_table(spark, sf_dir, "benchmark")
    before = _doc_manifest(docs)
    nxt = (docs.join(labels, "doc_id", "left")
           .where(F.coalesce(F.col("toxic"), F.lit(0)) != 1)
           .withColumn("text", F.when(F.col("quality") == 0, F.upper("text")).otherwise(F.col("text"))))
    after = _doc_manifest(nxt).unionByName(
        bench.select(F.concat(F.lit("bench/"), F.col("item_id").cast("string")).alias("key"),
                     F.octet_length("text").cast("bigint").alias("bytes"),
                     F.sha2("text", 256).alias("sha256")))
    return manifest.manifest_diff(before, after, "key", ["bytes", "sha256"])


def q17_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations").withColumn("text_sha256", F.sha2("text", 256))
    return history.latest_version(conv, "conv_id", "turn", ["role", "text_sha256"])


def q18_version_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return history.validity_intervals(conv, "conv_id", "turn")


def _transfer_log(events: DataFrame) -> DataFrame:
    """Events read as an attempt log: HTTP status or transport error per attempt."""
    k = _k()
    status = (F.when(F.col("event_type").isin("purchase", "signup"), F.lit(200))
              .when(F.col("event_type") == "view", F.lit(404))
              .when(F.col("event_type") == "error",
                    F.when(F.pmod(k, F.lit(4)) == 0, 429).when(F.pmod(k, F.lit(4)) == 1, 500)
                    .when(F.pmod(k, F.lit(4)) == 2, 503).otherwise(599)))
    kind = F.when(F.col("event_type") == "click", F.lit("timeout"))
    return events.withColumn("status", status).withColumn("error_kind", kind)


def q19_attempt_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _transfer_log(read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "props"))
    audited = history.attempt_audit(log.drop("props"), "user_id", ["ts", "event_id"], None,
                                    F.col("status"), F.col("error_kind"))
    return audited.select("user_id", "event_id", "outcome", "attempt_no", "wait_ms", "stop_reason")


# Outer and inner causes of the storage errors of q19_storage_retry, and the statuses of service errors.
OUTER, INNER, SERVICE_STATUS = ("io", "timeout", "client", "service", "conflict", "other"), ("", "service", "access_denied", "io"), \
    (429, 500, 403, 404, 503)


def q19_storage_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as storage errors with a cause chain: whether to try again, and the text to report."""
    k = _k()
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))
    outer, inner = pick(OUTER, F.pmod(k, F.lit(6))), pick(INNER, F.pmod(F.floor(k / 6), F.lit(4)))
    status = pick(SERVICE_STATUS, F.pmod(k, F.lit(5)))
    cause = lambda kind: F.struct(kind.alias("kind"), F.when(kind == "service", status).alias("status"))
    chain = F.filter(F.array(cause(outer), cause(inner)), lambda e: e["kind"] != "")
    message = F.when(F.pmod(k, F.lit(3)) == 1, F.lit("")).when(F.pmod(k, F.lit(3)) == 2, F.concat(F.lit("failed "), k))
    return read_table(spark, sf_dir, "events").select(
        "event_id", rules.storage_retryable(chain).alias("retry"), rules.error_text(message, outer).alias("text"))


def q20_response_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    k = _k()
    status = (F.when(F.col("event_type").isin("purchase", "signup", "click"), F.lit(200))
              .when(F.col("event_type") == "view", F.lit(404))
              .otherwise(F.when(F.pmod(k, F.lit(4)) == 0, 429).otherwise(503)))
    encoding = (F.when(F.pmod(k, F.lit(10)) == 0, F.lit("gzip"))
                .when(F.pmod(k, F.lit(10)) == 1, F.lit("IDENTITY"))
                .when(F.pmod(k, F.lit(10)) == 2, F.lit(None).cast("string"))
                .otherwise(F.lit("identity")))
    received = F.when(F.pmod(k, F.lit(25)) == 0, F.lit(0).cast("bigint")).otherwise(
        F.round(F.col("value") * 100).cast("bigint"))
    log = (ev.select("event_id", status.alias("status"), encoding.alias("encoding"),
                     received.alias("received_bytes"), k.alias("k"))
           .withColumn("declared_length",
                       F.when(F.pmod("k", F.lit(7)) == 0, F.col("received_bytes") + 1)
                       .when(F.pmod("k", F.lit(3)) == 0, F.lit(None).cast("bigint"))
                       .otherwise(F.col("received_bytes"))))
    checks = rules.response_rules(F.col("status"), F.col("encoding"), F.col("received_bytes"),
                                  F.col("declared_length"))
    return log.select("event_id", "status",
                      F.coalesce(rules.first_failure(checks), F.lit("accepted")).alias("reason"))


def q21_storage_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    pages = read_table(spark, sf_dir, "pages")
    data_key = F.format_string("raw/lang=%s/source=%s/doc-%d.txt", "lang", "source", "doc_id")
    prov = publish.provenance_records(
        docs.withColumn("data_key", data_key),
        [F.col("data_key").alias("key"), F.octet_length("text").cast("bigint").alias("bytes"),
         F.sha2("text", 256).alias("sha256")])
    doc_keys = prov.select(
        F.col("doc_id").alias("item_id"),
        F.array(F.struct(F.lit("data").alias("kind"), F.col("data_key").alias("key")),
                F.struct(F.lit("provenance").alias("kind"), F.col("provenance_key").alias("key")))
        .alias("keys"))
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    page_keys = pages.select(
        F.col("page_id").alias("item_id"),
        F.array(F.struct(F.lit("url").alias("kind"), F.col("url").alias("key")),
                F.struct(F.lit("path").alias("kind"), path.alias("key")),
                F.struct(F.lit("relative").alias("kind"),
                         F.regexp_replace(path, "^/+", "").alias("key"))).alias("keys"))
    keys = (doc_keys.unionByName(page_keys)
            .select("item_id", F.inline("keys")))
    verdict = F.coalesce(rules.first_failure(rules.storage_key_rules(F.col("key"))), F.lit("valid"))
    return keys.select("item_id", "kind", "key", verdict.alias("verdict"))


def q22_name_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    host = F.try_parse_url(F.col("url"), F.lit("HOST"))
    label = F.split_part(host, F.lit("."), F.lit(1))

    def verdict(checks):
        return F.coalesce(rules.first_failure(checks), F.lit("valid"))
    return pages.select(
        "page_id",
        verdict(rules.endpoint_rules(F.col("url"))).alias("endpoint_verdict"),
        verdict(rules.bucket_rules(host)).alias("host_bucket_verdict"),
        verdict(rules.bucket_rules(label)).alias("label_bucket_verdict"))


def q23_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text, replaced = F.col("text"), F.lit(0).cast("bigint")
    for secret in SECRETS:
        replaced = replaced + rules.occurrences(text, secret)
        text = rules.redact(text, [secret])
    return docs.select("doc_id", replaced.alias("replaced"),
                       F.sha2(text, 256).alias("redacted_sha256"))


def q25_first_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    out = history.first_writer(ev, ["user_id", "event_type"], ["ts", "event_id"], "event_id",
                               F.sha2(F.col("props"), 256))
    return out.select("user_id", "event_type", "event_id", "winner", "write_status")


# How the second copy of q29 differs, by remainders of the order key.
CHANGED, REMOVED, ADDED, NEW_KEYS = (997, 0), (1009, 5), (1013, 7), 100_000_000


def q29_changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that differ between two stored copies of orders, found by their trees."""
    orders = read_table(spark, sf_dir, "orders")
    rest = lambda c: F.pmod("o_orderkey", F.lit(c[0])) == c[1]
    later = (orders.where(~rest(REMOVED))
             .withColumn("o_totalprice", F.when(rest(CHANGED), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
             .unionByName(orders.where(rest(ADDED)).withColumn("o_orderkey", F.col("o_orderkey") + NEW_KEYS)))
    roots = []
    for df, name in ((orders, "before"), (later, "after")):
        roots.append(scratch_path(spark, f"q29-{name}"))
        merkle.write_copy(df, "o_orderkey", roots[-1], leaf_bits=10)
    return merkle.changed_keys(orders, "o_orderkey", *roots)


QUERIES = {
    "q10_month_selection": q10_month_selection,
    "q11_pair_status": q11_pair_status,
    "q12_sidecar_rules": q12_sidecar_rules,
    "q13_reconcile": q13_reconcile,
    "q16_manifest_diff": q16_manifest_diff,
    "q17_latest_version": q17_latest_version,
    "q18_version_intervals": q18_version_intervals,
    "q19_attempt_audit": q19_attempt_audit,
    "q19_storage_retry": q19_storage_retry,
    "q20_response_acceptance": q20_response_acceptance,
    "q21_storage_keys": q21_storage_keys,
    "q22_name_url_rules": q22_name_url_rules,
    "q23_redact": q23_redact,
    "q25_first_writer": q25_first_writer,
    "q29_changed_keys": q29_changed_keys,
}

_REQ_VALUES = ", ".join(f"({i}, '{t}')" for i, t in MONTH_REQUESTS)
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_BUCKET_SQL = """CASE WHEN NOT regexp_full_match({b}, '[a-z0-9][a-z0-9.-]{{1,61}}[a-z0-9]') THEN 'bucket_charset'
     WHEN contains({b}, '..') THEN 'bucket_double_dot'
     WHEN contains({b}, '.-') OR contains({b}, '-.') THEN 'bucket_dot_dash'
     WHEN regexp_full_match({b}, '[0-9]+(\\.[0-9]+){{3}}') THEN 'bucket_ip_address'
     ELSE 'valid' END"""
_INTEGRAL = "(json_type(sidecar, '{p}') IN ('BIGINT', 'UBIGINT') AND CAST(json_extract(sidecar, '{p}') AS HUGEINT) <= 9223372036854775807)"
_TEXT = "(coalesce(json_type(sidecar, '{p}') = 'VARCHAR' AND length(json_extract_string(sidecar, '{p}')) > 0, false))"
_TIME = "try_strptime(json_extract_string(sidecar, '{p}'), '%Y-%m-%dT%H:%M:%SZ') IS NOT NULL"

_SIDECAR_SQL = f"""
SELECT event_id,
  '{{"formatVersion":' || CASE WHEN d = 1 THEN '2' WHEN d = 2 THEN '"1"' ELSE '1' END
  || ',"month":' || CASE WHEN d = 4 THEN '""' ELSE '"' || strftime(ts, '%Y-%m') || '"' END
  || CASE WHEN d = 10 THEN '' ELSE ',"filename":"events-' || event_id || '.parquet"' END
  || ',"sourceUrl":"https://example.org/events/' || user_id || '"'
  || ',"finalUrl":"https://example.org/events/' || user_id || '"'
  || ',"retrievedAt":' || CASE WHEN d = 6 THEN '"yesterday"' ELSE '"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"' END
  || ',"bytes":' || CASE WHEN d = 3 THEN CAST(1000 + k AS VARCHAR) || '.5' WHEN d = 9 THEN '0' ELSE CAST(1000 + k AS VARCHAR) END
  || ',"sha256":"' || CASE WHEN d = 5 THEN upper(sha256(CAST(event_id AS VARCHAR))) ELSE sha256(CAST(event_id AS VARCHAR)) END || '"'
  || ',"verification":{{"verifiedAt":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"'
  || ',"parquetSchema":"message m {{}}","rowCount":' || CASE WHEN d = 7 THEN '-1' ELSE CAST(k AS VARCHAR) END
  || ',"sparkSchema":' || CASE WHEN d = 8 THEN '"text"' ELSE '{{"type":"struct","fields":[]}}' END
  || ',"versions":{{"java":"17","scala":"2.13","spark":"4.1"}}}}}}' AS sidecar
FROM (SELECT *, {_K} AS k, {_K} % 11 AS d FROM events)"""

_SIDECAR_RULES = [
    ("json_object", "json_type(sidecar) = 'OBJECT'"),
    ("format_version", f"{_INTEGRAL.format(p='$.formatVersion')} AND CAST(json_extract(sidecar, '$.formatVersion') AS HUGEINT) = 1"),
    ("text_fields", " AND ".join(_TEXT.format(p=f"$.{n}") for n in sidecar.TEXT_FIELDS)),
    ("bytes_positive", f"{_INTEGRAL.format(p='$.bytes')} AND CAST(json_extract(sidecar, '$.bytes') AS HUGEINT) > 0"),
    ("sha256_hex", "json_type(sidecar, '$.sha256') = 'VARCHAR' AND regexp_full_match(json_extract_string(sidecar, '$.sha256'), '[0-9a-f]{64}')"),
    ("timestamps", f"{_TIME.format(p='$.retrievedAt')} AND {_TIME.format(p='$.verification.verifiedAt')}"),
    ("row_count", f"{_INTEGRAL.format(p='$.verification.rowCount')} AND CAST(json_extract(sidecar, '$.verification.rowCount') AS HUGEINT) >= 0"),
    ("spark_schema_object", "json_type(sidecar, '$.verification.sparkSchema') = 'OBJECT'"),
]

SQL = {
    "q10_month_selection": f"""
WITH req(request_id, request) AS (VALUES {_REQ_VALUES}),
avail AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS rows FROM lineitem GROUP BY 1),
parts AS (SELECT request_id, string_split(request, ',') AS p FROM req),
items AS (SELECT request_id, CAST(unnest(generate_series(1, len(p))) AS INTEGER) AS ordinal,
                 trim(unnest(p)) AS month FROM parts),
flags AS (SELECT i.*, a.rows, count(*) OVER (PARTITION BY i.request_id, i.month) AS copies
          FROM items i LEFT JOIN avail a ON a.month = i.month),
verd AS (SELECT request_id, CASE
           WHEN bool_or(month = '') THEN 'empty_month'
           WHEN bool_or(NOT regexp_full_match(month, '[0-9]{{4}}-(0[1-9]|1[0-2])')) THEN 'bad_format'
           WHEN bool_or(copies > 1) THEN 'duplicate'
           WHEN bool_or(rows IS NULL) THEN 'not_available' ELSE 'valid' END AS verdict
         FROM flags GROUP BY 1)
SELECT f.request_id, v.verdict, f.ordinal, f.month, f.rows
FROM flags f JOIN verd v ON v.request_id = f.request_id WHERE v.verdict = 'valid'
UNION ALL
SELECT request_id, verdict, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
FROM verd WHERE verdict <> 'valid'""",
    "q11_pair_status": """
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.doc_id IS NOT NULL AS has_data,
       l.doc_id IS NOT NULL AS has_sidecar,
       CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'paired'
            WHEN d.doc_id IS NOT NULL THEN 'data_only' ELSE 'sidecar_only' END AS pairing
FROM (SELECT doc_id FROM documents) d FULL OUTER JOIN (SELECT doc_id FROM labels) l ON d.doc_id = l.doc_id""",
    "q12_sidecar_rules": f"""
WITH s AS ({_SIDECAR_SQL}),
r AS (SELECT {", ".join(f"coalesce({cond}, false) AS {name}" for name, cond in _SIDECAR_RULES)} FROM s)
SELECT rule, rows FROM (
  {" UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT {name}) AS rows FROM r" for name, _ in _SIDECAR_RULES)}
  UNION ALL SELECT 'valid', count(*) FILTER (WHERE {" AND ".join(n for n, _ in _SIDECAR_RULES)}) FROM r)""",
    "q13_reconcile": """
WITH req AS (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels),
f AS (SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha, lang || '/' || source AS ident FROM documents),
s AS (SELECT l.doc_id,
             CAST(strlen(d.text) + CASE WHEN l.doc_id % 13 = 0 THEN 1 ELSE 0 END AS BIGINT) AS rec_bytes,
             CASE WHEN l.doc_id % 7 = 0 THEN sha256(d.text || chr(10)) ELSE sha256(d.text) END AS rec_sha,
             CASE WHEN l.doc_id % 11 = 0 THEN d.lang || '/other' ELSE d.lang || '/' || d.source END AS rec_ident,
             coalesce(l.quality IN (0, 1) AND l.toxic = 0, false) AS metadata_ok
      FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id),
m AS (SELECT doc_id FROM documents WHERE doc_id % 17 = 0),
j AS (SELECT r.doc_id, r.doc_id % 19 = 0 AS refresh,
        CASE WHEN m.doc_id IS NOT NULL THEN 'pending'
             WHEN f.doc_id IS NULL AND s.doc_id IS NULL THEN 'absent'
             WHEN f.doc_id IS NULL OR s.doc_id IS NULL THEN 'incomplete'
             WHEN NOT s.metadata_ok THEN 'bad_metadata'
             WHEN f.ident IS DISTINCT FROM s.rec_ident THEN 'identity_mismatch'
             WHEN f.bytes IS DISTINCT FROM s.rec_bytes THEN 'size_mismatch'
             WHEN f.sha IS DISTINCT FROM s.rec_sha THEN 'digest_mismatch'
             ELSE 'accepted' END AS status
      FROM req r LEFT JOIN f ON f.doc_id = r.doc_id LEFT JOIN s ON s.doc_id = r.doc_id
      LEFT JOIN m ON m.doc_id = r.doc_id)
SELECT doc_id, refresh, status,
       CASE WHEN refresh THEN 'refreshed' WHEN status = 'accepted' THEN 'reused'
            WHEN status = 'absent' THEN 'downloaded' ELSE 'blocked' END AS action
FROM j""",
    "q16_manifest_diff": """
WITH b AS (SELECT 'doc/' || doc_id AS key, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha FROM documents),
n AS (SELECT d.doc_id, CASE WHEN l.quality = 0 THEN upper(d.text) ELSE d.text END AS text
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(l.toxic, 0) <> 1),
a AS (SELECT 'doc/' || doc_id AS key, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha FROM n
      UNION ALL
      SELECT 'bench/' || item_id, CAST(strlen(text) AS BIGINT), sha256(text) FROM benchmark)
SELECT coalesce(b.key, a.key) AS key,
       CASE WHEN b.key IS NULL THEN 'added' WHEN a.key IS NULL THEN 'removed'
            WHEN b.bytes IS NOT DISTINCT FROM a.bytes AND b.sha IS NOT DISTINCT FROM a.sha THEN 'same'
            ELSE 'changed' END AS change
FROM b FULL OUTER JOIN a ON a.key = b.key""",
    "q17_latest_version": """
SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role,
       arg_max(sha256(text), turn) AS text_sha256, count(*) AS versions
FROM conversations GROUP BY conv_id""",
    "q18_version_intervals": """
SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next_turn,
       lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL AS is_open
FROM conversations""",
    "q19_attempt_audit": f"""
WITH c AS (
  SELECT user_id, event_id, ts,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 200 WHEN event_type = 'view' THEN 404
         WHEN event_type = 'error' THEN CASE {_K} % 4 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 503 ELSE 599 END
    END AS status,
    CASE WHEN event_type = 'click' THEN 'timeout' END AS error_kind
  FROM events),
o AS (SELECT *, CASE WHEN status = 200 THEN 'success'
                     WHEN error_kind IN ('io', 'timeout') OR status = 429 OR status BETWEEN 500 AND 599 THEN 'transient'
                     ELSE 'permanent' END AS outcome FROM c),
i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS idx FROM o),
l AS (SELECT *, max(CASE WHEN outcome <> 'transient' THEN idx END) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_stop FROM i),
a AS (SELECT *, CAST(((idx - coalesce(last_stop, 0) - 1) % 3) + 1 AS INTEGER) AS attempt_no FROM l)
SELECT user_id, event_id, outcome, attempt_no,
       CAST(CASE WHEN attempt_no <= 1 THEN 0 ELSE least(30000, (attempt_no - 1) * 1000) END AS BIGINT) AS wait_ms,
       CASE WHEN outcome <> 'transient' THEN outcome WHEN attempt_no = 3 THEN 'exhausted' END AS stop_reason
FROM a""",
    "q20_response_acceptance": f"""
WITH e AS (
  SELECT event_id, {_K} AS k,
    CASE WHEN event_type IN ('purchase', 'signup', 'click') THEN 200 WHEN event_type = 'view' THEN 404
         WHEN {_K} % 4 = 0 THEN 429 ELSE 503 END AS status,
    CASE {_K} % 10 WHEN 0 THEN 'gzip' WHEN 1 THEN 'IDENTITY' WHEN 2 THEN NULL ELSE 'identity' END AS encoding,
    CASE WHEN {_K} % 25 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(round(value * 100) AS BIGINT) END AS received
  FROM events),
d AS (SELECT *, CASE WHEN k % 7 = 0 THEN received + 1 WHEN k % 3 = 0 THEN NULL ELSE received END AS declared FROM e)
SELECT event_id, status,
  CASE WHEN status <> 200 THEN 'http_status'
       WHEN lower(coalesce(encoding, 'identity')) <> 'identity' THEN 'content_encoding'
       WHEN NOT received > 0 THEN 'empty_body'
       WHEN declared IS NOT NULL AND declared <> received THEN 'length_mismatch'
       ELSE 'accepted' END AS reason
FROM d""",
    "q21_storage_keys": """
WITH dk AS (SELECT doc_id, text, 'raw/lang=' || lang || '/source=' || source || '/doc-' || doc_id || '.txt' AS data_key FROM documents),
keys AS (
  SELECT doc_id AS item_id, 'data' AS kind, data_key AS key FROM dk
  UNION ALL
  SELECT doc_id, 'provenance', 'provenance/' || sha256(CAST(json_object('formatVersion', 1, 'key', data_key,
         'bytes', CAST(strlen(text) AS BIGINT), 'sha256', sha256(text)) AS VARCHAR)) || '.json' FROM dk
  UNION ALL SELECT page_id, 'url', url FROM pages
  UNION ALL SELECT page_id, 'path', regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) FROM pages
  UNION ALL SELECT page_id, 'relative', regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^/+', '') FROM pages)
SELECT item_id, kind, key,
  CASE WHEN length(key) = 0 THEN 'empty_key' WHEN starts_with(key, '/') THEN 'absolute_key'
       WHEN contains(key, '://') THEN 'uri_key' ELSE 'valid' END AS verdict
FROM keys""",
    "q22_name_url_rules": f"""
WITH p AS (
  SELECT page_id, url,
    regexp_extract(url, '^([^:/?#]+):', 1) AS scheme,
    regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) AS authority,
    regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
h AS (SELECT *, regexp_replace(regexp_replace(authority, '^.*@', ''), ':[0-9]*$', '') AS host FROM p)
SELECT page_id,
  CASE WHEN scheme NOT IN ('http', 'https') THEN 'endpoint_scheme'
       WHEN host = '' THEN 'endpoint_host'
       WHEN contains(authority, '@') THEN 'endpoint_userinfo'
       WHEN regexp_matches(url, '^[^#]*[?]') THEN 'endpoint_query'
       WHEN contains(url, '#') THEN 'endpoint_fragment'
       WHEN path NOT IN ('', '/') THEN 'endpoint_path'
       ELSE 'valid' END AS endpoint_verdict,
  {_BUCKET_SQL.format(b="host")} AS host_bucket_verdict,
  {_BUCKET_SQL.format(b="split_part(host, '.', 1)")} AS label_bucket_verdict
FROM h""",
    "q25_first_writer": """
WITH w AS (SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS winner,
                  arg_min(sha256(props), (ts, event_id)) AS wd
           FROM events GROUP BY 1, 2)
SELECT e.user_id, e.event_type, e.event_id, w.winner,
       CASE WHEN e.event_id = w.winner THEN 'created'
            WHEN sha256(e.props) = w.wd THEN 'reused' ELSE 'conflict' END AS write_status
FROM events e JOIN w ON w.user_id = e.user_id AND w.event_type = e.event_type""",
}


def _redact_sql() -> str:
    text, parts = "text", []
    for s in SECRETS:
        parts.append(f"CAST((strlen({text}) - strlen(replace({text}, '{s}', ''))) / {len(s.encode())} AS BIGINT)")
        text = f"replace({text}, '{s}', '[redacted]')"
    return (f"SELECT doc_id, CAST({' + '.join(parts)} AS BIGINT) AS replaced, "
            f"sha256({text}) AS redacted_sha256 FROM documents")


SQL["q23_redact"] = _redact_sql()

SQL["q29_changed_keys"] = f"""
SELECT o_orderkey, 'removed' AS change FROM orders WHERE o_orderkey % {REMOVED[0]} = {REMOVED[1]}
UNION ALL SELECT o_orderkey, 'changed' FROM orders
  WHERE o_orderkey % {CHANGED[0]} = {CHANGED[1]} AND o_orderkey % {REMOVED[0]} <> {REMOVED[1]}
UNION ALL SELECT o_orderkey + {NEW_KEYS}, 'added' FROM orders WHERE o_orderkey % {ADDED[0]} = {ADDED[1]}"""

_PICK = lambda values, at: f"list_extract({list(values)}, {at} + 1)"
SQL["q19_storage_retry"] = f"""
WITH e AS (SELECT event_id, {_K} AS k FROM events),
c AS (SELECT *, {_PICK(OUTER, 'k % 6')} AS outer_kind, {_PICK(INNER, '(k // 6) % 4')} AS inner_kind,
             {_PICK(SERVICE_STATUS, 'k % 5')} AS status FROM e),
s AS (SELECT *, outer_kind = 'service' OR inner_kind = 'service' AS serviced FROM c)
SELECT event_id,
       CASE WHEN inner_kind = 'access_denied' OR (serviced AND status IN (401, 403)) OR outer_kind = 'conflict' THEN false
            WHEN serviced THEN status = 429 OR status >= 500
            ELSE outer_kind IN ('io', 'timeout', 'client') END AS retry,
       CASE WHEN k % 3 = 2 THEN 'failed ' || k ELSE outer_kind END AS text
FROM s"""
