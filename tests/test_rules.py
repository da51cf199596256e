"""Settings, naming, transfer and sidecar rules (cases from the reference's tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from intactly.functions import rules, sidecar
from intactly.operators import manifest


def _first(spark, values, checks_of):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = df.select("v", rules.first_failure(checks_of(F.col("v"))).alias("r")).collect()
    return {row["v"]: row["r"] for row in out}


def test_month_selection_rejections(spark):
    available = spark.createDataFrame([("2026-05", 5), ("2026-06", 6), ("2026-07", 7)],
                                      "month string, rows long")
    reqs = [(1, "2026-05,2026-07"), (2, ""), (3, "2026-05,"), (4, "2026-05,2026-05"),
            (5, "2026-5"), (6, "2026-08"), (7, "2026-13"), (8, "26-05"), (9, " 2026-07 , 2026-06"),
            (10, None)]
    requests = spark.createDataFrame(reqs, "request_id int, request string")
    out = manifest.month_selection(requests, available).collect()
    verdict = {r["request_id"]: r["verdict"] for r in out}
    assert verdict == {1: "valid", 2: "empty_month", 3: "empty_month", 4: "duplicate",
                       5: "bad_format", 6: "not_available", 7: "bad_format", 8: "bad_format",
                       9: "valid", 10: "empty_month"}
    ordered = sorted((r["ordinal"], r["month"]) for r in out if r["request_id"] == 9)
    assert ordered == [(1, "2026-07"), (2, "2026-06")]  # requested order kept


def test_storage_keys(spark):
    got = _first(spark, ["", "/inbox/a", "s3a://ride-data/a", "inbox/rides/2026-05.parquet"],
                 rules.storage_key_rules)
    assert got == {"": "empty_key", "/inbox/a": "absolute_key", "s3a://ride-data/a": "uri_key",
                   "inbox/rides/2026-05.parquet": None}


def test_bucket_names(spark):
    got = _first(spark, ["ride-data", "Bad_Bucket", "ab", "a..b", "a.-b", "192.168.0.1", "my.bucket-1"],
                 rules.bucket_rules)
    assert got == {"ride-data": None, "Bad_Bucket": "bucket_charset", "ab": "bucket_charset",
                   "a..b": "bucket_double_dot", "a.-b": "bucket_dot_dash",
                   "192.168.0.1": "bucket_ip_address", "my.bucket-1": None}


def test_endpoints(spark):
    got = _first(spark, ["http://localhost:9000", "https://store.example.org/", "ftp://h",
                         "http://user:pw@h:9000", "http://h?x=1", "http://h#f", "http://h/path"],
                 rules.endpoint_rules)
    assert got == {"http://localhost:9000": None, "https://store.example.org/": None,
                   "ftp://h": "endpoint_scheme", "http://user:pw@h:9000": "endpoint_userinfo",
                   "http://h?x=1": "endpoint_query", "http://h#f": "endpoint_fragment",
                   "http://h/path": "endpoint_path"}


def test_response_acceptance(spark):
    rows = [(200, None, 10, None), (200, "IDENTITY", 10, 10), (404, None, 10, 10),
            (200, "gzip", 10, 10), (200, None, 0, None), (200, None, 9, 10)]
    df = spark.createDataFrame(rows, "s int, e string, r long, d long")
    got = [r["x"] for r in df.select(rules.first_failure(rules.response_rules(
        F.col("s"), F.col("e"), F.col("r"), F.col("d"))).alias("x")).collect()]
    assert got == [None, None, "http_status", "content_encoding", "empty_body", "length_mismatch"]


def test_retry_classification(spark):
    df = spark.createDataFrame([(429, None), (500, None), (599, None), (600, None), (404, None),
                                (None, "timeout"), (None, "io"), (None, None)], "s int, k string")
    got = [r["x"] for r in df.select(rules.fetch_retryable(F.col("s"), F.col("k")).alias("x")).collect()]
    assert got == [True, True, True, False, False, True, True, False]

    chains = [
        [("io", None)],
        [("io", None), ("service", 503)],
        [("io", None), ("service", 403)],
        [("client", None), ("access_denied", None)],
        [("conflict", None)],
        [("service", 400), ("service", 503)],
        [("invalid_input", None), ("service", 503)],
        [("other", None)],
    ]
    schema = "c array<struct<kind string, status int>>"
    df = spark.createDataFrame([(c,) for c in chains], schema)
    got = [r["x"] for r in df.select(rules.storage_retryable(F.col("c")).alias("x")).collect()]
    assert got == [True, True, False, False, False, False, False, False]


def test_backoff_linear_with_cap(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (40,)], "n int")
    got = [r["w"] for r in df.select(rules.backoff_millis(F.col("n")).alias("w")).collect()]
    assert got == [0, 1000, 2000, 30000]


def test_redaction(spark):
    df = spark.createDataFrame([("key=abc secret=s3cr3t; again s3cr3t",)], "m string")
    out = df.select(rules.redact(F.col("m"), ["s3cr3t", "", "abc"]).alias("m")).first()["m"]
    assert "s3cr3t" not in out and "abc" not in out
    assert out.count(rules.REDACTED) == 3


VALID = ('{"formatVersion":1,"month":"2026-05","filename":"f.parquet","sourceUrl":"https://x/f",'
         '"finalUrl":"https://x/f","retrievedAt":"2026-05-01T00:00:00Z","bytes":10,'
         '"sha256":"' + "a" * 64 + '","verification":{"verifiedAt":"2026-05-01T00:00:01Z",'
         '"parquetSchema":"message m {}","rowCount":10,"sparkSchema":{"type":"struct","fields":[]},'
         '"versions":{"java":"17","scala":"2.13","spark":"4.1"}}}')


def test_sidecar_rules(spark):
    cases = {
        "ok": VALID,
        "version2": VALID.replace('"formatVersion":1', '"formatVersion":2'),
        "version_text": VALID.replace('"formatVersion":1', '"formatVersion":"1"'),
        "version_real": VALID.replace('"formatVersion":1', '"formatVersion":1.0'),
        "empty_month": VALID.replace('"month":"2026-05"', '"month":""'),
        "bytes_zero": VALID.replace('"bytes":10', '"bytes":0'),
        "bytes_huge": VALID.replace('"bytes":10', '"bytes":18446744073709551615'),
        "sha_upper": VALID.replace("a" * 64, "A" * 64),
        "bad_time": VALID.replace('"retrievedAt":"2026-05-01T00:00:00Z"', '"retrievedAt":"soon"'),
        "neg_rows": VALID.replace('"rowCount":10', '"rowCount":-1'),
        "schema_text": VALID.replace('"sparkSchema":{"type":"struct","fields":[]}', '"sparkSchema":"x"'),
        "not_json": "{oops",
    }
    df = sidecar.sidecar_fields(spark.createDataFrame(list(cases.items()), "name string, j string"), "j")
    got = {r["name"]: r["r"] for r in df.select(
        "name", rules.first_failure(sidecar.field_rules()).alias("r")).collect()}
    assert got == {"ok": None, "version2": "format_version", "version_text": "format_version",
                   "version_real": "format_version", "empty_month": "text_fields",
                   "bytes_zero": "bytes_positive", "bytes_huge": "bytes_positive",
                   "sha_upper": "sha256_hex", "bad_time": "timestamps", "neg_rows": "row_count",
                   "schema_text": "spark_schema_object", "not_json": "json_object"}


def test_sidecar_and_descriptor_readers(spark, workdir):
    import json
    import os
    os.makedirs(os.path.join(workdir, "sidecars"))
    for name, text in {"good": VALID, "bad": VALID.replace('"bytes":10', '"bytes":1.0')}.items():
        pretty = json.dumps(json.loads(text), indent=2)  # multi-line files, as written by the sink
        open(os.path.join(workdir, "sidecars", f"{name}.metadata.json"), "w").write(pretty)
    got = {os.path.basename(r["path"]): r["reasons"]
           for r in sidecar.read_sidecars(spark, os.path.join(workdir, "sidecars")).collect()}
    assert got == {"good.metadata.json": [], "bad.metadata.json": ["bytes_positive"]}

    desc = {"formatVersion": 1, "snapshotId": "s1", "retrievedAt": "2026-05-01T00:00:00Z",
            "files": [{"filename": "a.csv", "sourceUrl": "https://x/a", "bytes": 1, "sha256": "0" * 64,
                       "revision": "r"},
                      {"filename": "b.pdf", "sourceUrl": "https://x/b", "bytes": 2, "sha256": "1" * 64,
                       "revision": "r"}]}
    path = os.path.join(workdir, "descriptor.json")
    open(path, "w").write(json.dumps(desc, indent=2))
    assert sidecar.read_descriptor(spark, path, ["a.csv", "b.pdf"]).first()["reasons"] == []
    assert sidecar.read_descriptor(spark, path, ["b.pdf", "a.csv"]).first()["reasons"] == ["file_list"]


def test_lookup_csv_keeps_literal_na_and_fails_fast(spark, workdir):
    import os
    import pytest
    from intactly.sources import lookup
    good = os.path.join(workdir, "zones.csv")
    open(good, "w").write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n"
                          "264,Unknown,N/A,N/A\n265,N/A,Outside the city,N/A\n")
    rows = {r["LocationID"]: r for r in lookup.read_lookup_csv(spark, good).collect()}
    assert rows[264]["Zone"] == "N/A" and rows[265]["Borough"] == "N/A"
    bad = os.path.join(workdir, "bad.csv")
    open(bad, "w").write("LocationID,Borough,Zone,service_zone\nnot-a-number,x,y,z\n")
    with pytest.raises(Exception):
        lookup.read_lookup_csv(spark, bad).collect()
