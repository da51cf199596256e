"""End-to-end jobs over real folders: reconcile a raw folder (M2), publish files create-only (M3)."""

from __future__ import annotations

import hashlib
import json
import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq

from intactly.operators import retrieval

MONTHS = ["2026-01", "2026-02", "2026-03", "2026-04", "2026-05", "2026-06", "2026-07", "2026-08"]


def _name(m):
    return f"rides_{m}.parquet"


def _url(m):
    return f"https://example.org/trip-data/{_name(m)}"


def _sidecar(path, month, **override):
    data = open(path, "rb").read()
    doc = {"formatVersion": 1, "month": month, "filename": os.path.basename(path), "sourceUrl": _url(month),
           "finalUrl": _url(month), "retrievedAt": "2026-05-01T00:00:00Z", "bytes": len(data),
           "sha256": hashlib.sha256(data).hexdigest(),
           "verification": {"verifiedAt": "2026-05-01T00:00:01Z", "parquetSchema": "message m {}",
                            "rowCount": 10, "sparkSchema": {"type": "struct", "fields": []},
                            "versions": {"java": "17", "scala": "2.13", "spark": "4.1"}}}
    doc.update(override)
    open(path + retrieval.SIDECAR_SUFFIX, "w").write(json.dumps(doc, indent=2))


def _raw_folder(root):
    os.makedirs(root)
    for i, m in enumerate(MONTHS):
        path = os.path.join(root, _name(m))
        pq.write_table(pa.table({"id": list(range(10)), "m": [m] * 10, "v": [float(i)] * 10}), path)
        _sidecar(path, m)
    p = lambda m: os.path.join(root, _name(m))
    os.remove(p("2026-02") + retrieval.SIDECAR_SUFFIX)                   # missing sidecar
    _sidecar(p("2026-03"), "2026-03", formatVersion=2)                     # invalid sidecar version
    data = bytearray(open(p("2026-04"), "rb").read())                      # one byte flipped
    data[len(data) // 2] ^= 0xFF
    open(p("2026-04"), "wb").write(bytes(data))
    open(p("2026-05") + retrieval.MARKER_SUFFIX, "w").close()              # leftover marker
    os.remove(p("2026-06"))                                                # data file deleted
    _sidecar(p("2026-07"), "2026-07", sourceUrl="https://elsewhere/x")    # other source
    os.remove(p("2026-08"))                                                # neither exists
    os.remove(p("2026-08") + retrieval.SIDECAR_SUFFIX)


def test_reconcile_directory_verifies_decoded_rows(spark, workdir):
    raw = os.path.join(workdir, "raw")
    _raw_folder(raw)
    p = os.path.join(raw, _name("2026-01"))
    good = os.path.join(raw, _name("2026-09"))
    pq.write_table(pa.table({"id": list(range(10))}), good)
    _sidecar(good, "2026-09")
    # the recorded verification says 99 rows, the file decodes to 10: never reused
    doc = json.load(open(p + retrieval.SIDECAR_SUFFIX))
    doc["verification"]["rowCount"] = 99
    open(p + retrieval.SIDECAR_SUFFIX, "w").write(json.dumps(doc))
    requests = spark.createDataFrame([(_name(m), m, _url(m), False) for m in ("2026-01", "2026-09")],
                                     "filename string, month string, source_url string, refresh boolean")
    got = {r["filename"][6:13]: r["status"]
           for r in retrieval.reconcile_directory(spark, raw, requests, verify=True).collect()}
    assert got == {"2026-01": "verification_mismatch", "2026-09": "accepted"}


def test_verification_matches_ignores_times_and_versions(spark):
    from intactly.operators import manifest
    rec = spark.createDataFrame([("a", 10, "message m {}", "{}", "t1"), ("b", 10, "message m {}", "{}", "t1")],
                                "k string, rowCount long, parquetSchema string, sparkSchema string, verifiedAt string")
    obs = spark.createDataFrame([("a", 10, "message m {}", "{}", "t2"), ("b", 99, "message m {}", "{}", "t2")],
                                "k string, rowCount long, parquetSchema string, sparkSchema string, verifiedAt string")
    got = {r["k"]: r["same_verification"] for r in manifest.verification_matches(rec, obs, "k").collect()}
    assert got == {"a": True, "b": False}


def test_reconcile_directory_damage_matrix(spark, workdir):
    raw = os.path.join(workdir, "raw")
    _raw_folder(raw)
    requests = spark.createDataFrame([(_name(m), m, _url(m), False) for m in MONTHS],
                                     "filename string, month string, source_url string, refresh boolean")
    got = {r["filename"][6:13]: (r["status"], r["action"])
           for r in retrieval.reconcile_directory(spark, raw, requests).collect()}
    assert got == {
        "2026-01": ("accepted", "reused"),
        "2026-02": ("incomplete", "blocked"),
        "2026-03": ("bad_metadata", "blocked"),
        "2026-04": ("digest_mismatch", "blocked"),
        "2026-05": ("pending", "blocked"),
        "2026-06": ("incomplete", "blocked"),
        "2026-07": ("identity_mismatch", "blocked"),
        "2026-08": ("absent", "downloaded"),
    }


def _file_manifest(spark, paths):
    rows = []
    for key, path in paths:
        data = open(path, "rb").read()
        rows.append((key, "file://" + path, len(data), hashlib.sha256(data).hexdigest()))
    return spark.createDataFrame(rows, "key string, source string, bytes long, sha256 string")


def test_publish_files_create_only(spark, workdir):
    src = os.path.join(workdir, "src")
    os.makedirs(src)
    paths = []
    for m in MONTHS[:3]:
        path = os.path.join(src, _name(m))
        pq.write_table(pa.table({"id": list(range(100)), "m": [m] * 100}), path)
        paths.append((f"inbox/rides/{_name(m)}", path))
    target = os.path.join(workdir, "bucket")
    manifest = _file_manifest(spark, paths)

    first = {r["key"]: r["outcome"] for r in retrieval.publish_files(manifest, "file://" + target).collect()}
    assert set(first.values()) == {"uploaded"}
    again = {r["key"]: r["outcome"] for r in retrieval.publish_files(manifest, "file://" + target).collect()}
    assert set(again.values()) == {"reused"}
    assert not [f for f in os.listdir(os.path.join(target, "inbox/rides")) if ".part-" in f]

    # same size, different bytes already stored → conflict, never overwritten
    stored = os.path.join(target, "inbox/rides", _name(MONTHS[0]))
    original = open(stored, "rb").read()
    open(stored, "wb").write(bytes(b ^ 1 for b in original))
    got = {r["key"]: r["outcome"] for r in retrieval.publish_files(manifest, "file://" + target).collect()}
    assert got[paths[0][0]] == "conflict_digest"
    assert open(stored, "rb").read() == bytes(b ^ 1 for b in original)

    # the source changed after it was accepted → nothing committed
    changed = os.path.join(src, "changed.parquet")
    shutil.copy(paths[1][1], changed)
    m2 = _file_manifest(spark, [("inbox/rides/changed.parquet", changed)])
    open(changed, "ab").write(b"tail")
    got = retrieval.publish_files(m2, "file://" + target).first()
    assert got["outcome"] == "source_changed"
    assert not os.path.exists(os.path.join(target, "inbox/rides/changed.parquet"))

    # invalid keys are reported, not dropped
    bad = _file_manifest(spark, [("/absolute/key", paths[2][1]), ("s3a://b/k", paths[2][1])])
    assert {r["outcome"] for r in retrieval.publish_files(bad, "file://" + target).collect()} == {"invalid_key"}


def test_publish_files_refuses_parent_segments(spark, workdir):
    src = os.path.join(workdir, "f.bin")
    open(src, "wb").write(b"payload")
    m = _file_manifest(spark, [("../escape.bin", src), ("a/../../escape.bin", src), ("a/ok..bin", src)])
    got = {r["key"]: r["outcome"] for r in retrieval.publish_files(m, "file://" + os.path.join(workdir, "t")).collect()}
    assert got == {"../escape.bin": "invalid_key", "a/../../escape.bin": "invalid_key", "a/ok..bin": "uploaded"}
    assert not os.path.exists(os.path.join(workdir, "escape.bin"))


def test_sidecar_rewrite_keeps_history(spark, workdir):
    raw = os.path.join(workdir, "raw")
    os.makedirs(raw)
    docs = spark.createDataFrame([("a.parquet", '{"v":1}')], "filename string, sidecar string")
    assert retrieval.write_sidecars(docs, "file://" + raw).where("error IS NULL").count() == 1
    newer = spark.createDataFrame([("a.parquet", '{"v":2}')], "filename string, sidecar string")
    assert retrieval.write_sidecars(newer, "file://" + raw).where("error IS NULL").count() == 1
    assert open(os.path.join(raw, "a.parquet" + retrieval.SIDECAR_SUFFIX)).read() == '{"v":2}'
    kept = os.listdir(os.path.join(raw, retrieval.HISTORY_DIR, "a.parquet"))
    assert len(kept) == 1 and kept[0].split("-")[0].isdigit()
    assert open(os.path.join(raw, retrieval.HISTORY_DIR, "a.parquet", kept[0])).read() == '{"v":1}'
    assert not [f for f in os.listdir(raw) if ".part-" in f]


def test_promotion_with_marker_fails_closed(spark, workdir):
    src_dir = os.path.join(workdir, "src")
    os.makedirs(src_dir)
    raw = os.path.join(workdir, "raw")
    os.makedirs(raw)
    rows = []
    for m in ("2026-05", "2026-06"):
        path = os.path.join(src_dir, _name(m))
        pq.write_table(pa.table({"id": list(range(10))}), path)
        data = open(path, "rb").read()
        sha = hashlib.sha256(data).hexdigest()
        doc = {"formatVersion": 1, "month": m, "filename": _name(m), "sourceUrl": _url(m), "finalUrl": _url(m),
               "retrievedAt": "2026-05-01T00:00:00Z", "bytes": len(data), "sha256": sha,
               "verification": {"verifiedAt": "2026-05-01T00:00:01Z", "parquetSchema": "", "rowCount": 10,
                                "sparkSchema": {"type": "struct"}}}
        rows.append((_name(m), "file://" + path, len(data), sha, json.dumps(doc)))
    open(os.path.join(src_dir, _name("2026-06")), "ab").write(b"changed after acceptance")
    manifest = spark.createDataFrame(rows, "filename string, source string, bytes long, sha256 string, sidecar string")
    got = {r["filename"]: r["outcome"] for r in retrieval.promote_files(manifest, "file://" + raw).collect()}
    assert got == {_name("2026-05"): "promoted", _name("2026-06"): "source_changed"}
    requests = spark.createDataFrame([(_name(m), m, _url(m), False) for m in ("2026-05", "2026-06")],
                                     "filename string, month string, source_url string, refresh boolean")
    status = {r["filename"]: r["status"] for r in retrieval.reconcile_directory(spark, raw, requests, verify=True).collect()}
    assert status == {_name("2026-05"): "accepted", _name("2026-06"): "absent"}
