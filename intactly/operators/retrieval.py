"""Directory-level jobs: reconcile a raw folder (M2) and publish files create-only (M3).

Layout of a raw folder (as written by the retrieval step)::

    <file>                    data file, e.g. rides_2026-05.parquet
    <file>.metadata.json      provenance sidecar, format version 1
    <file>.pending            marker left by an unfinished promotion

All three are found with metadata-only listings; only data files are read
(streamed digests on executors) and only sidecars are parsed.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions import rules, schema, sidecar
from intactly.operators import integrity, manifest
from intactly.sources import files as file_sources
from intactly.sources.objects import claim

# Sidecar and marker suffixes, history folder.
SIDECAR_SUFFIX = ".metadata.json"
MARKER_SUFFIX = ".pending"
HISTORY_DIR = ".history"
COPY_CHUNK = 1 << 20

COPY_SCHEMA = ("key string, source string, target string, bytes long, sha256 string, "
               "outcome string, error string")


def _strip(col: str, suffix: str) -> F.Column:
    return F.expr(f"substring({col}, 1, length({col}) - {len(suffix)})")


SIDES_SCHEMA = ("filename string, rec_bytes long, rec_sha256 string, rec_identity string, "
                "metadata_ok boolean, rec_rows long, rec_parquet_schema string, rec_spark_schema string")


def _sidecars(spark: SparkSession, raw_dir: str, complete: bool = False) -> DataFrame:
    """Recorded provenance per data file; an empty folder gives an empty table."""
    listed = file_sources.existing_inventory(spark, raw_dir, f"*{SIDECAR_SUFFIX}")
    if listed.isEmpty():
        return spark.createDataFrame([], SIDES_SCHEMA)
    side_files = sidecar.read_sidecars(spark, f"{raw_dir.rstrip('/')}/*{SIDECAR_SUFFIX}", complete)
    return (side_files.withColumn("_name", F.element_at(F.split("path", "/"), -1))
            .select(_strip("_name", SIDECAR_SUFFIX).alias("filename"),
                    F.col("n_bytes").alias("rec_bytes"), F.col("s_sha256").alias("rec_sha256"),
                    F.concat_ws("|", "s_month", "s_filename", "s_source_url").alias("rec_identity"),
                    (F.size("reasons") == 0).alias("metadata_ok"), F.col("n_rows").alias("rec_rows"),
                    F.col("s_parquet_schema").alias("rec_parquet_schema"),
                    F.col("j_spark_schema").alias("rec_spark_schema")))


def reconcile_directory(spark: SparkSession, raw_dir: str, requests: DataFrame,
                        data_glob: str = "*.parquet", verify: bool = False, schemas: bool = False) -> DataFrame:
    """Status and action per requested file (M2).

    ``requests``: filename, month, source_url, refresh. Identity is the
    (month, filename, source URL) the sidecar records versus the request.
    With ``verify`` every requested data file is also fully decoded and reuse
    needs the decoded row count the sidecar recorded; an unreadable file
    never verifies. With ``schemas`` as well, sidecars must be complete and
    reuse needs both recorded schemas (``schema_changes`` names the paths).
    """
    wanted_names = requests.select("filename").distinct()
    inv = file_sources.existing_inventory(spark, raw_dir, data_glob).join(wanted_names, "filename", "left_semi")
    digests = file_sources.file_digests(inv)  # only requested files are read
    data = (digests.withColumn("filename", F.element_at(F.split("path", "/"), -1))
            .select("filename", "bytes", "sha256"))
    sides = _sidecars(spark, raw_dir, schemas)
    markers = (file_sources.existing_inventory(spark, raw_dir, f"*{MARKER_SUFFIX}")
               .select(_strip("filename", MARKER_SUFFIX).alias("filename")))
    wanted = requests.select("filename", "refresh",
                             F.concat_ws("|", "month", "filename", "source_url").alias("identity"))
    files = data.join(wanted.select("filename", "identity"), "filename", "inner")
    if verify or schemas:
        ok = F.col("status") == integrity.STATUS_OK
        decoded = integrity.verify_files(inv).select("filename", F.when(ok, F.col("decoded_rows")).alias("rows"), *[
            F.when(ok, F.col(c)).alias(c) for c in ("parquet_schema", "spark_schema")])
        files = files.join(decoded, "filename", "left")
    return manifest.reconcile(wanted.drop("identity"), files, sides, markers, "filename", verify, schemas)


def schema_changes(spark: SparkSession, raw_dir: str, data_glob: str = "*.parquet") -> DataFrame:
    """filename, path, change, recorded_type and observed_type where a file's schema is not the recorded one."""
    inv = file_sources.existing_inventory(spark, raw_dir, data_glob)
    observed = integrity.verify_files(inv).select("filename", F.col("spark_schema").alias("observed"))
    recorded = _sidecars(spark, raw_dir).select("filename", F.col("rec_spark_schema").alias("recorded"))
    return schema.differences(observed.join(recorded, "filename"), "filename")


def _copy_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs
    for pdf in batches:
        out = []
        for key, source, target, size, sha in pdf[["key", "source", "target", "bytes", "sha256"]] \
                .itertuples(index=False):
            outcome, error, part = None, None, None
            try:
                tfs, tpath = fs.FileSystem.from_uri(target)
                info = tfs.get_file_info(tpath)
                if info.type == fs.FileType.NotFound:
                    sfs, spath = fs.FileSystem.from_uri(source)
                    part = f"{tpath}.part-{uuid.uuid4().hex}"
                    tfs.create_dir(tpath.rsplit("/", 1)[0], recursive=True)
                    h, n = hashlib.sha256(), 0
                    with sfs.open_input_stream(spath) as src, tfs.open_output_stream(part) as dst:
                        while chunk := src.read(COPY_CHUNK):
                            h.update(chunk)
                            n += len(chunk)
                            dst.write(chunk)
                    if (n, h.hexdigest()) != (size, sha):
                        tfs.delete_file(part)
                        outcome = "source_changed"  # nothing committed, not retried
                    elif tfs.get_file_info(tpath).type != fs.FileType.NotFound:
                        tfs.delete_file(part)       # another writer won; judged below
                    else:
                        outcome = "uploaded" if claim(tfs, part, tpath) else None
                if outcome in (None, "uploaded"):
                    # independent read-back: size first, then a full digest
                    stored = tfs.get_file_info(tpath)
                    if stored.size != size:
                        outcome = "conflict_size"
                    else:
                        h = hashlib.sha256()
                        with tfs.open_input_stream(tpath) as back:
                            while chunk := back.read(COPY_CHUNK):
                                h.update(chunk)
                        if h.hexdigest() != sha:
                            outcome = "conflict_digest"
                        elif outcome is None:
                            outcome = "reused"
            except Exception as exc:  # one failing object does not stop the others
                outcome, error = "failed", f"{type(exc).__name__}: {exc}"
                if part:
                    _drop(tfs, part)
            out.append((key, source, target, size, sha, outcome, error))
        yield pd.DataFrame(out, columns=["key", "source", "target", "bytes", "sha256", "outcome", "error"])


def publish_files(manifest_df: DataFrame, target_root: str) -> DataFrame:
    """Create-only copy of files into ``target_root/<key>`` with read-back verification.

    ``manifest_df``: key, source (URI), bytes, sha256 as recorded when the
    file was accepted. The copy digests while copying and commits (renames)
    only when the bytes match the manifest; existing objects are never
    replaced. The commit is an exclusive create (``objects.claim``); stores
    whose move replaces are refused.
    """
    key_ok = F.coalesce(rules.all_pass(rules.relative_path_rules(F.col("key"))), F.lit(False))
    cols = ["key", "source", "target", "bytes", "sha256"]
    work = manifest_df.withColumn(
        "target", F.concat(F.lit(target_root.rstrip("/") + "/"), F.col("key"))).withColumn("_ok", key_ok)
    copied = (file_sources.spread(work.where("_ok").select(*cols), "key")
              .mapInPandas(_copy_partition, COPY_SCHEMA))
    # Invalid keys are reported, never dropped and never written.
    rejected = work.where("NOT _ok").select(*cols, F.lit("invalid_key").alias("outcome"),
                                            F.lit(None).cast("string").alias("error"))
    return copied.unionByName(rejected)


SIDECAR_WRITE_SCHEMA = "filename string, sidecar string, error string"


def _write_sidecar(filesystem, root: str, name: str, doc: str) -> None:
    """Replaces ``<name>.metadata.json``, keeping the previous document under ``.history``."""
    from pyarrow import fs
    path = f"{root}/{name}{SIDECAR_SUFFIX}"
    if filesystem.get_file_info(path).type == fs.FileType.File:
        # keep the previous document (even a malformed one) before replacing it
        keep = f"{root}/{HISTORY_DIR}/{name}/{int(time.time() * 1000)}-{uuid.uuid4().hex}.json"
        filesystem.create_dir(keep.rsplit("/", 1)[0], recursive=True)
        filesystem.copy_file(path, keep)
    part = f"{path}.part-{uuid.uuid4().hex}"
    try:
        with filesystem.open_output_stream(part) as dst:
            dst.write(doc.encode("utf-8"))
        filesystem.move(part, path)
    except Exception:
        _drop(filesystem, part)
        raise


def _checked_name(name: str) -> None:
    """Refuses a name that is empty or could leave its root."""
    if not name or name.startswith("/") or any(part in ("", ".", "..") for part in name.split("/")):
        raise ValueError(f"not a file name under the root: {name!r}")


def _drop(filesystem, path: str) -> None:
    """Removes a part file if it is there."""
    try:
        filesystem.delete_file(path)
    except OSError:
        pass


def _sidecar_partition(batches: Iterator[pd.DataFrame], raw_root: str) -> Iterator[pd.DataFrame]:
    from pyarrow import fs
    filesystem, base = fs.FileSystem.from_uri(raw_root)
    for pdf in batches:
        out = []
        for name, doc in pdf[["filename", "sidecar"]].itertuples(index=False):
            error = None
            try:
                _checked_name(name)
                _write_sidecar(filesystem, base.rstrip("/"), name, doc)
            except Exception as exc:
                error = f"{type(exc).__name__}: {exc}"
            out.append((name, doc, error))
        yield pd.DataFrame(out, columns=["filename", "sidecar", "error"])


def write_sidecars(docs: DataFrame, raw_root: str) -> DataFrame:
    """Writes one sidecar file per data file (``filename``, ``sidecar`` JSON text), on executors.

    A sidecar being replaced is first copied to
    ``.history/<file>/<epoch-millis>-<uuid>.json``; the new document is
    written beside it and moved into place. Returns one row per sidecar
    with the write error, if any.
    """
    return (file_sources.spread(docs.select("filename", "sidecar"), "filename")
            .mapInPandas(lambda it: _sidecar_partition(it, raw_root), SIDECAR_WRITE_SCHEMA))


PROMOTE_SCHEMA = "filename string, outcome string, error string"


def _promote_partition(batches: Iterator[pd.DataFrame], raw_root: str) -> Iterator[pd.DataFrame]:
    from pyarrow import fs
    filesystem, base = fs.FileSystem.from_uri(raw_root)
    root = base.rstrip("/")
    filesystem.create_dir(root, recursive=True)
    for pdf in batches:
        out = []
        for name, source, size, sha, doc in pdf[["filename", "source", "bytes", "sha256", "sidecar"]] \
                .itertuples(index=False):
            final, marker = f"{root}/{name}", f"{root}/{name}{MARKER_SUFFIX}"
            part = f"{final}.part-{uuid.uuid4().hex}"
            try:
                _checked_name(name)
                sfs, spath = fs.FileSystem.from_uri(source)
                h, n = hashlib.sha256(), 0                 # 1. a checked copy beside the accepted pair
                with sfs.open_input_stream(spath) as src, filesystem.open_output_stream(part) as dst:
                    while chunk := src.read(COPY_CHUNK):
                        h.update(chunk)
                        n += len(chunk)
                        dst.write(chunk)
                if (n, h.hexdigest()) != (size, sha):
                    filesystem.delete_file(part)
                    out.append((name, "source_changed", None))  # the accepted pair is untouched
                    continue
                with filesystem.open_output_stream(marker):
                    pass                                   # 2. the marker guards the two moves
                filesystem.move(part, final)               # 3. data
                _write_sidecar(filesystem, root, name, doc)  # 4. metadata (history kept)
                filesystem.delete_file(marker)             # 5. clear the marker
                out.append((name, "promoted", None))
            except Exception as exc:
                _drop(filesystem, part)
                out.append((name, "failed", f"{type(exc).__name__}: {exc}"))
        yield pd.DataFrame(out, columns=["filename", "outcome", "error"])


def promote_files(manifest_df: DataFrame, raw_root: str) -> DataFrame:
    """Two-step promotion into a raw folder with a marker (B6), one file per work item.

    ``manifest_df``: filename, source (URI), bytes, sha256, sidecar (JSON).
    Order per file: copy and check the bytes beside the accepted pair →
    write ``<file>.pending`` → move the data into place → write the sidecar
    (previous one kept) → remove the marker. A bad source leaves the accepted
    pair as it is; a failure between the two moves leaves the marker, so the
    pair is reported 'pending' and never reused until it is refreshed. Names
    that could leave the root are refused.
    """
    work = file_sources.spread(manifest_df.select("filename", "source", "bytes", "sha256", "sidecar"), "filename")
    return work.mapInPandas(lambda it: _promote_partition(it, raw_root), PROMOTE_SCHEMA)
