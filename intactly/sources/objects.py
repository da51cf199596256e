"""Objects and receipts as transactional sinks, through the Python Data Source API.

A sink's tasks do the work and report it in commit messages; only the
driver's commit makes it count. Names under the root::

    <key>                                an object, created once, never replaced
    _runs/<run>/part-*.json              what one task attempt did, a line per item
    _runs/<run>/committed.json           the parts of a run that was committed
    receipts/<id>/part-*.json            entries of a receipt, a line per object
    receipts/<id>/receipt.json           written last: without it there is no receipt

Objects are created exclusively: a copy goes beside its key, is compared
with its recorded size and digest on the way, and takes the key only if no
one else has. Then it is read back. A task attempt that is lost or repeated
leaves objects that the next attempt finds as its own bytes ('reused'), and
a part that no commit names.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from intactly.sources.files import CHUNK_BYTES, _open

# Folders and file names of the layout above.
RUNS, RECEIPTS, COMMITTED, RECEIPT = "_runs", "receipts", "committed.json", "receipt.json"
PROVENANCE = "provenance"
ITEM_SCHEMA = "key string, source string, bytes long, sha256 string, provenance string"
DONE_SCHEMA = ("key string, bytes long, sha256 string, action string, provenance_key string, provenance_bytes long, "
               "provenance_sha256 string, provenance_action string, error string")
ENTRY_SCHEMA = "entry string, accepted boolean"


class SourceChanged(Exception):
    """The bytes copied are not those recorded; nothing is committed and nothing is tried again."""


class Conflict(Exception):
    """Another object has the key."""


def hidden(text: str, secrets: Sequence[str]) -> str:
    """``text`` without the secrets, longest first."""
    for secret in sorted(filter(None, secrets), key=len, reverse=True):
        text = text.replace(secret, "***")
    return text


def claim(filesystem, part: str, final: str) -> bool:
    """Gives ``part`` the name ``final`` unless that exists; False when someone else has it.

    A hard link (local) and a rename within HDFS never replace a file. Stores
    whose move replaces are refused.
    """
    from pyarrow import fs
    if isinstance(filesystem, fs.LocalFileSystem):
        try:
            os.link(part, final)
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
        return True
    if isinstance(filesystem, fs.HadoopFileSystem):
        try:
            filesystem.move(part, final)
        except OSError:
            if filesystem.get_file_info(final).type == fs.FileType.NotFound:
                raise
            filesystem.delete_file(part)
            return False
        return True
    raise NotImplementedError(f"{filesystem.type_name} has no exclusive create; publish to local or HDFS storage")


def digest_of(filesystem, path: str) -> tuple[int, str]:
    size, sha = 0, hashlib.sha256()
    with filesystem.open_input_stream(path) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            size += len(chunk)
            sha.update(chunk)
    return size, sha.hexdigest()


def put(root: str, key: str, chunks: Iterator[bytes], size: int, sha256: str) -> str:
    """Creates an object or finds it there, and reads it back: 'uploaded' or 'reused'. Raises on anything else."""
    from pyarrow import fs
    filesystem, base = _open(f"{root.rstrip('/')}/{key}")
    action = "reused"
    if filesystem.get_file_info(base).type == fs.FileType.NotFound:
        filesystem.create_dir(base.rsplit("/", 1)[0], recursive=True)
        part = f"{base}.part-{uuid.uuid4().hex}"
        try:
            n, sha = 0, hashlib.sha256()
            with filesystem.open_output_stream(part) as out:
                for chunk in chunks:
                    n += len(chunk)
                    sha.update(chunk)
                    out.write(chunk)
            if (n, sha.hexdigest()) != (size, sha256):
                raise SourceChanged(f"copied {n} bytes that are not the recorded ones")
            action = "uploaded" if claim(filesystem, part, base) else "reused"
        finally:
            if filesystem.get_file_info(part).type != fs.FileType.NotFound:
                filesystem.delete_file(part)
    there, sha = digest_of(filesystem, base)
    if there != size:
        raise Conflict("stored object has another size")
    if sha != sha256:
        raise Conflict("stored object has another digest")
    return action


def _chunks(source: str) -> Iterator[bytes]:
    filesystem, path = _open(source)
    with filesystem.open_input_stream(path) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            yield chunk


def _write_once(path: str, text: str) -> None:
    """Creates a small file; raises if it exists."""
    filesystem, base = _open(path)
    filesystem.create_dir(base.rsplit("/", 1)[0], recursive=True)
    part = f"{base}.part-{uuid.uuid4().hex}"
    with filesystem.open_output_stream(part) as out:
        out.write(text.encode("utf-8"))
    if not claim(filesystem, part, base):
        raise FileExistsError(path)


@dataclass
class TaskDone(WriterCommitMessage):
    """What a task attempt wrote: its part, the lines in it, how many of them failed, bytes and digest."""
    part: str
    lines: int
    failed: int
    bytes: int
    sha256: str


class _PartWriter(DataSourceWriter):
    """Writes a part of JSON lines per task attempt; a subclass makes the lines and the commit."""

    def __init__(self, options: dict[str, str]):
        self.root, self.run = options["root"].rstrip("/"), options["run"]
        self.secrets = json.loads(options.get("secrets", "[]"))

    folder = RUNS

    def line(self, row: Row) -> tuple[str, bool]:
        raise NotImplementedError

    def write(self, iterator: Iterator[Row]) -> TaskDone:
        name = f"part-{uuid.uuid4().hex}.json"
        filesystem, base = _open(f"{self.root}/{self.folder}/{self.run}/{name}")
        filesystem.create_dir(base.rsplit("/", 1)[0], recursive=True)
        lines = failed = 0
        with filesystem.open_output_stream(base) as out:
            for row in iterator:
                text, ok = self.line(row)
                out.write(text.encode("utf-8") + b"\n")
                lines, failed = lines + 1, failed + (not ok)
        size, sha = digest_of(filesystem, base)
        return TaskDone(name, lines, failed, size, sha)

    def abort(self, messages: list[TaskDone | None]) -> None:
        """Drops the parts; objects that were accepted stay for the next run, as nothing is undone across objects."""
        from pyarrow import fs
        filesystem, base = _open(f"{self.root}/{self.folder}/{self.run}")
        if filesystem.get_file_info(base).type != fs.FileType.NotFound:
            filesystem.delete_dir(base)


class ObjectWriter(_PartWriter):
    """Publishes the object of each row, then its provenance under the provenance's own digest."""

    def line(self, row: Row) -> tuple[str, bool]:
        done = dict(key=row["key"], bytes=row["bytes"], sha256=row["sha256"], action="failed", provenance_key=None,
                    provenance_bytes=None, provenance_sha256=None, provenance_action=None, error=None)
        try:
            done["action"] = put(self.root, row["key"], _chunks(row["source"]), row["bytes"], row["sha256"])
            if row["provenance"] is not None:
                text = row["provenance"].encode("utf-8")
                sha = hashlib.sha256(text).hexdigest()
                done |= dict(provenance_key=f"{PROVENANCE}/{row['key']}/{sha}.json", provenance_bytes=len(text),
                             provenance_sha256=sha, provenance_action="failed")
                done["provenance_action"] = put(self.root, done["provenance_key"], iter([text]), len(text), sha)
        except PermissionError:
            raise  # denied access stops the whole run
        except Exception as exc:  # one failing object does not stop the others
            kind = {SourceChanged: "source_changed", Conflict: "conflict"}.get(type(exc), "failed")
            done["action"] = kind if done["provenance_key"] is None else done["action"]
            done["error"] = hidden(f"{type(exc).__name__}: {exc}", self.secrets)
        return json.dumps(done), done["error"] is None

    def commit(self, messages: list[TaskDone | None]) -> None:
        parts = [m.part for m in messages if m is not None]
        _write_once(f"{self.root}/{RUNS}/{self.run}/{COMMITTED}", json.dumps({"parts": parts}))


class ReceiptWriter(_PartWriter):
    """Writes entries, and the receipt that names them only if every one is accepted."""

    folder = RECEIPTS

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.header = json.loads(options["header"])

    def line(self, row: Row) -> tuple[str, bool]:
        return row["entry"], bool(row["accepted"])

    def commit(self, messages: list[TaskDone | None]) -> None:
        done = [m for m in messages if m is not None and m.lines]
        if failed := sum(m.failed for m in done):
            raise ValueError(f"{failed} objects were not accepted: no receipt")  # Spark aborts: the parts go
        objects = {"count": sum(m.lines for m in done),
                   "parts": [{"name": m.part, "entries": m.lines, "bytes": m.bytes, "sha256": m.sha256} for m in done]}
        head = {**self.header, "objects": objects, "publicationId": self.run}
        _write_once(f"{self.root}/{RECEIPTS}/{self.run}/{RECEIPT}", json.dumps(head, indent=2))


class ObjectSink(DataSource):
    """``intactly_objects``: rows of ``ITEM_SCHEMA``; options root, run and secrets (a JSON list)."""

    @classmethod
    def name(cls) -> str:
        return "intactly_objects"

    def schema(self) -> str:
        return ITEM_SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("objects are never overwritten: write with mode append")
        return ObjectWriter(dict(self.options))


class ReceiptSink(DataSource):
    """``intactly_receipt``: rows of ``ENTRY_SCHEMA``; options root, run (the receipt's id) and header (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "intactly_receipt"

    def schema(self) -> str:
        return ENTRY_SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("receipts are never overwritten: write with mode append")
        return ReceiptWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ObjectSink)
    spark.dataSource.register(ReceiptSink)


def _head(path: str) -> dict:
    filesystem, base = _open(path)
    with filesystem.open_input_stream(base) as stream:
        return json.loads(stream.read())


def committed(spark: SparkSession, root: str, run: str) -> DataFrame:
    """What a committed run did, a row per item (``DONE_SCHEMA``); raises if the run was not committed."""
    folder = f"{root.rstrip('/')}/{RUNS}/{run}"
    parts = [f"{folder}/{p}" for p in _head(f"{folder}/{COMMITTED}")["parts"]]
    return spark.read.schema(DONE_SCHEMA).json(parts) if parts else spark.createDataFrame([], DONE_SCHEMA)


def receipt(root: str, receipt_id: str) -> dict:
    """The head of a receipt; raises if there is none."""
    return _head(f"{root.rstrip('/')}/{RECEIPTS}/{receipt_id}/{RECEIPT}")


def receipt_entries(spark: SparkSession, root: str, receipt_id: str) -> DataFrame:
    """The entries that a receipt names, as JSON text in column ``value``."""
    folder = f"{root.rstrip('/')}/{RECEIPTS}/{receipt_id}"
    parts = [f"{folder}/{p['name']}" for p in receipt(root, receipt_id)["objects"]["parts"]]
    return spark.read.text(parts) if parts else spark.createDataFrame([], "value string")
