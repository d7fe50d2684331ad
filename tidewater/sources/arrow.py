"""Arrow IPC files as a Spark data source (Python Data Source API).

Paths may be local or URIs of a store that ``pyarrow.fs`` opens (``file://``,
``hdfs://``, ``s3://``, ``gs://``); several are separated by commas, the last
part may hold wildcards.

Read: the driver lists names and sizes and opens no file but the first (for the
schema).  A file of more than ``SPLIT_BYTES`` is read by several tasks, each taking its
share of the record batches after reading the footer itself.  Columns are taken by name:
a file that lacks one gives NULL, one with another type is refused.
``merged_schema`` finds the columns of many files in one job.

Write: tasks write files that nobody names yet; the commit creates a manifest with
the job's files in one step, and readers of the folder follow the newest manifest.
So a reader sees the table before or after a write, and a failed write changes nothing.
Files are kept while one of the last ``KEPT`` manifests names them, for readers that
began before the last overwrite.

Register once per session with ``register_arrow(spark)``; then
``spark.read.format("arrowipc").load(path_or_glob)`` and
``df.write.format("arrowipc").mode("overwrite").save(folder)``.
"""

from __future__ import annotations

import fnmatch
import json
import os
import posixpath
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StringType, StructField, StructType

FORMAT = "arrowipc"
SPLIT_BYTES = 64 << 20
FILE_COLUMN = "source_file"
MANIFEST = "_manifest-"
KEPT = 2


def _store(path: str):
    """(file system, path in it) of a local path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def _manifests(store, root: str) -> list[str]:
    """Paths of a folder's manifests, the oldest first."""
    from pyarrow import fs

    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.base_name.startswith(MANIFEST))


def _manifest(store, path: str) -> dict:
    with store.open_input_stream(path) as f:
        return json.loads(f.read())


def _listed(path: str) -> list[tuple[str, int]]:
    """Path and size of the file itself, of the files of a folder's manifest (without one: its
    ``.arrow`` files), or of what a pattern matches."""
    from pyarrow import fs

    store, inner = _store(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    whole = info.type == fs.FileType.Directory
    folder, pattern = (path, "*.arrow") if whole else posixpath.split(path)
    store, inner = _store(folder)
    found = store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    files = {f.base_name: f.size for f in found if f.type == fs.FileType.File}
    marks = sorted(n for n in files if n.startswith(MANIFEST))
    if marks:  # of the files beside a manifest only those it names are the table
        named = set(_manifest(store, f"{inner}/{marks[-1]}")["files"])
        files = {n: size for n, size in files.items() if n in named}
    return [(f"{folder.rstrip('/')}/{n}", files[n]) for n in sorted(files) if fnmatch.fnmatch(n, pattern)]


def _files(path: str) -> list[tuple[str, int]]:
    return [f for part in path.split(",") for f in _listed(part.strip())]


def _written_schema(path: str):
    """The schema in a folder's newest manifest, if there is one."""
    import pyarrow as pa

    store, inner = _store(path)
    marks = _manifests(store, inner)
    return pa.ipc.read_schema(pa.py_buffer(bytes.fromhex(_manifest(store, marks[-1])["schema"]))) if marks else None


def _open(path: str):
    """(reader, is a file with random access)."""
    import pyarrow as pa
    import pyarrow.ipc as ipc

    store, inner = _store(path)
    try:
        return ipc.open_file(store.open_input_file(inner)), True
    except pa.ArrowInvalid:
        return ipc.open_stream(store.open_input_stream(inner)), False


class _Share(InputPartition):
    """The ``part``-th of ``parts`` shares of a file's record batches."""

    def __init__(self, path: str, part: int, parts: int):
        super().__init__(path)
        self.path, self.part, self.parts = path, part, parts


def conformed(batch, names: list[str], types: list, path: str):
    """The batch with these columns, NULL where it has none; another type is an error."""
    import pyarrow as pa

    columns = []
    for name, kind in zip(names, types, strict=True):
        at = batch.schema.get_field_index(name)
        if at < 0:
            columns.append(pa.nulls(batch.num_rows, kind))
        elif batch.schema.field(at).type.equals(kind) or _widens(batch.schema.field(at).type, kind):
            columns.append(batch.column(at).cast(kind))
        else:
            raise ValueError(f"{path} has another schema: {name} is {batch.schema.field(at).type}, not {kind}")
    return columns


def _widens(found, wanted) -> bool:
    """The same values in another layout, such as large strings or other time units."""
    import pyarrow.types as t

    for same in (t.is_string, t.is_binary, t.is_timestamp):
        large = {t.is_string: t.is_large_string, t.is_binary: t.is_large_binary}.get(same, same)
        if (same(found) or large(found)) and (same(wanted) or large(wanted)):
            return True
    if t.is_null(found):
        return True
    if t.is_nested(found) and type(found) is type(wanted):
        return True
    return t.is_integer(found) and t.is_integer(wanted) and found.bit_width <= wanted.bit_width


class ArrowReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], schema: StructType, with_file: bool):
        self.files, self.schema, self.with_file = files, schema, with_file

    def partitions(self):
        shares = []
        for path, size in self.files:
            parts = max(1, -(-size // SPLIT_BYTES))
            shares += [_Share(path, i, parts) for i in range(parts)]
        return shares or [_Share("", 0, 1)]

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.path:  # a table without files
            return
        schema = to_arrow_schema(self.schema)
        names = [n for n in schema.names if not (self.with_file and n == FILE_COLUMN)]
        types = [schema.field(n).type for n in names]
        reader, random_access = _open(partition.path)
        if random_access:
            n, i, parts = reader.num_record_batches, partition.part, partition.parts
            batches = (reader.get_batch(j) for j in range(n * i // parts, n * (i + 1) // parts))
        else:  # a stream is read from its start, by its first share
            batches = reader if partition.part == 0 else ()
        for batch in batches:
            columns = conformed(batch, names, types, partition.path)
            if self.with_file:
                columns.append(pa.array([partition.path] * batch.num_rows, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *([FILE_COLUMN] if self.with_file else [])])


@dataclass
class _Written(WriterCommitMessage):
    name: str
    rows: int


class ArrowWriter(DataSourceArrowWriter):
    """Task attempts write files under the job's own name; the commit's manifest makes them the table."""

    def __init__(self, folder: str, schema: StructType, compression: str | None, overwrite: bool):
        self.folder, self.compression, self.overwrite = folder.rstrip("/"), compression, overwrite
        self.schema = schema
        self.job = uuid.uuid4().hex

    def _options(self):
        import pyarrow.ipc as ipc

        return ipc.IpcWriteOptions(compression=self.compression) if self.compression else None

    def commit(self, messages):
        from pyspark.sql.pandas.types import to_arrow_schema

        store, root = _store(self.folder)
        store.create_dir(root, recursive=True)
        marks = _manifests(store, root)
        files = sorted(m.name for m in messages if m is not None and m.name)
        if not self.overwrite:
            files = [posixpath.basename(f) for f, _ in _listed(self.folder)] + files if marks else self._unnamed(store, root) + files
        number = int(posixpath.basename(marks[-1])[len(MANIFEST) :].split(".")[0]) + 1 if marks else 1
        content = {"files": files, "schema": to_arrow_schema(self.schema).serialize().to_pybytes().hex()}
        draft = f"{root}/_draft-{self.job}"
        with store.open_output_stream(draft) as f:
            f.write(json.dumps(content).encode())
        store.move(draft, f"{root}/{MANIFEST}{number:010d}.json")
        self._clean(store, root, named_by_attempts={m.name for m in messages if m is not None})

    def _unnamed(self, store, root: str) -> list[str]:
        """Files of a folder without a manifest, written by other means."""
        from pyarrow import fs

        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".arrow") and self.job not in f.base_name)

    def _clean(self, store, root: str, named_by_attempts: set[str]) -> None:
        """Delete what only older manifests name, and files of this job's failed attempts."""
        marks = _manifests(store, root)
        kept = {n for m in marks[-KEPT:] for n in _manifest(store, m)["files"]}
        old = {n for m in marks[:-KEPT] for n in _manifest(store, m)["files"]} - kept
        from pyarrow import fs

        for f in store.get_file_info(fs.FileSelector(root)):
            if f.base_name in old or (self.job in f.base_name and f.base_name not in named_by_attempts):
                store.delete_file(f.path)
        for m in marks[:-KEPT]:
            store.delete_file(m)

    def abort(self, messages):
        from pyarrow import fs

        store, root = _store(self.folder)
        for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if self.job in f.base_name:
                store.delete_file(f.path)

    def write(self, iterator):
        import pyarrow.ipc as ipc
        from pyspark import TaskContext

        store, root = _store(self.folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{self.job}-{TaskContext.get().taskAttemptId()}.arrow"
        rows, writer = 0, None
        for batch in iterator:
            if writer is None:
                store.create_dir(root, recursive=True)
                sink = store.open_output_stream(f"{root}/{name}")
                writer = ipc.new_file(sink, batch.schema, options=self._options())
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
            sink.close()
        return _Written(name if writer is not None else "", rows)


class ArrowDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def _with_file(self) -> bool:
        return self.options.get("with_file", "false") == "true"

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        path = self.options.get("path", "")
        files = _files(path)
        found = _open(files[0][0])[0].schema if files else None if "," in path else _written_schema(path)
        if found is None:
            raise FileNotFoundError(f"no Arrow files at {path!r}")
        schema = from_arrow_schema(found)
        return StructType([*schema.fields, StructField(FILE_COLUMN, StringType())]) if self._with_file() else schema

    def reader(self, schema: StructType):
        return ArrowReader(_files(self.options.get("path", "")), schema, self._with_file())

    def writer(self, schema: StructType, overwrite: bool):
        return ArrowWriter(self.options["path"], schema, self.options.get("compression"), overwrite)


def register_arrow(spark: SparkSession) -> None:
    """Make ``format("arrowipc")`` available in this session."""
    spark.dataSource.register(ArrowDataSource)


def merged_schema(spark: SparkSession, path: str) -> StructType:
    """All columns of the files at ``path``, in order of first appearance by file name.

    Footers are read by tasks; the driver receives the distinct schemas.  Two files
    that give a column different types are an error.
    """
    import pyarrow as pa
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import from_arrow_schema

    files = [(f,) for f, _ in _files(path)]
    if not files:
        found = None if "," in path else _written_schema(path)
        if found is None:
            raise FileNotFoundError(f"no Arrow files at {path!r}")
        return from_arrow_schema(found)

    def footers(batches):
        for batch in batches:
            paths = batch.column("path").to_pylist()
            schemas = [_open(p)[0].schema.remove_metadata().serialize().to_pybytes() for p in paths]
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(schemas, pa.binary())], names=["path", "schema"])

    tasks = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame(files, "path string").repartition(tasks).mapInArrow(footers, "path string, schema binary")
    kinds = sorted((r["path"], bytes(r["schema"])) for r in rows.groupBy("schema").agg(F.min("path").alias("path")).collect())
    fields: dict[str, pa.Field] = {}
    for name, data in kinds:
        for f in pa.ipc.read_schema(pa.py_buffer(data)):
            if f.name in fields and not f.type.equals(fields[f.name].type) and not _widens(f.type, fields[f.name].type):
                raise ValueError(f"{name} has another schema: {f.name} is {f.type}, not {fields[f.name].type}")
            fields.setdefault(f.name, f.with_nullable(True))
    return from_arrow_schema(pa.schema(fields.values()))
