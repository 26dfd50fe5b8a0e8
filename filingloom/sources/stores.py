"""Data sources of their own: folders of reports, and a store of pages, with writes that count as a whole or not at all.

Both list and read in tasks, through any file system that Arrow knows by its address (a local or shared folder, HDFS, the
object stores); only the names of the top folders, or of the commits, are listed by the driver.

`reports`: files below `<ticker> - <company>` folders, each with its folder's `_metadata.json`. Filters on ticker and folder
leave folders unread. A write makes a folder whole in the task that has it (deal the rows by folder first) below a staging
folder; the commit moves each into place, one move a folder, and an abort removes the staging folder.

`pages`: rows of any columns in Parquet segments. A write has a folder, and a task a segment of its own name there; the
commit is one small file that names them, and only named segments are read. An abort removes the write's folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs as afs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

REPORT = "file_path string, folder string, file_name string, ticker string, size long, metadata string, content binary"
NOTES = "_metadata.json"
#: Folders that a task reads, and rows of files that it gives on at once.
FOLDERS, ROWS = 64, 64


def opened(path: str) -> tuple[afs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return afs.FileSystem.from_uri(path) if "://" in path else (afs.LocalFileSystem(), path)


def _listed(files: afs.FileSystem, path: str, recursive: bool = False) -> list[afs.FileInfo]:
    return sorted(files.get_file_info(afs.FileSelector(path, recursive=recursive, allow_not_found=True)), key=lambda i: i.path)


def _read(files: afs.FileSystem, path: str) -> bytes:
    with files.open_input_stream(path) as f:
        return f.read()


def _put(files: afs.FileSystem, path: str, body: bytes) -> None:
    with files.open_output_stream(path) as f:
        f.write(body)


def ticker_of(folder: str) -> str:
    return folder.split(" - ")[0].strip()


@dataclass
class Some(InputPartition):
    """Paths that a task reads; deep: with the folders below."""

    paths: list[str]
    deep: bool = True


@dataclass
class Wrote(WriterCommitMessage):
    paths: list[str]


class Reports(DataSource):
    """options: path; suffix (.pdf); content (false): whether the files themselves are read."""

    @classmethod
    def name(cls) -> str:
        return "reports"

    def schema(self) -> str:
        return REPORT

    def reader(self, schema) -> DataSourceReader:
        return ReportReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ReportWriter(self.options, overwrite)


class ReportReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.suffix = options["path"].rstrip("/"), options.get("suffix", ".pdf").lower()
        self.content = options.get("content", "false").lower() == "true"
        self.tests: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute in (("ticker",), ("folder",)):
                self.tests.append((f.attribute[0], frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            yield f  # a nested folder may have another name, so Spark looks at the rows again

    def wanted(self, folder: str) -> bool:
        return all((ticker_of(folder) if name == "ticker" else folder) in values for name, values in self.tests)

    def partitions(self) -> list[InputPartition]:
        files, root = opened(self.path)
        top = [i.path for i in _listed(files, root) if i.type == afs.FileType.Directory and not i.base_name.startswith(("_", "."))]
        # below a top folder others may lie, so one is left out only if it holds none
        deep = [p for p in top if self.wanted(p.rsplit("/", 1)[-1]) or any(i.type == afs.FileType.Directory for i in _listed(files, p))] if self.tests else top
        return [Some([root], False), *(Some(deep[k : k + FOLDERS]) for k in range(0, len(deep), FOLDERS))]

    def read(self, partition: Some) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.path)
        rows: list[tuple] = []
        for path in partition.paths:
            notes: dict[str, str | None] = {}
            for i in _listed(files, path, partition.deep):
                at, name = i.path.rsplit("/", 1)
                folder = at.rsplit("/", 1)[-1]
                if i.type != afs.FileType.File or not name.lower().endswith(self.suffix) or name.startswith(("_", ".")) or not self.wanted(folder):
                    continue
                if at not in notes:
                    there = files.get_file_info(f"{at}/{NOTES}").type == afs.FileType.File
                    notes[at] = _read(files, f"{at}/{NOTES}").decode("utf-8", "replace") if there else None
                rows.append((i.path, folder, name, ticker_of(folder), i.size, notes[at], _read(files, i.path) if self.content else None))
                if len(rows) == ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in REPORT.split(", ")])


class Place:
    """A folder of a write's own. While its marker is there, tasks may write to it; a task that finds it gone at its end takes
    back what it has written, as the write has been aborted meanwhile."""

    def __init__(self, path: str, name: str) -> None:
        self.path, self.name = path, name
        files, at = self.found()
        files.create_dir(at)
        _put(files, f"{at}/_open", b"")

    def found(self) -> tuple[afs.FileSystem, str]:
        files, root = opened(self.path)
        return files, f"{root}/{self.name}"

    def still(self) -> None:
        files, at = self.found()
        if files.get_file_info(f"{at}/_open").type == afs.FileType.NotFound:
            self.remove()
            raise RuntimeError("the write is over")

    def close(self) -> None:
        files, at = self.found()
        files.delete_file(f"{at}/_open")

    def remove(self) -> None:
        files, at = self.found()
        if files.get_file_info(at).type == afs.FileType.Directory:
            files.delete_dir(at)


class ReportWriter(DataSourceArrowWriter):
    """Rows: folder, file_name, content, metadata (the folder's; of its rows any)."""

    def __init__(self, options, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.stage = Place(self.path, f"_staged-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, at = self.stage.found()
        own = f"{at}/{uuid.uuid4().hex}"  # an attempt's own
        made: set[str] = set()
        for b in iterator:
            for folder, name, body, notes in zip(*(b.column(c).to_pylist() for c in ("folder", "file_name", "content", "metadata")), strict=True):
                at = f"{own}/{folder}"
                if folder not in made:
                    made.add(folder)
                    files.create_dir(at)
                    if notes is not None:
                        _put(files, f"{at}/{NOTES}", notes.encode())
                _put(files, f"{at}/{name}", body or b"")
        self.stage.still()
        return Wrote([f"{own}/{f}" for f in sorted(made)])

    def commit(self, messages: list[Wrote | None]) -> None:
        files, root = opened(self.path)
        paths = [p for m in messages if m is not None for p in m.paths]
        places = [f"{root}/{p.rsplit('/', 1)[-1]}" for p in paths]
        there = [i.path for i in files.get_file_info(places) if i.type != afs.FileType.NotFound] if places else []
        if len(set(places)) < len(places) or (there and not self.overwrite):
            self.abort(messages)
            raise FileExistsError(f"folders that are there already, or come from two tasks: {sorted({*there, *(p for p in places if places.count(p) > 1)})[:3]}")
        for path, place in zip(paths, places, strict=True):
            if place in there:
                files.delete_dir(place)
            files.move(path, place)
        self.abort(messages)

    def abort(self, messages: list[Wrote | None]) -> None:
        self.stage.remove()


class Pages(DataSource):
    """options: path. The columns are those of the first write."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self):
        from pyspark.sql.types import StructType

        files, root = opened(self.options["path"].rstrip("/"))
        commits = _commits(files, root)
        if not commits:
            raise FileNotFoundError(f"no pages in {root}")
        return StructType.fromJson(commits[-1]["schema"])

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return PageWriter(self.options, schema, overwrite)


def _commits(files: afs.FileSystem, root: str) -> list[dict]:
    """What counts, the oldest first: from the last write that replaced all."""
    found = [json.loads(_read(files, i.path)) for i in _listed(files, f"{root}/_commits") if i.base_name.endswith(".json")]
    return found[max((k for k, c in enumerate(found) if c["replaces"]), default=0) :]


class PageReader(DataSourceReader):
    def __init__(self, options, schema) -> None:
        self.path, self.names, self.tests = options["path"].rstrip("/"), schema.names, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1:
                self.tests.append((f.attribute[0], [f.value] if isinstance(f, EqualTo) else list(f.value)))
            yield f

    def partitions(self) -> list[InputPartition]:
        files, root = opened(self.path)
        return [Some([f"{root}/{s}"]) for c in _commits(files, root) for s in c["segments"]] or [Some([])]

    def read(self, partition: Some) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.path)
        test = reduce(lambda a, b: a & b, (pc.field(n).isin(v) for n, v in self.tests)) if self.tests else None
        for path in partition.paths:
            for b in ds.dataset(path, filesystem=files, format="parquet").to_batches(columns=self.names, filter=test, batch_size=256):
                if b.num_rows:
                    yield b


class PageWriter(DataSourceArrowWriter):
    def __init__(self, options, schema, overwrite: bool) -> None:
        self.path, self.json, self.overwrite = options["path"].rstrip("/"), schema.jsonValue(), overwrite
        self.own = Place(self.path, f"segments/{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, root = opened(self.path)
        segment, out = f"{self.own.name}/{uuid.uuid4().hex}.parquet", None
        for b in iterator:
            out = out or pq.ParquetWriter(f"{root}/{segment}", b.schema, filesystem=files)
            out.write_batch(b)
        if out is not None:
            out.close()
        self.own.still()
        return Wrote([segment] if out is not None else [])

    def commit(self, messages: list[Wrote | None]) -> None:
        files, root = opened(self.path)
        files.create_dir(f"{root}/_commits")
        number = 1 + max((int(i.base_name.split("-")[0]) for i in _listed(files, f"{root}/_commits")), default=0)
        body = {"segments": [p for m in messages if m is not None for p in m.paths], "replaces": self.overwrite, "schema": self.json}
        own = f"{root}/_commits/{number:010d}-{uuid.uuid4().hex}"
        _put(files, f"{own}.part", json.dumps(body).encode())
        files.move(f"{own}.part", f"{own}.json")
        self.own.close()

    def abort(self, messages: list[Wrote | None]) -> None:
        self.own.remove()


def registered(spark: SparkSession) -> SparkSession:
    """The session, with both sources and their filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (Reports, Pages):
        spark.dataSource.register(source)
    return spark
