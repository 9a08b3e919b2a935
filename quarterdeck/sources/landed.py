"""Landed files as a Spark data source: folders are planned, files are listed and opened in tasks.

The driver walks the folders down to ``depth`` levels and holds nothing but their names; each folder is one partition, and its files are
listed by the task that reads it. Comparisons of ``path``, ``doc_id`` and ``folder`` with constants are taken over by the source, so
that files which a query does not want are not opened, and folders not even listed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith, StringStartsWith

LISTED = "path string, folder string, doc_id string, length long, modified timestamp"
_BATCH_BYTES = 16 << 20
_BATCH_ROWS = 1000


def _open(location: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; plain paths are local or mounted."""
    if location.startswith("file:/") and not location.startswith("file://"):
        location = location.removeprefix("file:")  # as Spark writes local paths
    return fs.FileSystem.from_uri(location) if "://" in location else (fs.LocalFileSystem(), location)


def _passes(one: Filter, name: str) -> bool:
    if isinstance(one, EqualTo):
        return name == one.value
    if isinstance(one, In):
        return name in one.value
    return name.startswith(one.value) if isinstance(one, StringStartsWith) else name.endswith(one.value)


def _stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


@dataclass
class Folder(InputPartition):
    """One folder. ``below`` tells whether folders in it are part of it."""

    location: str
    below: bool


class LandedReader(DataSourceReader):
    """Rows of one folder per partition."""

    def __init__(self, roots: list[str], depth: int, below: bool, content: bool):
        self.roots, self.depth, self.below, self.content = roots, depth, below, content
        self.taken: list[tuple[str, Filter]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take over what compares a name with constants; the rest stays with Spark."""
        for one in filters:
            if isinstance(one, (EqualTo, In, StringStartsWith, StringEndsWith)) and one.attribute[0] in ("path", "doc_id", "folder"):
                self.taken.append((one.attribute[0], one))
            else:
                yield one

    def _wanted(self, **names: str) -> bool:
        """Whether a file of these names passes every filter taken over."""
        return all(_passes(one, names[column]) for column, one in self.taken)

    def _may_hold(self, folder: str, below: bool) -> bool:
        """Whether a file in ``folder``, or below it, can pass the filters on folder and path."""
        inside = folder.rstrip("/") + "/"
        for column, one in self.taken:
            if column == "doc_id" or isinstance(one, StringEndsWith):
                continue
            values = one.value if isinstance(one, In) else [one.value]
            if isinstance(one, StringStartsWith):
                fits = [inside.startswith(v) or v.startswith(inside) for v in values]
            elif column == "folder":
                fits = [v == folder or below and v.startswith(inside) for v in values]
            else:
                fits = [v.startswith(inside) and (below or "/" not in v[len(inside) :]) for v in values]
            if not any(fits):
                return False
        return True

    def partitions(self) -> Sequence[Folder]:
        """Every folder down to ``depth`` levels below a root; with ``below``, folders deeper than that go with the one they are in."""
        found, level = [], list(self.roots)
        for step in range(self.depth + 1):
            last, inner = step == self.depth, []
            for location in level:
                system, path = _open(location)
                if not last:
                    kinds = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
                    inner += [f"{location.rstrip('/')}/{k.base_name}" for k in kinds if k.type == fs.FileType.Directory]
                below = last and self.below
                if self._may_hold(location, below):
                    found.append(Folder(location, below))
            level = inner
        # Spark wants one partition at least.
        return found or [Folder("", False)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        if not partition.location:
            return
        system, path = _open(partition.location)
        rows, size = [], 0
        for info in system.get_file_info(fs.FileSelector(path, recursive=partition.below, allow_not_found=True)):
            if info.type != fs.FileType.File or info.base_name.startswith((".", "_")):
                continue
            place = partition.location.rstrip("/") + info.path[len(path.rstrip("/")) :]
            folder = place.rsplit("/", 1)[0]
            if not self._wanted(path=place, doc_id=_stem(place), folder=folder):
                continue
            content = _content(system, info.path) if self.content else None
            rows.append((place, folder, _stem(place), info.size, info.mtime, content))
            size += len(content or b"")
            if size >= _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.binary()]
        names = ["path", "folder", "doc_id", "length", "modified", "content"]
        width = len(names) if self.content else len(names) - 1
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows))[:width], kinds)], names=names[:width])


def _content(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_file(path) as file:
        return file.read()


class LandedFiles(DataSource):
    """``spark.read.format("landed_files")``: options ``roots`` (lines), ``depth`` (of folders, 2), ``below`` (true) and ``content`` (false)."""

    @classmethod
    def name(cls) -> str:
        return "landed_files"

    def _flag(self, name: str, default: str) -> bool:
        return str(self.options.get(name, default)).lower() == "true"

    def schema(self) -> str:
        return f"{LISTED}, content binary" if self._flag("content", "false") else LISTED

    def reader(self, schema) -> LandedReader:
        depth, below = int(self.options.get("depth", 2)), self._flag("below", "true")
        return LandedReader(self.options["roots"].split("\n"), depth, below, self._flag("content", "false"))


def landed_files(spark: SparkSession, roots: str | Sequence[str], depth: int = 2, below: bool = True, content: bool = False) -> DataFrame:
    """Files below ``roots``: path, folder, doc_id (name without extension), length, modified, and the bytes if asked for.

    ``depth`` is the number of folder levels that partitions are planned from (type and quarter); folders under these count only with ``below``. A root that is missing has no files; files
    whose names begin with a dot or an underscore are left out, as Spark does.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedFiles)
    listed = [roots] if isinstance(roots, str) else list(roots)
    options = {"roots": "\n".join(listed), "depth": str(depth), "below": str(below).lower(), "content": str(content).lower()}
    return spark.read.format("landed_files").options(**options).load()


def open_files(wanted: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``wanted`` with the bytes of the file at ``path``, opened where the row is; rows whose file is gone drop out.

    Spark deals out the rows first, so tasks open about as many files each, whatever folder they lie in.
    """
    names = [c for c in wanted.columns if c != content]
    schema = ", ".join([*(f"`{c}` {wanted.schema[c].dataType.simpleString()}" for c in names), f"`{content}` binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, size = 0, [], 0
            places = batch.column(names.index(path)).to_pylist()
            for k, place in enumerate(places):
                held.append(_read_if_there(place))
                size += len(held[-1] or b"")
                if size >= _BATCH_BYTES or k + 1 == len(places):
                    part = batch.slice(start, len(held))
                    full = pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], names=[*names, content])
                    yield full.filter(full.column(len(names)).is_valid())
                    start, held, size = k + 1, [], 0

    return wanted.select(*names).mapInArrow(run, schema)


def _read_if_there(place: str | None) -> bytes | None:
    if place is None:
        return None
    system, path = _open(place)
    return _content(system, path) if system.get_file_info(path).type == fs.FileType.File else None


# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
