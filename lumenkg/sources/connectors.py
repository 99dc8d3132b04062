"""Data sources for stored responses and image folders, read through ``spark.read.format`` and ``spark.readStream.format``.

``stored_responses`` reads a folder ``<api>/<key>.json`` of response bodies, one file per call. A partition is some files
of one api; a filter on ``api`` or ``key`` leaves out folders and files before anything is opened. As a stream it gives
each file once: the offset is the newest (time, name) seen, so a restart goes on where the checkpoint stands.

``image_folders`` lists images with their folder; contents aren't opened.

Paths may be local or of any file system that Arrow knows (``hdfs://``, ``s3://``). What only Spark's own readers open is
read by ``files.response_files`` instead, with the same columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

#: Files of one api that a task reads.
FILES_PER_PARTITION = 1000
RESPONSES = "api string, key string, body string, status string, path string"
IMAGES = "img_id string, folder string, path string, bytes long"
#: Image file endings.
ENDINGS = (".jpg", ".jpeg", ".png", ".webp")


@dataclass
class Files(InputPartition):
    """Files (path, modification time) of one api."""

    api: str
    paths: tuple[str, ...]


def _listed(root: str, recursive: bool = True) -> list:
    """File infos under ``root`` in order of their path."""
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root.removeprefix("file:"))
    found = system.get_file_info(fs.FileSelector(at, recursive=recursive, allow_not_found=True))
    return sorted((x for x in found if x.type == fs.FileType.File), key=lambda x: x.path)


def _opened(root: str, path: str) -> bytes:
    from pyarrow import fs

    system = fs.FileSystem.from_uri(root)[0] if "://" in root else fs.LocalFileSystem()
    with system.open_input_stream(path) as f:
        return f.read()


def _parts(path: str) -> tuple[str, str]:
    """(api, key) of ``.../<api>/<key>.json``."""
    folders = path.split("/")
    return folders[-2], folders[-1].removesuffix(".json")


def _rows(root: str, partition: Files | None) -> Iterator[tuple]:
    for path in partition.paths if partition else ():  # without partitions Spark asks for None
        api, key = _parts(path)
        body = _opened(root, path).decode("utf-8", "replace")
        try:
            json.loads(body)
            status = "ok"
        except ValueError:
            status = "json_parse_failed"
        yield api, key, body, status, path


def _partitions(paths: list[str]) -> list[Files]:
    by: dict[str, list[str]] = {}
    for p in paths:
        by.setdefault(_parts(p)[0], []).append(p)
    return [Files(api, tuple(own[k : k + FILES_PER_PARTITION])) for api, own in by.items() for k in range(0, len(own), FILES_PER_PARTITION)]


class ResponseReader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802 - the interface's name
        """Equality on ``api`` and ``key`` chooses files; everything else is left to Spark."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in ("api", "key"):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self) -> Sequence[InputPartition]:
        def asked(path: str) -> bool:
            api, key = _parts(path)
            return all(v in self.wanted.get(c, {v}) for c, v in (("api", api), ("key", key)))

        apis = self.wanted.get("api")
        roots = [self.root] if apis is None else [f"{self.root}/{a}" for a in sorted(apis)]
        return _partitions([x.path for r in roots for x in _listed(r) if x.path.endswith(".json") and asked(x.path)])

    def read(self, partition: Files) -> Iterator[tuple]:
        yield from _rows(self.root, partition)


class ResponseStream(DataSourceStreamReader):
    """Files by (modification time, path); the listing of a batch is kept until it is committed."""

    def __init__(self, root: str):
        self.root = root

    def _since(self, start: dict, end: dict | None) -> list[tuple[int, str]]:
        found = sorted((x.mtime_ns or 0, x.path) for x in _listed(self.root) if x.path.endswith(".json"))
        after = (start["time"], start["path"])
        return [x for x in found if after < x and (end is None or x <= (end["time"], end["path"]))]

    def initialOffset(self) -> dict:  # noqa: N802
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        last = self._since(self.initialOffset(), None)[-1:]
        return {"time": last[0][0], "path": last[0][1]} if last else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return _partitions([p for _, p in self._since(start, end)])

    def read(self, partition: Files) -> Iterator[tuple]:
        yield from _rows(self.root, partition)

    def commit(self, end: dict) -> None:
        """Nothing is held per batch."""


class StoredResponses(DataSource):
    """``spark.read.format("stored_responses").load(folder)``: (api, key, body, status, path)."""

    @classmethod
    def name(cls) -> str:
        return "stored_responses"

    def schema(self) -> str:
        return RESPONSES

    def reader(self, schema) -> DataSourceReader:
        return ResponseReader(self.options["path"].rstrip("/"))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return ResponseStream(self.options["path"].rstrip("/"))


class ImageReader(DataSourceReader):
    def __init__(self, root: str):
        self.root, self.wanted = root, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("folder",):
                self.wanted = f.value
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        folders = [x.path for x in self._folders(fs)] if self.wanted is None else [f"{self.root}/{self.wanted}"]
        return [Files(path.rstrip("/").split("/")[-1], (path,)) for path in folders]

    def _folders(self, fs) -> list:
        system, at = fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)
        found = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
        return sorted((x for x in found if x.type == fs.FileType.Directory), key=lambda x: x.path)

    def read(self, partition: Files | None) -> Iterator[tuple]:
        for x in _listed(partition.paths[0], recursive=False) if partition else ():
            name = x.path.split("/")[-1]
            if name.lower().endswith(ENDINGS):
                yield name.rsplit(".", 1)[0], partition.api, x.path, x.size


class ImageFolders(DataSource):
    """``spark.read.format("image_folders").load(folder)``: (img_id, folder, path, bytes) of the images in its folders."""

    @classmethod
    def name(cls) -> str:
        return "image_folders"

    def schema(self) -> str:
        return IMAGES

    def reader(self, schema) -> DataSourceReader:
        return ImageReader(self.options["path"].rstrip("/"))


def register(spark: SparkSession) -> None:
    """Make both formats known to the session and let filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StoredResponses)
    spark.dataSource.register(ImageFolders)
