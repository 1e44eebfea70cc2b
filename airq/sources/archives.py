"""Zipped product archives as a Spark data source: one partition per archive, the station filter pushed to the file names.

``spark.read.format("product_archives").load(root)`` gives ``(station, path, name, header, line, error)``, a row per line of
the product member and one row with ``error`` for an archive that cannot be read to its end. A condition on ``station``
(equal, in a list) leaves other archives unopened. An archive is read as a stream, so a task holds a chunk of its lines. The
folder must be one that driver and executors can open; for other stores see ``weather.read_archives``.
"""

from __future__ import annotations

import os
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

FORMAT = "product_archives"
LINES = "station int, path string, name string, header string, line string, error string"
# Fixed value: archive names hold a five-digit station number between underscores.
NAME = re.compile(r"stundenwerte_[A-Za-z0-9_]+\.zip$")
STATION = re.compile(r"_(\d{5})_")
CHUNK = 50_000
UNREADABLE = (zipfile.BadZipFile, zlib.error, ValueError, OSError, EOFError, RuntimeError, NotImplementedError)


def local_path(root: str) -> str | None:
    """The folder behind a path or ``file:`` address; None for another store."""
    parts = urlparse(root)
    if not parts.scheme:
        return root
    return unquote(parts.path) if parts.scheme == "file" else None


@dataclass
class Archive(InputPartition):
    path: str
    station: int | None


def archives_below(root: str) -> Iterator[Archive]:
    for folder, _, names in os.walk(root):
        for name in sorted(names):
            if NAME.match(name):
                station = STATION.search(name)
                yield Archive(os.path.join(folder, name), int(station[1]) if station else None)


def product_lines(path: str | BinaryIO) -> Iterator[tuple[str, str, list[str]]]:
    """``(member, header, lines)`` in chunks, of the first member whose name holds ``produkt_``.

    An archive gives lines only if it is whole to its end, so it is read twice.
    """
    with zipfile.ZipFile(path) as archive:
        members = [n for n in archive.namelist() if "produkt_" in n]
        if not members:
            raise ValueError("no produkt_ member")
        with archive.open(members[0]) as member:
            while member.read(1 << 20):
                pass
        with archive.open(members[0]) as member:
            text = (raw.decode("ISO-8859-1").rstrip("\r\n") for raw in member)
            header, lines = next(text, ""), []
            for line in text:
                lines.append(line)
                if len(lines) == CHUNK:
                    yield members[0], header, lines
                    lines = []
            if lines:
                yield members[0], header, lines


class ArchiveReader(DataSourceReader):
    def __init__(self, schema: StructType, root: str):
        self.names = schema.names
        self.root = root
        self.wanted: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("station",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> list[Archive]:
        found = [a for a in archives_below(self.root) if self.wanted is None or a.station in self.wanted]
        return found or [Archive("", None)]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return

        def rows(lines: list, **same) -> pa.RecordBatch:
            whole = {"station": partition.station, "path": partition.path, "name": None, "header": None, "error": None, **same}
            columns = [lines if c == "line" else [whole[c]] * len(lines) for c in self.names]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "station" else pa.string()) for n, c in zip(self.names, columns)], self.names)

        try:
            for name, header, lines in product_lines(partition.path):
                yield rows(lines, name=name, header=header)
        except UNREADABLE as problem:
            yield rows([None], error=str(problem) or type(problem).__name__)


class ProductArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINES

    def reader(self, schema: StructType) -> ArchiveReader:
        root = local_path(self.options["path"])
        if root is None:
            raise ValueError(f"{self.options['path']} cannot be opened as a folder")
        return ArchiveReader(schema, root)


def scan_archives(spark: SparkSession, root: str, stations: list[int] | None = None) -> DataFrame:
    """Lines of the archives below ``root``, of the named stations only if given; their names are all that others cost."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ProductArchives)
    lines = spark.read.format(FORMAT).load(root)
    return lines if stations is None else lines.where(lines["station"].isin(stations))
