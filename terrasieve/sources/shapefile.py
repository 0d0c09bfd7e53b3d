"""Shapefile source: format "shapefile" after register(spark).

A shapefile is three files side by side: shapes (.shp), their places (.shx) and a table of attributes (.dbf). `path` names the .shp. Columns:
geom (well-known binary; null for null shapes), then the attributes: whole numbers of at most 18 digits as long, other numbers as double,
logicals as boolean, all else as text without blanks at its end; empty and unreadable numbers and logicals are null. Option `encoding` (default: what a .cpg
file says, or else latin-1), option `rows` (records of a partition). Records that are marked as deleted are left out. A schema that names
some columns leaves the others unread.

Partitions are ranges of records, from the size of the .shx alone; a task reads its part of each file, so a large file is read by many and
a lost part again. Polygons: clockwise rings begin a polygon, the others are holes of the smallest one round them; a hole that lies in none
stands by itself. Heights and measures are dropped.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from terrasieve.sources.geopackage import _local as local_path

# Fixed values of the format: header sizes, shape types without heights and measures, their variants' steps.
HEADER, ENTRY, FIELD = 100, 8, 32
POINT, POLYLINE, POLYGON, MULTIPOINT = 1, 3, 5, 8
# Well-known binary's type numbers.
_WKB = {"point": 1, "line": 2, "polygon": 3, "points": 4, "lines": 5, "polygons": 6}
ROWS, BATCH = 200_000, 5_000


@dataclass
class Table:
    """The layout of a .dbf file: records, bytes before them, bytes of each, and (name, type, length, decimals) of each field."""

    records: int
    start: int
    width: int
    fields: list[tuple[str, str, int, int]]


def _beside(path: str, suffix: str) -> str | None:
    """The file with this suffix beside a .shp, whatever the case of its suffix."""
    stem = os.path.splitext(path)[0]
    return next((stem + s for s in (suffix, suffix.upper()) if os.path.exists(stem + s)), None)


def table_of(path: str, encoding: str) -> Table:
    with open(path, "rb") as f:
        head = f.read(32)
        records, start, width = struct.unpack_from("<IHH", head, 4)
        fields = []
        while len(raw := f.read(FIELD)) == FIELD and raw[0] != 0x0D:
            fields.append((raw[:11].split(b"\0")[0].decode(encoding), chr(raw[11]), raw[16], raw[17]))
    return Table(records, start, width, fields)


def _kind(field: tuple[str, str, int, int]):
    _, kind, length, decimals = field
    if kind == "N" and not decimals and length <= 18:
        return LongType()
    return DoubleType() if kind in "NF" else BooleanType() if kind == "L" else StringType()


def _value(raw: bytes, kind, encoding: str):
    text = raw.decode(encoding, "replace").split("\0")[0].rstrip()
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, BooleanType):
        return {"t": True, "y": True, "f": False, "n": False}.get(text.strip().lower())
    try:
        return int(text) if isinstance(kind, LongType) else float(text)
    except ValueError:  # blanks, or stars for a number that didn't fit
        return None


def _run(xy: np.ndarray) -> bytes:
    return struct.pack("<I", len(xy)) + np.ascontiguousarray(xy, "<f8").tobytes()


def _one(kind: str, parts: list[bytes]) -> bytes:
    return struct.pack("<BII", 1, _WKB[kind], len(parts)) + b"".join(parts)


def _area(ring: np.ndarray) -> float:
    """Twice the signed area; less than 0 for a clockwise ring. Places are taken from the first, so that far ones keep their digits."""
    x, y = (ring - ring[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum())


def _inside(p: np.ndarray, ring: np.ndarray) -> bool:
    (x0, y0), (x1, y1) = ring[:-1].T, ring[1:].T
    cross = (y0 > p[1]) != (y1 > p[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (x1 - x0) * (p[1] - y0) / (y1 - y0) + x0
    return bool((cross & (p[0] < at)).sum() % 2)


def polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Rings as polygons, each its outer ring and its holes."""
    outer = [[r] for r in rings if len(r) and _area(r) <= 0]
    for hole in (r for r in rings if len(r) and _area(r) > 0):
        # a corner may lie on the outer ring, so most corners decide
        spots = hole[:-1] if len(hole) > 1 else hole
        round_it = [p for p in outer if 2 * sum(_inside(s, p[0]) for s in spots) > len(spots)]
        if round_it:
            min(round_it, key=lambda p: abs(_area(p[0]))).append(hole)
        else:
            outer.append([hole])
    return outer


def shape_wkb(data: bytes) -> bytes | None:
    """The well-known binary of a record's content; null for a null shape."""
    kind = struct.unpack_from("<i", data)[0]
    if kind == 0:
        return None
    kind %= 10
    if kind == POINT:
        return struct.pack("<BI", 1, _WKB["point"]) + data[4:20]
    n_parts = 0
    if kind in (POLYLINE, POLYGON):
        n_parts, n = struct.unpack_from("<ii", data, 36)
        at = 44 + 4 * n_parts
    elif kind == MULTIPOINT:
        (n,) = struct.unpack_from("<i", data, 36)
        at = 40
    else:
        raise ValueError(f"shapes of type {kind} aren't read")
    xy = np.frombuffer(data, "<f8", 2 * n, at).reshape(n, 2)
    if kind == MULTIPOINT:
        return _one("points", [struct.pack("<BI", 1, _WKB["point"]) + p.tobytes() for p in xy])
    starts = [*np.frombuffer(data, "<i4", n_parts, 44).tolist(), n]
    runs = [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    if kind == POLYLINE:
        parts = [struct.pack("<BI", 1, _WKB["line"]) + _run(r) for r in runs]
        return parts[0] if len(parts) == 1 else _one("lines", parts)
    parts = [_one("polygon", [_run(r) for r in p]) for p in polygons(runs)]
    return parts[0] if len(parts) == 1 else _one("polygons", parts)


@dataclass
class Records(InputPartition):
    """Records `first` to `end` - 1 of a file, counted from 0."""

    first: int
    end: int


class Reader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, encoding: str, rows: int):
        self.schema, self.path, self.encoding, self.rows = schema, path, encoding, rows

    def partitions(self) -> list[Records]:
        n = (os.path.getsize(_beside(self.path, ".shx")) - HEADER) // ENTRY
        return [Records(i, min(i + self.rows, n)) for i in range(0, n, self.rows)] or [Records(0, 0)]

    def read(self, partition: Records) -> Iterator[pa.RecordBatch]:
        kinds, names = to_arrow_schema(self.schema), self.schema.fieldNames()
        beside = _beside(self.path, ".dbf")
        table = table_of(beside, self.encoding) if beside else Table(0, 0, 0, [])
        spans, at = {}, 1
        for field in table.fields:
            spans[field[0]] = (at, at + field[2], _kind(field))
            at += field[2]
        with open(_beside(self.path, ".shx"), "rb") as index, open(self.path, "rb") as shapes, open(beside or os.devnull, "rb") as attributes:
            for first in range(partition.first, partition.end, BATCH):
                n = min(BATCH, partition.end - first)
                index.seek(HEADER + ENTRY * first)
                places = np.frombuffer(index.read(ENTRY * n), ">i4").reshape(n, 2).astype(np.int64) * 2
                attributes.seek(table.start + table.width * first)
                rows = [attributes.read(table.width) for _ in range(n)] if beside else [b" "] * n
                held = [i for i, r in enumerate(rows) if r[:1] != b"*"]
                arrays = []
                for name, kind in zip(names, kinds.types, strict=True):
                    if name == "geom":
                        column = []
                        for i in held:
                            shapes.seek(places[i, 0] + 8)
                            column.append(shape_wkb(shapes.read(places[i, 1])))
                    else:
                        a, b, own = spans[name]
                        column = [_value(rows[i][a:b], own, self.encoding) for i in held]
                    arrays.append(pa.array(column, kind))
                yield pa.RecordBatch.from_arrays(arrays, schema=kinds)


class Shapefile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def _path(self) -> str:
        path = local_path(self.options["path"])
        if not os.path.exists(path) or not _beside(path, ".shx"):
            raise ValueError(f"{path} is no shapefile, or lacks its .shx")
        return path

    def _encoding(self) -> str:
        if said := self.options.get("encoding"):
            return said
        page = _beside(self._path(), ".cpg")
        if not page:
            return "latin-1"
        with open(page) as f:
            name = f.read().strip()
        return f"cp{name}" if name.isdigit() else name or "latin-1"

    def schema(self) -> StructType:
        beside = _beside(self._path(), ".dbf")
        fields = table_of(beside, self._encoding()).fields if beside else []
        return StructType([StructField("geom", BinaryType()), *(StructField(f[0], _kind(f)) for f in fields)])

    def reader(self, schema: StructType) -> Reader:
        return Reader(schema, self._path(), self._encoding(), int(self.options.get("rows", ROWS)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Shapefile)
