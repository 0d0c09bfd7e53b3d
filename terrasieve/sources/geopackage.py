"""GeoPackage source and sink: format "gpkg" after register(spark).

A GeoPackage is a SQLite file with a table for each layer; geometries are blobs with a small header before their well-known binary.

Reading: `path` is one file or a folder of files with one schema; option `layer` (default: the first in the contents table) and `rows`
(rows of a partition). A file of more than SPLIT bytes is split into ranges of row ids with about so many rows each, smaller ones are one
partition and aren't opened to plan. Tasks give Arrow batches. A schema that names some columns makes SQLite read only those. Comparisons
of columns with values are pushed down to SQLite. Option `bounds` adds the columns min_x, min_y, max_x, max_y of each geometry (null where it
has no corner); comparisons of them go through the layer's R-tree, if it has one, before Spark holds them against the exact values.
Writing: `path` becomes a folder with one file a task, each with an R-tree, and a manifest that names the files: readers see what it names,
and it is replaced by one rename when all tasks have ended, so they see all of a write or nothing. What failed tasks left goes then, or when
the write fails. To get one file, reduce the partitions first. Options `layer`, `geometry` (default geom), `srs`. Modes overwrite and append.
Column names of SQLite ignore case. A null geometry stays null. Types: whole numbers, reals, text, booleans, blobs; dates are text.
"""

from __future__ import annotations

import contextlib
import json
import os
import sqlite3
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, FloatType, LongType, StringType, StructField, StructType

from terrasieve.sources.wkb import lines

ROWS, BATCH = 500_000, 10_000
#: Files up to so many bytes are one partition.
SPLIT = 64_000_000
MANIFEST = "_files.json"
#: Columns of option bounds, and the R-tree's names for them.
BOUNDS = {"min_x": "minx", "min_y": "miny", "max_x": "maxx", "max_y": "maxy"}
_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
# Fixed values of the format: application id, version, envelope sizes by indicator.
APPLICATION, VERSION, ENVELOPES = 0x47504B47, 10300, (0, 32, 48, 48, 64)
TABLES = """
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT, description TEXT, last_change TEXT, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);
CREATE TABLE gpkg_extensions (table_name TEXT, column_name TEXT, extension_name TEXT NOT NULL, definition TEXT NOT NULL, scope TEXT NOT NULL);
"""


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _local(path: str) -> str:
    """A path on a disk or mount; SQLite can't open files of other stores."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return path
    if scheme != "file":
        raise ValueError(f"GeoPackages are read and written by file paths, not by {scheme}:")
    return rest.removeprefix("//")


def _named(path: str) -> list[str] | None:
    """The names in a folder's manifest; None without one."""
    try:
        with open(os.path.join(path, MANIFEST)) as f:
            return json.load(f)
    except FileNotFoundError:
        return None


def _packages(path: str) -> list[str]:
    """Names of the files that a folder holds for readers."""
    named = _named(path)
    return sorted(f for f in os.listdir(path) if f.endswith(".gpkg")) if named is None else named


def _publish(path: str, names: list[str]) -> None:
    """The folder now holds these files: one rename."""
    hidden = os.path.join(path, f"_{uuid.uuid4().hex}.json")
    with open(hidden, "w") as f:
        json.dump(sorted(names), f)
    os.replace(hidden, os.path.join(path, MANIFEST))


def _files(path: str) -> list[str]:
    path = _local(path)
    if not os.path.isdir(path):
        return [path]
    found = [os.path.join(path, f) for f in _packages(path)]
    if not found:
        raise ValueError(f"no GeoPackage in {path}")
    return found


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)


def without_header(blob: bytes | None) -> bytes | None:
    """The well-known binary in a GeoPackage geometry."""
    if blob is None:
        return None
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    return blob[8 + ENVELOPES[blob[3] >> 1 & 7] :]


def bounds_of(wkb: bytes | None) -> tuple[float, float, float, float] | None:
    """min_x, min_y, max_x, max_y of the lines and rings of a geometry."""
    found = [xy for xy in lines(wkb) if len(xy)] if wkb else []
    if not found:
        return None
    xy = np.concatenate(found)
    return (*map(float, xy.min(axis=0)), *map(float, xy.max(axis=0)))


def with_header(wkb: bytes | None, srs: int) -> bytes | None:
    return None if wkb is None else b"GP" + struct.pack("<BBi", 0, 1, srs) + wkb


def _type(declared: str):
    name = declared.upper().partition("(")[0].strip()
    if name == "BOOLEAN":
        return BooleanType()
    if name in ("TINYINT", "SMALLINT", "MEDIUMINT", "INT", "INTEGER"):
        return LongType()
    if name in ("FLOAT", "DOUBLE", "REAL"):
        return DoubleType()
    return StringType() if name in ("TEXT", "DATE", "DATETIME") else BinaryType()


def _declared(kind) -> str:
    if isinstance(kind, BooleanType):
        return "BOOLEAN"
    if isinstance(kind, (DoubleType, FloatType)):
        return "DOUBLE"
    if isinstance(kind, StringType):
        return "TEXT"
    if isinstance(kind, BinaryType):
        return "BLOB"
    if kind.typeName() in ("byte", "short", "integer", "long"):
        return "INTEGER"
    raise ValueError(f"a GeoPackage has no column of type {kind.simpleString()}")


@dataclass
class Rows(InputPartition):
    """Rows of a file whose id is at least `first` and below `end`; None: all of them."""

    path: str
    first: int | None = None
    end: int | None = None


def _ranges(path: str, layer: str, rows: int) -> list[Rows]:
    """Ranges of row ids with at most `rows` rows, however the ids lie."""
    with _open(path) as db:
        starts = [r[0] for r in db.execute(f"SELECT id FROM (SELECT rowid AS id, row_number() OVER (ORDER BY rowid) AS n FROM {_quoted(layer)}) WHERE (n - 1) % ? = 0 ORDER BY id", (rows,))]
    return [Rows(path, a, b) for a, b in zip(starts, [*starts[1:], None], strict=True)]


class Reader(DataSourceReader):
    def __init__(self, schema: StructType, files: list[str], layer: str, geometry: str | None, rows: int, split: int):
        self.schema, self.files, self.layer, self.geometry, self.rows, self.split = schema, files, layer, geometry, rows, split
        self.where: list[tuple[str, list]] = []
        self.near: list[tuple[str, float]] = []

    def pushFilters(self, filters: list[Filter]):
        """Comparisons that SQLite makes as Spark does go there; those of bounds go to the R-tree and come back, as it rounds outward."""
        kinds = {f.name: f.dataType for f in self.schema}
        for f in filters:
            sign, name = _SIGNS.get(type(f)), f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in BOUNDS and name in kinds:
                if sign in (">", ">=", "<", "<="):
                    self.near.append((f"{BOUNDS[name]} {sign}= ?" if sign in "<>" else f"{BOUNDS[name]} {sign} ?", float(f.value)))
                yield f
            elif name not in kinds or name == self.geometry or isinstance(kinds[name], (DoubleType, BinaryType)) and not isinstance(f, (IsNull, IsNotNull)):
                yield f  # doubles: NaN has no place in SQLite's order
            elif sign and f.value is not None:
                self.where.append((f"{_quoted(name)} {sign} ?", [f.value]))
            elif isinstance(f, In) and None not in f.value:
                self.where.append((f"{_quoted(name)} IN ({', '.join('?' * len(f.value))})", list(f.value)))
            elif isinstance(f, (IsNull, IsNotNull)):
                self.where.append((f"{_quoted(name)} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", []))
            else:
                yield f

    def partitions(self) -> list[Rows]:
        found = []
        for path in self.files:
            found += [Rows(path)] if os.path.getsize(path) <= self.split else _ranges(path, self.layer, self.rows)
        return found

    def query(self, db: sqlite3.Connection, partition: Rows) -> tuple[str, list]:
        """The statement of a partition's rows and its values."""
        plain = [f.name for f in self.schema if f.name not in BOUNDS]
        bounded = len(plain) < len(self.schema)
        names = plain + [self.geometry] * (bounded and self.geometry not in plain)
        terms, values = [t for t, _ in self.where], [v for _, more in self.where for v in more]
        for sign, limit in ((">=", partition.first), ("<", partition.end)):
            if limit is not None:
                terms.append(f"rowid {sign} ?")
                values.append(limit)
        tree = f"rtree_{self.layer}_{self.geometry}"
        if self.near and db.execute("SELECT 1 FROM sqlite_master WHERE name = ?", (tree,)).fetchone():
            terms.append(f"rowid IN (SELECT id FROM {_quoted(tree)} WHERE {' AND '.join(t for t, _ in self.near)})")
            values += [v for _, v in self.near]
        return f"SELECT {', '.join(map(_quoted, names)) or 'rowid'} FROM {_quoted(self.layer)}{' WHERE ' * bool(terms)}{' AND '.join(terms)}", values

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(self.schema)
        plain = [f.name for f in self.schema if f.name not in BOUNDS]
        with _open(partition.path) as db:
            text, values = self.query(db, partition)
            rows = db.execute(text, values)
            names = [d[0] for d in rows.description]
            while held := rows.fetchmany(BATCH):
                columns = dict(zip(names, zip(*held, strict=True), strict=True))
                if self.geometry in columns:
                    columns[self.geometry] = [without_header(v) for v in columns[self.geometry]]
                if len(plain) < len(self.schema):
                    found = [bounds_of(v) or (None,) * 4 for v in columns[self.geometry]]
                    columns |= dict(zip(BOUNDS, zip(*found, strict=True), strict=True))
                arrays = []
                for field in kinds:
                    column = columns[field.name] if field.name in columns else next(v for k, v in columns.items() if k.lower() == field.name.lower())
                    arrays.append(pa.array([None if v is None else bool(v) for v in column] if pa.types.is_boolean(field.type) else list(column), field.type))
                yield pa.RecordBatch.from_arrays(arrays, schema=kinds)


@dataclass
class Written(WriterCommitMessage):
    name: str


class Writer(DataSourceArrowWriter):
    def __init__(self, schema: StructType, path: str, overwrite: bool, layer: str, geometry: str, srs: int):
        if geometry not in schema.fieldNames():
            raise ValueError(f"no geometry column {geometry}")
        self.columns = [(f.name, _declared(f.dataType)) for f in schema]
        self.path, self.overwrite, self.layer, self.geometry, self.srs = _local(path), overwrite, layer, geometry, srs
        self.run = uuid.uuid4().hex
        os.makedirs(self.path, exist_ok=True)
        open(self._token(self.run), "w").close()

    def _token(self, run: str) -> str:
        """A file that is there while a write goes on."""
        return os.path.join(self.path, f"_{run}.run")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        os.makedirs(self.path, exist_ok=True)
        hidden = os.path.join(self.path, f"_{self.run}-{uuid.uuid4().hex}.tmp")
        try:
            self._fill(hidden, iterator)
        except BaseException:
            if os.path.exists(hidden):
                os.remove(hidden)
            raise
        if not os.path.exists(self._token(self.run)):  # given up while this task was at work
            os.remove(hidden)
            raise RuntimeError("the write has failed")
        return Written(os.path.basename(hidden))

    def _fill(self, hidden: str, batches: Iterator[pa.RecordBatch]) -> None:
        db = sqlite3.connect(hidden)
        db.execute("PRAGMA journal_mode=OFF")
        db.execute(f"PRAGMA application_id={APPLICATION}")
        db.execute(f"PRAGMA user_version={VERSION}")
        db.executescript(TABLES)
        key = next(k for k in ("fid", "_fid", "_gpkg_fid") if k not in {c.lower() for c, _ in self.columns})
        fields = ", ".join(f"{_quoted(c)} {'GEOMETRY' if c == self.geometry else t}" for c, t in self.columns)
        tree = f"rtree_{self.layer}_{self.geometry}"
        db.execute(f"CREATE TABLE {_quoted(self.layer)} ({key} INTEGER PRIMARY KEY, {fields})")
        db.execute(f"CREATE VIRTUAL TABLE {_quoted(tree)} USING rtree(id, minx, maxx, miny, maxy)")
        organization = "EPSG" if self.srs > 0 else "NONE"
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, 'undefined', NULL)", (f"{organization} {self.srs}", self.srs, organization, self.srs))
        db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (self.layer, self.layer, self.srs))
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'GEOMETRY', ?, 0, 0)", (self.layer, self.geometry, self.srs))
        db.execute("INSERT INTO gpkg_extensions VALUES (?, ?, 'gpkg_rtree_index', 'http://www.geopackage.org/spec120/#extension_rtree', 'write-only')", (self.layer, self.geometry))
        at = [c for c, _ in self.columns].index(self.geometry)
        names, marks = ", ".join([key, *(_quoted(c) for c, _ in self.columns)]), ", ".join("?" * (len(self.columns) + 1))
        first = 1
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            boxes = [bounds_of(v) for v in columns[at]]
            columns[at] = [with_header(v, self.srs) for v in columns[at]]
            ids = range(first, first + b.num_rows)
            db.executemany(f"INSERT INTO {_quoted(self.layer)} ({names}) VALUES ({marks})", zip(ids, *columns, strict=True))
            db.executemany(f"INSERT INTO {_quoted(tree)} VALUES (?, ?, ?, ?, ?)", ((i, x[0], x[2], x[1], x[3]) for i, x in zip(ids, boxes, strict=True) if x))
            first += b.num_rows
        db.commit()
        db.close()

    def _swept(self, kept: set[str]) -> None:
        """End this write. What its tasks, and those of writes that are over, left besides the files that count goes."""
        with contextlib.suppress(FileNotFoundError):
            os.remove(self._token(self.run))
        for name in os.listdir(self.path):
            dead = name.startswith("_") and name.endswith(".tmp") and not os.path.exists(self._token(name[1:].partition("-")[0]))
            if dead or (name.startswith("part-") and self.run in name and name not in kept):
                with contextlib.suppress(FileNotFoundError):
                    os.remove(os.path.join(self.path, name))

    def commit(self, messages: list[Written | None]) -> None:
        os.makedirs(self.path, exist_ok=True)
        before = _packages(self.path)
        _publish(self.path, before)  # from now on readers see no file that the manifest doesn't name
        made = []
        for m in messages:
            if m is not None:
                name = f"part-{m.name[1:-4]}.gpkg"
                os.replace(os.path.join(self.path, m.name), os.path.join(self.path, name))
                made.append(name)
        _publish(self.path, made if self.overwrite else [*before, *made])
        self._swept(set(made))
        for name in before if self.overwrite else []:
            os.remove(os.path.join(self.path, name))

    def abort(self, messages: list[Written | None]) -> None:
        self._swept(set())


class GeoPackage(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def _layer(self) -> tuple[list[str], str, str | None]:
        files = _files(self.options["path"])
        with _open(files[0]) as db:
            layers = [r[0] for r in db.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY rowid")]
            layer = self.options.get("layer") or (layers[0] if layers else None)
            if layer not in layers:
                raise ValueError(f"{files[0]} has no layer {layer}; it has {layers}")
            geometry = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
        return files, layer, geometry[0] if geometry else None

    def schema(self) -> StructType:
        files, layer, geometry = self._layer()
        with _open(files[0]) as db:
            columns = [(r[1], r[2]) for r in db.execute(f"PRAGMA table_info({_quoted(layer)})")]
        more = BOUNDS if str(self.options.get("bounds", "false")).lower() == "true" else ()
        return StructType([*(StructField(c, BinaryType() if c == geometry else _type(t)) for c, t in columns), *(StructField(c, DoubleType()) for c in more)])

    def reader(self, schema: StructType) -> Reader:
        return Reader(schema, *self._layer(), int(self.options.get("rows", ROWS)), int(self.options.get("split", SPLIT)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        o = self.options
        return Writer(schema, o["path"], overwrite, o.get("layer", "layer"), o.get("geometry", "geom"), int(o.get("srs", -1)))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach Python sources, which Spark leaves off by default."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GeoPackage)
