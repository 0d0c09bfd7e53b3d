"""Well-known binary, the geometry encoding of vector files: its lines as coordinate arrays, and edges as rows."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type numbers of the encoding.
LINE, POLYGON, MULTILINE, COLLECTIONS = 2, 3, 5, (4, 5, 6, 7)


def lines(data: bytes) -> list[np.ndarray]:
    """Lines and polygon rings of a geometry, each an array of x, y. Points give none; heights and measures are dropped."""
    found: list[np.ndarray] = []
    _read(data, 0, found)
    return found


def _read(data: bytes, at: int, found: list[np.ndarray]) -> int:
    order = "<" if data[at] else ">"
    kind = struct.unpack_from(f"{order}I", data, at + 1)[0]
    at += 9 if kind & 0x20000000 else 5
    thousand = (kind & 0xFFFF) // 1000
    width = 2 + (bool(kind & 0x80000000) or thousand in (1, 3)) + (bool(kind & 0x40000000) or thousand in (2, 3))
    kind = (kind & 0xFFFF) % 1000

    def number() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(f"{order}I", data, at - 4)[0]

    def run() -> np.ndarray:
        nonlocal at
        n = number()
        xy = np.frombuffer(data, f"{order}f8", n * width, at).reshape(n, width)[:, :2].astype(float)
        at += 8 * n * width
        return xy

    if kind == LINE:
        found.append(run())
    elif kind == POLYGON:
        for _ in range(number()):
            found.append(run())
    elif kind in COLLECTIONS:
        for _ in range(number()):
            at = _read(data, at, found)
    else:
        at += 8 * width
    return at


def kind_of(geometry: Column) -> tuple[Column, Column]:
    """(type number without heights and measures, whether it is empty) by the header of well-known binary; null for null."""
    h = F.hex(geometry)
    little = F.substring(h, 1, 2) == "01"

    def number(byte: int) -> Column:
        parts = [F.substring(h, 2 * (byte + i) + 1, 2) for i in range(4)]
        return F.conv(F.when(little, F.concat(*parts[::-1])).otherwise(F.concat(*parts)), 16, 10).cast("long")

    kind = number(1)
    count = F.when(kind.bitwiseAND(F.lit(0x20000000)) != 0, number(9)).otherwise(number(5))
    return kind.bitwiseAND(F.lit(0xFFFF)) % 1000, count == 0


def lines_only(layer: DataFrame, geometry: str = "geom") -> DataFrame:
    """The rows of layer whose geometry is a line or a multiple line that isn't empty."""
    kind, empty = kind_of(F.col(geometry))
    return layer.filter(kind.isin(LINE, MULTILINE) & ~empty)


def line_wkb(xy: np.ndarray) -> bytes:
    """A line of x, y rows, little-endian."""
    return struct.pack("<BII", 1, LINE, len(xy)) + np.ascontiguousarray(xy, "<f8").tobytes()


def edges(layer: DataFrame, id_col: str = "fid", geometry: str = "geom") -> DataFrame:
    """(id, part, seq, ax, ay, bx, by): the edges of lines and of polygons' rings, inner ones too. Null and empty geometries give no rows.
    No shuffle; extra columns are not read."""
    kind = layer.schema[id_col].dataType.simpleString()
    names = ["id", "part", "seq", "ax", "ay", "bx", "by"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parts, found = [], [], []
            for i, data in enumerate(b.column(1).to_pylist()):
                for part, xy in enumerate(lines(data) if data else []):
                    if len(xy) > 1:
                        rows.append(i)
                        parts.append(part)
                        found.append(xy)
            n = np.array([len(xy) - 1 for xy in found], dtype=np.int64)
            ends = [np.concatenate([xy[k : len(xy) - 1 + k] for xy in found]) if found else np.zeros((0, 2)) for k in (0, 1)]
            seq = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            columns = [b.column(0).take(pa.array(np.repeat(rows, n).astype(np.int64))), pa.array(np.repeat(parts, n).astype(np.int64)), pa.array(seq)]
            columns += [pa.array(np.ascontiguousarray(v[:, k])) for v in ends for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return layer.select(id_col, geometry).mapInArrow(run, f"id {kind}, part long, seq long, ax double, ay double, bx double, by double")


def edge_lines(edge_rows: DataFrame, geometry: str = "geom") -> DataFrame:
    """edge_rows (ax, ay, bx, by and others) with each edge as a line in place of its four coordinates."""
    others = [c for c in edge_rows.columns if c not in ("ax", "ay", "bx", "by")]
    schema = ", ".join([*(f"`{c}` {edge_rows.schema[c].dataType.simpleString()}" for c in others), f"{geometry} binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xy = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("ax", "ay", "bx", "by")], axis=1).reshape(-1, 2, 2)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), pa.array([line_wkb(x) for x in xy], pa.binary())], names=[*others, geometry])

    return edge_rows.select(*others, "ax", "ay", "bx", "by").mapInArrow(run, schema)
