"""Shapefiles written here byte by byte."""

import struct

import pytest

from terrasieve.sources import shapefile, wkb


def poly(kind, *parts):
    points = [p for part in parts for p in part]
    starts, at = [], 0
    for part in parts:
        starts.append(at)
        at += len(part)
    box = [f(p[i] for p in points) for f in (min, max) for i in (0, 1)]
    body = struct.pack("<i4d2i", kind, *box, len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts)
    return body + b"".join(struct.pack("<2d", *p) for p in points)


def write(folder, shapes, fields, rows, encoding="latin-1", deleted=()):
    """fields: (name, type, length, decimals); rows: tuples of texts."""
    body, index = b"", b""
    for i, s in enumerate(shapes):
        index += struct.pack(">2i", (100 + len(body)) // 2, len(s) // 2)
        body += struct.pack(">2i", i + 1, len(s) // 2) + s
    for name, data in (("x.shp", body), ("x.shx", index)):
        head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(data)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
        (folder / name).write_bytes(head + data)
    width = 1 + sum(f[2] for f in fields)
    head = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(fields), width)
    for name, kind, length, decimals in fields:
        head += name.encode(encoding).ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([length, decimals]) + b"\0" * 14
    data = b""
    for i, row in enumerate(rows):
        data += b"*" if i in deleted else b" "
        data += b"".join((v.encode(encoding).ljust(f[2]) if f[1] == "C" else v.encode(encoding).rjust(f[2]))[: f[2]] for v, f in zip(row, fields, strict=True))
    (folder / "x.dbf").write_bytes(head + b"\r" + data + b"\x1a")
    return str(folder / "x.shp")


SQUARE = [(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)]  # clockwise
HOLE = [(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)]
ISLAND = [(20, 20), (20, 30), (30, 30), (30, 20), (20, 20)]
FIELDS = [("name", "C", 12, 0), ("n", "N", 9, 0), ("size", "N", 12, 3), ("ok", "L", 1, 0), ("day", "D", 8, 0)]
SHAPES = [poly(5, SQUARE, HOLE), struct.pack("<i", 0), poly(5, ISLAND, HOLE, SQUARE), poly(3, [(0, 0), (1, 1), (2, 0)], [(5, 5), (6, 6)]), struct.pack("<i2d", 1, 3.0, 4.0), poly(15, SQUARE) + struct.pack("<2d5d", 0, 9, *range(5)), struct.pack("<i4di4d", 8, 0, 0, 1, 1, 2, 0, 0, 1, 1)]
ROWS = [("café", "1", "1.5", "T", "20240131"), ("", "", "", "?", ""), ("b", "-22", "*" * 12, "f", "20240201"), ("c", "3", "2", "N", ""), ("d", "4", "1e3", "Y", ""), ("e", "5", "0", " ", ""), ("f", "6", "-0.25", "t", "")]


def test_shapes_and_attributes(spark, tmp_path):
    shapefile.register(spark)
    path = write(tmp_path, SHAPES, FIELDS, ROWS)
    layer = spark.read.format("shapefile").option("rows", 2).load(path)
    assert layer.rdd.getNumPartitions() == 4 and [f.dataType.simpleString() for f in layer.schema] == ["binary", "string", "bigint", "double", "boolean", "string"]
    rows = layer.collect()
    assert [tuple(r)[1:] for r in rows] == [("café", 1, 1.5, True, "20240131"), ("", None, None, None, ""), ("b", -22, None, False, "20240201"), ("c", 3, 2.0, False, ""), ("d", 4, 1000.0, True, ""), ("e", 5, 0.0, None, ""), ("f", 6, -0.25, True, "")]
    kinds = [r.geom and struct.unpack_from("<I", r.geom, 1)[0] for r in rows]
    assert kinds == [3, None, 6, 5, 1, 3, 4]
    assert [[tuple(p) for p in x] for x in wkb.lines(bytes(rows[0].geom))] == [SQUARE, HOLE]
    # the hole goes to the square round it, wherever it stands
    assert [[tuple(p) for p in x] for x in wkb.lines(bytes(rows[2].geom))] == [ISLAND, SQUARE, HOLE]
    assert len(wkb.lines(bytes(rows[3].geom))) == 2 and len(wkb.lines(bytes(rows[5].geom))) == 1
    edges = wkb.edges(layer.filter("n is not null"), "n").groupBy("id").count().collect()
    assert {r.id: r["count"] for r in edges} == {1: 8, -22: 12, 3: 3, 5: 4}


def test_encodings_deleted_rows_and_schemas(spark, tmp_path):
    shapefile.register(spark)
    path = write(tmp_path, SHAPES[:3], FIELDS[:1], [("Жук",), ("b",), ("c",)], "cp1251", deleted={1})
    (tmp_path / "x.cpg").write_text("1251\n")
    assert [r.name for r in spark.read.format("shapefile").load(path).collect()] == ["Жук", "c"]
    assert [r.name for r in spark.read.schema("name string").format("shapefile").option("encoding", "cp1251").load(path).collect()] == ["Жук", "c"]
    (tmp_path / "x.dbf").unlink()
    assert spark.read.format("shapefile").load(path).columns == ["geom"] and spark.read.format("shapefile").load(path).count() == 3
    empty = tmp_path / "empty"
    empty.mkdir()
    assert spark.read.format("shapefile").load(write(empty, [], FIELDS, [])).count() == 0
    with pytest.raises(Exception, match="no shapefile"):
        spark.read.format("shapefile").load(str(tmp_path / "none.shp"))


def test_rings():
    import numpy as np

    inner = [(3, 3), (3, 3.5), (3.5, 3.5), (3.5, 3), (3, 3)]  # an island in the hole
    drop = [(3.1, 3.1), (3.2, 3.1), (3.2, 3.2), (3.1, 3.1)]  # a hole in the island
    found = shapefile.polygons([np.array(r, float) for r in (HOLE, SQUARE, drop, inner)])
    assert [[tuple(map(tuple, r)) for r in p] for p in found] == [[tuple(map(tuple, np.array(r, float))) for r in p] for p in ([SQUARE, HOLE], [inner, drop])]
    assert len(shapefile.polygons([np.array(HOLE, float)])) == 1
