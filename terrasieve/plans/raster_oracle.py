"""SQL of the queries over mosaics, borders and samples, written apart from the DataFrame code."""

from __future__ import annotations

from terrasieve.plans.oracle import with_views

_MOSAIC = """WITH i AS (SELECT vec_id, embedding AS v, (vec_id % 50) * 5 + 0.25::DOUBLE * (vec_id % 4) AS x0, (vec_id // 50) * 5 + 0.125::DOUBLE * (vec_id % 3) AS y0, CASE WHEN vec_id % 2 = 0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS s FROM embeddings),
    g AS (SELECT min(x0) AS gx, max(y0) AS gy, min(s) AS gp FROM i),
    r AS (SELECT *, unnest(range(ceil((gy - y0) / gp - 0.5::DOUBLE)::BIGINT, ceil((gy - y0 + 8 * s) / gp - 0.5::DOUBLE)::BIGINT)) AS row FROM i, g),
    c AS (SELECT *, unnest(range(ceil((x0 - gx) / gp - 0.5::DOUBLE)::BIGINT, ceil((x0 - gx + 8 * s) / gp - 0.5::DOUBLE)::BIGINT)) AS col FROM r),
    p AS (SELECT row, col, vec_id, v[floor((y0 - gy + (row + 0.5::DOUBLE) * gp) / s)::BIGINT * 8 + floor((gx + (col + 0.5::DOUBLE) * gp - x0) / s)::BIGINT + 1]::DOUBLE AS value FROM c),
    m AS (SELECT row, col, arg_max(value, vec_id) AS value FROM p WHERE value >= 0 GROUP BY 1, 2)"""


def _axis(name: str, source: str, i: str, n: str, step: str, bounds: str = "") -> str:
    """Weights of source pixels k in output pixels along one axis: key columns, i, k, w. bounds: a condition on k."""
    return f""", {name}1 AS (SELECT *, unnest(range({n})) AS {i} FROM {source}), {name}2 AS (SELECT *, {name}_off + ({i} + 0.5::DOUBLE) * {step} AS centre, greatest(1.0::DOUBLE, {step}) AS reach FROM {name}1),
    {name}3 AS (SELECT *, unnest(range(floor(centre - reach - 1)::BIGINT, ceil(centre + reach + 1)::BIGINT)) AS k FROM {name}2),
    {name}4 AS (SELECT key, {i}, k, greatest(0.0::DOUBLE, 1 - abs(k + 0.5::DOUBLE - centre) / reach) AS w FROM {name}3 {bounds}),
    {name} AS (SELECT key, {i}, k, w / sum(w) OVER (PARTITION BY key, {i}) AS w FROM {name}4)"""


def _mask(limit: float, name: str) -> str:
    """name: row, col of the pixels whose centre is within a distance of a (level or upright) edge, limit being its square."""
    return f""", g0 AS (SELECT *, unnest(range(floor(least(ax, bx))::BIGINT - 2, ceil(greatest(ax, bx))::BIGINT + 3)) AS col FROM e), h0 AS (SELECT *, unnest(range(floor(least(ay, by_))::BIGINT - 2, ceil(greatest(ay, by_))::BIGINT + 3)) AS row FROM g0),
        {name} AS (SELECT DISTINCT row, col FROM h0 WHERE row >= 0 AND col >= 0 AND (col + 0.5::DOUBLE - greatest(least(ax, bx), least(greatest(ax, bx), col + 0.5::DOUBLE)))^2 + (row + 0.5::DOUBLE - greatest(least(ay, by_), least(greatest(ay, by_), row + 0.5::DOUBLE)))^2 <= {limit})"""


def _thinned(source: str, name: str, rounds: int = 6, chunk: int = 2048) -> str:
    """name: what parallel thinning leaves of source, chunk by chunk. m has a bit for each set neighbour, clockwise from the one above. The rounds
    are stated; a further one must change nothing, or the count of rows is wrong on purpose."""
    near = "(VALUES (-1, 0, 1), (-1, 1, 2), (0, 1, 4), (1, 1, 8), (1, 0, 16), (1, -1, 32), (0, -1, 64), (-1, -1, 128)) AS w(y, x, bit)"
    out, last = "", source
    for k in range(2 * rounds + 2):
        free = "m & 21 <> 21 AND m & 84 <> 84" if k % 2 == 0 else "m & 69 <> 69 AND m & 81 <> 81"
        out += f""", u{k} AS (SELECT p.row, p.col, coalesce(sum(bit) FILTER (q.row IS NOT NULL), 0)::INT AS m FROM {last} p, {near}
            LEFT JOIN {last} q ON q.row = p.row + y AND q.col = p.col + x AND q.row // {chunk} = p.row // {chunk} AND q.col // {chunk} = p.col // {chunk} GROUP BY 1, 2),
        z{k} AS (SELECT row, col FROM u{k} WHERE NOT (bit_count(m) BETWEEN 2 AND 6 AND bit_count(((m >> 1) | ((m & 1) << 7)) & ~m) = 1 AND {free}))"""
        last = f"z{k}"
    done = f"z{2 * rounds - 1}"
    return out + f", {name} AS (SELECT row, col FROM {done} UNION ALL SELECT -1, -1 WHERE (SELECT count(*) FROM {done}) <> (SELECT count(*) FROM {last}))"


_TOTALS = """,
        sides AS (SELECT d.*, s.* FROM d, (VALUES (-1, 0, 0, 1), (0, 1, 1, 0), (1, 0, 0, -1), (0, -1, -1, 0)) AS s(ny, nx, hy, hx)),
        free AS (SELECT sides.* FROM sides ANTI JOIN d ON d.row = sides.row + ny AND d.col = sides.col + nx),
        goes AS (SELECT free.*, a.row IS NOT NULL OR b.row IS NOT NULL AS leaves FROM free LEFT JOIN d a ON a.row = free.row + ny + hy AND a.col = free.col + nx + hx LEFT JOIN d b ON b.row = free.row + hy AND b.col = free.col + hx),
        pts AS (SELECT row, col FROM goes WHERE leaves UNION ALL SELECT row, col FROM goes GROUP BY 1, 2 HAVING count(*) = 4 AND NOT bool_or(leaves)),
        quads AS (SELECT y, x, count(*) AS n, min(dx) <> max(dx) AND min(dy) <> max(dy) AND count(*) = 2 AND (max(dx) FILTER (dy = 0)) + (max(dx) FILTER (dy = 1)) = 1 AS diagonal
            FROM (SELECT row - dy AS y, col - dx AS x, dy, dx FROM d, (SELECT unnest([0, 1]) AS dy), (SELECT unnest([0, 1]) AS dx)) GROUP BY 1, 2)
        SELECT (SELECT (sum((n = 1)::INT) - sum((n = 3)::INT) - 2 * sum(diagonal::INT)) // 4 FROM quads)::BIGINT AS outer_less_holes, (SELECT count(*) FROM d) AS area, count(*) AS points, sum(row)::BIGINT AS rows, sum(col)::BIGINT AS cols FROM pts"""


def _contours(rounds: int = 20, least: int = 5) -> str:
    """Borders of d, point by point, without straight runs. Each round joins the pointers with themselves, for rings of up to 2^rounds sides."""

    def doubled(name: str, first: str, more: str) -> str:
        out = f", {name}0 AS MATERIALIZED ({first})"
        for k in range(rounds):
            out += f", {name}{k + 1} AS MATERIALIZED (SELECT a.id, b.ptr, {more} FROM {name}{k} a JOIN {name}{k} b ON b.id = a.ptr)"
        return out

    return (
        """, s1 AS (SELECT d.*, s.* FROM d, (VALUES (0, -1, 0, 0, 1), (1, 0, 1, 1, 0), (2, 1, 0, 0, -1), (3, 0, -1, -1, 0)) AS s(way, ny, nx, hy, hx)),
        s2 AS MATERIALIZED (SELECT s1.*, row_number() OVER (ORDER BY s1.row, s1.col, way) AS id FROM s1 ANTI JOIN d ON d.row = s1.row + ny AND d.col = s1.col + nx),
        s3 AS (SELECT s2.*, a.row IS NOT NULL AS l, b.row IS NOT NULL AS f FROM s2 LEFT JOIN d a ON a.row = s2.row + ny + hy AND a.col = s2.col + nx + hx LEFT JOIN d b ON b.row = s2.row + hy AND b.col = s2.col + hx),
        fol AS MATERIALIZED (SELECT s3.id, s2.id AS nxt FROM s3 JOIN s2 ON s2.row = s3.row + CASE WHEN l THEN s3.ny + s3.hy WHEN f THEN s3.hy ELSE 0 END AND s2.col = s3.col + CASE WHEN l THEN s3.nx + s3.hx WHEN f THEN s3.hx ELSE 0 END
            AND s2.way = (s3.way + CASE WHEN l THEN 3 WHEN f THEN 0 ELSE 1 END) % 4)"""
        + doubled("mn", "SELECT id, nxt AS ptr, id AS low FROM fol", "least(a.low, b.low) AS low")
        + doubled("ds", f"SELECT fol.id, CASE WHEN nxt = low THEN fol.id ELSE nxt END AS ptr, (nxt <> low)::BIGINT AS dist FROM fol JOIN mn{rounds} m ON m.id = fol.id", "a.dist + CASE WHEN a.ptr = a.id THEN 0 ELSE b.dist END AS dist")
        + f""", o1 AS (SELECT low, s2.row, s2.col, way, max(dist) OVER (PARTITION BY low) - dist AS pos FROM s2 JOIN mn{rounds} m ON m.id = s2.id JOIN ds{rounds} e ON e.id = s2.id),
        ar AS (SELECT low, sum(CASE way WHEN 1 THEN col + 1 WHEN 3 THEN -col ELSE 0 END) < 0 AS hole, arg_min(row || ' ' || col || ' ' || way, pos) AS border FROM o1 GROUP BY 1),
        o2 AS (SELECT *, coalesce(lag(row) OVER w <> row OR lag(col) OVER w <> col, true) AS begins, first_value(row) OVER w AS fr, first_value(col) OVER w AS fc FROM o1 WINDOW w AS (PARTITION BY low ORDER BY pos)),
        o3 AS (SELECT *, count(*) OVER (PARTITION BY low) AS runs, row_number() OVER (PARTITION BY low ORDER BY pos) AS run FROM o2 WHERE begins),
        o4 AS (SELECT low, row, col, pos FROM o3 WHERE runs = 1 OR run < runs OR row <> fr OR col <> fc),
        o5 AS (SELECT *, count(*) OVER (PARTITION BY low) AS n, coalesce(lag(row) OVER w, last_value(row) OVER v) AS pr, coalesce(lag(col) OVER w, last_value(col) OVER v) AS pc, coalesce(lead(row) OVER w, first_value(row) OVER w) AS nr, coalesce(lead(col) OVER w, first_value(col) OVER w) AS nc
            FROM o4 WINDOW w AS (PARTITION BY low ORDER BY pos), v AS (PARTITION BY low ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
        o6 AS (SELECT low, row, col, row_number() OVER (PARTITION BY low ORDER BY pos) - 1 AS seq, count(*) OVER (PARTITION BY low) AS n FROM o5 WHERE n = 1 OR row - pr <> nr - row OR col - pc <> nc - col)
        SELECT border, hole, seq, col + 0.5::DOUBLE AS x, row + 0.5::DOUBLE AS y FROM o6 JOIN ar ON ar.low = o6.low WHERE n >= {least}"""
    )


def _downscaled(ratio: float, n: int) -> str:
    return f"""SELECT {ratio}::DOUBLE AS ratio, vec_id, y{n}.i AS row, x{n}.j AS col, round(sum(y{n}.w * x{n}.w * embedding[y{n}.k * 8 + x{n}.k + 1]::DOUBLE), 6) AS value, 0.25::DOUBLE * 8 / {n} AS out_px FROM embeddings, y{n}, x{n} GROUP BY 1, 2, 3, 4"""


def _axes(n: int) -> str:
    one = lambda name, i: _axis(f"{name}{n}", f"(SELECT 0 AS key, 0.0::DOUBLE AS {name}{n}_off)", i, str(n), f"(8.0::DOUBLE / {n})", "WHERE k >= 0 AND k < 8")
    return one("y", "i") + one("x", "j")


SQL: dict[str, str] = {
    "q_regrid_mosaic": _MOSAIC + " SELECT row, col, round(value, 6) AS value FROM m",
    "q_window_by_bounds": _MOSAIC + """, w AS (SELECT s_suppkey AS key, (gy - (4.6::DOUBLE + (s_suppkey * 7 % 50))) / gp AS y_off, (((s_suppkey * 13 % 260) - 3 + 0.3::DOUBLE) - gx) / gp AS x_off, gp FROM supplier, g)"""
    + _axis("y", "w", "i", "6", "(4.7::DOUBLE / gp / 6)") + _axis("x", "w", "j", "5", "(3.9::DOUBLE / gp / 5)")
    + " SELECT y.key, y.i AS row, x.j AS col, round(coalesce(sum(y.w * x.w * m.value), 0), 6) AS value FROM y JOIN x ON x.key = y.key LEFT JOIN m ON m.row = y.k AND m.col = x.k GROUP BY 1, 2, 3",
    "q_downscale_ratio": f"WITH z AS (SELECT 1){_axes(2)}{_axes(4)} {_downscaled(0.3, 2)} UNION ALL {_downscaled(0.5, 4)}",
    "q_border_totals": with_views("e", _mask(0.5625, "d") + _TOTALS),
    "q_thinned_pixels": with_views("e", _mask(2.25, "d0") + _thinned("d0", "d") + " SELECT row, col FROM d"),
    "q_contour_totals": with_views("e", _mask(2.25, "d0") + _thinned("d0", "d") + _TOTALS),
    "q_border_contours": with_views("e", _mask(2.25, "d0") + _thinned("d0", "d") + _contours()),
    "q_scaler_sampled": with_views("v", """, h AS (SELECT i % 4 AS band, value, row_number() OVER (PARTITION BY i % 4 ORDER BY ('0x' || left(md5(vec_id || ':' || i), 15))::BIGINT) AS place FROM v)
        SELECT band, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM h WHERE place <= 1000 GROUP BY 1"""),
}
