"""SQL of the line comparison's queries, written apart from the DataFrame code."""

from __future__ import annotations

from terrasieve.plans.oracle import intervals, with_views


def _pieces(source: str, mask: str, n: str = "") -> str:
    """pd{n}: id, inside, t0, t1 of a source edge's pieces in line order."""
    on = "PARTITION BY id ORDER BY lo, hi"
    touch = "CASE WHEN lo <= f + 1e-9 THEN f ELSE lo END"
    return intervals(source, mask, n) + f"""
        , mk{n} AS (SELECT id, lo, hi FROM iv{n} WHERE lo <= hi UNION ALL SELECT id, 1.0::DOUBLE, 1.0::DOUBLE FROM {source}),
        re{n} AS (SELECT *, coalesce(max(hi) OVER ({on} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS reach FROM mk{n}),
        gr{n} AS (SELECT *, sum((lo > reach + 1e-9)::INT) OVER ({on}) AS g FROM re{n}),
        gp{n} AS (SELECT id, min(lo) AS lo, max(hi) AS hi, min(reach) AS f FROM gr{n} GROUP BY id, g),
        pd{n} AS (SELECT * FROM (SELECT id, false AS inside, f AS t0, {touch} AS t1 FROM gp{n} UNION ALL SELECT id, true, {touch}, hi FROM gp{n}) WHERE t1 - t0 > 1e-9)"""


_AT = "CASE {t} WHEN 0 THEN {a} WHEN 1 THEN {b} ELSE {a} + {t} * ({b} - {a}) END AS {n}"
_ENDS = ", ".join(_AT.format(t=t, a=f"s.a{c}", b=f"s.b{c}{'_' * (c == 'y')}", n=n) for t, c, n in (("t0", "x", "x0"), ("t0", "y", "y0"), ("t1", "x", "x1"), ("t1", "y", "y1")))
_LENGTH = "sqrt((s.bx - s.ax) * (s.bx - s.ax) + (s.by_ - s.ay) * (s.by_ - s.ay)) * (t1 - t0) AS length"


def _compared(views: str = "e p") -> str:
    """c_: the comparison's pieces, with the source edge's corners."""
    one = lambda n, source, kind, seq: f"SELECT d.id, {kind} AS kind, row_number() OVER (PARTITION BY d.id, inside ORDER BY t0)::INT - 1 AS seq, {_ENDS}, {_LENGTH}, t0, t1, s.ax, s.ay, s.bx, s.by_ FROM pd{n} d JOIN {source} s ON s.id = d.id {seq}"
    return _pieces("p", "e") + _pieces("e", "p", "2") + f""", c_ AS ({one("", "p", "CASE WHEN inside THEN 'TP' ELSE 'FP' END", "")} UNION ALL {one("2", "e", "'FN'", "WHERE NOT inside")})"""


_MERGED = """, w1 AS (SELECT kind, t0, t1, floor(ax / 0.001::DOUBLE + 0.5)::BIGINT AS ax, floor(ay / 0.001::DOUBLE + 0.5)::BIGINT AS ay, floor(bx / 0.001::DOUBLE + 0.5)::BIGINT AS bx, floor(by_ / 0.001::DOUBLE + 0.5)::BIGINT AS by_ FROM c_),
        w2 AS (SELECT *, (bx - ax < 0 OR (bx = ax AND by_ < ay)) AS turned, gcd(abs(bx - ax), abs(by_ - ay)) AS g FROM w1),
        w3 AS (SELECT kind, CASE WHEN turned THEN -1 ELSE 1 END * (bx - ax) // g AS ux, CASE WHEN turned THEN -1 ELSE 1 END * (by_ - ay) // g AS uy, CASE WHEN turned THEN bx ELSE ax END AS lx, CASE WHEN turned THEN by_ ELSE ay END AS ly,
            g, CASE WHEN turned THEN 1 - t1 ELSE t0 END AS f, CASE WHEN turned THEN 1 - t0 ELSE t1 END AS l FROM w2),
        w4 AS (SELECT kind, ux, uy, ux * ly - uy * lx AS off, ux * ux + uy * uy AS n2, lx, ly, ux * lx + uy * ly AS zero, ux * lx + uy * ly + f * (g * (ux * ux + uy * uy)) AS lo, ux * lx + uy * ly + l * (g * (ux * ux + uy * uy)) AS hi FROM w3),
        w5 AS (SELECT *, coalesce(lo > max(hi) OVER (PARTITION BY kind, ux, uy, off ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1e-9 * greatest(1.0, abs(lo)), true)::INT AS fresh FROM w4),
        w6 AS (SELECT *, sum(fresh) OVER (PARTITION BY kind, ux, uy, off ORDER BY lo, hi) AS grp FROM w5),
        w7 AS (SELECT kind, ux, uy, any_value(n2) AS n2, min(lo) AS lo, max(hi) AS hi, min({'z': zero, 'x': lx, 'y': ly}) AS b FROM w6 GROUP BY kind, ux, uy, off, grp),
        mg AS (SELECT kind, (b.x + (lo - b.z) / n2 * ux) * 0.001::DOUBLE AS ax, (b.y + (lo - b.z) / n2 * uy) * 0.001::DOUBLE AS ay, (b.x + (hi - b.z) / n2 * ux) * 0.001::DOUBLE AS bx, (b.y + (hi - b.z) / n2 * uy) * 0.001::DOUBLE AS by_, (hi - lo) / sqrt(n2) * 0.001::DOUBLE AS length FROM w7)"""

_CELLS = lambda a, b, m: f"unnest(range((least({a}, {b}) - {m}) // 20000, (greatest({a}, {b}) + {m}) // 20000 + 1))"


def _noded() -> str:
    """nd: kind, ax, ay, bx, by_ of the noded union in whole units. Coordinates are moved to positive numbers, so that // rounds down."""
    low = "(SELECT min(least(x0, x1, y0, y1)) FROM c_)"
    whole = lambda c: f"floor({c} / 0.001::DOUBLE + 0.5)::BIGINT"
    shift = f"(CASE WHEN {low} < 0 THEN {whole(low)} - 1 ELSE 0 END)"
    moved = lambda c: f"{whole(c)} - sh"
    side = lambda z, d, lo: f"CASE WHEN {d} > 0 THEN {lo} ELSE -{lo} END"  # noqa: E731, ARG005
    once = "SELECT DISTINCT kind, CASE WHEN f THEN ax ELSE bx END AS ax, CASE WHEN f THEN ay ELSE by_ END AS ay, CASE WHEN f THEN bx ELSE ax END AS bx, CASE WHEN f THEN by_ ELSE ay END AS by_ FROM (SELECT *, (ax < bx OR (ax = bx AND ay < by_)) AS f FROM {t} WHERE ax <> bx OR ay <> by_)"
    inside = lambda n0, w, c0, n1, c1: f"({w} = 0 OR (({n0} < {w} OR ({n0} = {w} AND {c0})) AND ({n1} > 0 OR ({n1} = 0 AND {c1}))))"
    both = lambda n0, w0, c0, n1, w1, c1: f"({w0} = 0 OR {w1} = 0 OR {n0} * {w1} < {n1} * {w0} OR ({n0} * {w1} = {n1} * {w0} AND {c0} AND {c1}))"
    return f"""
        , sh AS (SELECT {shift} AS sh), r1 AS (SELECT kind, {moved("x0")} AS ax, {moved("y0")} AS ay, {moved("x1")} AS bx, {moved("y1")} AS by_ FROM c_, sh),
        r2 AS ({once.format(t="r1")}), r3 AS (SELECT *, row_number() OVER (ORDER BY kind, ax, ay, bx, by_) AS sid FROM r2),
        g1 AS (SELECT *, {_CELLS("ax", "bx", 0)} AS cx FROM r3), g2 AS (SELECT *, {_CELLS("ay", "by_", 0)} AS cy FROM g1),
        xk1 AS (SELECT DISTINCT a.kind, a.ax::HUGEINT AS ax, a.ay::HUGEINT AS ay, (a.bx - a.ax)::HUGEINT AS ux, (a.by_ - a.ay)::HUGEINT AS uy, (b.bx - b.ax)::HUGEINT AS vx, (b.by_ - b.ay)::HUGEINT AS vy, (b.ax - a.ax)::HUGEINT AS wx, (b.ay - a.ay)::HUGEINT AS wy
            FROM g2 a JOIN g2 b ON a.kind = b.kind AND a.cx = b.cx AND a.cy = b.cy AND a.sid < b.sid),
        xk2 AS (SELECT *, ux * wy - uy * wx AS c, ux * (wy + vy) - uy * (wx + vx) AS d, vy * wx - vx * wy AS a, vy * (wx - ux) - vx * (wy - uy) AS b FROM xk1),
        xk3 AS (SELECT kind, ax, ay, ux, uy, CASE WHEN a > b THEN a ELSE -a END AS s, abs(a - b) AS w FROM xk2 WHERE ((c < 0 AND d > 0) OR (c > 0 AND d < 0)) AND ((a < 0 AND b > 0) OR (a > 0 AND b < 0))),
        xk4 AS (SELECT kind, ax, ay, 2 * ux * s + w AS nx, 2 * uy * s + w AS ny, 2 * w AS m FROM xk3),
        h1 AS (SELECT kind, ax AS x, ay AS y FROM r3 UNION SELECT kind, bx, by_ FROM r3 UNION
            SELECT kind, (ax + CASE WHEN nx >= 0 THEN nx // m ELSE -((m - 1 - nx) // m) END)::BIGINT, (ay + CASE WHEN ny >= 0 THEN ny // m ELSE -((m - 1 - ny) // m) END)::BIGINT FROM xk4),
        h2 AS (SELECT *, x // 20000 AS cx, y // 20000 AS cy FROM h1),
        j1 AS (SELECT *, {_CELLS("ax", "bx", 1)} AS cx FROM r3), j2 AS (SELECT *, {_CELLS("ay", "by_", 1)} AS cy FROM j1),
        j3 AS (SELECT DISTINCT sid, j2.kind, ax, ay, bx, by_, x, y FROM j2 JOIN h2 ON j2.kind = h2.kind AND j2.cx = h2.cx AND j2.cy = h2.cy AND x BETWEEN least(ax, bx) - 1 AND greatest(ax, bx) + 1 AND y BETWEEN least(ay, by_) - 1 AND greatest(ay, by_) + 1),
        j4 AS (SELECT *, 2 * (bx - ax)::HUGEINT AS dx, 2 * (by_ - ay)::HUGEINT AS dy, 2 * (x - ax)::HUGEINT AS px, 2 * (y - ay)::HUGEINT AS py FROM j3),
        j5 AS (SELECT *, abs(dx) AS wx, abs(dy) AS wy, {side("x", "dx", "(px - 1)").replace("ELSE -(px - 1)", "ELSE -(px + 1)")} AS lx, {side("x", "dx", "(px + 1)").replace("ELSE -(px + 1)", "ELSE -(px - 1)")} AS hx,
            {side("y", "dy", "(py - 1)").replace("ELSE -(py - 1)", "ELSE -(py + 1)")} AS ly, {side("y", "dy", "(py + 1)").replace("ELSE -(py + 1)", "ELSE -(py - 1)")} AS hy FROM j4),
        j6 AS (SELECT * FROM j5 WHERE (dx <> 0 OR (px - 1 <= 0 AND px + 1 > 0)) AND (dy <> 0 OR (py - 1 <= 0 AND py + 1 > 0)) AND {inside("lx", "wx", "dx > 0", "hx", "dx < 0")} AND {inside("ly", "wy", "dy > 0", "hy", "dy < 0")}
            AND {both("lx", "wx", "dx > 0", "hy", "wy", "dy < 0")} AND {both("ly", "wy", "dy > 0", "hx", "wx", "dx < 0")}),
        j7 AS (SELECT kind, x AS ax, y AS ay, lead(x) OVER q AS bx, lead(y) OVER q AS by_ FROM j6 WINDOW q AS (PARTITION BY sid ORDER BY dx * px + dy * py)),
        j8 AS ({once.format(t="(SELECT * FROM j7 WHERE bx IS NOT NULL)")}),
        nd AS (SELECT kind, ax + sh AS ax, ay + sh AS ay, bx + sh AS bx, by_ + sh AS by_ FROM j8, sh)"""


_CHAINS = """, arc AS (SELECT kind, ax AS ux, ay AS uy, bx AS vx, by_ AS vy FROM nd UNION ALL SELECT kind, bx, by_, ax, ay FROM nd),
        dg AS (SELECT kind, ux AS x, uy AS y, count(*) AS n FROM arc GROUP BY 1, 2, 3),
        nx AS (SELECT a.*, b.vx AS wx, b.vy AS wy FROM arc a JOIN dg ON dg.kind = a.kind AND dg.x = a.vx AND dg.y = a.vy AND dg.n = 2 JOIN arc b ON b.kind = a.kind AND b.ux = a.vx AND b.uy = a.vy AND (b.vx <> a.ux OR b.vy <> a.uy)),
        walk AS (SELECT a.kind, ux AS sx, uy AS sy, vx AS tx, vy AS ty, 0::BIGINT AS i, ux, uy, vx, vy FROM arc a JOIN dg ON dg.kind = a.kind AND dg.x = a.ux AND dg.y = a.uy AND dg.n <> 2
            UNION ALL SELECT w.kind, sx, sy, tx, ty, i + 1, nx.vx, nx.vy, wx, wy FROM walk w JOIN nx ON nx.kind = w.kind AND nx.ux = w.ux AND nx.uy = w.uy AND nx.vx = w.vx AND nx.vy = w.vy),
        rest AS (SELECT * FROM arc EXCEPT SELECT kind, ux, uy, vx, vy FROM walk),
        turn AS (SELECT kind, ux AS sx, uy AS sy, vx AS tx, vy AS ty, 0::BIGINT AS i, ux, uy, vx, vy FROM rest
            UNION ALL SELECT w.kind, sx, sy, tx, ty, i + 1, nx.vx, nx.vy, wx, wy FROM turn w JOIN nx ON nx.kind = w.kind AND nx.ux = w.ux AND nx.uy = w.uy AND nx.vx = w.vx AND nx.vy = w.vy
                WHERE (nx.vx <> sx OR nx.vy <> sy) AND (nx.vx > sx OR (nx.vx = sx AND nx.vy > sy))),
        closed AS (SELECT kind, sx, sy, tx, ty FROM turn WHERE vx = sx AND vy = sy),
        steps AS (SELECT *, false AS ring FROM walk UNION ALL SELECT turn.*, true FROM turn JOIN closed USING (kind, sx, sy, tx, ty)),
        ends AS (SELECT kind, sx, sy, tx, ty, max(i) AS last, arg_max({'a': vx, 'b': vy, 'c': ux, 'd': uy}, i) AS e FROM steps GROUP BY 1, 2, 3, 4, 5),
        kept AS (SELECT s.*, last, e.a = s.sx AND e.b = s.sy AS ring_ FROM steps s JOIN ends USING (kind, sx, sy, tx, ty) WHERE (s.sx, s.sy, s.tx, s.ty) < (e.a, e.b, e.c, e.d)),
        spots AS (SELECT kind, sx, sy, tx, ty, i AS seq, ux AS x, uy AS y, ring_ FROM kept UNION ALL SELECT kind, sx, sy, tx, ty, i + 1, vx, vy, ring_ FROM kept WHERE i = last)"""

_REPORT = """, cl AS (SELECT file_name, kind, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) * greatest(0, t1 - t0) AS clipped FROM (SELECT c.file_name, l.*,
        greatest(0.0, CASE WHEN bx = ax THEN 0.0 ELSE least((xmin - ax) / (bx - ax), (xmax - ax) / (bx - ax)) END, CASE WHEN by_ = ay THEN 0.0 ELSE least((ymin - ay) / (by_ - ay), (ymax - ay) / (by_ - ay)) END) AS t0,
        least(1.0, CASE WHEN bx = ax THEN 1.0 ELSE greatest((xmin - ax) / (bx - ax), (xmax - ax) / (bx - ax)) END, CASE WHEN by_ = ay THEN 1.0 ELSE greatest((ymin - ay) / (by_ - ay), (ymax - ay) / (by_ - ay)) END) AS t1
        FROM mg l JOIN c ON least(ax, bx) <= xmax AND greatest(ax, bx) >= xmin AND least(ay, by_) <= ymax AND greatest(ay, by_) >= ymin)),
        sm AS (SELECT file_name, sum(clipped) FILTER (kind = 'TP') AS tp, sum(clipped) FILTER (kind = 'FP') AS fp, sum(clipped) FILTER (kind = 'FN') AS fn FROM cl GROUP BY 1),
        y1 AS (SELECT f.file_name, keep, CASE WHEN keep THEN coalesce(tp, 0) END AS tp_length, CASE WHEN keep THEN coalesce(fp, 0) END AS fp_length, CASE WHEN keep THEN coalesce(fn, 0) END AS fn_length FROM f LEFT JOIN sm ON sm.file_name = f.file_name),
        y2 AS (SELECT *, CASE WHEN keep THEN CASE WHEN tp_length + fp_length > 0 THEN tp_length / (tp_length + fp_length) ELSE 0 END END AS precision, CASE WHEN keep THEN CASE WHEN tp_length + fn_length > 0 THEN tp_length / (tp_length + fn_length) ELSE 0 END END AS recall FROM y1)
        SELECT y2.file_name, coalesce(split, 'NA') AS dataset_split, keep, round(tp_length, 3) AS tp_length, round(fp_length, 3) AS fp_length, round(fn_length, 3) AS fn_length, round(precision, 3) AS precision, round(recall, 3) AS recall,
            round(CASE WHEN keep THEN CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END END, 3) AS f1_score FROM y2 LEFT JOIN m ON m.file_name = y2.file_name"""

SQL: dict[str, str] = {
    "q_line_pieces": with_views("e p", _compared() + " SELECT id, kind, seq, round(x0, 4) AS x0, round(y0, 4) AS y0, round(x1, 4) AS x1, round(y1, 4) AS y1, round(length, 4) AS length FROM c_"),
    "q_piece_totals": with_views("e p", _compared() + " SELECT kind, round(sum(length), 3) AS length, count(DISTINCT id) AS lines, count(*) AS pieces FROM c_ GROUP BY 1"),
    "q_merged_pieces": with_views("e p", _compared() + _MERGED + " SELECT kind, round(ax, 3) AS x0, round(ay, 3) AS y0, round(bx, 3) AS x1, round(by_, 3) AS y1, round(length, 3) AS length FROM mg"),
    "q_noded_parts": with_views("e p", _compared() + _noded() + " SELECT kind, round(ax * 0.001::DOUBLE, 3) AS x0, round(ay * 0.001::DOUBLE, 3) AS y0, round(bx * 0.001::DOUBLE, 3) AS x1, round(by_ * 0.001::DOUBLE, 3) AS y1, round(sqrt(((bx - ax) * (bx - ax))::DOUBLE + ((by_ - ay) * (by_ - ay))::DOUBLE) * 0.001::DOUBLE, 4) AS length FROM nd"),
    "q_chained_lines": with_views("e p", _compared() + _noded() + _CHAINS + " SELECT kind, sx || ' ' || sy || ' ' || tx || ' ' || ty AS line, seq, round(x * 0.001::DOUBLE, 3) AS x, round(y * 0.001::DOUBLE, 3) AS y, ring_ AS ring FROM spots", recursive=True),
    "q_chip_report_compared": with_views("e p c b f m", _compared() + _MERGED + _REPORT),
}
