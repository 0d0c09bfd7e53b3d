"""The same queries in SQL for DuckDB, written apart from the DataFrame code. V holds the derived views as common table expressions."""

from __future__ import annotations

_VIEWS = {
    "e": """e AS (SELECT 4 * p_partkey + i AS id, CASE WHEN i IN (1, 2) THEN x + 10 ELSE x END::DOUBLE AS ax, CASE WHEN i IN (2, 3) THEN y + 10 ELSE y END::DOUBLE AS ay,
        CASE WHEN i IN (0, 1) THEN x + 10 ELSE x END::DOUBLE AS bx, CASE WHEN i IN (1, 2) THEN y + 10 ELSE y END::DOUBLE AS by_
        FROM (SELECT p_partkey, (p_partkey % 20) * 10 AS x, (p_partkey // 20) * 10 AS y FROM part), (SELECT unnest([0, 1, 2, 3]) AS i))""",
    "p": """p AS (SELECT o_orderkey AS id, ax + o_custkey % 9 - 4 AS ax, ay + o_custkey % 7 - 3 AS ay, bx + o_custkey % 5 - 2 AS bx, by_ + o_custkey % 11 - 5 AS by_ FROM e JOIN orders ON o_orderkey % (SELECT 4 * count(*) FROM part) = id)""",
    "c": """c AS (SELECT 'chip_' || cx || '_' || cy || '.tif' AS file_name, cx, cy, cx * 24.0::DOUBLE AS xmin, cy * 24.0::DOUBLE AS ymin, cx * 24.0::DOUBLE + 32 AS xmax, cy * 24.0::DOUBLE + 32 AS ymax
        FROM (SELECT unnest(range(0, 9)) AS cx), (SELECT unnest(range(0, ceil((max(p_partkey) // 20 + 1) * 10 / 24.0)::BIGINT)) AS cy FROM part))""",
    "b": """b AS (SELECT '/data/chips/' || file_name AS image_file, CASE (7 * cx + 3 * cy) % 6 WHEN 0 THEN ' True' WHEN 1 THEN '1' WHEN 2 THEN 'no' WHEN 3 THEN 'YES ' WHEN 4 THEN '1.0' END AS is_background_only
        FROM c WHERE (cx + cy) % 5 <> 4)""",
    "f": """f AS (SELECT c.*, is_background_only, NOT coalesce(lower(trim(is_background_only)) IN ('true', '1', 'yes'), false) AS keep FROM c LEFT JOIN b ON split_part(image_file, '/', 4) = file_name)""",
    "m": """m AS (SELECT file_name, CASE (5 * cx + cy) % 10 WHEN 8 THEN 'test' WHEN 7 THEN 'val' WHEN 6 THEN 'val' ELSE 'train' END AS split FROM c WHERE (5 * cx + cy) % 10 <> 9)""",
    "l": """l AS (SELECT *, CASE id % 3 WHEN 0 THEN 'TP' WHEN 1 THEN 'FP' ELSE 'FN' END AS pred_result FROM p)""",
    "clip": """clip AS (SELECT file_name, pred_result, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) * greatest(0, t1 - t0) AS clipped FROM (SELECT c.file_name, l.*,
        greatest(0.0, CASE WHEN bx = ax THEN 0.0 ELSE least((xmin - ax) / (bx - ax), (xmax - ax) / (bx - ax)) END, CASE WHEN by_ = ay THEN 0.0 ELSE least((ymin - ay) / (by_ - ay), (ymax - ay) / (by_ - ay)) END) AS t0,
        least(1.0, CASE WHEN bx = ax THEN 1.0 ELSE greatest((xmin - ax) / (bx - ax), (xmax - ax) / (bx - ax)) END, CASE WHEN by_ = ay THEN 1.0 ELSE greatest((ymin - ay) / (by_ - ay), (ymax - ay) / (by_ - ay)) END) AS t1
        FROM l JOIN c ON least(ax, bx) <= xmax AND greatest(ax, bx) >= xmin AND least(ay, by_) <= ymax AND greatest(ay, by_) >= ymin))""",
    "s": """s AS (SELECT file_name, coalesce(sum(clipped) FILTER (pred_result = 'TP'), 0) AS tp, coalesce(sum(clipped) FILTER (pred_result = 'FP'), 0) AS fp, coalesce(sum(clipped) FILTER (pred_result = 'FN'), 0) AS fn FROM clip GROUP BY 1),
        q AS (SELECT f.file_name, keep, CASE WHEN keep THEN coalesce(tp, 0) END AS tp_length, CASE WHEN keep THEN coalesce(fp, 0) END AS fp_length, CASE WHEN keep THEN coalesce(fn, 0) END AS fn_length FROM f LEFT JOIN s ON s.file_name = f.file_name),
        pr AS (SELECT *, CASE WHEN keep THEN CASE WHEN tp_length + fp_length > 0 THEN tp_length / (tp_length + fp_length) ELSE 0 END END AS precision, CASE WHEN keep THEN CASE WHEN tp_length + fn_length > 0 THEN tp_length / (tp_length + fn_length) ELSE 0 END END AS recall FROM q),
        report AS (SELECT pr.*, coalesce(split, 'NA') AS dataset_split, CASE WHEN keep THEN CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END END AS f1_score FROM pr LEFT JOIN m ON m.file_name = pr.file_name)""",
    "v": """v AS (SELECT vec_id, unnest(range(0, 64)) AS i, unnest(embedding)::DOUBLE AS value FROM embeddings)""",
    "pm": """pm AS (SELECT a.vec_id, a.i, 1 / (1 + exp(-10 * a.value)) AS prob, CASE WHEN b.value > 0 THEN 1 ELSE 0 END AS mask FROM v a JOIN v b ON b.vec_id = (a.vec_id + 1) % (SELECT count(*) FROM embeddings) AND b.i = a.i)""",
    "n": """n AS (SELECT vec_id, sum((prob > 0.5 AND mask > 0)::INT)::INT AS both_, sum((prob > 0.5)::INT)::INT AS p, sum((mask > 0)::INT)::INT AS t FROM pm GROUP BY 1),
        io AS (SELECT *, CASE WHEN p + t - both_ = 0 THEN 1 ELSE both_ / (p + t - both_) END AS iou, CASE WHEN p + t = 0 THEN 1 ELSE 2 * both_ / (p + t) END AS dice FROM n)""",
    "h": """h AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS epoch, value AS val_loss FROM events)""",
    "mo": """mo AS (SELECT strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN '_checkpoint.pth' ELSE '.pth' END AS name FROM orders)""",
}


def with_views(views: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' * recursive}{', '.join(_VIEWS[v] for v in views.split())} {body}"


def intervals(source: str, mask: str, n: str = "") -> str:
    """Covered intervals of source edges by capsules of 3 round mask edges, then inside and outside. n: ends the names of its parts."""
    return f"""
        , pair{n} AS (SELECT x.id, x.ax, x.ay, x.bx - x.ax AS vx, x.by_ - x.ay AS vy, y.bx - y.ax AS wx, y.by_ - y.ay AS wy, x.ax - y.ax AS ux, x.ay - y.ay AS uy, x.ax - y.bx AS zx, x.ay - y.by_ AS zy
            FROM {source} x JOIN {mask} y ON least(x.ax, x.bx) <= greatest(y.ax, y.bx) + 3 AND greatest(x.ax, x.bx) >= least(y.ax, y.bx) - 3 AND least(x.ay, x.by_) <= greatest(y.ay, y.by_) + 3 AND greatest(x.ay, x.by_) >= least(y.ay, y.by_) - 3),
        k{n} AS (SELECT id, vx * vx + vy * vy AS a, vx * ux + vy * uy AS rb, ux * ux + uy * uy - 9 AS rc, vx * zx + vy * zy AS sb, zx * zx + zy * zy - 9 AS sc, ux * wx + uy * wy AS l0, vx * wx + vy * wy AS l1, ux * wy - uy * wx AS c0, vx * wy - vy * wx AS c1, wx * wx + wy * wy AS ww FROM pair{n}),
        t{n} AS (SELECT id, CASE WHEN rb * rb - a * rc >= 0 THEN (-rb - sqrt(rb * rb - a * rc)) / a END AS r0, CASE WHEN rb * rb - a * rc >= 0 THEN (-rb + sqrt(rb * rb - a * rc)) / a END AS r1,
            CASE WHEN sb * sb - a * sc >= 0 THEN (-sb - sqrt(sb * sb - a * sc)) / a END AS s0, CASE WHEN sb * sb - a * sc >= 0 THEN (-sb + sqrt(sb * sb - a * sc)) / a END AS s1,
            greatest(CASE WHEN l1 = 0 THEN CASE WHEN l0 BETWEEN 0 AND ww THEN -1e9 ELSE 1e9 END ELSE least(-l0 / l1, (ww - l0) / l1) END, CASE WHEN c1 = 0 THEN CASE WHEN abs(c0) <= 3 * sqrt(ww) THEN -1e9 ELSE 1e9 END ELSE least((-3 * sqrt(ww) - c0) / c1, (3 * sqrt(ww) - c0) / c1) END) AS b0,
            least(CASE WHEN l1 = 0 THEN CASE WHEN l0 BETWEEN 0 AND ww THEN 1e9 ELSE -1e9 END ELSE greatest(-l0 / l1, (ww - l0) / l1) END, CASE WHEN c1 = 0 THEN CASE WHEN abs(c0) <= 3 * sqrt(ww) THEN 1e9 ELSE -1e9 END ELSE greatest((-3 * sqrt(ww) - c0) / c1, (3 * sqrt(ww) - c0) / c1) END) AS b1 FROM k{n}),
        hu{n} AS (SELECT id, least(r0, s0, CASE WHEN b0 <= b1 THEN b0 END) AS h0, greatest(r1, s1, CASE WHEN b0 <= b1 THEN b1 END) AS h1 FROM t{n}),
        iv{n} AS (SELECT id, greatest(0.0, h0) AS lo, least(1.0, h1) AS hi FROM hu{n} WHERE h0 IS NOT NULL),
        cov{n} AS (SELECT id, lo, hi, max(hi) OVER (PARTITION BY id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rm FROM iv{n}),
        su{n} AS (SELECT id, sum(greatest(0, hi - greatest(lo, coalesce(rm, lo)))) AS part FROM cov{n} GROUP BY 1),
        sp{n} AS (SELECT x.id, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS length, coalesce(part, 0) AS part FROM {source} x LEFT JOIN su{n} ON su{n}.id = x.id)"""


_TOTALS = intervals("p", "e") + ", tf AS (SELECT sum(length * part) AS tp, sum(length * (1 - part)) AS fp FROM sp)"
_FN = intervals("e", "p", "2")

_MEANS = ", ".join(f"round(avg({c}), 4) AS {c}" for c in ("precision", "recall", "f1_score"))

SQL: dict[str, str] = {
    "q_bg_filter": with_views("c b f", "SELECT file_name, is_background_only FROM f WHERE keep"),
    "q_split_lookup": with_views("c m", "SELECT c.file_name, coalesce(split, 'NA') AS dataset_split FROM c LEFT JOIN m ON m.file_name = c.file_name"),
    "q_chip_clip_lengths": with_views("e p c l clip", "SELECT file_name, pred_result, sum(round(clipped * 10000)::BIGINT)::BIGINT AS length FROM clip GROUP BY 1, 2"),
    "q_chip_report": with_views("e p c b f m l clip s", f"SELECT file_name, dataset_split, keep, {', '.join(f'round({c}, 4) AS {c}' for c in ('tp_length', 'fp_length', 'fn_length', 'precision', 'recall', 'f1_score'))} FROM report"),
    "q_split_means": with_views("e p c b f m l clip s", f"SELECT dataset_split, {_MEANS} FROM report WHERE f1_score IS NOT NULL GROUP BY 1"),
    "q_overall_mean": with_views("e p c b f m l clip s", f"SELECT {_MEANS}, count(*) AS chips FROM report WHERE f1_score IS NOT NULL"),
    "q_line_split": with_views("e p", intervals("p", "e") + " SELECT id, round(length, 4) AS length, round(length * part, 4) AS inside, round(length * (1 - part), 4) + 0.0 AS outside FROM sp"),
    "q_fn_lengths": with_views("e p", intervals("e", "p") + " SELECT id, round(length * (1 - part), 4) AS fn_length FROM sp WHERE length * (1 - part) > 1e-9"),
    "q_line_totals": with_views("e p", _TOTALS + _FN + """, z AS (SELECT tp, fp, (SELECT sum(length * (1 - part)) FROM sp2) AS fn FROM tf), y AS (SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall FROM z)
        SELECT round(tp, 3) AS tp, round(fp, 3) AS fp, round(fn, 3) AS fn, round(precision, 4) AS precision, round(recall, 4) AS recall, round(2 * precision * recall / (precision + recall), 4) AS f1 FROM y"""),
    "q_union_all": with_views("e p", "SELECT 'TP' AS pred_result, count(*) AS n, sum(id)::BIGINT AS ids FROM p UNION ALL SELECT 'FN', count(*), sum(id)::BIGINT FROM e"),
    "q_dissolve_len": with_views("e p", """, a AS (SELECT 'truth' AS k, * FROM e UNION ALL SELECT 'predicted', * FROM p), g AS (SELECT *, (bx - ax)::BIGINT AS dx, (by_ - ay)::BIGINT AS dy FROM a),
        u AS (SELECT *, CASE WHEN dx < 0 OR (dx = 0 AND dy < 0) THEN -1 ELSE 1 END * dx // gcd(abs(dx), abs(dy)) AS ux, CASE WHEN dx < 0 OR (dx = 0 AND dy < 0) THEN -1 ELSE 1 END * dy // gcd(abs(dx), abs(dy)) AS uy FROM g WHERE dx <> 0 OR dy <> 0),
        o AS (SELECT k, ux, uy, ux * ay - uy * ax AS off, least(ux * ax + uy * ay, ux * bx + uy * by_) AS lo, greatest(ux * ax + uy * ay, ux * bx + uy * by_) AS hi FROM u),
        w AS (SELECT *, max(hi) OVER (PARTITION BY k, ux, uy, off ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rm FROM o)
        SELECT k, round(sum(greatest(0, hi - greatest(lo, coalesce(rm, lo))) / sqrt(ux * ux + uy * uy)), 3) AS length FROM w GROUP BY 1"""),
    "q_iou_dice": with_views("v pm n", "SELECT vec_id, both_ AS both, p, t, round(iou, 6) AS iou, round(dice, 6) AS dice FROM io").replace("both_ AS both,", 'both_ AS "both",'),
    "q_eval_summary": with_views("v pm n", "".join(f"{u} SELECT '{m}' AS metric, round(avg({m}), 6) AS mean, round(median({m}), 6) AS median, round(min({m}), 6) AS least, round(max({m}), 6) AS greatest, round(stddev_pop({m}), 6) AS std FROM io" for u, m in (("", "iou"), (" UNION ALL", "dice")))),
    "q_confusion_pixels": with_views("v pm", "SELECT vec_id, CASE WHEN prob > 0.5 AND mask > 0 THEN 'tp' WHEN prob > 0.5 THEN 'fp' WHEN prob < 0.5 AND mask > 0 THEN 'fn' ELSE 'tn' END AS kind, count(*) AS pixels FROM pm GROUP BY 1, 2"),
    "q_tta_mean": with_views("v", """, r AS (SELECT vec_id, i // 8 AS row, i % 8 AS col, value FROM v), k AS (SELECT *, unnest([row, 7 - col, 7 - row, col]) AS rr, unnest([col, row, 7 - col, 7 - row]) AS cc FROM r)
        SELECT vec_id, row, col, round(avg(1 / (1 + exp(-(10 * value + 0.1::DOUBLE * cc - 0.05::DOUBLE * rr)))), 6) AS value FROM k GROUP BY 1, 2, 3"""),
    "q_tiling": """WITH s AS (SELECT n_nationkey, n_nationkey * 97 + 400 AS width, n_nationkey * 41 + 700 AS height FROM nation),
        x AS (SELECT *, unnest(range(0, width, 384)) AS col_off FROM s), y AS (SELECT *, unnest(range(0, height, 384)) AS row_off FROM x)
        SELECT n_nationkey, col_off::INT AS col_off, row_off::INT AS row_off, least(512, width - col_off)::INT AS tile_width, least(512, height - row_off)::INT AS tile_height FROM y""",
    "q_mosaic_lastwins": """WITH x AS (SELECT l_partkey % 50 AS row, l_suppkey % 40 AS col, l_quantity AS value, row_number() OVER (PARTITION BY l_partkey % 50, l_suppkey % 40 ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS n FROM lineitem WHERE l_linenumber <> 1)
        SELECT row, col, value FROM x WHERE n = 1""",
    "q_chunk_counts": "SELECT (l_partkey % 500) // 128 AS chunk_row, (l_suppkey % 400) // 128 AS chunk_col, count(*) AS n, sum((l_quantity > 25)::INT)::BIGINT AS high FROM lineitem GROUP BY 1, 2",
    "q_mask_rasterize": with_views("e", """, g AS (SELECT *, unnest(range(floor(least(ax, bx))::BIGINT - 2, ceil(greatest(ax, bx))::BIGINT + 3)) AS col FROM e), h AS (SELECT *, unnest(range(floor(least(ay, by_))::BIGINT - 2, ceil(greatest(ay, by_))::BIGINT + 3)) AS row FROM g),
        d AS (SELECT DISTINCT row, col FROM h WHERE row >= 0 AND col >= 0 AND (col + 0.5::DOUBLE - greatest(least(ax, bx), least(greatest(ax, bx), col + 0.5::DOUBLE)))^2 + (row + 0.5::DOUBLE - greatest(least(ay, by_), least(greatest(ay, by_), row + 0.5::DOUBLE)))^2 <= 0.5625)
        SELECT x.cx, y.cy, count(*) AS mask_pixels FROM d JOIN (SELECT unnest(range(0, 1000)) AS cx) x ON col >= x.cx * 24 AND col < x.cx * 24 + 32 JOIN (SELECT unnest(range(0, 100000)) AS cy) y ON row >= y.cy * 24 AND row < y.cy * 24 + 32 GROUP BY 1, 2"""),
    "q_downscale": with_views("v", "SELECT vec_id, i // 8 // 2 AS row, i % 8 // 2 AS col, round(avg(value), 6) AS value FROM v GROUP BY 1, 2, 3"),
    "q_upsample_band": """WITH s AS (SELECT vec_id, embedding AS px FROM embeddings), g AS (SELECT *, unnest(range(0, 16)) AS r FROM s), f AS (SELECT *, unnest(range(0, 16)) AS c FROM g),
        k AS (SELECT *, (r + 0.5::DOUBLE) / 2 - 0.5::DOUBLE AS y, (c + 0.5::DOUBLE) / 2 - 0.5::DOUBLE AS x FROM f),
        w AS (SELECT *, greatest(0, floor(y))::INT AS y0, least(7, floor(y) + 1)::INT AS y1, greatest(0, floor(x))::INT AS x0, least(7, floor(x) + 1)::INT AS x1, y - floor(y) AS fy, x - floor(x) AS fx FROM k),
        o AS (SELECT vec_id, px[y0 * 8 + x0 + 1]::DOUBLE * (1 - fx) * (1 - fy) + px[y0 * 8 + x1 + 1]::DOUBLE * fx * (1 - fy) + px[y1 * 8 + x0 + 1]::DOUBLE * (1 - fx) * fy + px[y1 * 8 + x1 + 1]::DOUBLE * fx * fy AS val FROM w)
        SELECT vec_id, round(sum(val), 4) AS total, round(max(val), 6) AS top, count(*) AS n FROM o GROUP BY 1""",
    "q_affine": with_views("v", "SELECT vec_id, i // 8 AS row, i % 8 AS col, 0.25::DOUBLE * (i % 8 + 0.5::DOUBLE) + 400000 AS x, -0.25::DOUBLE * (i // 8 + 0.5::DOUBLE) + 300000 AS y, i // 8 + 0.5::DOUBLE AS back_row, i % 8 + 0.5::DOUBLE AS back_col FROM v"),
    "q_normalise": with_views("v", """SELECT vec_id, (i % 4)::VARCHAR AS band, round(sum((value * 255 - CASE i % 4 WHEN 0 THEN 0.48 WHEN 1 THEN 0.46 WHEN 2 THEN 0.41 ELSE 0.5 END::DOUBLE * 255) / (CASE i % 4 WHEN 0 THEN 0.22 WHEN 1 THEN 0.21 WHEN 2 THEN 0.2 ELSE 0.25 END::DOUBLE * 255)), 4) AS total FROM v GROUP BY 1, 2"""),
    "q_scaler": with_views("v", "SELECT i % 4 AS band, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM v GROUP BY 1"),
    "q_display_scale": with_views("v", """, r AS (SELECT vec_id, min(value) AS lo, max(value) AS hi FROM v GROUP BY 1), x AS (SELECT r.vec_id, round(sum((value - lo) / (hi - lo + 1e-8)), 5) AS total FROM v JOIN r ON r.vec_id = v.vec_id GROUP BY 1)
        SELECT vec_id, total FROM x"""),
    "q_pairs_semi": with_views("c m", "SELECT file_name FROM c WHERE file_name IN (SELECT file_name FROM m)"),
    "q_missing_anti": with_views("c m", "SELECT file_name FROM c WHERE file_name NOT IN (SELECT file_name FROM m)"),
    "q_missing_zeros": with_views("e p l", ", k AS (SELECT id % 50 AS k, count(*) AS n FROM l WHERE pred_result = 'FP' GROUP BY 1) SELECT n_nationkey, coalesce(n, 0) AS n FROM nation LEFT JOIN k ON k = n_nationkey"),
    "q_ratio_split": with_views("c", """, r AS (SELECT file_name, row_number() OVER (ORDER BY md5(file_name || '|42'), file_name) - 1 AS rk, (SELECT count(*) FROM c) AS n FROM c)
        SELECT file_name, CASE WHEN rk < floor(n * 0.7 + 1e-9) THEN 'train' WHEN rk < floor(n * 0.7 + 1e-9) + floor(n * 0.2 + 1e-9) THEN 'val' ELSE 'test' END AS split FROM r"""),
    "q_sample_n": with_views("c", "SELECT file_name FROM c ORDER BY md5(file_name || '|7'), file_name LIMIT 6"),
    "q_latest_model": with_views("mo", "SELECT name FROM mo ORDER BY name NOT LIKE '%\\_checkpoint.pth' ESCAPE '\\' DESC, name DESC LIMIT 1"),
    "q_early_stop": with_views("h", """, a AS (SELECT *, min(val_loss) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM h),
        b AS (SELECT *, best IS NULL OR val_loss < best AS is_best FROM a), c AS (SELECT *, epoch - max(CASE WHEN is_best THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch) AS bad FROM b),
        d AS (SELECT *, min(CASE WHEN bad >= 10 THEN epoch END) OVER (PARTITION BY run_id) AS stop FROM c) SELECT run_id, epoch::INT AS epoch, val_loss, is_best, bad FROM d WHERE stop IS NULL OR epoch <= stop"""),
    "q_plateau_rate": with_views("h", """, w(run_id, epoch, best, bad, rate) AS (SELECT run_id, epoch, val_loss, 0, 1e-4::DOUBLE FROM h WHERE epoch = 1
        UNION ALL SELECT h.run_id, h.epoch, CASE WHEN val_loss < best * (1 - 1e-3) THEN val_loss ELSE best END, CASE WHEN val_loss < best * (1 - 1e-3) OR bad + 1 > 3 THEN 0 ELSE bad + 1 END, CASE WHEN NOT val_loss < best * (1 - 1e-3) AND bad + 1 > 3 THEN rate * 0.5 ELSE rate END
        FROM w JOIN h ON h.run_id = w.run_id AND h.epoch = w.epoch + 1) SELECT run_id, arg_max(rate, epoch) AS rate FROM w GROUP BY 1""", True),
    "q_epoch_mean": "SELECT day(ts)::INT AS epoch, round(avg(value), 6) AS mean_loss, count(*) AS batches FROM events GROUP BY 1",
    "q_prefix_strip": "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || '.w' ELSE p_name || '._orig_mod.w' END AS key FROM part",
    "q_outcome_counts": "SELECT sum((o_orderstatus = 'F')::INT)::BIGINT AS success, count(*) AS total, count(*) - sum((o_orderstatus = 'F')::INT)::BIGINT AS failed FROM orders",
    "q_union_scans": with_views("c", "SELECT file_name FROM c"),
    "q_report_text": with_views("mo", "SELECT name, upper(name[1:8]) AS day, replace(name, '.pth', '_analysis.png') AS plot, format('{:,.1f}', length(name) * 1234.56::DOUBLE) AS size FROM mo"),
    "q_ratio_split_kept": with_views("c b f", """, x AS (SELECT file_name FROM f WHERE keep), r AS (SELECT file_name, row_number() OVER (ORDER BY md5(file_name || '|42'), file_name) - 1 AS rk, (SELECT count(*) FROM x) AS n FROM x)
        SELECT file_name, CASE WHEN rk < floor(n * 0.7 + 1e-9) THEN 'train' WHEN rk < floor(n * 0.7 + 1e-9) + floor(n * 0.2 + 1e-9) THEN 'val' ELSE 'test' END AS split FROM r"""),
    "q_dissolve_parts": with_views("e p", """, a AS (SELECT 'truth' AS k, * FROM e UNION ALL SELECT 'predicted', * FROM p),
        m AS (SELECT k, floor((ax + 0.25::DOUBLE) * 1000 + 0.5::DOUBLE)::BIGINT AS ax, floor((ay + 0.5::DOUBLE) * 1000 + 0.5::DOUBLE)::BIGINT AS ay, floor((bx + 0.25::DOUBLE) * 1000 + 0.5::DOUBLE)::BIGINT AS bx, floor((by_ + 0.5::DOUBLE) * 1000 + 0.5::DOUBLE)::BIGINT AS by_ FROM a),
        u AS (SELECT *, CASE WHEN bx < ax OR (bx = ax AND by_ < ay) THEN -1 ELSE 1 END * ((bx - ax) // gcd(abs(bx - ax), abs(by_ - ay))) AS ux, CASE WHEN bx < ax OR (bx = ax AND by_ < ay) THEN -1 ELSE 1 END * ((by_ - ay) // gcd(abs(bx - ax), abs(by_ - ay))) AS uy FROM m WHERE ax <> bx OR ay <> by_),
        o AS (SELECT k, ux, uy, ux * ay - uy * ax AS off, least(ux * ax + uy * ay, ux * bx + uy * by_) AS lo, greatest(ux * ax + uy * ay, ux * bx + uy * by_) AS hi FROM u),
        w AS (SELECT *, CASE WHEN lo > coalesce(max(hi) OVER (PARTITION BY k, ux, uy, off ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo - 1) THEN 1 ELSE 0 END AS fresh FROM o),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY k, ux, uy, off ORDER BY lo, hi) AS part FROM w),
        z AS (SELECT k, ux, uy, off, min(lo) AS lo, max(hi) AS hi, (ux * ux + uy * uy)::DOUBLE AS n2 FROM g GROUP BY k, ux, uy, off, part)
        SELECT k, round((ux::HUGEINT * lo - uy::HUGEINT * off)::DOUBLE / n2 / 1000, 3) AS x0, round((uy::HUGEINT * lo + ux::HUGEINT * off)::DOUBLE / n2 / 1000, 3) AS y0, round((ux::HUGEINT * hi - uy::HUGEINT * off)::DOUBLE / n2 / 1000, 3) AS x1, round((uy::HUGEINT * hi + ux::HUGEINT * off)::DOUBLE / n2 / 1000, 3) AS y1,
        round((hi - lo) / sqrt(n2) / 1000, 3) AS length FROM z"""),
    "q_gpkg_box": with_views("e p", """, i AS (SELECT id, greatest(0.0, CASE WHEN bx = ax THEN CASE WHEN ax BETWEEN 33.5 AND 78 THEN 0.0 ELSE 9.0 END ELSE least((33.5::DOUBLE - ax) / (bx - ax), (78 - ax) / (bx - ax)) END, CASE WHEN by_ = ay THEN CASE WHEN ay BETWEEN 41.25 AND 96.5 THEN 0.0 ELSE 9.0 END ELSE least((41.25::DOUBLE - ay) / (by_ - ay), (96.5::DOUBLE - ay) / (by_ - ay)) END) AS t0,
        least(1.0, CASE WHEN bx = ax THEN 1.0 ELSE greatest((33.5::DOUBLE - ax) / (bx - ax), (78 - ax) / (bx - ax)) END, CASE WHEN by_ = ay THEN 1.0 ELSE greatest((41.25::DOUBLE - ay) / (by_ - ay), (96.5::DOUBLE - ay) / (by_ - ay)) END) AS t1, ax, ay FROM p)
        SELECT id, ax AS x0, ay AS y0 FROM i WHERE t0 <= t1"""),
    "q_box_filter": with_views("e p", """, i AS (SELECT id, greatest(0.0, CASE WHEN bx = ax THEN CASE WHEN ax BETWEEN 33.5 AND 78 THEN 0.0 ELSE 9.0 END ELSE least((33.5::DOUBLE - ax) / (bx - ax), (78 - ax) / (bx - ax)) END, CASE WHEN by_ = ay THEN CASE WHEN ay BETWEEN 41.25 AND 96.5 THEN 0.0 ELSE 9.0 END ELSE least((41.25::DOUBLE - ay) / (by_ - ay), (96.5::DOUBLE - ay) / (by_ - ay)) END) AS t0,
        least(1.0, CASE WHEN bx = ax THEN 1.0 ELSE greatest((33.5::DOUBLE - ax) / (bx - ax), (78 - ax) / (bx - ax)) END, CASE WHEN by_ = ay THEN 1.0 ELSE greatest((41.25::DOUBLE - ay) / (by_ - ay), (96.5::DOUBLE - ay) / (by_ - ay)) END) AS t1 FROM p)
        SELECT 'line' AS layer, id FROM i WHERE t0 <= t1 UNION ALL SELECT 'parcel', p_partkey FROM part WHERE (p_partkey % 20) * 10 <= 78 AND (p_partkey % 20) * 10 + 10 >= 33.5 AND (p_partkey // 20) * 10 <= 96.5 AND (p_partkey // 20) * 10 + 10 >= 41.25"""),
    "q_run_stamps": """SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS file_stamp, strftime(ts, '%Y-%m-%d %H:%M:%S') AS log_stamp, 'preds_' || strftime(ts, '%Y%m%d_%H%M%S') || '.gpkg' AS file_name FROM events""",
    "q_model_states": """WITH m AS (SELECT p_partkey, CASE p_size % 2 WHEN 0 THEN 'unet' ELSE 'unetplusplus' END AS arch, p_brand AS encoder, unnest([{'k': 'a.w', 'v': p_retailprice}, {'k': 'b._orig_mod.w', 'v': p_size::DOUBLE}]) AS x FROM part)
        SELECT p_partkey AS name, arch, encoder, CASE WHEN p_partkey % 3 = 0 THEN replace(x.k, '_orig_mod.', '') ELSE x.k END AS key, x.v AS value FROM m""",
    "q_box_inside": "SELECT p_partkey AS id FROM part WHERE (p_partkey % 20) * 10 <= 43 AND (p_partkey % 20) * 10 + 10 >= 42.5 AND (p_partkey // 20) * 10 <= 53.25 AND (p_partkey // 20) * 10 + 10 >= 53",
    "q_crs_labels": with_views("e p", "SELECT 'split' AS layer, count(*) AS n FROM p UNION ALL SELECT 'EPSG:27700', count(*) FROM e"),
    "q_chip_index": """WITH s AS (SELECT n_nationkey AS n, n_nationkey * 97 + 400 AS width, n_nationkey * 41 + 700 AS height, CASE WHEN n_nationkey % 2 = 0 THEN 0.25 ELSE 0.5 END::DOUBLE AS px FROM nation),
        x AS (SELECT *, unnest(range(0, width, 384)) AS c FROM s), y AS (SELECT *, unnest(range(0, height, 384)) AS r FROM x)
        SELECT 'chip_' || n || '_' || c || '_' || r || '.tif' AS file_name, n * 1000 + 400000 + px * c AS xmin, 300000 - n * 500 - px * r - px * least(512, height - r) AS ymin, n * 1000 + 400000 + px * c + px * least(512, width - c) AS xmax, 300000 - n * 500 - px * r AS ymax FROM y""",
    "q_display_bytes": """WITH x AS (SELECT vec_id, embedding::DOUBLE[] AS px FROM embeddings), b AS (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN list_transform(px, lambda v: (floor(abs(v) * 1000)::BIGINT % 256) / 255::DOUBLE) ELSE list_transform(px, lambda v: (v - list_min(px)) / (list_max(px) - list_min(px) + 1e-8)) END AS s FROM x)
        SELECT vec_id, round(list_sum(s), 5) AS total FROM b""",
    "q_stack_bands": """WITH x AS (SELECT vec_id, embedding::DOUBLE[] AS px, 2 + vec_id % 3 AS n FROM embeddings), f AS (SELECT vec_id, unnest(range(0, 16)) AS i FROM x WHERE n = 3 AND vec_id % 7 <> 0),
        g AS (SELECT f.vec_id, i, px[61:64] AS q, (i // 4 + 0.5::DOUBLE) / 2 - 0.5::DOUBLE AS y, (i % 4 + 0.5::DOUBLE) / 2 - 0.5::DOUBLE AS z FROM f JOIN x ON x.vec_id = f.vec_id),
        h AS (SELECT vec_id, i, q, greatest(0, floor(y))::INT AS y0, least(1, floor(y) + 1)::INT AS y1, greatest(0, floor(z))::INT AS z0, least(1, floor(z) + 1)::INT AS z1, y - floor(y) AS fy, z - floor(z) AS fz FROM g),
        k AS (SELECT vec_id, list(q[y0 * 2 + z0 + 1] * (1 - fz) * (1 - fy) + q[y0 * 2 + z1 + 1] * fz * (1 - fy) + q[y1 * 2 + z0 + 1] * (1 - fz) * fy + q[y1 * 2 + z1 + 1] * fz * fy ORDER BY i) AS fine FROM h GROUP BY 1),
        l AS (SELECT x.vec_id, n, CASE WHEN n <> 3 THEN px[(n - 1) * 16 + 1:n * 16] WHEN fine IS NULL THEN list_transform(range(16), lambda _: 0.0::DOUBLE) ELSE fine END AS last FROM x LEFT JOIN k ON k.vec_id = x.vec_id)
        SELECT vec_id, CASE n WHEN 3 THEN 'added' WHEN 4 THEN 'has four' ELSE 'skipped' END AS status, CASE WHEN n = 3 THEN 4 ELSE n END::INT AS bands, round(list_sum(last), 4) AS total, round(last[6], 6) AS sixth FROM l""",
    "q_band_order": """WITH x AS (SELECT vec_id, embedding::DOUBLE[] AS px, unnest(range(0, 16))::INT AS i FROM embeddings WHERE vec_id % 3 > 0) SELECT vec_id, i, px[33 + i] AS blue, px[17 + i] AS green, px[1 + i] AS red FROM x""",
    "q_boundless_window": """WITH x AS (SELECT vec_id, embedding::DOUBLE[] AS px, unnest(range(0, 16)) AS i FROM embeddings), y AS (SELECT *, vec_id % 11 - 3 + i // 4 AS r, vec_id % 13 - 4 + i % 4 AS c FROM x),
        z AS (SELECT vec_id, CASE WHEN r BETWEEN 0 AND 7 AND c BETWEEN 0 AND 7 THEN px[r * 8 + c + 1] ELSE 0 END AS v FROM y) SELECT vec_id, round(sum(v), 5) AS total, sum((v = 0)::INT)::INT AS zeros FROM z GROUP BY 1""",
    "q_latest_mtime": "SELECT o_orderkey || '_boundaries.gpkg' AS file_name FROM orders WHERE o_orderkey % 5 <> 0 ORDER BY o_orderdate DESC, o_orderkey || '_boundaries.gpkg' DESC LIMIT 1",
    "q_z_order": with_views("c", "SELECT '/data/chips/' || file_name AS path, xmin, ymin, xmax, ymax, row_number() OVER (ORDER BY file_name) - 1 AS z_order FROM c"),
    "q_seeded_shuffle": with_views("c", "SELECT file_name, row_number() OVER (ORDER BY md5(file_name || '|11'), file_name) - 1 AS place FROM c"),
    "q_flags_csv": with_views("c b", "SELECT image_file, is_background_only FROM b"),
    "q_scaler_json": with_views("v", "SELECT (i % 4)::VARCHAR AS band, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM v GROUP BY 1"),
    "q_append_log": "SELECT 'run: ' || r || ', n_name: ' || n_name || ', score: ' || n_nationkey * r AS value FROM nation, (SELECT unnest([1, 2]) AS r)",
    "q_overwrite_guard": "SELECT r_regionkey AS key, true AS refused, (SELECT count(*) FROM nation) AS kept FROM region",
    "q_lines_only": with_views("e", "SELECT id FROM e WHERE id % 7 IN (3, 5, 6)"),
    "q_gpkg_roundtrip": with_views("e", "SELECT id, ax AS x0, ay AS y0, bx AS x1, by_ AS y1 FROM e"),
}

SQL |= {f"q_{name}_all": SQL[f"q_{name}"] for name in ("report_text", "display_scale", "upsample_band")}
