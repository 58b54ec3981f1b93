"""DuckDB SQL of the registered queries."""

from __future__ import annotations

PX = """px AS (SELECT *, R // 2 AS G, R // 4 AS B, CASE WHEN x > -0.05 THEN 255 WHEN x > -0.1 THEN 127 ELSE 0 END AS mask,
  CASE WHEN x > 0.12 OR x < -0.25 THEN 255 ELSE 0 END AS pred FROM
  (SELECT slide, tile, CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS xx, x, greatest(0, least(255, CAST(floor(1024 * x) AS INTEGER))) AS R FROM
    (SELECT label AS slide, vec_id AS tile, i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, range(1, 65) t(i))))"""
SEG = f"""{PX}, seg AS (SELECT slide, tile, y, xx, x, mask, pred, CASE WHEN mask >= 255 THEN R ELSE 0 END AS red,
  CASE WHEN mask >= 255 THEN G ELSE 0 END AS green, CASE WHEN mask >= 255 THEN B ELSE 0 END AS blue FROM px)"""
CLEAN = f"""{SEG}, clean AS (SELECT slide, tile, y, xx, red + green + blue AS rgb, CASE WHEN red + green + blue > 0 THEN pred ELSE 0 END AS pred,
  pred > 0 AND red + green + blue <= 0 AS removed FROM seg)"""


def _blocks(tissue: str) -> str:
    return f"""{CLEAN}, blocks AS (SELECT slide, tile, least(y // 3, 2)::INTEGER AS br, least(xx // 3, 2)::INTEGER AS bc, count(*) FILTER (pred <> 0) AS n_pred,
  count(*) FILTER ({tissue} <> 0) AS n_tissue FROM clean GROUP BY 1, 2, 3, 4),
 pct AS (SELECT *, CASE WHEN n_tissue = 0 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * n_pred / n_tissue END AS pct FROM blocks)"""


BLOCKS, WRAP = _blocks("rgb"), _blocks("rgb % 256")
RANGE = f"{BLOCKS}, rng AS (SELECT slide, least(min(pct), 0.0) AS min_pct, greatest(max(pct), 0.0) AS max_pct FROM pct GROUP BY slide)"
HEAT = f"""{RANGE}, heat AS (SELECT t.slide, t.tile, r, c, coalesce(pct, 0.0) * 1000 AS value FROM
  (SELECT label AS slide, vec_id AS tile, r::INTEGER AS r, c::INTEGER AS c, least(least(CAST(floor((r + 0.5) * 8 / 4) AS INTEGER), 7) // 3, 2) AS br,
    least(least(CAST(floor((c + 0.5) * 8 / 4) AS INTEGER), 7) // 3, 2) AS bc FROM embeddings, range(4) a(r), range(4) b(c)) t
  LEFT JOIN pct p ON p.slide = t.slide AND p.tile = t.tile AND p.br = t.br AND p.bc = t.bc)"""
DENSITY = "SELECT slide, tile, br, bc, n_pred, n_tissue, round(pct, 6) AS pct FROM pct"

SLIDES = """sl AS (SELECT p_partkey AS slide_id, CAST(3000 + p_partkey * 37 % 20000 AS INTEGER) AS h, CAST(2000 + p_partkey * 91 % 30000 AS INTEGER) AS w, p_size, p_retailprice,
  p_partkey || '_22_#' || p_size || '_' || CASE WHEN p_partkey % 5 = 0 THEN st || '_' || rg ELSE rg || '_' || st END AS name FROM
  (SELECT *, ['MFG', 'PUT', 'BS'][p_partkey % 3 + 1] AS rg, ['CP13', 'Iron', 'Amyloid'][p_partkey // 3 % 3 + 1] AS st FROM part))"""
GRID = f"{SLIDES}, grid AS (SELECT *, CAST(ceil(h / 2890.0) AS INTEGER) AS grid_rows, CAST(ceil(w / 2890.0) AS INTEGER) AS grid_cols FROM sl WHERE h > 0 AND w > 0)"
TILES = f"{GRID}, tl AS (SELECT *, CAST(t AS INTEGER) AS tile_id, CAST(t // grid_cols AS INTEGER) AS gr, CAST(t % grid_cols AS INTEGER) AS gc FROM grid, range(grid_rows * grid_cols) x(t))"
COORDS = f"""{TILES}, co AS (SELECT slide_id, tile_id, gr, gc, CAST(gr::BIGINT * h // grid_rows AS INTEGER) AS row_up, CAST(gc::BIGINT * w // grid_cols AS INTEGER) AS col_up,
  CAST((gr + 1)::BIGINT * h // grid_rows AS INTEGER) AS row_low, CAST((gc + 1)::BIGINT * w // grid_cols AS INTEGER) AS col_low FROM tl)"""
STAIN = "CASE WHEN name ILIKE '%cp13%' THEN 'tau' WHEN name ILIKE '%\\_amyloid%' ESCAPE '\\' THEN 'amyloid' WHEN name ILIKE '%\\_iron%' ESCAPE '\\' THEN 'iron' END"
REGION = "CASE WHEN name ILIKE '%\\_mfg%' ESCAPE '\\' THEN 'mfg' WHEN name ILIKE '%\\_put%' ESCAPE '\\' THEN 'put' WHEN name ILIKE '%\\_bs%' ESCAPE '\\' THEN 'bs' END"
LOG = """lg AS (SELECT user_id AS slide, CASE event_type WHEN 'error' THEN 'STAGE1_FAILED' WHEN 'click' THEN 'STAGE2_EMPTY' WHEN 'view' THEN 'STAGE3_ABNORMAL' ELSE 'OK' END AS code,
  event_type AS stage, ts, event_id AS seq, ['amyloid', 'tau', 'iron'][user_id % 3 + 1] AS stain FROM events)"""
LAST = f"{LOG}, last AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY ts DESC, seq DESC) AS k FROM lg)"
LOGITS = """lo AS (SELECT label AS slide, vec_id AS tile, i::INTEGER AS i, CAST(embedding[i + 1] AS DOUBLE) AS a, CAST(embedding[i + 33] AS DOUBLE) AS b, CASE WHEN (vec_id + i) % 3 = 0 THEN 1 ELSE 0 END AS y
  FROM embeddings, range(32) t(i)), pr AS (SELECT *, exp(a - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b))) AS p0,
  exp(b - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b))) AS p1 FROM lo)"""
LOSS = f"""{LOGITS}, pt AS (SELECT *, CASE WHEN y = 1 THEN p1 ELSE 1 - p1 END AS p FROM pr),
 ls AS (SELECT slide, avg(-(CASE WHEN y = 1 THEN 0.7 ELSE 0.3 END)::DOUBLE * pow(1 - p, 2) * ln(p) * (1 + i % 4)) AS focal, sum(p1 * y) AS tp, sum(p1 * (1 - y)) AS fp, sum((1 - p1) * y) AS fn FROM pt GROUP BY slide),
 lt AS (SELECT slide, focal, 1 - (tp + 1e-5) / (tp + 0.6::DOUBLE * fp + 0.4::DOUBLE * fn + 1e-5) AS tversky FROM ls)"""
CONF = "cf AS (SELECT toxic AS truth, quality AS pred, count(*) AS n FROM labels WHERE toxic <> -1 AND quality IS NOT NULL GROUP BY 1, 2)"
SCENES = """sc AS (SELECT l_suppkey % 5 AS slide, l_linenumber AS scene, l_orderkey % 32 AS y, l_partkey % 32 AS x, max(CASE WHEN l_quantity < 40 THEN 0 ELSE CAST(floor(5 * l_quantity) AS INTEGER) END) AS v
  FROM lineitem GROUP BY 1, 2, 3, 4)"""
AUG = "[[y, xx], [y, 7 - xx], [7 - y, xx], [7 - xx, y], [7 - y, 7 - xx], [xx, 7 - y]]"


def _eroded(source: str, n: int) -> str:
    """Pixels of source (slide, tile, r, c) with all four neighbours, for disks of radius 1."""
    return f"""fg AS ({source}), al AS (SELECT f.slide, f.tile, f.r, f.c FROM fg f JOIN fg o ON f.slide = o.slide AND f.tile = o.tile AND abs(f.r - o.r) + abs(f.c - o.c) <= 1
  GROUP BY 1, 2, 3, 4 HAVING count(*) = {n})"""


#: A pixel and its four neighbours.
CROSS = "(VALUES (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)) o(dy, dx)"


def _slide_alive(px: str) -> str:
    """Places at half size of whole slides whose four neighbours are tissue of px as well."""
    return f"""ti AS (SELECT slide, tile // 20 * 4 + y // 2 AS gy, tile % 20 * 4 + xx // 2 AS gx FROM {px} WHERE mask > 0 AND y % 2 = 1 AND xx % 2 = 1),
 al AS (SELECT f.slide, f.gy, f.gx FROM ti f CROSS JOIN {CROSS} JOIN ti n ON n.slide = f.slide AND n.gy = f.gy + dy AND n.gx = f.gx + dx GROUP BY 1, 2, 3 HAVING count(*) = 5)"""


def _neighbours(south: str, east: str) -> str:
    return f"""WITH {TILES} SELECT slide_id, tile_id, CASE WHEN gr > 0 THEN tile_id - grid_cols END AS north, CASE WHEN {south} THEN tile_id + grid_cols END AS south,
  CASE WHEN {east} THEN tile_id + 1 END AS east, CASE WHEN gc > 0 THEN tile_id - 1 END AS west FROM tl"""


WHOLE = f"""{PX}, wh AS (SELECT *, tile // 20 * 8 + y AS gy, tile % 20 * 8 + xx AS gx FROM px),
 er AS (SELECT a.slide, a.tile, a.y, a.xx, a.mask, count(*) AS n FROM wh a LEFT JOIN wh b ON a.slide = b.slide AND b.mask > 0 AND
  ((a.gy = b.gy AND a.gx = b.gx) OR (a.gy = b.gy AND a.gx = b.gx - 1) OR (a.gy = b.gy AND a.gx = b.gx + 1) OR (a.gx = b.gx AND a.gy = b.gy - 1) OR (a.gx = b.gx AND a.gy = b.gy + 1)) GROUP BY 1, 2, 3, 4, 5)"""
PARTS = """pa AS (SELECT slide, seq, (y0 + i // 2)::INTEGER AS y, (x0 + i % 2)::INTEGER AS x, v FROM (SELECT l_suppkey % 5 AS slide, (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey * 50 + CAST(l_quantity AS INTEGER) AS seq, (l_partkey % 40 - 1)::INTEGER AS y0, (l_orderkey % 50 - 1)::INTEGER AS x0,
  CASE WHEN l_quantity < 20 THEN 0 ELSE CAST(floor(5 * l_quantity) AS INTEGER) END AS v FROM lineitem), range(6) t(i) WHERE y0 + i // 2 >= 0 AND x0 + i % 2 >= 0)"""
REPORT = f"""{HEAT}, nt AS (SELECT slide, tile, bool_or(pred > 0) AS p FROM px GROUP BY 1, 2), cn AS (SELECT slide, count(*) AS n_tiles, count(*) FILTER (p) AS n_pred FROM nt GROUP BY 1),
 vf AS (SELECT slide, max(value) AS m, count(*) FILTER (value <> 0) AS n_nonzero FROM heat GROUP BY 1),
 rp AS (SELECT slide::INTEGER AS slide, n_tiles, n_tiles AS n_seg, n_pred, 0::BIGINT AS n_errors, round(m, 6) AS max_value, n_nonzero, CASE WHEN n_pred = 0 THEN 'STAGE2_EMPTY' WHEN m > 100000 THEN 'STAGE3_ABNORMAL'
   WHEN n_nonzero = 0 THEN 'STAGE3_VERIFY_FAILED' ELSE 'OK' END AS code, CASE WHEN n_pred = 0 OR n_nonzero = 0 THEN 'FAIL' WHEN m > 100000 THEN 'WARN' ELSE 'OK' END AS status FROM cn JOIN vf USING (slide)
  UNION ALL SELECT (-r_regionkey - 1)::INTEGER, 1::BIGINT, NULL, NULL, NULL, NULL, NULL, 'DIR_NOT_FOUND', 'FAIL' FROM region)"""

CODE = """CASE WHEN slide_id % 19 = 0 THEN 'DIR_NOT_FOUND' WHEN slide_id % 17 = 0 THEN 'STAGE1_FAILED' WHEN slide_id % 13 = 0 THEN 'STAGE1_EMPTY' WHEN slide_id % 11 = 0 THEN 'TILEMASKER_LOG_MISSING'
  WHEN p_size = 1 THEN 'STAGE2_FAILED' WHEN p_size = 2 THEN 'STAGE2_EMPTY' WHEN p_size = 3 THEN 'STAGE3_FAILED' WHEN p_retailprice * 60 > 100000 THEN 'STAGE3_ABNORMAL'
  WHEN p_size % 7 = 0 THEN 'STAGE3_VERIFY_FAILED' ELSE 'OK' END"""

#: REPORT with masks eroded over whole slides, and heatmaps by what is left of them.
_PXE = f"""{PX.replace("px AS", "px0 AS", 1)}, wh AS (SELECT slide, tile // 20 * 8 + y AS gy, tile % 20 * 8 + xx AS gx FROM px0 WHERE mask > 0),
 er AS (SELECT f.slide, f.gy, f.gx FROM wh f CROSS JOIN {CROSS} JOIN wh n ON n.slide = f.slide AND n.gy = f.gy + dy AND n.gx = f.gx + dx GROUP BY 1, 2, 3 HAVING count(*) = 5),
 px AS (SELECT px0.* REPLACE (CASE WHEN er.gy IS NULL THEN 0 ELSE mask END AS mask) FROM px0 LEFT JOIN er ON px0.slide = er.slide AND tile // 20 * 8 + y = er.gy AND tile % 20 * 8 + xx = er.gx)"""
ERODED = REPORT.replace(PX, _PXE).replace("heat AS (", "heat0 AS (", 1).replace(
    ", nt AS (", f""", {_slide_alive("px")}, heat AS (SELECT h.* REPLACE (CASE WHEN al.gy IS NULL THEN 0.0::DOUBLE ELSE value END AS value)
  FROM heat0 h LEFT JOIN al ON h.slide = al.slide AND h.tile // 20 * 4 + h.r = al.gy AND h.tile % 20 * 4 + h.c = al.gx), nt AS (""", 1,
)

ORACLE_SQL: dict[str, str] = {
    "q_tile_grid": f"WITH {GRID} SELECT slide_id, h, w, grid_rows, grid_cols FROM grid",
    "q_tile_coords": f"WITH {COORDS} SELECT * FROM co",
    "q_coord_sanity": f"""WITH {COORDS}, s AS (SELECT slide_id, count(*) AS n_tiles, CAST(sum((row_low - row_up)::BIGINT * (col_low - col_up)) AS BIGINT) AS tile_area FROM co GROUP BY 1)
  SELECT slide_id, n_tiles, grid_rows * grid_cols AS n_expected, tile_area, h::BIGINT * w AS image_area, n_tiles = grid_rows * grid_cols AND tile_area = h::BIGINT * w AS ok FROM grid JOIN s USING (slide_id)""",
    "q_adjacency": _neighbours("gr < grid_rows - 1", "gc < grid_cols - 1"),
    "q_adjacency_compat": _neighbours("true", "true"),
    "q_seg_tile": f"WITH {SEG} SELECT slide, tile, y AS r, xx AS c, red, green, blue FROM seg",
    "q_clean_pred": f"WITH {CLEAN} SELECT slide, tile, y AS r, xx AS c, pred, removed FROM clean",
    "q_clean_stats": f"""WITH {CLEAN}, g AS (SELECT slide, tile, count(*) FILTER (removed) AS gone FROM clean GROUP BY 1, 2)
  SELECT e.label AS slide, count(*) AS total, count(gone) AS processed, count(*) FILTER (gone IS NULL) AS skipped, CAST(sum(coalesce(gone, 0)) AS BIGINT) AS pixels_removed,
  count(*) FILTER (gone > 0) AS tiles_with_background FROM embeddings e LEFT JOIN g ON e.label = g.slide AND e.vec_id = g.tile GROUP BY 1""",
    "q_tile_mask_join": f"""WITH {PX}, m AS (SELECT DISTINCT slide, tile FROM px WHERE mask = 255), s AS (SELECT label AS slide, count(*) AS n_images, count(m.tile) AS n_masks
  FROM embeddings LEFT JOIN m ON slide = label AND tile = vec_id GROUP BY 1)
  SELECT slide, n_images, n_masks, n_masks AS n_joined, n_images <> n_masks AS excluded, CASE WHEN n_images <> n_masks THEN 1 ELSE 0 END::BIGINT AS n_errors FROM s""",
    "q_block_density": f"WITH {BLOCKS} {DENSITY}",
    "q_block_density_wrap": f"WITH {WRAP} {DENSITY}",
    "q_block_density_tiles": f"WITH {BLOCKS} {DENSITY}",
    "q_slide_minmax": f"WITH {RANGE} SELECT slide, round(min_pct, 6) AS min_pct, round(max_pct, 6) AS max_pct FROM rng",
    "q_res10": f"WITH {HEAT} SELECT slide, tile, r, c, round(value, 6) AS value FROM heat",
    "q_colormap": f"""WITH {HEAT} SELECT slide, tile, r, c, CASE WHEN max_pct > min_pct THEN greatest(0, least(255, CAST(floor((value / 1000 - min_pct) / (max_pct - min_pct) * 256) AS INTEGER))) ELSE 0 END AS gray
  FROM heat JOIN rng USING (slide)""",
    "q_verify": f"""WITH {HEAT}, s AS (SELECT slide, max(value) AS m, count(*) FILTER (value <> 0) AS n_nonzero, count(*) AS n FROM heat GROUP BY 1)
  SELECT slide, round(m, 6) AS max_value, n_nonzero, round(100.0::DOUBLE * n_nonzero / n, 6) AS pct_nonzero,
  CASE WHEN m > 100000 THEN 'STAGE3_ABNORMAL' WHEN n_nonzero = 0 THEN 'STAGE3_VERIFY_FAILED' ELSE 'OK' END AS code FROM s""",
    "q_erode_mask": f"""WITH {PX}, {_eroded("SELECT slide, tile, y AS r, xx AS c FROM px WHERE mask > 0", 5)}
  SELECT px.slide, px.tile, y AS r, xx AS c, CASE WHEN al.tile IS NULL THEN 0 ELSE mask END AS mask FROM px LEFT JOIN al ON px.slide = al.slide AND px.tile = al.tile AND y = al.r AND xx = al.c""",
    "q_res10_tiles": f"WITH {HEAT} SELECT slide, tile, r, c, round(value, 6) AS value FROM heat",
    "q_heatmap_erode": f"""WITH {HEAT}, {_slide_alive("px")}
  SELECT h.slide, h.tile, h.r, h.c, round(value, 6) AS value, CASE WHEN al.gy IS NULL THEN 0.0::DOUBLE ELSE round(value, 6) END AS value_eroded
  FROM heat h LEFT JOIN al ON h.slide = al.slide AND h.tile // 20 * 4 + h.r = al.gy AND h.tile % 20 * 4 + h.c = al.gx""",
    "q_z_projection": "SELECT l_suppkey % 5 AS slide, l_orderkey % 32 AS y, l_partkey % 32 AS x, max(CAST(floor(5 * l_quantity) AS INTEGER)) AS v FROM lineitem GROUP BY 1, 2, 3",
    "q_axis_projection": "SELECT l_suppkey % 5 AS slide, l_linenumber % 3 AS channel, l_orderkey % 32 AS y, l_partkey % 32 AS x, max(CAST(floor(5 * l_quantity) AS INTEGER)) AS v FROM lineitem GROUP BY 1, 2, 3, 4",
    "q_mosaic_last_wins": f"WITH {SCENES} SELECT slide, y, x, coalesce(arg_max(v, scene) FILTER (v > 0), 0) AS v FROM sc GROUP BY 1, 2, 3",
    "q_stitch_paste": f"WITH {SCENES} SELECT slide, y, x, arg_max(v, scene) AS v FROM sc GROUP BY 1, 2, 3",
    "q_canvas_extent": """WITH p AS (SELECT l_suppkey % 5 AS slide, CAST(trunc(l_partkey / 4.0e6 / 2.5e-7) AS INTEGER) AS x0, CAST(trunc(l_orderkey / 4.0e6 / 2.5e-7) AS INTEGER) AS y0 FROM lineitem),
  e AS (SELECT slide, min(y0) AS y0, min(x0) AS x0, max(y0 + 64) AS y1, max(x0 + 48) AS x1 FROM p GROUP BY 1)
  SELECT slide, y0, x0, y1 - y0 AS height, x1 - x0 AS width, (y1 - y0)::BIGINT * (x1 - x0) * 3 AS bytes FROM e""",
    "q_softmax_argmax": f"WITH {LOGITS} SELECT slide, tile, i, round(p0, 6) AS p0, round(p1, 6) AS p1, CASE WHEN b > a THEN 1 ELSE 0 END AS cls FROM pr",
    "q_tile_inference": f"WITH {PX} SELECT slide, tile, CAST(count(*) FILTER (R + G + B > 382.5) AS INTEGER) AS n_positive, 64 AS n_bytes FROM px GROUP BY 1, 2",
    "q_tta_mean": f"""WITH {PX}, a AS (SELECT slide, tile, y, xx, x, unnest({AUG}) AS k FROM px),
  m AS (SELECT slide, tile, y AS r, xx AS c, avg(1 / (1 + exp(-(x + 0.01::DOUBLE * k[1] - 0.02::DOUBLE * k[2])))) AS p FROM a GROUP BY 1, 2, 3, 4)
  SELECT slide, tile, r, c, round(p, 6) AS p, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS cls FROM m""",
    "q_preprocess": f"WITH {PX} SELECT slide, tile, y AS r, xx AS c, round(R / 255.0::DOUBLE, 6) AS red, round(G / 255.0::DOUBLE, 6) AS green, round(B / 255.0::DOUBLE, 6) AS blue FROM px",
    "q_confusion": f"WITH {CONF} SELECT * FROM cf",
    "q_seg_metrics": f"""WITH {CONF}, s AS (SELECT sum(n)::DOUBLE AS total, coalesce(sum(n) FILTER (truth = pred), 0)::DOUBLE AS hit, coalesce(sum(n) FILTER (truth = pred AND truth = 0), 0)::DOUBLE AS tn,
  coalesce(sum(n) FILTER (truth = pred AND truth <> 0), 0)::DOUBLE AS tp, coalesce(sum(n) FILTER (truth <> pred AND truth <> 0), 0)::DOUBLE AS fn, coalesce(sum(n) FILTER (truth <> pred AND pred <> 0), 0)::DOUBLE AS fp FROM cf)
  SELECT round(hit / nullif(total, 0), 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(tp / nullif(total - tn, 0), 6) AS iou,
  round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS dice FROM s""",
    "q_iou_per_class": f"""WITH {CONF}, k AS (SELECT truth AS cls FROM cf UNION SELECT pred FROM cf)
  SELECT cls, round(coalesce(sum(n) FILTER (truth = cls AND pred = cls), 0)::DOUBLE / sum(n), 6) AS iou FROM k JOIN cf ON cls = truth OR cls = pred GROUP BY 1""",
    "q_focal_loss": f"WITH {LOSS} SELECT slide, round(focal, 6) AS focal FROM lt",
    "q_tversky_loss": f"WITH {LOSS} SELECT slide, round(tversky, 6) AS tversky, round(0.5::DOUBLE * focal + 0.5::DOUBLE * tversky, 6) AS loss FROM lt",
    "q_dynamic_scale": f"""WITH {PX}, e AS (SELECT slide, tile, min(x) AS lo, max(x) AS hi FROM px GROUP BY 1, 2)
  SELECT slide, tile, y AS r, xx AS c, round(CASE WHEN hi > lo THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, (x - lo) / (hi - lo))) ELSE 0 END, 6) AS scaled FROM px JOIN e USING (slide, tile)""",
    "q_pad_shape": f"WITH {SLIDES} SELECT slide_id, CAST(ceil(h / 32.0) * 32 AS INTEGER) AS pad_h, CAST(ceil(w / 32.0) * 32 AS INTEGER) AS pad_w FROM sl",
    "q_case_id": f"WITH {SLIDES} SELECT name, nullif(regexp_extract(name, '^(\\d+_\\d+)', 1), '') AS case_id FROM sl",
    "q_stain_classify": f"WITH {SLIDES} SELECT name, {STAIN} AS stain, {REGION} AS region FROM sl",
    "q_roi_swap": f"""WITH {SLIDES} SELECT name, CASE WHEN slide_id % 5 = 0 THEN array_to_string(string_split(name, '_')[1:3] || [string_split(name, '_')[5], string_split(name, '_')[4]], '_') ELSE name END AS ordered FROM sl""",
    "q_tile_name": "SELECT vec_id AS tile, 'tile_' || lpad(vec_id::VARCHAR, CAST(greatest(4, length(vec_id::VARCHAR)) AS INTEGER), '0') || '.tif' AS file, 'tile_' || lpad(vec_id::VARCHAR, CAST(greatest(4, length(vec_id::VARCHAR)) AS INTEGER), '0') || '_mask.tif' AS mask_file, vec_id::INTEGER AS number FROM embeddings",
    "q_ascii": "SELECT p_partkey, regexp_replace(replace(p_name || ' 5 µm é ' || p_size, 'µm', 'um'), '[^\\x00-\\x7F]', '?', 'g') AS label FROM part",
    "q_pattern_filter": f"WITH {SLIDES} SELECT name FROM sl WHERE contains(name, '_#7_') OR contains(name, 'CP13_BS') OR contains(name, '3_22')",
    "q_name_exclusions": f"WITH {SLIDES} SELECT name || '_mask.tif' AS file FROM sl WHERE slide_id % 4 = 3",
    "q_last_mask": f"WITH {SLIDES} SELECT {STAIN} AS stain, arg_max(name, slide_id) AS last_file, arg_min(name, slide_id) AS first_file FROM sl GROUP BY 1",
    "q_failure_codes": f"WITH {SLIDES}, c AS (SELECT slide_id, {CODE} AS code FROM sl) SELECT slide_id, code, CASE code WHEN 'OK' THEN 'OK' WHEN 'STAGE3_ABNORMAL' THEN 'WARN' ELSE 'FAIL' END AS status FROM c",
    "q_latest_status": f"WITH {LAST} SELECT slide, code, ts FROM last WHERE k = 1",
    "q_results_by_stain": f"WITH {LAST} SELECT stain, count(*) AS slides, count(*) FILTER (code IN ('OK', 'STAGE3_ABNORMAL')) AS reprocessed, count(*) FILTER (code NOT IN ('OK', 'STAGE3_ABNORMAL')) AS failed FROM last WHERE k = 1 GROUP BY 1",
    "q_stage_timing": f"""WITH {LOG}, n AS (SELECT *, lead(ts) OVER (PARTITION BY slide ORDER BY ts, seq) AS nx FROM lg),
  s AS (SELECT stage, count(*) AS runs, CAST(sum((epoch_us(nx) - epoch_us(ts)) // 1000000) AS BIGINT) AS seconds FROM n WHERE nx IS NOT NULL GROUP BY 1) SELECT *, seconds // 60 AS minutes FROM s""",
    "q_resume_pending": "SELECT o_custkey AS slide, o_orderkey AS tile FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')",
    "q_ready_slides": "SELECT c_custkey AS slide, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'OK' ELSE 'DIR_NOT_FOUND' END AS code FROM customer",
    "q_grid_fallback": f"WITH {GRID} SELECT slide_id, grid_rows, CAST(CASE WHEN p_size > 30 THEN grid_cols + slide_id % 2 ELSE grid_cols END AS INTEGER) AS grid_cols, p_size > 30 AND slide_id % 2 = 1 AS size_differs FROM grid",
    "q_union_sources": "SELECT user_id, event_type FROM events WHERE event_type = 'view' UNION ALL SELECT user_id, event_type FROM events WHERE event_type = 'click'",
    "q_distinct_slides": "SELECT DISTINCT user_id AS slide FROM events",
    "q_top_errors": f"""WITH {LOG}, e AS (SELECT seq, slide || ' ' || code AS message FROM lg WHERE code <> 'OK')
  SELECT * FROM (SELECT * FROM e ORDER BY seq LIMIT 10) UNION ALL SELECT NULL, '... and ' || (count(*) - 10) || ' more' FROM e HAVING count(*) > 10""",
    "q_stain_dim": f"WITH {SLIDES}, s AS (SELECT slide_id, {STAIN} AS stain FROM sl) SELECT slide_id, stain, CASE stain WHEN 'amyloid' THEN 'Amyloid' WHEN 'tau' THEN 'Tau' ELSE 'Iron' END || '_seg_tiles' AS folder FROM s",
    "q_cleanup_report": """WITH b AS (SELECT ['amyloid', 'tau', 'iron'][o_custkey % 3 + 1] AS stain, o_custkey AS slide, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS kb FROM orders GROUP BY 1, 2 HAVING kb > 0),
  s AS (SELECT stain, count(*) AS slides, CAST(sum(kb) AS BIGINT) AS kb FROM b GROUP BY 1) SELECT *, kb // 1024 AS mb, kb // 1048576 AS gb FROM s""",
    "q_label_map": f"WITH {PX} SELECT slide, count(*) AS labelled, CAST(sum(CASE WHEN pred > 0 THEN 1 ELSE 0 END) AS BIGINT) AS foreground FROM px WHERE x >= -0.2 GROUP BY 1",
    "q_mask_resize": """SELECT label AS slide, vec_id AS tile, (i // 8)::INTEGER AS r, (i % 8)::INTEGER AS c, CASE WHEN x > -0.05 THEN 255 WHEN x > -0.1 THEN 127 ELSE 0 END AS mask
  FROM (SELECT label, vec_id, i, CAST(embedding[i // 16 * 16 + i % 8 // 2 * 2 + 1] AS DOUBLE) AS x FROM embeddings, range(64) t(i))""",
    "q_mask_windows": f"""WITH {PX}, n AS (SELECT slide, (max(tile) // 20 + 1) * 4 AS mh FROM px GROUP BY 1),
 s AS (SELECT slide, tile // 20 * 4 + y // 2 AS my, tile % 20 * 4 + xx // 2 AS mx, mask FROM px WHERE y % 2 = 1 AND xx % 2 = 1),
 o AS (SELECT slide, tile, y, xx, mh, greatest(least((tile // 20 * 8 + y + 0.5::DOUBLE) / 2 - 0.5::DOUBLE, mh - 1), 0) AS py, greatest(least((tile % 20 * 8 + xx + 0.5::DOUBLE) / 2 - 0.5::DOUBLE, 79), 0) AS px_ FROM px JOIN n USING (slide)),
 k AS (SELECT slide, tile, y, xx, least(floor(py) + dy, mh - 1)::BIGINT AS my, least(floor(px_) + dx, 79)::BIGINT AS mx, (CASE dy WHEN 0 THEN 1 - py + floor(py) ELSE py - floor(py) END) * (CASE dx WHEN 0 THEN 1 - px_ + floor(px_) ELSE px_ - floor(px_) END) AS share
  FROM o, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) q(dy, dx))
 SELECT k.slide, tile, y AS r, xx AS c, floor(sum(share * coalesce(mask, 0)) + 0.5::DOUBLE)::INTEGER AS mask FROM k LEFT JOIN s ON s.slide = k.slide AND s.my = k.my AND s.mx = k.mx GROUP BY 1, 2, 3, 4""",
    "q_window_tiles": f"""WITH {PX}, n AS (SELECT slide, (max(tile) // 20 + 1) * 8 AS h, ceil((max(tile) // 20 + 1) * 8 / 24.0)::BIGINT AS rows FROM px GROUP BY 1),
 w AS (SELECT slide, g * 7 + c AS tile_id, g * h // rows AS row_up, (g + 1) * h // rows AS row_low, c * 160 // 7 AS col_up, (c + 1) * 160 // 7 AS col_low FROM n, range(rows) a(g), range(7) b(c)),
 q AS (SELECT slide, tile // 20 * 8 + y AS gy, tile % 20 * 8 + xx AS gx, mask FROM px)
 SELECT w.slide, tile_id::INTEGER AS tile_id, row_up, col_up, (row_low - row_up)::INTEGER AS h, (col_low - col_up)::INTEGER AS w, coalesce(sum(mask), 0)::INTEGER AS total
 FROM w LEFT JOIN q ON q.slide = w.slide AND gy >= row_up AND gy < row_low AND gx >= col_up AND gx < col_low GROUP BY ALL""",
    "q_reduce_slides": f"""WITH {PX}, n AS (SELECT slide, (max(tile) // 20 + 1) * 8 AS h FROM px GROUP BY 1), m AS (SELECT slide, tile // 20 * 8 + y AS gy, tile % 20 * 8 + xx AS gx, mask FROM px),
 z AS (SELECT sum(exp(-2.0::DOUBLE * k * k)) AS z FROM range(-2, 3) r(k)), g AS (SELECT t, coalesce((SELECT exp(-2.0::DOUBLE * t * t) WHERE t <= 2), 0) / z / 2 + coalesce((SELECT exp(-2.0::DOUBLE * (t - 1) * (t - 1)) WHERE t >= -1), 0) / z / 2 AS k FROM range(-2, 4) r(t), z),
 o AS (SELECT slide, i AS y, j AS x, h, a.k * b.k AS k, abs(2 * i + a.t) AS sy, abs(2 * j + b.t) AS sx FROM n, range(h // 2) r(i), range(80) s(j), g a, g b),
 q AS (SELECT slide, y, x, k, CASE WHEN sy > h - 1 THEN 2 * (h - 1) - sy ELSE sy END AS gy, CASE WHEN sx > 159 THEN 318 - sx ELSE sx END AS gx FROM o)
 SELECT slide, y::INTEGER AS y, x::INTEGER AS x, floor(sum(k * mask) + 1e-6)::INTEGER AS v FROM q JOIN m USING (slide, gy, gx) GROUP BY 1, 2, 3 HAVING floor(sum(k * mask) + 1e-6) > 0""",
    "q_regions": f"""WITH RECURSIVE {PX}, m AS (SELECT slide, tile // 20 * 8 + y AS gy, tile % 20 * 8 + xx AS gx FROM px WHERE pred > 0),
 near AS (SELECT a.slide, a.gy AS ay, a.gx AS ax, b.gy AS by_, b.gx AS bx FROM m a CROSS JOIN range(-1, 2) r(dy) CROSS JOIN range(-1, 2) s(dx) JOIN m b ON b.slide = a.slide AND b.gy = a.gy + dy AND b.gx = a.gx + dx),
 reach AS (SELECT slide, gy AS y0, gx AS x0, gy, gx FROM m UNION SELECT reach.slide, y0, x0, by_, bx FROM reach JOIN near ON near.slide = reach.slide AND ay = gy AND ax = gx),
 o AS (SELECT slide, gy, gx, min(y0 * 1000000 + x0) AS root FROM reach GROUP BY 1, 2, 3),
 c AS (SELECT slide, root, count(*) AS area, min(gy)::INTEGER AS top, min(gx)::INTEGER AS "left", (max(gy) + 1)::INTEGER AS low, (max(gx) + 1)::INTEGER AS "right" FROM o GROUP BY 1, 2)
 SELECT slide, area, top, "left", low, "right" FROM c QUALIFY row_number() OVER (PARTITION BY slide ORDER BY area DESC, top, "left", low, "right") = 1""",
    "q_sliding": f"WITH {PX} SELECT slide, (tile // 20 * 8 + y)::INTEGER AS y, (tile % 20 * 8 + xx)::INTEGER AS x, 255 AS v FROM px WHERE R + G + B > 382.5",
    "q_scene_planes": f"""WITH {PX}, b AS (SELECT slide, tile, (y * 8 + xx) * 3 + k AS i, [R, G, B][k + 1] AS v FROM px, range(3) t(k)),
 s AS (SELECT slide, tile, v, slide % 3 AS m, CASE slide % 3 WHEN 0 THEN i % 3 * 8 + i // 24 WHEN 1 THEN i // 8 % 8 ELSE i // 64 * 4 + i // 4 % 4 END AS r, CASE slide % 3 WHEN 0 THEN i // 3 % 8 WHEN 1 THEN i % 8 ELSE i % 4 END AS c FROM b)
 SELECT slide, tile, r::INTEGER AS r, c::INTEGER AS c, max(v) AS pixels, CASE m WHEN 1 THEN 'YX' ELSE 'CYX' END AS axes FROM s GROUP BY slide, tile, r, c, m""",
    "q_masking_applied": f"WITH {PX} SELECT slide, count(*) FILTER (mask < 255 AND R > 0) AS n_changed, count(*) FILTER (mask < 255 AND R > 0) > 0 AS applied FROM px GROUP BY 1",
    "q_erode_slide_tiles": f"WITH {WHOLE} SELECT slide, tile, y AS r, xx AS c, CASE WHEN n = 5 THEN mask ELSE 0 END AS mask FROM er",
    "q_eroded_count": f"WITH {WHOLE} SELECT slide, count(*) FILTER (mask > 0 AND n < 5) AS n_eroded FROM er GROUP BY 1",
    "q_tta_tiles": f"""WITH {PX}, a AS (SELECT slide, tile, y, xx, (R + G + B) / 765.0::DOUBLE AS l, unnest({AUG}) AS k FROM px),
  m AS (SELECT slide, tile, y AS r, xx AS c, avg(1 / (1 + exp(0.5::DOUBLE - (l + 0.01::DOUBLE * k[1] - 0.02::DOUBLE * k[2])))) AS p FROM a GROUP BY 1, 2, 3, 4)
  SELECT slide, tile, r, c, CASE WHEN p > 0.5 THEN 255 ELSE 0 END AS cls FROM m""",
    "q_shrink_tiles": f"""WITH {PX}, s AS (SELECT slide, tile, y // 3 AS y3, xx // 3 AS x3, count(*) AS n, sum(R) AS sr, sum(G) AS sg, sum(B) AS sb FROM px GROUP BY 1, 2, 3, 4)
  SELECT slide, tile, y3::INTEGER AS r, (x3 * 3 + k)::INTEGER AS c, ([sr, sg, sb][k + 1] // n)::INTEGER AS small FROM s, range(3) t(k)""",
    "q_cut_tiles": f"""WITH {PX}, e AS (SELECT *, y * 3 // 8 AS g0, xx * 3 // 8 AS h0 FROM px), g AS (SELECT *, CASE WHEN (g0 + 1) * 8 // 3 <= y THEN g0 + 1 ELSE g0 END AS gr, CASE WHEN (h0 + 1) * 8 // 3 <= xx THEN h0 + 1 ELSE h0 END AS gc FROM e)
  SELECT tile AS slide_id, (gr * 3 + gc)::INTEGER AS tile_id, (gr * 8 // 3)::INTEGER AS row_up, (gc * 8 // 3)::INTEGER AS col_up, (3 * count(*))::INTEGER AS n_bytes, sum(R + G + B)::INTEGER AS total FROM g GROUP BY 1, 2, gr, gc""",
    "q_paste_max": f"WITH {PARTS} SELECT slide, y, x, max(v) AS v FROM pa GROUP BY 1, 2, 3 HAVING max(v) > 0",
    "q_paste_last": f"WITH {PARTS} SELECT slide, y, x, arg_max(v, seq) AS v FROM pa GROUP BY 1, 2, 3 HAVING arg_max(v, seq) > 0",
    "q_paste_last_set": f"WITH {PARTS} SELECT slide, y, x, arg_max(v, seq) AS v FROM pa WHERE v > 0 GROUP BY 1, 2, 3",
    "q_infer_stats": f"""WITH {PX}, t AS (SELECT slide, tile, max(R) AS m, bool_or(mask = 255) AS tissue, max(mask) AS k FROM px GROUP BY 1, 2), f AS (SELECT *, m >= 64 OR k = 0 AS tried FROM t)
  SELECT slide, count(*) FILTER (tried AND tissue) AS processed, count(*) FILTER (NOT tried) AS skipped, count(*) FILTER (tried AND NOT tissue) AS errors FROM f GROUP BY 1""",
    "q_error_counts": f"WITH {LOG} SELECT stage, count(*) AS entries, count(*) FILTER (code <> 'OK') AS errors FROM lg GROUP BY 1",
    "q_log_entries": f"""WITH {LAST}, l AS (SELECT slide, code FROM last WHERE k = 1) SELECT slide, 'success' AS log, CASE code WHEN 'OK' THEN slide::VARCHAR ELSE slide || '|' || code END AS line FROM l WHERE code IN ('OK', 'STAGE3_ABNORMAL')
  UNION ALL SELECT slide, 'failure', slide || '|' || code FROM l WHERE code <> 'OK'""",
    "q_conversion_state": """WITH o AS (SELECT o_custkey AS k, bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus <> 'F') AS s FROM orders GROUP BY 1)
  SELECT c_custkey AS slide, CASE WHEN f AND s THEN 'done' WHEN f THEN 'resume' ELSE 'convert' END AS state FROM customer LEFT JOIN o ON k = c_custkey""",
    "q_tiling_xml": f"WITH {GRID} SELECT slide_id, h, w, name || '<1>.tif' AS file, '/data/a&b/' || name AS home, grid_rows, grid_cols FROM grid",
    "q_adjacency_xml": f"""WITH {TILES} SELECT slide_id, count(*)::INTEGER AS n_tiles, sum((gr > 0)::INTEGER + (gc > 0)::INTEGER + (gr < grid_rows - 1)::INTEGER + (gc < grid_cols - 1)::INTEGER)::INTEGER AS n_neighbours,
  coalesce(sum(tile_id + grid_cols) FILTER (gr < grid_rows - 1), 0)::INTEGER AS south_sum FROM tl GROUP BY 1""",
    "q_ome_metadata": f"""WITH {SLIDES} SELECT slide_id, CASE WHEN p_size > 0 THEN round(p_size * 1e-7::DOUBLE * 1e6::DOUBLE, 6) END AS x, CASE WHEN slide_id > 50 THEN 0.25::DOUBLE END AS y,
  CASE WHEN slide_id > 50 THEN 'um' END AS "PhysicalSizeYUnit", NULL::DOUBLE AS z, '5 um;' || name AS channels FROM sl""",
    "q_images_with_masks": f"WITH {SLIDES} SELECT '/data/' || name || '/output/RES/a.tiff' AS path, '/data/' || name || '/mask/final_mask/y_mask.tiff' AS mask FROM sl WHERE p_size > 5",
    "q_res_dirs": f"WITH {SLIDES} SELECT '/data/' || name || '/output' AS slide_dir, '/data/' || name || '/output/RES' AS res_dir, '/data/' || name || '/output/RES/a_res10.tiff' AS small FROM sl",
    "q_seg_tile_files": f"WITH {SLIDES} SELECT '/data/' || name || '/heatmap/seg_tiles/tile_000' || k || '.tif' AS path, 'tile_000' || k || '.tif' AS name, (k + 1)::INTEGER AS no FROM sl, range(2) t(k)",
    "q_tiff_roundtrip": f"""WITH {PX} SELECT '3063_22_#' || slide || '_BS_Iron/tile_' || lpad(tile::VARCHAR, CAST(greatest(4, length(tile::VARCHAR)) AS INTEGER), '0') || '.tif' AS name, 8::BIGINT AS h, 8::BIGINT AS w, 3::BIGINT AS channels, 1 AS pages,
  'uint8' AS dtype, false AS big, sum(R + G + B)::INTEGER AS total FROM px GROUP BY slide, tile""",
    "q_name_parts": f"""WITH {SLIDES} SELECT name, array_to_string(list_filter(string_split(name, '_'), lambda p: lower(p) NOT IN ('cp13', 'iron', 'amyloid')), '_') AS plain,
  CASE p_size WHEN 7 THEN 0 WHEN 3 THEN 1 WHEN 20 THEN 2 END AS cls FROM sl""",
    "q_slide_pipeline": f"WITH {REPORT} SELECT * FROM rp",
    "q_slide_pipeline_eroded": f"WITH {ERODED} SELECT * FROM rp",
    "q_stage_states": f"""WITH {REPORT} SELECT slide, ['masking', 'prediction', 'heatmap'][k] AS stage, CASE WHEN code = 'DIR_NOT_FOUND' THEN 'not reached' WHEN code = 'STAGE2_EMPTY' THEN ['ok', 'failed', 'not reached'][k]
  WHEN code = 'STAGE3_VERIFY_FAILED' THEN ['ok', 'ok', 'failed'][k] ELSE 'ok' END AS state FROM rp, range(1, 4) t(k)""",
}
ORACLE_SQL["q_scale_tiles"] = ORACLE_SQL["q_dynamic_scale"]
ORACLE_SQL["q_slide_colormap"] = ORACLE_SQL["q_colormap"]
