"""A query for each operator over the derived views; names and columns equal those of plans/oracle.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasieve.functions import geometry as G
from terrasieve.functions import scalars as S
from terrasieve.functions.staging import new_path
from terrasieve.operators import lines as L
from terrasieve.operators import raster as R
from terrasieve.operators import selection as C
from terrasieve.operators.kernels import thin_chunks, trace_lines
from terrasieve.plans import fixtures as V
from terrasieve.sources import files, geopackage, wkb

BUFFER, MASK_BUFFER = 3.0, 0.75
CHUNK = 2048  # pixels, as in the reference
SCALER = '{"0":{"mean":0.48,"std":0.22},"1":{"mean":0.46,"std":0.21},"2":{"mean":0.41,"std":0.2},"3":{"mean":0.5,"std":0.25}}'
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f"q_{f.__name__}"] = f
    return f


def r4(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4) + F.lit(0.0)


def fixed(c: Column) -> Column:
    """Length in ten-thousandths: whole numbers have one sum in any order."""
    return F.round(c * 10_000).cast("long")


def flagged(spark: SparkSession, d: str) -> DataFrame:
    flags = V.backgrounds(spark, d).select(S.base_name(F.col("image_file")).alias("file_name"), "is_background_only")
    return V.chips(spark, d).join(flags, "file_name", "left").withColumn("keep", ~S.truthy(F.col("is_background_only")))


def _report(spark: SparkSession, d: str) -> DataFrame:
    kept = L.chip_metrics(flagged(spark, d), V.labelled_lines(spark, d))
    return C.split_lookup(kept, V.members(spark, d))


@query
def bg_filter(spark, d):
    return flagged(spark, d).filter("keep").select("file_name", "is_background_only")


@query
def split_lookup(spark, d):
    return C.split_lookup(V.chips(spark, d).select("file_name"), V.members(spark, d))


@query
def chip_clip_lengths(spark, d):
    c = L.clip_to_boxes(V.labelled_lines(spark, d), V.chips(spark, d))
    return c.groupBy(F.col("rfile_name").alias("file_name"), "pred_result").agg(F.sum(fixed(F.col("clipped"))).alias("length"))


@query
def chip_report(spark, d):
    cols = ("tp_length", "fp_length", "fn_length", "precision", "recall", "f1_score")
    return _report(spark, d).select("file_name", "dataset_split", "keep", *[r4(c).alias(c) for c in cols])


@query
def split_means(spark, d):
    kept = _report(spark, d).na.drop(subset=["f1_score"])
    return kept.groupBy("dataset_split").agg(*[r4(F.avg(c)).alias(c) for c in ("precision", "recall", "f1_score")])


@query
def overall_mean(spark, d):
    kept = _report(spark, d).na.drop(subset=["f1_score"])
    return kept.agg(*[r4(F.avg(c)).alias(c) for c in ("precision", "recall", "f1_score")], F.count(F.lit(1)).alias("chips"))


@query
def line_split(spark, d):
    s = L.split_by_buffer(V.predictions(spark, d), V.edges(spark, d), BUFFER)
    return s.select("id", *[r4(c).alias(c) for c in ("length", "inside", "outside")])


@query
def fn_lengths(spark, d):
    return L.split_by_buffer(V.edges(spark, d), V.predictions(spark, d), BUFFER).filter("outside > 1e-9").select("id", r4("outside").alias("fn_length"))


@query
def line_totals(spark, d):
    t = L.line_totals(V.predictions(spark, d), V.edges(spark, d), BUFFER)
    return t.select(*[F.round(c, 3).alias(c) for c in ("tp", "fp", "fn")], *[r4(c).alias(c) for c in ("precision", "recall", "f1")])


@query
def union_all(spark, d):
    tp = V.predictions(spark, d).select("id", F.lit("TP").alias("pred_result"))
    fn = V.edges(spark, d).select("id", F.lit("FN").alias("pred_result"))
    return tp.unionByName(fn).groupBy("pred_result").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query
def dissolve_len(spark, d):
    both = V.edges(spark, d).withColumn("k", F.lit("truth")).unionByName(V.predictions(spark, d).withColumn("k", F.lit("predicted")))
    return L.dissolve(both, "k").select("k", F.round("length", 3).alias("length"))


@query
def dissolve_parts(spark, d):
    """Merged lines of both layers, moved off the whole numbers."""
    both = V.edges(spark, d).withColumn("k", F.lit("truth")).unionByName(V.predictions(spark, d).withColumn("k", F.lit("predicted")))
    moved = both.select("k", *[(F.col(c) + m).alias(c) for c, m in (("ax", 0.25), ("ay", 0.5), ("bx", 0.25), ("by", 0.5))])
    parts = L.dissolve_parts(moved, "k")
    return parts.select("k", *[F.round(parts[c], 3).alias(n) for c, n in (("ax", "x0"), ("ay", "y0"), ("bx", "x1"), ("by", "y1"))], F.round("length", 3).alias("length"))


BOX = (33.5, 41.25, 78.0, 96.5)


@query
def box_filter(spark, d):
    """Predicted lines and parcels that meet one box, whole."""
    lines = L.lines_in_box(V.predictions(spark, d), BOX).select(F.lit("line").alias("layer"), "id")
    parcels = L.areas_in_box(V.edges(spark, d).withColumn("parcel", F.expr("id div 4")), BOX, "parcel")
    return lines.unionByName(parcels.select(F.lit("parcel").alias("layer"), F.col("parcel").alias("id")))


@query
def box_inside(spark, d):
    """Parcels that meet a box which lies inside one of them."""
    return L.areas_in_box(V.edges(spark, d).withColumn("parcel", F.expr("id div 4")), (42.5, 53.0, 43.0, 53.25), "parcel").select(F.col("parcel").alias("id"))


@query
def crs_labels(spark, d):
    """Two labelled layers are compared before they are joined; rows by label."""
    p, e = L.with_crs(V.predictions(spark, d), "EPSG:27700"), L.with_crs(V.edges(spark, d), "EPSG:27700")
    s = L.split_by_buffer(p, e, BUFFER).select("id", F.lit("split").alias("layer"))
    return s.select("layer").unionByName(e.select(F.col("crs").alias("layer"))).groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


@query
def chip_index(spark, d):
    """The boxes of chips from their affine and size."""
    n = F.col("n_nationkey")
    sized = V.table(spark, d, "nation").select("n_nationkey", (n * 97 + 400).alias("width"), (n * 41 + 700).alias("height"))
    x0, y0, px = (n * 1000 + 400_000).cast("double"), (300_000 - n * 500).cast("double"), F.when(n % 2 == 0, 0.25).otherwise(0.5)
    zero = F.lit(0.0)
    box = G.box_of(F.col("tile_width"), F.col("tile_height"), (px, zero, x0 + px * F.col("col_off"), zero, -px, y0 - px * F.col("row_off")))
    name = F.concat_ws("_", F.lit("chip"), "n_nationkey", "col_off", F.concat(F.col("row_off").cast("string"), F.lit(".tif")))
    return R.tiles(sized).select(name.alias("file_name"), *[b.alias(c) for b, c in zip(box, ("xmin", "ymin", "xmax", "ymax"), strict=True)])


@query
def iou_dice(spark, d):
    n = V.probabilities(spark, d).select("vec_id", R.overlap_counts(F.col("prob"), F.col("mask")).alias("n"))
    return n.select("vec_id", "n.both", "n.p", "n.t", F.round(R.iou(F.col("n")), 6).alias("iou"), F.round(R.dice(F.col("n")), 6).alias("dice"))


@query
def eval_summary(spark, d):
    n = V.probabilities(spark, d).select(R.overlap_counts(F.col("prob"), F.col("mask")).alias("n"))
    f = R.five_numbers(n.select(R.iou(F.col("n")).alias("iou"), R.dice(F.col("n")).alias("dice")), "iou", "dice")
    return f.select("metric", *[F.round(c, 6).alias(c) for c in ("mean", "median", "least", "greatest", "std")])


@query
def confusion_pixels(spark, d):
    p = V.probabilities(spark, d).select("vec_id", F.explode(F.arrays_zip("prob", "mask")).alias("x"))
    return p.select("vec_id", R.confusion(F.col("x.prob"), F.col("x.mask")).alias("kind")).groupBy("vec_id", "kind").agg(F.count(F.lit(1)).alias("pixels"))


@query
def tta_mean(spark, d):
    m = R.turned_mean(V.pixel_rows(spark, d), ["vec_id"], 8, lambda v, r, c: S.sigmoid(10 * v + 0.1 * c - 0.05 * r))
    return m.select("vec_id", "row", "col", F.round("value", 6).alias("value"))


@query
def tiling(spark, d):
    sized = V.table(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") * 97 + 400).alias("width"), (F.col("n_nationkey") * 41 + 700).alias("height"))
    return R.tiles(sized).select("n_nationkey", "col_off", "row_off", "tile_width", "tile_height")


@query
def mosaic_lastwins(spark, d):
    p = V.table(spark, d, "lineitem").select((F.col("l_partkey") % 50).alias("row"), (F.col("l_suppkey") % 40).alias("col"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("value"))
    return R.mosaic(p, ["l_orderkey", "l_linenumber"], F.col("l_linenumber") == 1)


@query
def chunk_counts(spark, d):
    p = V.table(spark, d, "lineitem").select((F.col("l_partkey") % 500).alias("row"), (F.col("l_suppkey") % 400).alias("col"), "l_quantity")
    return R.chunked(p, 128).groupBy("chunk_row", "chunk_col").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("l_quantity") > 25).cast("long")).alias("high"))


@query
def mask_rasterize(spark, d):
    px = R.rasterise(V.edges(spark, d), MASK_BUFFER)
    chip = V.STRIDE
    span = lambda c: F.sequence(F.greatest(F.lit(0), F.floor((F.col(c) - V.CHIP) / chip) + 1), F.floor(F.col(c) / chip))
    inside = px.filter("row >= 0 and col >= 0").select("row", "col", F.explode(span("col")).alias("cx")).select("row", "cx", F.explode(span("row")).alias("cy"))
    return inside.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("mask_pixels"))


@query
def downscale(spark, d):
    return R.downscale(V.pixel_rows(spark, d), 2, ["vec_id"]).select("vec_id", "row", "col", F.round("value", 6).alias("value"))


@query
def upsample_band(spark, d):
    return _upsampled(V.vectors(spark, d))


def _upsampled(images: DataFrame) -> DataFrame:
    u = R.upsample(images.select("vec_id", "pixels"), 8, 8, 2)
    return u.groupBy("vec_id").agg(F.round(F.sum("value"), 4).alias("total"), F.round(F.max("value"), 6).alias("top"), F.count(F.lit(1)).alias("n"))


@query
def affine(spark, d):
    t = (0.25, 0.0, 400_000.0, 0.0, -0.25, 300_000.0)
    x, y = G.to_map(F.col("row").cast("double"), F.col("col").cast("double"), t)
    p = V.pixel_rows(spark, d).select("vec_id", "row", "col", x.alias("x"), y.alias("y"))
    r, c = G.to_pixel(F.col("x"), F.col("y"), t)
    return p.select("*", F.round(r, 6).alias("back_row"), F.round(c, 6).alias("back_col"))


@query
def normalise(spark, d):
    scaler = files.scaler_of(F.lit(SCALER))
    p = V.pixel_rows(spark, d).select("vec_id", "row", "col", (F.col("col") % 4).cast("string").alias("band"), F.col("value"), scaler.alias("s"))
    s = F.element_at("s", F.col("band"))
    n = p.select("vec_id", "band", S.normalise(F.col("value") * 255, s["mean"], s["std"]).alias("v"))
    return n.groupBy("vec_id", "band").agg(F.round(F.sum("v"), 4).alias("total"))


@query
def scaler(spark, d):
    p = V.pixel_rows(spark, d).select((F.col("col") % 4).alias("band"), F.col("value"))
    return R.band_statistics(p).select("band", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query
def display_scale(spark, d):
    return _displayed(V.vectors(spark, d))


def _displayed(images: DataFrame) -> DataFrame:
    n = R.display_scaled(F.col("pixels"), F.lit(False))
    return images.select("vec_id", F.round(F.aggregate(n, F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@query
def display_bytes(spark, d):
    """Images of bytes over 255, others by their own range."""
    v = V.vectors(spark, d).select("vec_id", (F.col("vec_id") % 2 == 0).alias("is_byte"), "pixels")
    as_bytes = F.transform("pixels", lambda x: F.floor(F.abs(x) * 1000) % 256 + F.lit(0.0))
    v = v.withColumn("pixels", F.when(F.col("is_byte"), as_bytes).otherwise(F.col("pixels")))
    n = R.display_scaled(F.col("pixels"), F.col("is_byte"))
    return v.select("vec_id", F.round(F.aggregate(n, F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


def _banded(spark: SparkSession, d: str) -> DataFrame:
    """Images of 4 x 4 pixels with 2, 3 or 4 bands from a vector's first 64 components."""
    bands = F.transform(F.sequence(F.lit(0), (1 + F.col("vec_id") % 3).cast("int")), lambda i: F.slice("pixels", i * 16 + 1, 16))
    return V.vectors(spark, d).select("vec_id", bands.alias("bands"))


@query
def stack_bands(spark, d):
    """A finer fourth band is added to images of three; every seventh image has none and gets zeros."""
    finer = R.upsampled(F.slice("pixels", 61, 4), 2, 2, 2)
    extra = V.vectors(spark, d).filter("vec_id % 7 <> 0").select("vec_id", finer.alias("pixels"))
    s = R.add_band(_banded(spark, d), extra, "vec_id")
    last = F.element_at("bands", -1)
    return s.select("vec_id", "status", F.size("bands").alias("bands"), F.round(F.aggregate(last, F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.round(F.element_at(last, 6), 6).alias("sixth"))


@query
def band_order(spark, d):
    """Colours turned round and pixel by pixel: the bands of each pixel in one array."""
    p = _banded(spark, d).filter(F.size("bands") > 2).select("vec_id", F.posexplode(R.by_pixel(R.band_subset(F.col("bands"), 3, 2, 1))).alias("i", "v"))
    return p.select("vec_id", "i", *[F.get("v", F.lit(k)).alias(c) for k, c in enumerate(("blue", "green", "red"))])


@query
def boundless_window(spark, d):
    """Windows of 4 x 4 pixels, some of them partly outside, where 0 stands."""
    k = F.col("vec_id")
    w = R.window_of(F.col("pixels"), 8, 8, (k % 11 - 3).cast("int"), (k % 13 - 4).cast("int"), 4, 4)
    return V.vectors(spark, d).select("vec_id", F.round(F.aggregate(w, F.lit(0.0), lambda a, x: a + x), 5).alias("total"), F.size(F.filter(w, lambda x: x == 0.0)).alias("zeros"))


@query
def pairs_semi(spark, d):
    return files.paired(V.chips(spark, d).select("file_name"), V.members(spark, d))


@query
def missing_anti(spark, d):
    return V.chips(spark, d).select("file_name").join(V.members(spark, d), "file_name", "left_anti")


@query
def missing_zeros(spark, d):
    sums = V.labelled_lines(spark, d).filter("pred_result = 'FP'").groupBy((F.col("id") % 50).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return V.table(spark, d, "nation").join(sums, F.col("n_nationkey") == F.col("k"), "left").select("n_nationkey", F.coalesce("n", F.lit(0)).alias("n"))


@query
def ratio_split(spark, d):
    return C.ratio_split(V.chips(spark, d).select("file_name"), "file_name").select("file_name", "split")


@query
def ratio_split_kept(spark, d):
    """The split of the chips that aren't flagged as background only, as the reference has it by default."""
    return C.ratio_split(flagged(spark, d).filter("keep").select("file_name"), "file_name").select("file_name", "split")


@query
def sample_n(spark, d):
    return C.sample_rows(V.chips(spark, d).select("file_name"), "file_name", 6, 7)


@query
def latest_model(spark, d):
    return C.latest_model(V.models(spark, d))


@query
def early_stop(spark, d):
    return C.early_stop(V.histories(spark, d), 10).select("run_id", "epoch", "val_loss", "is_best", F.col("bad").cast("long").alias("bad"))


@query
def plateau_rate(spark, d):
    return C.plateau_rate(V.histories(spark, d), 1e-4, 3)


@query
def epoch_mean(spark, d):
    b = V.table(spark, d, "events").select(F.dayofmonth("ts").alias("epoch"), F.col("value").alias("loss"))
    return b.groupBy("epoch").agg(F.round(F.avg("loss"), 6).alias("mean_loss"), F.count(F.lit(1)).alias("batches"))


@query
def prefix_strip(spark, d):
    k = V.table(spark, d, "part").select("p_partkey", F.concat(F.when(F.col("p_partkey") % 3 == 0, "_orig_mod.").otherwise(""), "p_name", F.lit("._orig_mod.w")).alias("key"))
    return k.select("p_partkey", S.strip_prefix(F.col("key")).alias("key"))


@query
def outcome_counts(spark, d):
    ok = V.table(spark, d, "orders").select((F.col("o_orderstatus") == "F").alias("ok"))
    return ok.agg(F.sum(F.col("ok").cast("long")).alias("success"), F.count(F.lit(1)).alias("total")).withColumn("failed", F.col("total") - F.col("success"))


@query
def union_scans(spark, d):
    c = V.chips(spark, d).select("file_name")
    return c.unionByName(c.filter("file_name like '%_1%'")).dropDuplicates(["file_name"])


@query
def report_text(spark, d):
    """The strings of every row of models."""
    return C.report_strings(V.models(spark, d))


@query
def thinned_lines(spark, d):
    """Threshold, thin by chunk, trace the whole mosaic and map: the vectorising end of the prediction."""
    px = R.rasterise(V.edges(spark, d), 1.5).filter("row >= 0 and col >= 0")
    thin = thin_chunks(R.chunked(px, CHUNK))
    return trace_lines(thin, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0), CHUNK, least=5)


@query
def gpkg_roundtrip(spark, d):
    """Edges written as lines of a GeoPackage layer and read back."""
    geopackage.register(spark)
    path = new_path(spark, "gpkg")
    wkb.edge_lines(V.edges(spark, d)).write.format("gpkg").option("layer", "edges").mode("append").save(path)
    e = wkb.edges(spark.read.format("gpkg").option("layer", "edges").load(path), "id")
    return e.select("id", F.col("ax").alias("x0"), F.col("ay").alias("y0"), F.col("bx").alias("x1"), F.col("by").alias("y1"))


@query
def gpkg_box(spark, d):
    """Predicted lines of a GeoPackage that meet a box: its R-tree finds those whose bounds do."""
    geopackage.register(spark)
    path = new_path(spark, "gpkg-box")
    wkb.edge_lines(V.predictions(spark, d)).write.format("gpkg").option("layer", "lines").mode("append").save(path)
    layer = spark.read.format("gpkg").option("layer", "lines").option("bounds", True).load(path)
    x0, y0, x1, y1 = BOX
    near = layer.filter((F.col("min_x") <= x1) & (F.col("max_x") >= x0) & (F.col("min_y") <= y1) & (F.col("max_y") >= y0))
    return L.lines_in_box(wkb.edges(near, "id"), BOX).select("id", F.col("ax").alias("x0"), F.col("ay").alias("y0"))


@query
def run_stamps(spark, d):
    """Times as names of files and lines of logs have them."""
    t = F.col("ts")
    return V.table(spark, d, "events").select("event_id", S.stamp(t).alias("file_stamp"), S.stamp(t, S.LOG_STAMP).alias("log_stamp"), F.concat(F.lit("preds_"), S.stamp(t), F.lit(".gpkg")).alias("file_name"))


@query
def model_states(spark, d):
    """Checkpoints of both kinds, their weights by name without the compiler's prefix."""
    k = F.col("p_partkey")
    prefix = F.when(k % 3 == 0, "_orig_mod.").otherwise("")
    state = F.create_map(F.concat(prefix, F.lit("a.w")), F.col("p_retailprice"), F.concat(prefix, F.lit("b._orig_mod.w")), F.col("p_size").cast("double"))
    own = lambda odd, name: F.when((k % 2 == 1) == F.lit(odd), state).alias(name)
    m = V.table(spark, d, "part").select(k.alias("name"), F.when(F.col("p_size") % 2 == 0, "unet").otherwise("unetplusplus").alias("arch"), F.col("p_brand").alias("encoder"), own(True, "state_dict"), own(False, "model_state_dict"))
    return files.model_states(m).select("name", "arch", "encoder", F.explode("state").alias("key", "value"))


@query
def latest_mtime(spark, d):
    """The file with the suffix that was changed last."""
    name = F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 5 == 0, "_other.gpkg").otherwise("_boundaries.gpkg"))
    return C.latest_by_time(V.table(spark, d, "orders").select(name.alias("file_name"), F.col("o_orderdate").alias("modified")), "_boundaries.gpkg")


@query
def z_order(spark, d):
    """A mosaic's manifest: files with their place in it."""
    c = V.chips(spark, d).select(F.concat(F.lit("/data/chips/"), "file_name").alias("path"), "xmin", "ymin", "xmax", "ymax")
    return files.manifest(c)


@query
def seeded_shuffle(spark, d):
    return C.shuffled(V.chips(spark, d).select("file_name"), "file_name", 11)


@query
def flags_csv(spark, d):
    """Flags written as a CSV and read back as text."""
    path = new_path(spark, "flags")
    V.backgrounds(spark, d).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.background_flags(spark, path)


@query
def scaler_json(spark, d):
    """Band statistics written as a JSON scaler and read back."""
    path = new_path(spark, "scaler")
    p = V.pixel_rows(spark, d).select((F.col("col") % 4).alias("band"), F.col("value"))
    files.write_scaler(R.band_statistics(p), path)
    s = files.read_scaler(spark, path).select(F.explode("scaler").alias("band", "s"))
    return s.select("band", F.round("s.mean", 6).alias("mean"), F.round("s.std", 6).alias("std"))


@query
def append_log(spark, d):
    """Two runs add their lines to one log."""
    path = new_path(spark, "log")
    for seed in (1, 2):
        files.append_log(V.table(spark, d, "nation").select(F.lit(seed).alias("run"), "n_name", (F.col("n_nationkey") * seed).alias("score")), path)
    return spark.read.text(path)


@query
def overwrite_guard(spark, d):
    """A second write without leave is refused, and what is there stays; with leave it replaces it."""
    path = new_path(spark, "guarded")
    files.guarded(V.table(spark, d, "nation"), False).parquet(path)
    try:
        files.guarded(V.table(spark, d, "region"), False).parquet(path)
        refused = False
    except AnalysisException:
        refused = True
    kept = spark.read.parquet(path).count()
    files.guarded(V.table(spark, d, "region").select(F.col("r_regionkey").alias("key")), True).parquet(path)
    return spark.read.parquet(path).select("key", F.lit(refused).alias("refused"), F.lit(kept).cast("long").alias("kept"))


@query
def lines_only(spark, d):
    """Geometries of several kinds; lines that aren't empty stay."""
    hexed = [F.unhex(F.lit(h)) for h in ("010200000000000000", "0101000000000000000000F03F0000000000000040", "010500000000000000", "00000000050000000100000000020000000200000000000000000000000000000000000000000000000000000000000000000000000000000000")]
    e = wkb.edge_lines(V.edges(spark, d).select("id", "ax", "ay", "bx", "by"))
    k = F.col("id") % 7
    odd = F.when(k == 0, hexed[0]).when(k == 1, hexed[1]).when(k == 2, hexed[2]).when(k == 3, hexed[3]).when(k == 4, F.lit(None).cast("binary")).otherwise(F.col("geom"))
    return wkb.lines_only(e.withColumn("geom", odd)).select("id")


# Names from when the queries without `_all` left rows out.
QUERIES |= {f"q_{name}_all": QUERIES[f"q_{name}"] for name in ("report_text", "display_scale", "upsample_band")}
