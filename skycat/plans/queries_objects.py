"""Registered queries: objects, light curves, nested products, readers, writers and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import streaming
from ..functions.healpix import coarser, healpix_nested
from ..operators import nested, objects, versions
from ..session import shared_folder
from ..sources import readers, writers
from ..streaming import state
from .fixtures import Catalog
from .queries_sky import BITS, HEALPIX, R, rounded, walked, within
from .registry import query

BEST = "SELECT pid FROM diffimages WHERE vbest <> 0"

STATS = f"""
WITH r AS (SELECT m.aid, s.ra, s.dec, s.fluxfit AS flux FROM merges m JOIN sources s ON m.sid = s.sid WHERE s.pid IN ({BEST})),
w AS (SELECT aid, CASE WHEN bool_or(ra < 10) OVER (PARTITION BY aid) AND bool_or(ra > 350) OVER (PARTITION BY aid) AND ra > 350 THEN ra - 360 ELSE ra END AS ra, dec, flux FROM r)
SELECT aid, CASE WHEN round(avg(ra), 7) < 0 THEN round(avg(ra) + 360, 7) ELSE round(avg(ra), 7) END AS meanra, round(stddev_pop(ra), 9) AS stdevra, round(avg(dec), 7) AS meandec, round(stddev_pop(dec), 9) AS stdevdec,
  round(avg(flux), 7) AS meanflux, round(stddev_pop(flux), 5) AS stdevflux, count(*) AS nsources FROM w GROUP BY aid"""


@query("object_statistics", STATS)
def object_statistics(t):
    out = objects.object_statistics(t.merges, t.sources, t.diffimages)
    return rounded(rounded(rounded(out, 9, "stdevra", "stdevdec"), 5, "stdevflux"), 7, "meanra", "meandec", "meanflux")


@query("incremental_mean", """
WITH o AS (SELECT aid, ra0 AS meanra, dec0 AS meandec, p_size AS nsources FROM objects),
d AS (SELECT aid, sum(CASE WHEN ra - meanra > 180 THEN ra - meanra - 360 WHEN ra - meanra < -180 THEN ra - meanra + 360 ELSE ra - meanra END) AS dra,
   sum(dec - meandec) AS ddec, count(*) AS k FROM sources JOIN o ON partkey = aid GROUP BY aid),
n AS (SELECT o.aid, meanra + coalesce(dra, 0) / (nsources + coalesce(k, 0)) AS a, meandec + coalesce(ddec, 0) / (nsources + coalesce(k, 0)) AS meandec,
   nsources + coalesce(k, 0) AS nsources FROM o LEFT JOIN d ON o.aid = d.aid)
SELECT aid, round(CASE WHEN a < 0 THEN a + 360 WHEN a >= 360 THEN a - 360 ELSE a END, 9) AS meanra, round(meandec, 9) AS meandec, nsources FROM n""")
def incremental_mean(t):
    o = t.objects.selectExpr("aid", "ra0 AS meanra", "dec0 AS meandec", "p_size AS nsources")
    out = objects.incremental_mean(o, t.sources.select(F.col("partkey").alias("aid"), "ra", "dec"))
    return rounded(out, 9, "meanra", "meandec")


BANDS = {1: "F184", 2: "H158", 3: "J129", 4: "K213", 5: "R062", 6: "Y106", 7: "Z087", 8: "W146"}


@query("per_band_object_summary", "SELECT aid, " + ", ".join(
    f"round(avg(fluxfit) FILTER (fid = {i}), 7) AS {b}_mean, round(stddev_pop(fluxfit) FILTER (fid = {i}), 5) AS {b}_sigma, "
    f"count(*) FILTER (fid = {i}) AS {b}_ndata, min(fluxfit) FILTER (fid = {i}) AS {b}_min, max(fluxfit) FILTER (fid = {i}) AS {b}_max"
    for i, b in BANDS.items()) + " FROM merges m JOIN sources s ON m.sid = s.sid GROUP BY aid")
def per_band_object_summary(t):
    out = objects.per_band_object_summary(t.merges, t.sources, BANDS)
    return rounded(rounded(out, 7, *[b + "_mean" for b in BANDS.values()]), 5, *[b + "_sigma" for b in BANDS.values()])


@query("count_objects_by_field", "SELECT field, count(*) AS n FROM objects GROUP BY ROLLUP (field)")
def count_objects_by_field(t):
    return objects.count_by_field(t.objects)


@query("count_merges_by_field", "SELECT field, count(*) AS n FROM merges GROUP BY ROLLUP (field)")
def count_merges_by_field(t):
    return objects.count_by_field(t.merges)


@query("orphan_objects", f"SELECT aid, field FROM objects WHERE aid NOT IN (SELECT aid FROM merges WHERE sid IN (SELECT sid FROM sources WHERE fid = 1 AND pid IN ({BEST})))")
def orphan_objects(t):
    used = objects.prune_not_best(t.sources.filter("fid = 1"), t.diffimages).select("sid")
    return objects.orphan_objects(t.objects, t.merges.join(used, "sid", "left_semi")).select("aid", "field")


@query("merges_outside_field", """SELECT o.field, count(*) AS n_outside FROM merges m JOIN objects o ON m.aid = o.aid JOIN sources s ON m.sid = s.sid
  WHERE s.field <> o.field GROUP BY o.field""")
def merges_outside_field(t):
    owned = t.merges.select("aid", "sid").join(t.objects.select("aid", "field"), "aid")
    return objects.merges_outside_field(owned, t.sources)


@query("lightcurve", "SELECT aid, mjdobs, s.sid, fid, fluxfit, fluxerr FROM merges m JOIN sources s ON m.sid = s.sid ORDER BY aid, mjdobs, s.sid")
def lightcurve(t):
    return objects.lightcurve(t.merges, t.sources)


LATEST = """l AS (SELECT aid, sid AS trigger_sid, mjdobs AS trigger_mjd FROM (SELECT m.aid, s.sid, s.mjdobs,
   row_number() OVER (PARTITION BY m.aid ORDER BY s.mjdobs DESC, s.sid DESC) AS n FROM merges m JOIN sources s ON m.sid = s.sid) WHERE n = 1)"""


@query("object_previous_detections", f"""WITH {LATEST}
SELECT l.aid, trigger_sid, trigger_mjd, s.sid, s.mjdobs FROM l JOIN merges m ON l.aid = m.aid JOIN sources s ON m.sid = s.sid
WHERE s.mjdobs >= trigger_mjd - 365.25 AND s.sid <> trigger_sid""")
def object_previous_detections(t):
    triggers = objects.latest_triggers(t.merges, t.sources)
    return objects.previous_detections(triggers, t.merges, t.sources)


@query("prune_redundant_merges", "SELECT DISTINCT aid, sid, field FROM repeated_merges")
def prune_redundant_merges(t):
    return objects.prune_redundant_merges(t.repeated_merges)


@query("prune_not_best_merges", f"SELECT aid, sid FROM merges WHERE sid IN (SELECT sid FROM sources WHERE pid IN ({BEST}))")
def prune_not_best_merges(t):
    return objects.prune_not_best_merges(t.merges.select("aid", "sid"), t.sources, t.diffimages)


@query("prune_not_best_sources", f"SELECT sid, pid, fluxfit FROM sources WHERE pid IN ({BEST})")
def prune_not_best_sources(t):
    return objects.prune_not_best(t.sources.select("sid", "pid", "fluxfit"), t.diffimages)


@query("register_merge_once", """SELECT DISTINCT l_partkey AS aid, l_suppkey AS sid FROM lineitem""")
def register_merge_once(t):
    rows = t.lineitem.selectExpr("l_partkey AS aid", "l_suppkey AS sid", "l_returnflag AS f")
    old = rows.filter("f = 'A'").select("aid", "sid").distinct()
    return objects.register_merge_once(old, rows.filter("f <> 'A'").select("aid", "sid"))


@query("drop_empty_fields", """
WITH m AS (SELECT DISTINCT field FROM sources WHERE fid = 2 AND sca < 5),
o AS (SELECT aid, field FROM objects WHERE field IN (SELECT field FROM m))
SELECT 'object' AS kind, field, count(*) AS n FROM o GROUP BY field
UNION ALL SELECT 'merge', field, count(*) FROM sources WHERE fid = 2 AND sca < 5 AND field IN (SELECT field FROM objects) GROUP BY field""")
def drop_empty_fields(t):
    m = t.sources.filter("fid = 2 AND sca < 5").select("sid", "field")
    o, m = objects.drop_empty_fields(t.objects.select("aid", "field"), m)
    count = F.count("*").alias("n")
    return (o.groupBy("field").agg(count).select(F.lit("object").alias("kind"), "field", "n")
            .unionByName(m.groupBy("field").agg(count).select(F.lit("merge").alias("kind"), "field", "n")))


@query("backfill_index_columns", HEALPIX.rstrip() + f""",
h AS (SELECT sid, face * 262144 + {BITS} AS hp9 FROM f),
z AS (SELECT s.sid, s.ra, CAST(floor((s.dec + 90) / 2) AS BIGINT) AS zone, f.filter, s.sca FROM sources s JOIN filters f ON s.fid = f.fid),
n AS (SELECT *, CASE WHEN zone IN (0, 89) THEN 1 ELSE CAST(floor(180e0 * cos(radians(zone * 2e0 - 89e0))) AS BIGINT) END AS n FROM z)
SELECT n.sid, filter, sca, zone * 1000 + 1 + CAST(floor(ra / (360e0 / n) + CASE WHEN n = 1 THEN 0 ELSE 5e-1 END) AS BIGINT) % n AS field,
  hp9 >> 6 AS hp6, hp9 FROM n JOIN h ON h.sid = n.sid""")
def backfill_index_columns(t):
    from ..operators.tiles import point_to_tile

    named = nested.with_filter_name(t.sources.select("sid", "fid", "sca", "ra", "dec"), t.filters).withColumnRenamed("filter_name", "filter")
    hp9 = named.withColumn("hp9", healpix_nested("ra", "dec", 9)).withColumn("hp6", coarser(F.col("hp9"), 3))
    return point_to_tile(hp9, t.tiles, h=2.0).select("sid", "filter", "sca", "field", "hp6", "hp9")


# --- nested products -------------------------------------------------------------------------


@query("nest_lightcurves", """SELECT aid, p_size AS nsources, CAST(floor(mjdobs / 365.25) AS BIGINT) AS chunk, count(*) AS n_points, min(mjdobs) AS first_mjd, max(mjdobs) AS last_mjd,
  min(struct_pack(a := mjdobs, b := s.sid, c := fid, d := fluxfit)).d AS any_flux FROM merges m JOIN sources s ON m.sid = s.sid JOIN objects o USING (aid) GROUP BY aid, p_size, chunk""")
def nest_lightcurves(t):
    return _nested(t).select("aid", "nsources", "chunk", F.size("nested_lc_data").cast("long").alias("n_points"),
                             F.col("nested_lc_data")[0]["mjdobs"].alias("first_mjd"),
                             F.element_at("nested_lc_data", -1)["mjdobs"].alias("last_mjd"),
                             F.col("nested_lc_data")[0]["fluxfit"].alias("any_flux"))


def _nested(t):
    o = t.objects.withColumnRenamed("p_size", "nsources")
    return nested.nest_lightcurves(o, t.merges, t.sources, ["aid", "nsources"], ["sid", "mjdobs", "fid", "fluxfit"])


@query("unnest_lightcurves", """SELECT aid, CAST(floor(mjdobs / 365.25) AS BIGINT) AS chunk,
  CAST(row_number() OVER (PARTITION BY aid, floor(mjdobs / 365.25) ORDER BY mjdobs, s.sid) - 1 AS INT) AS pos, mjdobs, s.sid, fid, fluxfit
  FROM merges m JOIN sources s ON m.sid = s.sid JOIN objects o USING (aid) WHERE p_size > 0""")
def unnest_lightcurves(t):
    return nested.unnest_lightcurves(_nested(t)).drop("nsources")


@query("build_dia_source", """SELECT s.sid AS "diaSourceId", expid AS visit, sca AS detector, partkey AS "diaObjectId", filter AS band, fluxfit AS "psfFlux",
  round(fluxfit / fluxerr, 9) AS snr, flags, isdiffpos, redchi, field FROM sources s JOIN filters f ON s.fid = f.fid""")
def build_dia_source(t):
    s = nested.with_filter_name(t.sources, t.filters)
    r = s.select(nested.dia_source(s.columns, F.col("partkey"), F.col("filter_name")).alias("r")).select("r.*")
    return rounded(r.select("diaSourceId", "visit", "detector", "diaObjectId", "band", "psfFlux", "snr", "flags", "isdiffpos", "redchi", "field"), 9, "snr")


@query("build_dia_object", f"""WITH {LATEST}
SELECT o.aid AS "diaObjectId", ra0 AS ra, dec0 AS dec, p_size AS "nDiaSources", trigger_mjd AS "lastDiaSourceMjdTai", trigger_mjd AS "validityStartMjdTai"
FROM objects o JOIN l ON o.aid = l.aid""")
def build_dia_object(t):
    o = t.objects.withColumnRenamed("p_size", "nsources").join(objects.latest_triggers(t.merges, t.sources), "aid")
    r = o.select(nested.dia_object(F.col("trigger_mjd"), F.col("trigger_mjd"), F.col("trigger_mjd")).alias("r")).select("r.*")
    return r.select("diaObjectId", "ra", "dec", "nDiaSources", "lastDiaSourceMjdTai", "validityStartMjdTai")


@query("build_dia_forced_source", """SELECT sid AS "diaForcedSourceId", partkey AS "diaObjectId", expid AS visit, ra0 AS ra, fluxfit AS "psfFlux", mjdobs AS "midpointMjdTai"
  FROM sources s JOIN objects o ON s.partkey = o.aid""")
def build_dia_forced_source(t):
    s = t.sources.selectExpr("sid AS forced_id", "partkey AS aid", "expid", "sca", "fluxfit AS forcediffimflux", "mjdobs", "fid")
    s = nested.with_filter_name(s, t.filters).join(t.objects.select("aid", "ra0", "dec0"), "aid")
    r = s.select(nested.dia_forced_source(s.columns, F.col("ra0"), F.col("dec0"), F.col("filter_name")).alias("r")).select("r.*")
    return r.select("diaForcedSourceId", "diaObjectId", "visit", "ra", "psfFlux", "midpointMjdTai")


@query("assemble_alerts", f"""WITH {LATEST},
p AS (SELECT trigger_sid, count(*) AS n_prev, min(s.mjdobs) AS f, max(s.mjdobs) AS g, round(sum(s.fluxfit), 3) AS prev_flux
   FROM l JOIN merges m ON l.aid = m.aid JOIN sources s ON m.sid = s.sid WHERE s.mjdobs >= trigger_mjd - 365.25 AND s.sid <> trigger_sid GROUP BY trigger_sid)
SELECT l.trigger_sid AS "diaSourceId", l.aid, filter AS band, coalesce(n_prev, -1) AS n_prev, least(trigger_mjd, coalesce(f, trigger_mjd)) AS first_mjd,
  greatest(trigger_mjd, coalesce(g, trigger_mjd)) AS last_mjd, prev_flux
FROM l JOIN sources s ON l.trigger_sid = s.sid JOIN filters USING (fid) LEFT JOIN p ON p.trigger_sid = l.trigger_sid""")
def assemble_alerts(t):
    alerts = _alerts(t)
    total = F.aggregate("prvDiaSources", F.lit(0.0), lambda a, s: a + s["psfFlux"])
    return alerts.select("diaSourceId", F.col("diaObject.diaObjectId").alias("aid"), F.col("diaSource.band").alias("band"),
                         F.coalesce(F.size("prvDiaSources"), F.lit(-1)).cast("long").alias("n_prev"),
                         F.col("diaObject.firstDiaSourceMjdTai").alias("first_mjd"), F.col("diaObject.lastDiaSourceMjdTai").alias("last_mjd"),
                         F.round(total, 3).alias("prev_flux"))


def _alerts(t, forced=None):
    triggers = objects.latest_triggers(t.merges, t.sources).select(F.col("trigger_sid").alias("sid"))
    o = t.objects.withColumnRenamed("p_size", "nsources")
    return nested.assemble_alerts(triggers, t.merges, o, t.sources, t.filters, forced=forced)


HISTORY = f"""WITH {LATEST},
d AS (SELECT l.trigger_sid, s.*, f.filter FROM l JOIN merges m ON l.aid = m.aid JOIN sources s ON m.sid = s.sid JOIN filters f ON s.fid = f.fid
   WHERE s.mjdobs >= trigger_mjd - 365.25 AND s.sid <> trigger_sid)
SELECT trigger_sid, CAST(row_number() OVER (PARTITION BY trigger_sid ORDER BY mjdobs, sid) - 1 AS INT) AS pos, sid AS "diaSourceId", expid AS visit,
  partkey AS "diaObjectId", mjdobs AS "midpointMjdTai", filter AS band, fluxfit AS "psfFlux", field, pid FROM d"""


@query("alert_history_rows", HISTORY)
def alert_history_rows(t):
    """The nested history of all alerts, record by record."""
    rows = _alerts(t).select(F.col("diaSourceId").alias("trigger_sid"), F.posexplode("prvDiaSources").alias("pos", "r"))
    return rows.select("trigger_sid", "pos", *[f"r.{c}" for c in ("diaSourceId", "visit", "diaObjectId", "midpointMjdTai", "band", "psfFlux", "field", "pid")])


@query("alert_forced_rows", f"""WITH {LATEST},
d AS (SELECT l.trigger_sid, s.sid, s.expid, s.partkey, o.ra0, s.fluxfit, s.mjdobs, f.filter FROM l JOIN sources s ON l.aid = s.partkey
   JOIN objects o ON o.aid = l.aid JOIN filters f ON s.fid = f.fid WHERE s.mjdobs >= trigger_mjd - 365.25)
SELECT trigger_sid, CAST(row_number() OVER (PARTITION BY trigger_sid ORDER BY mjdobs, sid) - 1 AS INT) AS pos, sid AS "diaForcedSourceId",
  expid AS visit, partkey AS "diaObjectId", ra0 AS ra, filter AS band, fluxfit AS "psfFlux", mjdobs AS "midpointMjdTai" FROM d""")
def alert_forced_rows(t):
    """The nested forced photometry of all alerts, record by record."""
    forced = t.sources.selectExpr("partkey AS aid", "sid AS forced_id", "expid", "sca", "fid", "fluxfit AS forcediffimflux", "mjdobs")
    rows = _alerts(t, forced).select(F.col("diaSourceId").alias("trigger_sid"), F.posexplode("prvDiaForcedSources").alias("pos", "r"))
    return rows.select("trigger_sid", "pos", *[f"r.{c}" for c in ("diaForcedSourceId", "visit", "diaObjectId", "ra", "band", "psfFlux", "midpointMjdTai")])


@query("catalog_to_records", """SELECT image_id, chunk, count(*) AS n_records, min(ref_id) AS first_id FROM (SELECT image_id, ref_id, ref_id // 1000 AS chunk FROM ref_catalog) GROUP BY image_id, chunk""")
def catalog_to_records(t):
    out = nested.catalog_to_records(t.ref_catalog, ["image_id"], ["ref_id", "x", "y", "flux"], ["ref_id"], F.floor(F.col("ref_id") / 1000))
    return out.select("image_id", "chunk", F.size("records").cast("long").alias("n_records"), F.col("records")[0]["ref_id"].cast("long").alias("first_id"))


@query("build_catalogue", f"""WITH c AS (SELECT field, partkey, sid, pid, dec, fluxfit, mjdobs * 100 + sca AS batch FROM sources WHERE flags = 0),
f AS (SELECT *, min(batch) OVER (PARTITION BY field, partkey) = batch AS is_first FROM c),
m AS (SELECT s.sid AS aid, m.sid, m.pid, m.dec, m.fluxfit FROM f s JOIN f m ON s.field = m.field AND s.partkey = m.partkey WHERE s.is_first AND (s.sid = m.sid OR NOT m.is_first)),
b AS (SELECT * FROM m WHERE pid IN ({BEST}))
SELECT aid, count(*) AS nsources, round(avg(dec), 7) AS meandec, round(sum(fluxfit), 3) AS sumflux, round(stddev_pop(fluxfit), 3) AS stdevflux FROM b GROUP BY aid""")
def build_catalogue(t):
    """The steps in a row: load by date and detector, load again, associate, register once, prune, statistics."""
    from ..operators import associate

    path = _folder(t)
    rows = t.sources.selectExpr("sid", "pid", "sid AS id", "isdiffpos AS positive", "ra", "dec", "fluxfit", "flags", "field", "expid", "fid", "mjdobs",
                                "date_format(dateobs, 'yyyy') AS proc_date", "sca")
    for part in (rows.filter("mjdobs < 50000"), rows):  # an early night first, then everything
        writers.bulk_load_sources(part.filter("positive").drop("positive"), part.filter("NOT positive").drop("positive"), path)
    loaded = t.spark.read.parquet(path)
    clean = loaded.filter("flags = 0")
    found = associate.associate_within_field(clean, 3e-5)
    merges = objects.register_merge_once(found.filter("sid % 2 = 0"), found)
    kept = objects.prune_not_best_merges(merges.select("aid", "sid"), clean, t.diffimages)
    stats = objects.object_statistics(kept, clean, None).select("aid", "nsources", "meandec", (F.col("meanflux") * F.col("nsources")).alias("sumflux"), "stdevflux")
    return rounded(rounded(stats, 7, "meandec"), 3, "sumflux", "stdevflux")


# --- readers -----------------------------------------------------------------------------------


def _folder(t) -> str:
    return f"{shared_folder(t.spark)}/skycat-{uuid.uuid4().hex}"


PACKED_LINES = 2_000_000  # lines of a compressed file, which is read in one piece


def _files(t, lines, by: str | None = None, packed: bool = False) -> str:
    """The lines as text files, as the survey delivers them: what is read back is a scan of these files.  ``by`` gives each file a folder of that name.

    ``packed`` compresses the files.
    """
    folder = _folder(t)
    if packed:
        lines.write.option("compression", "gzip").option("maxRecordsPerFile", PACKED_LINES).text(folder)
        return folder
    writer = lines.write if by is None else lines.write.partitionBy(by)
    writer.text(folder)
    return folder


@query("scan_ascii_catalog", "SELECT ref_id, x, y, fwhm AS \"FLUX_RADIUS_1\" FROM ref_catalog")
def scan_ascii_catalog(t):
    """Catalogue files with comment lines, and broken ones that are set apart."""
    lines = t.ref_catalog.selectExpr("explode(array('# 1 NUMBER', concat_ws('   ', '', ref_id, x, y, fwhm, mag), "
                                     "CASE WHEN ref_id % 50 = 0 THEN concat_ws(' ', ref_id, x) WHEN ref_id % 50 = 1 THEN concat_ws(' ', 'x', x, y, fwhm, mag) ELSE '' END)) AS value")
    folder = _files(t, lines)
    names = readers.parameter_names(["NUMBER\n", "X_IMAGE\n", "Y_IMAGE\n", "FLUX_RADIUS(1)\n", "MAG\n"])
    out = readers.read_ascii_catalog(t.spark, folder, names, {"NUMBER": "bigint", "X_IMAGE": "double", "Y_IMAGE": "double", "FLUX_RADIUS_1": "double"}, "broken")
    return out.filter("broken IS NULL").drop("file", "broken").withColumnsRenamed({"NUMBER": "ref_id", "X_IMAGE": "x", "Y_IMAGE": "y"})


def _pair(t):
    """Main and finder catalogue files of the detections, one line per source, with the detection run in front."""
    s = t.sources
    main = _files(t, s.selectExpr("concat_ws(' ', pid, sid, xfit, yfit, fluxfit, fluxerr, redchi, flags, ra, dec) AS value"), packed=True)
    finder = _files(t, s.filter("id <> 3").selectExpr("concat_ws(' ', pid, sid, sharpness, roundness1, npix, peak) AS value"), packed=True)
    a = readers.read_ascii_catalog(t.spark, main, "pid id x_fit y_fit flux_fit flux_err reduced_chi2 flags ra dec".split(),
                                   {"pid": "bigint", "id": "bigint", "x_fit": "double", "y_fit": "double", "flux_fit": "double", "reduced_chi2": "double", "ra": "double"}).drop("file")
    b = readers.read_ascii_catalog(t.spark, finder, "pid id sharpness roundness1 n_pixels peak".split(),
                                   {"pid": "bigint", "id": "bigint", "sharpness": "double", "n_pixels": "int"}).drop("file")
    return a, b, t.diffimages.select("pid", "expid", "sca", "fid", "field")


@query("scan_psf_catalog_pair", """SELECT s.pid, s.sid AS id, xfit, yfit, fluxfit, redchi, ra, sharpness, npix, d.expid, d.sca, d.fid, d.field
  FROM sources s JOIN diffimages d ON s.pid = d.pid WHERE s.id <> 3""")
def scan_psf_catalog_pair(t):
    return readers.join_catalog_pair(*_pair(t), ["pid"])


@query("scan_positions", "SELECT reqid, ra, dec FROM positions")
def scan_positions(t):
    """Request files with comment lines, and broken ones that are set apart."""
    lines = t.positions.selectExpr("explode(array('# comment', concat_ws(',', reqid, ra, dec), CASE WHEN reqid % 9 = 0 THEN concat_ws(',', reqid, 'north', dec) ELSE '' END)) AS value")
    return readers.read_positions(t.spark, _files(t, lines), "broken").filter("broken IS NULL").drop("broken")


@query("scan_injection_json", """SELECT truth_id % 1000 AS doc, CAST(truth_id AS VARCHAR) AS id, CASE WHEN truth_id % 2 = 0 THEN 'gaussian' ELSE 'sinusoidal' END AS type,
  x AS ra, y AS dec, mag AS magnitude, CASE WHEN truth_id % 2 = 0 THEN 2.5e0 END AS sigma FROM truth""")
def scan_injection_json(t):
    one = t.truth.selectExpr(
        "truth_id % 1000 AS doc", "CAST(truth_id AS STRING) AS id",
        "named_struct('type', CASE WHEN truth_id % 2 = 0 THEN 'gaussian' ELSE 'sinusoidal' END, 'ra', x, 'dec', y, 'parameters', "
        "named_struct('magnitude', mag, 'sigma', CASE WHEN truth_id % 2 = 0 THEN 2.5e0 END)) AS s")
    docs = one.groupBy("doc").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("id", "s")))).alias("value"))
    folder = _files(t, docs.repartition("doc"), "doc")  # a file for each document
    found = readers.read_injections(t.spark, folder)
    return found.select(readers.folder_name(F.col("file")).cast("long").alias("doc"), "id", "type", "ra", "dec", "magnitude", "sigma")


@query("scan_csv_schedule", """SELECT fid + 100 AS program, plan, pass, segment, duration, target = 3 AS unnamed FROM exposure_plan""")
def scan_csv_schedule(t):
    lines = t.exposure_plan.selectExpr(
        "concat(CAST(fid + 100 AS STRING), '_plan.ecsv') AS file",
        "explode(array('# %ECSV 1.0', 'PLAN PASS SEGMENT DURATION TARGET_NAME', concat_ws(' ', plan, pass, segment, duration, "
        "CASE WHEN target = 3 THEN '<no name>' ELSE 'star' END))) AS value")
    plans = readers.read_lines(t.spark, _files(t, lines, "file")).withColumn("file", readers.folder_name(F.col("file")))
    out = readers.parse_exposure_plan(plans, "PLAN PASS SEGMENT DURATION TARGET_NAME".split(),
                                      {"PLAN": "bigint", "PASS": "bigint", "SEGMENT": "bigint", "DURATION": "double", "TARGET_NAME": "string"})
    return out.select("program", F.col("PLAN").alias("plan"), F.col("PASS").alias("pass"), F.col("SEGMENT").alias("segment"),
                      F.col("DURATION").alias("duration"), (F.col("TARGET_NAME") == "<no_name>").alias("unnamed"))


@query("row_checksum", """SELECT filename, CASE WHEN page_id % 5 = 0 THEN 'missing' WHEN page_id % 3 = 0 THEN 'changed' ELSE 'ok' END AS state
  FROM (SELECT page_id, concat('page_', CAST(page_id AS VARCHAR), '.html') AS filename FROM pages)""")
def row_checksum(t):
    """Page files, as delivered, against the checksums that were stored for them."""
    pages = t.pages.selectExpr("page_id", "concat('page_', CAST(page_id AS STRING), '.html') AS filename", "html AS value", "encode(concat(html, '\\n'), 'UTF-8') AS content")
    table = pages.select("filename", F.md5(F.when(F.col("page_id") % 3 == 0, F.lit(b"old")).otherwise(F.col("content"))).alias("checksum"))
    folder = _files(t, pages.filter("page_id % 5 <> 0").select("filename", "value"), "filename")
    found = readers.read_checksums(t.spark, folder, by_folder=True)
    return versions.row_changes(table, found).select("filename", "state")


# --- writers: write, then read back --------------------------------------------------------------


@query("bulk_load_sources", """SELECT sca, isdiffpos, count(*) AS n, min(sid) AS first_sid FROM sources GROUP BY sca, isdiffpos""")
def bulk_load_sources(t):
    path = _folder(t)
    rows = t.sources.selectExpr("sid", "pid", "sid AS id", "isdiffpos AS positive", "fluxfit", "date_format(dateobs, 'yyyy') AS proc_date", "sca")
    positive, negative = rows.filter("positive").drop("positive"), rows.filter("NOT positive").drop("positive")
    writers.bulk_load_sources(positive, negative, path)
    if writers.bulk_load_sources(positive, negative, path):
        raise RuntimeError("a repeated load added rows")
    return (t.spark.read.parquet(path).groupBy("sca", "isdiffpos").agg(F.count("*").alias("n"), F.min("sid").alias("first_sid"))
            .withColumn("sca", F.col("sca").cast("smallint")))


@query("sink_source_catalog", "SELECT sid, pid, ra, dec, fluxfit, mjdobs FROM sources")
def sink_source_catalog(t):
    path = _folder(t)
    writers.write_source_catalog(t.sources, path, ["sid", "pid", "ra", "dec", "fluxfit", "mjdobs"])
    return t.spark.read.parquet(path)


@query("range_chunks", """SELECT chunk, min(sid) AS start_sid, max(sid) AS end_sid, count(*) AS n FROM
  (SELECT sid, (row_number() OVER (ORDER BY sid) - 1) // 1000 + 1 AS chunk FROM sources) GROUP BY chunk""")
def range_chunks(t):
    out = writers.range_chunks(t.sources.select("sid"), "sid", 1000, 5000)
    return out.groupBy("chunk").agg(F.min("sid").alias("start_sid"), F.max("sid").alias("end_sid"), F.count("*").alias("n"))


@query("sink_skypixel_catalog", """
WITH c AS (SELECT hp9, count(*) AS n FROM (SELECT l_partkey * 7919 % 3145728 AS hp9 FROM lineitem) GROUP BY hp9),
""" + ",\n".join(f"o{k} AS (SELECT hp9 >> {2 * (9 - k)} AS px, sum(n) AS n FROM c GROUP BY 1)" for k in range(2, 9)) + """,
a AS (SELECT c.hp9, c.n, CASE """ + " ".join(f"WHEN o{k}.n <= 500 THEN {k}" for k in range(2, 9)) + """ ELSE 9 END AS norder FROM c """
       + " ".join(f"JOIN o{k} ON o{k}.px = c.hp9 >> {2 * (9 - k)}" for k in range(2, 9)) + """)
SELECT norder, hp9 >> (2 * (9 - norder)) AS npix, CAST(sum(n) AS BIGINT) AS n FROM a GROUP BY 1, 2""")
def sink_skypixel_catalog(t):
    path = _folder(t)
    rows = t.lineitem.selectExpr("l_partkey * 7919 % 3145728 AS hp9", "l_orderkey")
    writers.write_skypixel_catalog(rows, path, max_rows=500)
    return t.spark.read.parquet(path).groupBy("norder", F.col("npix").cast("long").alias("npix")).agg(F.count("*").alias("n"))


@query("skypixel_margin_join", f"""SELECT a.rid, b.rid AS other_rid FROM l2filemeta a JOIN l2filemeta b
  ON {within(0.3, 'a.ra0', 'a.dec0', 'b.ra0', 'b.dec0')} WHERE a.rid <> b.rid""")
def skypixel_margin_join(t):
    """Image centres as a sky-pixel catalogue with margins of 0.3 degrees: every pixel is matched alone, its rows with its rows and its margin."""
    from ..operators import spatial

    path = _folder(t)
    rows = t.l2filemeta.select("rid", "ra0", "dec0", healpix_nested("ra0", "dec0", 5).alias("hp5"))
    shape = dict(pixel="hp5", max_rows=200, lowest=2, highest=5)
    writers.write_skypixel_catalog(rows, f"{path}/rows", **shape)
    writers.write_skypixel_margin(rows, f"{path}/margin", 0.3, pos=("ra0", "dec0"), **shape)
    own, margin = (t.spark.read.parquet(f"{path}/{x}").select("rid", "ra0", "dec0", "norder", "npix") for x in ("rows", "margin"))
    there = own.unionByName(margin).toDF("other_rid", "o_ra", "o_dec", "o_norder", "o_npix")
    pairs = spatial.sky_join_all_pairs(own, there, 0.3, ("ra0", "dec0"), ("o_ra", "o_dec"), on=[("norder", "o_norder"), ("npix", "o_npix")], distance=None,
                                       keep=F.col("rid") != F.col("other_rid"))
    return pairs.select("rid", "other_rid")


@query("sink_alerts", f"""WITH {LATEST} SELECT trigger_sid AS "diaSourceId", aid FROM l""")
def sink_alerts(t):
    path = _folder(t)
    writers.write_alerts(_alerts(t), path)
    return t.spark.read.parquet(path).select("diaSourceId", F.col("diaObject.diaObjectId").alias("aid"))


@query("sink_lightcurve_text", """SELECT reqid, count(*) AS n, min(expid) AS first_expid FROM (SELECT partkey AS reqid, expid FROM sources) GROUP BY reqid""")
def sink_lightcurve_text(t):
    path = _folder(t)
    rows = t.sources.selectExpr("partkey AS reqid", "partkey AS field", "mjdobs + 2400000.5 AS jd", "expid", "pid", "sca", "fid",
                                "fluxfit AS psfflux", "1 AS sindex")
    writers.write_lightcurve_text(rows, path)
    token = F.split("value", " ")
    return (t.spark.read.text(path).select(token[0].cast("long").alias("reqid"), token[3].cast("int").alias("expid"))
            .groupBy("reqid").agg(F.count("*").alias("n"), F.min("expid").alias("first_expid")))


# --- streams -------------------------------------------------------------------------------------


class StreamCatalog(Catalog):
    """The same fixtures with lineitem arriving as a stream."""

    def __getattr__(self, name):
        if name == "lineitem":
            schema = self.spark.read.parquet(f"{self.sf_dir}/lineitem.parquet").schema
            return self.spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(self.sf_dir)
        return super().__getattr__(name)


@query("nightly_window_counts", "SELECT dateobs AS day, sca, count(*) AS n FROM (SELECT date_trunc('day', dateobs) AS dateobs, sca FROM sources) GROUP BY dateobs, sca")
def nightly_window_counts(t):
    folder = _folder(t)
    counted = streaming.nightly_window_counts(StreamCatalog(t.spark, t.sf_dir).sources)
    (counted.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{folder}/counts"))
     .option("checkpointLocation", f"{folder}/_stream").trigger(availableNow=True).start().awaitTermination())
    return t.spark.read.parquet(f"{folder}/counts").withColumn("day", F.col("day").cast("timestamp_ntz"))


def date_slices(rows, n):
    """``rows`` in up to ``n`` slices of about equal size in the order of mjdobs; equal dates stay together."""
    borders = sorted(set(rows.approxQuantile("mjdobs", [i / n for i in range(1, n)], 0.01)))
    number = sum([F.when(F.col("mjdobs") >= x, 1).otherwise(0) for x in borders], F.lit(0))
    return [rows.filter(number == i) for i in range(len(borders) + 1)]


@query("streaming_association", """
WITH c AS (SELECT field, partkey, sid, mjdobs * 100 + sca AS batch FROM sources WHERE flags = 0),
f AS (SELECT *, min(batch) OVER (PARTITION BY field, partkey) = batch AS is_first FROM c)
SELECT s.field, s.sid AS aid, m.sid FROM f s JOIN f m ON s.field = m.field AND s.partkey = m.partkey
WHERE s.is_first AND (s.sid = m.sid OR NOT m.is_first)""")
def streaming_association(t):
    """Sources arrive in the order of their dates, in four micro-batches that hold about a quarter of the rows each."""
    folder = _folder(t)
    rows = t.sources
    for i, part in enumerate(date_slices(rows, 4)):
        part.write.parquet(f"{folder}/in/part={i}")
        files = t.spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        streaming.streaming_association(files, folder, 3e-5).awaitTermination()  # takes the files that came since the last run
    return t.spark.read.parquet(f"{folder}/merges").select("field", "aid", "sid")


@query("streaming_association_state", walked(R))
def streaming_association_state(t):
    """The same arrival in four micro-batches, with the objects in Spark's keyed state; each run starts again from it."""
    folder = _folder(t)
    rows = t.sources
    for i, part in enumerate(date_slices(rows, 4)):
        part.write.parquet(f"{folder}/in/part={i}")
        files = t.spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        state.associate_with_state(files, folder, R).awaitTermination()
    return t.spark.read.parquet(f"{folder}/merges").select("field", "aid", "sid")


@query("alert_stream_out", "SELECT sid AS \"diaSourceId\", partkey AS aid FROM sources")
def alert_stream_out(t):
    folder = _folder(t)
    arriving = StreamCatalog(t.spark, t.sf_dir).sources.select("sid")
    o = t.objects.withColumnRenamed("p_size", "nsources")
    streaming.alert_stream_out(arriving, folder, t.merges, o, t.sources, t.filters).awaitTermination()
    return t.spark.read.parquet(f"{folder}/alerts").select("diaSourceId", F.col("diaObject.diaObjectId").alias("aid"))


@query("alert_stream_in", f"""WITH {LATEST} SELECT trigger_sid AS "diaSourceId", aid FROM l""")
def alert_stream_in(t):
    folder = _folder(t)
    writers.write_alerts(_alerts(t), f"{folder}/in")
    schema = t.spark.read.parquet(f"{folder}/in").schema
    arriving = streaming.alert_stream_in(t.spark, f"{folder}/in", schema)
    (arriving.select("diaSourceId", F.col("diaObject.diaObjectId").alias("aid")).writeStream.format("parquet")
     .option("checkpointLocation", f"{folder}/_in").option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination())
    return t.spark.read.parquet(f"{folder}/out")


@query("alert_packets_avro", HISTORY)
def alert_packets_avro(t):
    """All alerts as Avro packets, written in two parts and streamed back; every nested record of the history."""
    folder = _folder(t)
    alerts = _alerts(t)
    for part in (alerts.filter("diaSourceId % 2 = 0"), alerts.filter("diaSourceId % 2 <> 0")):
        writers.write_alerts(part, f"{folder}/in", packets="avro")
        arriving = streaming.alert_stream_in(t.spark, f"{folder}/in", alerts.schema, packets="avro")
        (arriving.writeStream.format("parquet").option("checkpointLocation", f"{folder}/_in").option("path", f"{folder}/out")
         .trigger(availableNow=True).start().awaitTermination())
    rows = t.spark.read.schema(alerts.schema).parquet(f"{folder}/out").select(F.col("diaSourceId").alias("trigger_sid"), F.posexplode("prvDiaSources").alias("pos", "r"))
    return rows.select("trigger_sid", "pos", *[f"r.{c}" for c in ("diaSourceId", "visit", "diaObjectId", "midpointMjdTai", "band", "psfFlux", "field", "pid")])


@query("alert_packets_whole", f"""WITH {LATEST},
d AS (SELECT l.trigger_sid, l.trigger_mjd, s.sid, s.mjdobs, s.fluxfit FROM l JOIN merges m ON l.aid = m.aid JOIN sources s ON m.sid = s.sid JOIN filters f ON s.fid = f.fid
   WHERE s.mjdobs >= trigger_mjd - 365.25 AND s.sid <> trigger_sid),
h AS (SELECT trigger_sid, count(*) AS n, min(mjdobs) AS first, max(mjdobs) AS last, sum(fluxfit) AS flux FROM d GROUP BY trigger_sid)
SELECT l.trigger_sid AS "diaSourceId", l.aid, s.expid AS visit, s.mjdobs AS "midpointMjdTai", f.filter AS band, s.fluxfit AS "psfFlux", s.ra, s.dec,
  coalesce(h.n, 0) AS n_prev, round(coalesce(h.flux, 0), 3) AS prev_flux, least(s.mjdobs, coalesce(h.first, s.mjdobs)) AS first_mjd, greatest(s.mjdobs, coalesce(h.last, s.mjdobs)) AS last_mjd
FROM l JOIN sources s ON s.sid = l.trigger_sid JOIN filters f ON s.fid = f.fid LEFT JOIN h ON h.trigger_sid = l.trigger_sid""")
def alert_packets_whole(t):
    """The other parts of all packets, through the bytes that a message broker carries."""
    from ..sources import avro

    alerts = _alerts(t)
    back = avro.decode_rows(avro.encode_rows(alerts, "diaSourceId"), alerts.schema)
    total = F.round(F.aggregate(F.coalesce("prvDiaSources", F.array().cast(alerts.schema["prvDiaSources"].dataType)), F.lit(0.0), lambda a, s: a + s["psfFlux"]), 3)
    return back.select("diaSourceId", F.col("diaObject.diaObjectId").alias("aid"), *[f"diaSource.{c}" for c in ("visit", "midpointMjdTai", "band", "psfFlux", "ra", "dec")],
                       F.greatest(F.coalesce(F.size("prvDiaSources"), F.lit(0)), F.lit(0)).cast("long").alias("n_prev"), total.alias("prev_flux"),
                       F.col("diaObject.firstDiaSourceMjdTai").alias("first_mjd"), F.col("diaObject.lastDiaSourceMjdTai").alias("last_mjd"))
