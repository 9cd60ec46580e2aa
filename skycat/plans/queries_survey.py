"""Registered queries: schedules, pixel tables and detection quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation, pixels, schedule, spatial
from .queries_sky import rounded
from .registry import query

# --- schedules ---------------------------------------------------------------------------------

JOINED = """j AS (SELECT s.segment_id, s.start_s, s.end_s, e.exposure_no, e.duration, e.exposure_time, e.fid, e.target, e.mjdobs
  FROM segments s JOIN exposure_plan e ON s.segment = e.segment AND s.pass = e.pass AND s.program = e.program AND s.plan = e.plan)"""
STARTS = JOINED + """, w AS (SELECT *, start_s + sum(duration) OVER (PARTITION BY segment_id ORDER BY exposure_no) - duration AS exposure_start FROM j)"""


def _joined(t):
    return schedule.schedule_join(t.segments, t.exposure_plan).filter("matched = 'both'")


def _starts(t):
    return schedule.exposure_start_times(_joined(t), ["exposure_no"], F.floor(F.col("exposure_no") / 1e11))


@query("schedule_join", """SELECT CASE WHEN s.segment_id IS NULL THEN 'right_only' WHEN e.exposure_no IS NULL THEN 'left_only' ELSE 'both' END AS matched,
  count(*) AS n_rows FROM (SELECT * FROM segments WHERE state <> 'P') s FULL JOIN (SELECT * FROM exposure_plan WHERE target <> 1) e
  ON s.segment = e.segment AND s.pass = e.pass AND s.program = e.program AND s.plan = e.plan GROUP BY 1""")
def schedule_join(t):
    joined = schedule.schedule_join(t.segments.filter("state <> 'P'"), t.exposure_plan.filter("target <> 1"))
    return schedule.schedule_join_counts(joined)


@query("exposure_start_times", f"WITH {STARTS} SELECT segment_id, exposure_no, exposure_start FROM w")
def exposure_start_times(t):
    return _starts(t).select("segment_id", "exposure_no", "exposure_start")


@query("drop_overruns", f"""WITH {STARTS}, l AS (SELECT segment_id, max(exposure_no) FILTER (exposure_start + exposure_time <= end_s) AS last_no FROM w GROUP BY segment_id)
SELECT w.segment_id, exposure_no, exposure_start FROM w JOIN l ON w.segment_id = l.segment_id WHERE exposure_no <= last_no""")
def drop_overruns(t):
    return schedule.fitted_schedule(_joined(t), ["exposure_no"]).filter("kept").select("segment_id", "exposure_no", "exposure_start")


@query("overrun_statistics", f"""WITH {STARTS}, l AS (SELECT segment_id, max(exposure_no) FILTER (exposure_start + exposure_time <= end_s) AS last_no FROM w GROUP BY segment_id),
d AS (SELECT w.segment_id, count(*) FILTER (last_no IS NULL OR exposure_no > last_no) AS dropped FROM w JOIN l ON w.segment_id = l.segment_id GROUP BY w.segment_id)
SELECT count(*) AS n_segments, round(avg(dropped), 6) AS mean_n, round(stddev_pop(dropped), 6) AS std_n, median(dropped) AS median_n,
  min(dropped) AS min_n, max(dropped) AS max_n FROM d WHERE dropped > 0""")
def overrun_statistics(t):
    return rounded(schedule.fitted_statistics(schedule.fitted_schedule(_joined(t), ["exposure_no"])), 6, "mean_n", "std_n")


@query("exceedance_flags", f"""WITH {STARTS} SELECT segment_id, exposure_no, round(exposure_start + duration - end_s, 5) AS delta_s,
  exposure_start + duration - end_s >= 0 AS exceeds FROM w""")
def exceedance_flags(t):
    return rounded(schedule.exceedance_flags(_starts(t)).select("segment_id", "exposure_no", "delta_s", "exceeds"), 5, "delta_s")


@query("exposures_per_position", "SELECT ra0 AS ra, dec0 AS dec, count(*) AS n_exposures FROM l2filemeta GROUP BY ra0, dec0")
def exposures_per_position(t):
    return schedule.exposures_per_position(t.l2filemeta.select(F.col("ra0").alias("ra"), F.col("dec0").alias("dec")))


@query("schedule_time_histogram", f"""WITH {JOINED}, m AS (SELECT target, mjdobs + duration / 7e0 AS mid, duration FROM j),
l AS (SELECT target, min(mid) AS lo, max(mid) AS hi FROM m GROUP BY target)
SELECT m.target, least(CAST(floor((mid - lo) * 1200 / (hi - lo)) AS BIGINT), 1199) AS bin, round(sum(duration), 6) AS total, count(*) AS n
FROM m JOIN l ON m.target = l.target GROUP BY 1, 2""")
def schedule_time_histogram(t):
    rows = _joined(t).withColumn("mid", F.col("mjdobs") + F.col("duration") / 7.0)
    return rounded(schedule.schedule_time_histogram(rows, "target", "mid", "duration"), 6, "total")


# --- pixel tables --------------------------------------------------------------------------------

VALID = "v AS (SELECT *, CASE WHEN isnan(value) THEN NULL ELSE value END AS v FROM {0})"
FACTOR = 1.014234135772351  # root of 1 / (1 - 2 a phi(a) / (2 Phi(a) - 1)), a = 3 * 0.9944579 (the 84th percentile of a normal distribution)


@query("pixel_clipped_stats", f"""WITH {VALID.format('pixels')},
p AS (SELECT image_id, median(v) AS gmed, 0.5 * (quantile_cont(v, 0.84) - quantile_cont(v, 0.16)) AS gsigma FROM v GROUP BY image_id)
SELECT v.image_id, round(any_value(gmed), 6) AS gmed, round(any_value(gsigma), 6) AS gsigma, min(v) AS gdatamin, max(v) AS gdatamax,
  count(*) FILTER (v >= 100) AS satcount, count(*) - count(v) AS nancount, count(*) AS pixcount,
  round(avg(v) FILTER (abs(v - gmed) <= 3 * gsigma), 9) AS clippedavg,
  round(stddev_pop(v) FILTER (abs(v - gmed) <= 3 * gsigma) * {FACTOR!r}, 6) AS clippedstd,
  count(*) FILTER (abs(v - gmed) <= 3 * gsigma) AS nkept, count(v) - count(*) FILTER (abs(v - gmed) <= 3 * gsigma) AS noutliers
FROM v JOIN p ON v.image_id = p.image_id GROUP BY v.image_id""")
def pixel_clipped_stats(t):
    out = pixels.pixel_clipped_stats(t.pixels, 3.0, 100.0)
    return rounded(rounded(out, 6, "gmed", "gsigma", "clippedstd"), 9, "clippedavg")


@query("background_clipped_mean", f"""WITH {VALID.format('frame')}, s AS (SELECT max(y) + 1 AS ny, max(x) + 1 AS nx FROM v),
g AS (SELECT gy, gx FROM (SELECT unnest(range(0, (SELECT ny FROM s), 8)) AS gy), (SELECT unnest(range(0, (SELECT nx FROM s), 8)) AS gx)),
o AS (SELECT unnest(range(-5, 6)) AS d),
w AS (SELECT gy, gx, CASE WHEN gy + a.d < 0 THEN -(gy + a.d) WHEN gy + a.d >= ny THEN 2 * ny - 2 - gy - a.d ELSE gy + a.d END AS y,
   CASE WHEN gx + b.d < 0 THEN -(gx + b.d) WHEN gx + b.d >= nx THEN 2 * nx - 2 - gx - b.d ELSE gx + b.d END AS x FROM g, o a, o b, s),
r AS (SELECT gy, gx, v FROM w JOIN v ON w.y = v.y AND w.x = v.x),
p AS (SELECT gy, gx, count(*) - count(v) AS n_bad, median(v) AS m, 0.5 * (quantile_cont(v, 0.841) - quantile_cont(v, 0.159)) AS s FROM r GROUP BY gy, gx),
k AS (SELECT r.gy, r.gx, avg(v) AS background, stddev_samp(v) / sqrt(count(*)) AS unc, count(*) AS n FROM r JOIN p ON r.gy = p.gy AND r.gx = p.gx WHERE abs(v - m) < 3 * s GROUP BY r.gy, r.gx),
c AS (SELECT gy, gx, count(v) AS nv FROM r GROUP BY gy, gx)
SELECT CAST(0 AS BIGINT) AS image_id, p.gy AS y, p.gx AS x, n_bad, CASE WHEN n_bad <= 36 THEN round(background, 9) END AS background,
  CASE WHEN n_bad <= 36 THEN round(unc, 7) END AS background_unc, CASE WHEN n_bad <= 36 THEN round(s, 6) END AS scale,
  CASE WHEN n_bad <= 36 THEN n END AS n_used, CASE WHEN n_bad <= 36 THEN nv - n END AS n_rejected
FROM p JOIN k ON p.gy = k.gy AND p.gx = k.gx JOIN c ON p.gy = c.gy AND p.gx = c.gx""")
def background_clipped_mean(t):
    out = pixels.background_clipped_mean(t.frame, 5, 8, 3.0, 30.0)
    return rounded(rounded(rounded(out, 9, "background"), 7, "background_unc"), 6, "scale")


@query("background_global", f"""WITH {VALID.format('pixels')},
p AS (SELECT image_id, median(v) AS m, 0.5 * (quantile_cont(v, 0.841) - quantile_cont(v, 0.159)) AS s FROM v GROUP BY image_id)
SELECT v.image_id, round(avg(v) FILTER (abs(v - m) < 2 * s), 9) AS background,
  round(stddev_samp(v) FILTER (abs(v - m) < 2 * s) / sqrt(count(*) FILTER (abs(v - m) < 2 * s)), 7) AS background_unc, round(any_value(s), 6) AS scale,
  count(*) FILTER (abs(v - m) < 2 * s) AS n_used, count(v) - count(*) FILTER (abs(v - m) < 2 * s) AS n_rejected, count(*) - count(v) AS n_bad
FROM v JOIN p ON v.image_id = p.image_id GROUP BY v.image_id""")
def background_global(t):
    return rounded(rounded(rounded(pixels.background_global(t.pixels, 2.0), 9, "background"), 7, "background_unc"), 6, "scale")


@query("local_clipped_average", f"""WITH {VALID.format('frame')},
r AS (SELECT c.y, c.x, n.v FROM v c, (SELECT unnest([-1, 0, 1]) AS dy) a, (SELECT unnest([-1, 0, 1]) AS dx) b, v n
   WHERE c.v IS NOT NULL AND n.y = c.y + dy AND n.x = c.x + dx AND n.v IS NOT NULL),
p AS (SELECT y, x, median(v) AS m, 0.5 * (quantile_cont(v, 0.84) - quantile_cont(v, 0.16)) AS s FROM r GROUP BY y, x)
SELECT CAST(0 AS BIGINT) AS image_id, r.y, r.x, round(avg(v), 7) AS value FROM r JOIN p ON r.y = p.y AND r.x = p.x WHERE abs(v - m) <= 3 * s GROUP BY r.y, r.x""")
def local_clipped_average(t):
    return rounded(pixels.local_clipped_average(t.frame), 7, "value")


@query("image_moments", f"""WITH {VALID.format('pixels')},
m AS (SELECT image_id, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS sigma FROM v GROUP BY image_id)
SELECT v.image_id, any_value(n) AS n, round(any_value(mean), 9) AS mean, round(any_value(sigma), 7) AS sigma,
  round(sum(pow(v - mean, 3)) / (any_value(n) * pow(any_value(sigma), 3)), 7) AS skew,
  round(sum(pow(v - mean, 4)) / (any_value(n) * pow(any_value(sigma), 4)) - 3, 7) AS kurtosis
FROM v JOIN m ON v.image_id = m.image_id GROUP BY v.image_id""")
def image_moments(t):
    return rounded(rounded(pixels.image_moments(t.pixels), 9, "mean"), 7, "sigma", "skew", "kurtosis")


@query("coverage_depth_percent", "SELECT image_id, round(100 * sum(least(value, 2.5e0)) / (2.5e0 * count(*)), 9) AS cov5percent FROM cov_frame GROUP BY image_id")
def coverage_depth_percent(t):
    return rounded(pixels.coverage_depth_percent(t.cov_frame, 2.5), 9, "cov5percent")


NAN = "CAST('NaN' AS DOUBLE)"


@query("mask_by_coverage", f"""SELECT p.image_id, p.y, p.x, CASE WHEN c.value >= 0.5 THEN p.value ELSE {NAN} END AS value
  FROM frame p JOIN cov_frame c USING (image_id, y, x)""")
def mask_by_coverage(t):
    return pixels.mask_by_coverage(t.frame, t.cov_frame, 0.5)


@query("naive_difference", "SELECT p.image_id, p.y, p.x, round(p.value - r.value, 9) AS value FROM frame p JOIN ref_frame r USING (image_id, y, x)")
def naive_difference(t):
    return rounded(pixels.naive_difference(t.frame, t.ref_frame), 9, "value")


@query("pixel_uncertainty", f"""SELECT p.image_id, p.y, p.x, round(CASE WHEN isnan(p.value) THEN 2e0 ELSE
  sqrt(abs(p.value) / 1.8 + abs(r.value) / (1.8 * CASE WHEN c.value >= 0.5 THEN c.value ELSE 1 END) + 4) END, 9) AS value
  FROM frame p JOIN ref_frame r USING (image_id, y, x) JOIN cov_frame c USING (image_id, y, x)""")
def pixel_uncertainty(t):
    sigma = t.frame.select("image_id").distinct().withColumn("sigma", F.lit(2.0))
    return rounded(pixels.pixel_uncertainty(t.frame, t.ref_frame, t.cov_frame, sigma, 1.8, 0.5), 9, "value")


@query("simple_uncertainty", "SELECT image_id, y, x, round(sqrt(abs(value) * 57.04 / 1.8 + 25) / 57.04, 9) AS value FROM frame WHERE NOT isnan(value)")
def simple_uncertainty(t):
    return rounded(pixels.simple_uncertainty(t.frame.filter("NOT isnan(value)"), 1.8, 57.04, 5.0), 9, "value")


STACK = """ordered AS (SELECT *, CASE WHEN isnan(value) THEN NULL ELSE value END AS v FROM stack_pixels)"""


def _coadd_sql(expr, scale="count(v)"):
    return f"""WITH {STACK} SELECT y, x, coalesce({expr}, {NAN}) AS value, CASE WHEN count(v) > 0 THEN round(sqrt(sum(unc * unc) FILTER (v IS NOT NULL)) / {scale}, 9)
      ELSE {NAN} END AS unc, count(v) AS coverage FROM ordered GROUP BY y, x"""


def _coadd(t, how, digits=None):
    out = rounded(pixels.coadd_pixels(t.stack_pixels, how, "event_id"), 9, "unc")
    return rounded(out, digits, "value") if digits else out


@query("coadd_pixels", _coadd_sql("round(avg(v), 8)"))
def coadd_pixels(t):
    return _coadd(t, "mean", 8)


@query("coadd_pixels_sum", _coadd_sql("round(sum(v), 8)", "1"))
def coadd_pixels_sum(t):
    return _coadd(t, "sum", 8)


@query("coadd_pixels_median", _coadd_sql("round(median(v), 8)"))
def coadd_pixels_median(t):
    return _coadd(t, "median", 8)


@query("coadd_pixels_min", _coadd_sql("min(v)"))
def coadd_pixels_min(t):
    return _coadd(t, "min")


@query("coadd_pixels_max", _coadd_sql("max(v)"))
def coadd_pixels_max(t):
    return _coadd(t, "max")


@query("coadd_pixels_first", _coadd_sql("arg_min(v, event_id)"))
def coadd_pixels_first(t):
    return _coadd(t, "first")


@query("coadd_pixels_last", _coadd_sql("arg_max(v, event_id)"))
def coadd_pixels_last(t):
    return _coadd(t, "last")


@query("normalize_pixels", f"""WITH {VALID.format('frame')}, s AS (SELECT image_id, sum(v) AS total FROM v GROUP BY image_id)
SELECT v.image_id, y, x, round(value / total, 12) AS value FROM v JOIN s ON v.image_id = s.image_id WHERE NOT isnan(value)""")
def normalize_pixels(t):
    return rounded(pixels.normalize_pixels(t.frame).filter("NOT isnan(value)"), 12, "value")


@query("fill_nan_pixels", "SELECT image_id, y, x, CASE WHEN isnan(value) THEN -1e0 ELSE value END AS value, isnan(value) AS was_nan FROM frame")
def fill_nan_pixels(t):
    return pixels.fill_nan_pixels(t.frame, -1.0)


@query("restore_nan_pixels", "SELECT image_id, y, x, value FROM frame")
def restore_nan_pixels(t):
    return pixels.restore_nan_pixels(pixels.fill_nan_pixels(t.frame, 0.0))


@query("transpose_pixels", "SELECT image_id, x AS y, y AS x, value FROM frame")
def transpose_pixels(t):
    return pixels.transpose_pixels(t.frame)


@query("scale_pixels", "SELECT image_id, y, x, value * 2.5e0 AS value FROM frame")
def scale_pixels(t):
    return pixels.scale_pixels(t.frame, 2.5)


def _candidates(t):
    return t.events.selectExpr("CAST(0 AS BIGINT) AS image_id", "event_id AS cand_id", "CAST(floor(event_id / 64) AS BIGINT) AS y", "event_id % 64 AS x", "event_type").filter("event_type = 'purchase'")


DIFF = "d AS (SELECT p.y, p.x, CASE WHEN isnan(p.value) THEN NULL ELSE p.value - r.value END AS v FROM frame p JOIN ref_frame r USING (image_id, y, x))"


@query("stamp_metrics", f"""WITH {DIFF}, c AS (SELECT event_id AS cand_id, CAST(floor(event_id / 64) AS BIGINT) AS cy, event_id % 64 AS cx FROM events WHERE event_type = 'purchase'),
o AS (SELECT unnest(range(-2, 3)) AS k),
s AS (SELECT cand_id, a.k AS dy, b.k AS dx, v FROM c, o a, o b, d WHERE d.y = cy + a.k AND d.x = cx + b.k),
f AS (SELECT p.cand_id, p.dy, p.dx, median(q.v) AS m FROM s p JOIN s q ON p.cand_id = q.cand_id AND abs(p.dy - q.dy) <= 1 AND abs(p.dx - q.dx) <= 1 GROUP BY 1, 2, 3),
z AS (SELECT cand_id, count(*) FILTER (v < 0) AS n_negative, count(*) - count(v) AS n_bad FROM s GROUP BY cand_id),
u AS (SELECT cand_id, sum(m) AS a, sum(abs(m)) AS b FROM f GROUP BY cand_id)
SELECT CAST(0 AS BIGINT) AS image_id, z.cand_id, n_negative, n_bad, CASE WHEN b > 0 THEN round(a / b, 8) END AS sumrat FROM z JOIN u ON z.cand_id = u.cand_id""")
def stamp_metrics(t):
    diff = pixels.naive_difference(t.frame, t.ref_frame)
    return rounded(pixels.stamp_metrics(_candidates(t), diff), 8, "sumrat")


@query("forced_flux_weights", f"""WITH {VALID.format('frame')}, o AS (SELECT unnest(range(-1, 2)) AS k),
c AS (SELECT event_id AS req_id, CAST(floor(event_id / 64) AS BIGINT) AS cy, event_id % 64 AS cx FROM events WHERE event_type = 'purchase')
SELECT CAST(0 AS BIGINT) AS image_id, req_id, round(sum(v / (1 + a.k * a.k + b.k * b.k)), 8) AS flux, count(v) AS n_pixels
FROM c, o a, o b, v WHERE v.y = cy + a.k AND v.x = cx + b.k GROUP BY req_id""")
def forced_flux_weights(t):
    weights = t.spark.range(9).selectExpr("CAST(floor(id / 3) - 1 AS BIGINT) AS dy", "id % 3 - 1 AS dx").withColumn(
        "weight", 1.0 / (1 + F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")))
    out = pixels.forced_flux_weights(_candidates(t).withColumnRenamed("cand_id", "req_id"), t.frame, weights)
    return rounded(out, 8, "flux")


# --- detection quality ------------------------------------------------------------------------------

MATCHES = """d AS (SELECT r.image_id, r.ref_id, r.flux AS flux_ref, s.sci_id, s.flux AS flux_sci, r.x - s.x AS dx, r.y - s.y AS dy,
   pow(r.x - s.x, 2) + pow(r.y - s.y, 2) AS d2 FROM ref_catalog r JOIN sci_catalog s ON r.image_id = s.image_id
   WHERE abs(r.x - s.x) <= 60 AND abs(r.y - s.y) <= 60),
m AS (SELECT *, row_number() OVER (PARTITION BY image_id, ref_id ORDER BY round(d2, 6), sci_id) AS n FROM d WHERE d2 <= 3600)"""


@query("gain_match_scale", f"""WITH {MATCHES}, g AS (SELECT image_id, count(*) AS k, median(flux_ref / flux_sci) AS ratio, sqrt(avg(dx * dx)) AS rx, sqrt(avg(dy * dy)) AS ry,
  median(dx) AS mx, median(dy) AS my FROM m WHERE n = 1 GROUP BY image_id)
SELECT i.image_id, coalesce(k, 0) AS n_matches, round(CASE WHEN k >= 20 THEN ratio ELSE pow(10e0, 0.4 * (25.5 - 25)) END, 8) AS scale,
  round(CASE WHEN k >= 20 THEN rx ELSE 0.1 END, 7) AS dx_rms, round(CASE WHEN k >= 20 THEN ry ELSE 0.1 END, 7) AS dy_rms,
  round(CASE WHEN k >= 20 THEN mx ELSE 0 END, 6) AS dx_median, round(CASE WHEN k >= 20 THEN my ELSE 0 END, 6) AS dy_median
FROM (SELECT DISTINCT image_id FROM ref_catalog) i LEFT JOIN g ON i.image_id = g.image_id""")
def gain_match_scale(t):
    ref = t.ref_catalog.select("image_id", "ref_id", "x", "y")
    m = spatial.catalog_match_nearest_pixel(ref, t.sci_catalog, 60.0).withColumnRenamed("flux", "flux_sci")
    m = m.join(t.ref_catalog.select("image_id", "ref_id", F.col("flux").alias("flux_ref")), ["image_id", "ref_id"])
    defaults = t.ref_catalog.select("image_id").distinct().select("image_id", F.lit(25.5).alias("zp_ref"), F.lit(25.0).alias("zp_sci"), F.lit(0.1).alias("default_rms"))
    out = evaluation.gain_match_scale(m, defaults)
    return rounded(rounded(rounded(out, 8, "scale"), 7, "dx_rms", "dy_rms"), 6, "dx_median", "dy_median")


@query("forced_flux_calibration", """WITH l AS (SELECT suppkey % 40 AS reqid, CASE WHEN id = 1 THEN NULL ELSE fluxfit END AS tf, CASE WHEN id = 2 THEN 0 ELSE fluxfit * 0.9 - fluxerr END AS pf, peak AS af FROM sources)
SELECT reqid, count(tf) AS n_true, round(median(tf / pf) FILTER (tf IS NOT NULL AND pf <> 0 AND af <> 0), 9) AS psf_ratio,
  round(median(tf / af) FILTER (tf IS NOT NULL AND pf <> 0 AND af <> 0), 7) AS aper_ratio FROM l GROUP BY reqid""")
def forced_flux_calibration(t):
    lc = t.sources.selectExpr("suppkey % 40 AS reqid", "CASE WHEN id = 1 THEN NULL ELSE fluxfit END AS true_flux",
                              "CASE WHEN id = 2 THEN 0 ELSE fluxfit * 0.9 - fluxerr END AS psf_flux", "peak AS aper_flux")
    return rounded(rounded(evaluation.forced_flux_calibration(lc), 9, "psf_ratio"), 7, "aper_ratio")


@query("catalog_fwhm_summary", """SELECT image_id, min(fwhm) AS fwhm_min, max(fwhm) AS fwhm_max, round(median(fwhm), 9) AS fwhm_median,
  round(CASE WHEN median(fwhm) < 0 THEN 2 ELSE median(fwhm) END, 9) AS fwhm_used FROM ref_catalog GROUP BY image_id""")
def catalog_fwhm_summary(t):
    return rounded(evaluation.catalog_fwhm_summary(t.ref_catalog), 9, "fwhm_median", "fwhm_used")


CUTS = """c AS (SELECT *, fluxfit / (fluxerr * 700) AS snr, -2.5 * log10(peak) + 25 AS magap, -2.5 * log10(peak * (1 + (sharpness - 0.05) * 4)) + 25 AS magpsf FROM sources),
s AS (SELECT *, CASE WHEN NOT (least(xfit, yfit, 4087 - xfit, 4087 - yfit) > 5 AND snr >= 5 AND elong <= 2 AND apfluxratio BETWEEN 0.35 AND 1.2) THEN 0
  WHEN NOT (redchi > 0 AND redchi < 10 AND abs(magap - magpsf) < 0.15) THEN 1 ELSE 2 END AS stage, partkey % 3 = 0 AS matched FROM c)"""


@query("candidate_quality_cuts", f"WITH {CUTS} SELECT fid, " + ", ".join(
    f"count(*) FILTER ({'' if n == 'matched' else 'NOT '}matched AND stage >= {k}) AS {n}{k}" for n in ("matched", "unmatched") for k in range(3)) + ", " + ", ".join(
    f"round(100 * count(*) FILTER ({c}matched AND stage >= {k}) / CAST(nullif(count(*) FILTER ({c}matched), 0) AS DOUBLE), 7) AS {n}{k}_pct"
    for n, c in (("matched", ""), ("unmatched", "NOT ")) for k in (1, 2)) + " FROM s GROUP BY fid")
def candidate_quality_cuts(t):
    c = t.sources.selectExpr("fid", "xfit AS x", "yfit AS y", "fluxfit / (fluxerr * 700) AS snr", "elong", "apfluxratio", "redchi", "partkey % 3 = 0 AS matched",
                             "-2.5 * log10(peak) + 25 AS magap", "-2.5 * log10(peak * (1 + (sharpness - 0.05) * 4)) + 25 AS magpsf")
    staged = evaluation.candidate_quality_cuts(c, 4088, 4088, max_mag_diff=0.15)
    out = evaluation.stage_counts(staged, "fid", "matched")
    return rounded(out, 7, *[f"{n}{k}_pct" for n in ("matched", "unmatched") for k in (1, 2)])


@query("catalog_case_summary", f"""WITH c AS (SELECT fid AS filter, suppkey % 4 AS "case", partkey, count(*) * 1e0 AS a,
    CASE WHEN partkey % 7 = 0 THEN {NAN} ELSE count(*) FILTER (flags = 0) * 1e0 END AS b FROM sources GROUP BY 1, 2, 3),
v AS (SELECT *, CASE WHEN isnan(b) THEN NULL ELSE b END AS bb FROM c)
SELECT filter, "case", count(a) AS sample_size, round(avg(a), 8) AS n_sources_mean, round(stddev_pop(a), 8) AS n_sources_std,
  round(1.96 * stddev_pop(a) / sqrt(count(a)), 8) AS n_sources_margin, round(avg(bb), 8) AS n_matches_mean, round(stddev_pop(bb), 8) AS n_matches_std,
  round(1.96 * stddev_pop(bb) / sqrt(count(bb)), 8) AS n_matches_margin FROM v GROUP BY filter, "case\"""")
def catalog_case_summary(t):
    per = t.sources.groupBy(F.col("fid").alias("filter"), (F.col("suppkey") % 4).alias("case"), "partkey").agg(
        F.count("*").cast("double").alias("n_sources"), F.count_if(F.col("flags") == 0).cast("double").alias("m"))
    per = per.withColumn("n_matches", F.when(F.col("partkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("m")))
    out = evaluation.catalog_case_summary(per)
    return rounded(out, 8, *[c for c in out.columns if c.startswith("n_")])


@query("detection_confusion", """WITH a AS (SELECT truth_id, mag < 25 AS a, truth_id % 3 <> 0 AS b FROM truth)
SELECT count(*) FILTER (a) AS first_true, count(*) FILTER (NOT a) AS first_false, count(*) FILTER (b) AS second_true,
  count(*) FILTER (NOT b) AS second_false, count(*) FILTER (a AND NOT b) AS only_first, count(*) FILTER (NOT a AND b) AS only_second FROM a""")
def detection_confusion(t):
    a, b = t.truth.selectExpr("truth_id", "mag < 25 AS found"), t.truth.selectExpr("truth_id", "truth_id % 3 <> 0 AS found")
    return evaluation.detection_confusion(a, b, "truth_id")


def _sweep(n):
    return f"""th AS (SELECT unnest(range(0, {n})) AS step), bins AS (SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg FROM scores GROUP BY p),
  totals AS (SELECT sum(pos) AS np, sum(neg) AS nn FROM bins),
  c AS (SELECT step, step / {n - 1}e0 AS threshold, coalesce(sum(pos) FILTER (p > step / {n - 1}e0), 0) AS tp, coalesce(sum(neg) FILTER (p > step / {n - 1}e0), 0) AS fp
        FROM th, bins GROUP BY step),
  e AS (SELECT step, threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(np - tp AS BIGINT) AS fn, CAST(nn - fp AS BIGINT) AS tn FROM c, totals),
  r AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS recall,
        CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy FROM e),
  f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM r)"""


@query("precision_recall_curve", f"WITH {_sweep(201)} SELECT step, threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM f")
def precision_recall_curve(t):
    return rounded(evaluation.precision_recall_curve(t.scores, 201), 9, "precision", "recall")


@query("closest_to_precision", f"""WITH {_sweep(201)}, g AS (SELECT target, threshold, precision, recall, row_number() OVER (PARTITION BY target ORDER BY abs(precision - target), step) AS n
   FROM f, (SELECT unnest([0.9e0, 0.95e0, 0.98e0]) AS target))
SELECT target, threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM g WHERE n = 1""")
def closest_to_precision(t):
    curve = evaluation.precision_recall_curve(t.scores, 201)
    return rounded(evaluation.closest_to_precision(curve, [0.9, 0.95, 0.98]), 9, "precision", "recall")


@query("best_f1", f"""WITH {_sweep(1000)} SELECT threshold, round(f1, 9) AS f1, round(precision, 9) AS precision, round(recall, 9) AS recall, round(accuracy, 9) AS accuracy, tp, fp, fn, tn
  FROM f ORDER BY f1 DESC, step LIMIT 1""")
def best_f1(t):
    return rounded(evaluation.best_f1(t.scores), 9, "f1", "precision", "recall", "accuracy")


@query("classifier_metrics", """WITH c AS (SELECT count(*) FILTER (p > 0.5 AND y = 1) AS tp, count(*) FILTER (p > 0.5 AND y <> 1) AS fp,
   count(*) FILTER (p <= 0.5 AND y = 1) AS fn, count(*) FILTER (p <= 0.5 AND y <> 1) AS tn FROM scores),
k AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2e0 AS r FROM scores),
a AS (SELECT (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2e0) / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y <> 1)) AS roc_auc FROM k)
SELECT tp, fp, fn, tn, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 9) AS recall,
  round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 9) AS accuracy, round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 9) AS f1, round(roc_auc, 9) AS roc_auc FROM c, a""")
def classifier_metrics(t):
    return rounded(evaluation.classifier_metrics(t.scores), 9, "precision", "recall", "accuracy", "f1", "roc_auc")


@query("metrics_at_precision", f"""WITH {_sweep(1000)} SELECT threshold, round(f1, 9) AS f1, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(accuracy, 9) AS accuracy, tp, fp, fn, tn FROM f ORDER BY abs(precision - 0.6), step LIMIT 1""")
def metrics_at_precision(t):
    return rounded(evaluation.metrics_at_precision(t.scores), 9, "f1", "precision", "recall", "accuracy")


@query("pr_auc", """WITH b AS (SELECT p, count(*) FILTER (y = 1) AS pos, count(*) AS n FROM scores GROUP BY p),
c AS (SELECT p, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen FROM b WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
d AS (SELECT pos, tp / CAST(seen AS DOUBLE) AS pr, coalesce(lag(tp / CAST(seen AS DOUBLE)) OVER (ORDER BY p DESC), 1e0) AS pr0 FROM c)
SELECT round(sum(pos * (pr + pr0) / 2) / sum(pos), 9) AS pr_auc FROM d""")
def pr_auc(t):
    return rounded(evaluation.pr_auc(t.scores), 9, "pr_auc")


@query("candidate_pixel_cuts", f"""WITH {DIFF}, c AS (SELECT event_id AS cand_id, CAST(floor(event_id / 64) AS BIGINT) AS cy, event_id % 64 AS cx, CAST(event_id % 3 AS INT) AS stage
   FROM events WHERE event_type = 'purchase'),
o AS (SELECT unnest(range(-2, 3)) AS k),
s AS (SELECT cand_id, a.k AS dy, b.k AS dx, v FROM c, o a, o b, d WHERE d.y = cy + a.k AND d.x = cx + b.k),
f AS (SELECT p.cand_id, p.dy, p.dx, median(q.v) AS m FROM s p JOIN s q ON p.cand_id = q.cand_id AND abs(p.dy - q.dy) <= 1 AND abs(p.dx - q.dx) <= 1 GROUP BY 1, 2, 3),
z AS (SELECT cand_id, count(*) FILTER (v < 0) AS n_negative, count(*) - count(v) AS n_bad FROM s GROUP BY cand_id),
u AS (SELECT cand_id, sum(m) AS a, sum(abs(m)) AS b FROM f GROUP BY cand_id)
SELECT c.cand_id, CASE WHEN stage = 2 AND n_negative <= 14 AND n_bad <= 12 AND b > 0 AND a / b >= -0.05 THEN 3 ELSE stage END AS stage
FROM c LEFT JOIN z ON z.cand_id = c.cand_id LEFT JOIN u ON u.cand_id = c.cand_id""")
def candidate_pixel_cuts(t):
    """The last stage of the candidate cuts, from the pixels around each candidate."""
    diff = pixels.naive_difference(t.frame, t.ref_frame)
    staged = _candidates(t).withColumn("stage", F.expr("CAST(cand_id % 3 AS INT)"))
    out = evaluation.pixel_cuts(staged, pixels.stamp_metrics(staged, diff), max_negative=14, min_sumrat=-0.05)
    return out.select("cand_id", "stage")


@query("segment_schedule", """WITH v AS (SELECT o_orderkey, lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS program, lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') AS plan,
   lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS pass, lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') AS segment, CAST(o_orderdate AS TIMESTAMP) AS day, o_custkey FROM orders)
SELECT o_orderkey AS row_id, CAST(program AS INT) AS program, CAST(plan AS INT) AS plan, CAST(pass AS INT) AS pass, CAST(segment AS INT) AS segment,
  day + INTERVAL 1 HOUR AS segment_start, day + INTERVAL 3 HOUR + INTERVAL 5 SECOND AS segment_end,
  CASE WHEN o_custkey % 3 = 0 THEN CAST(o_custkey % 360 AS DOUBLE) ELSE CAST(o_custkey % 90 AS DOUBLE) END AS pa FROM v""")
def segment_schedule(t):
    """Segment schedules with typed columns, from 13-digit visit ids and day-of-year times."""
    from ..sources.readers import parse_segments

    rows = t.orders.selectExpr(
        "o_orderkey AS row_id", "concat(lpad(o_orderkey % 100000, 5, '0'), lpad(o_custkey % 100, 2, '0'), lpad(o_orderkey % 1000, 3, '0'), lpad(o_custkey % 1000, 3, '0')) AS visit_id",
        "date_format(o_orderdate, 'yyyy.DDD') || ':01:00:00' AS start", "date_format(o_orderdate, 'yyyy.DDD') || ':03:00:05' AS end",
        "CASE WHEN o_custkey % 3 = 0 THEN CAST(o_custkey % 360 AS DOUBLE) END AS assigned_orient", "CAST(o_custkey % 90 AS DOUBLE) AS nominal_orient")
    return parse_segments(rows).select("row_id", "program", "plan", "pass", "segment", "segment_start", "segment_end", "pa")


HIST = """l AS (SELECT fid, min(mag) AS lo, max(mag) AS hi FROM truth GROUP BY fid),
b AS (SELECT t.fid, lo, hi, least(CAST(floor((mag - lo) * 29 / (hi - lo)) AS BIGINT), 28) AS bin, truth_id % 800 > (mag - 20) * 100 AS rec FROM truth t JOIN l ON t.fid = l.fid),
h AS (SELECT fid, bin, any_value(lo) + (bin + 0.5) * (any_value(hi) - any_value(lo)) / 29 AS mag, count(*) AS n_true, count(*) FILTER (rec) AS n_recovered FROM b GROUP BY fid, bin)"""


def _histogram(t):
    return evaluation.recovery_histogram(t.truth.withColumn("recovered", F.expr("truth_id % 800 > (mag - 20) * 100")), "fid")


@query("recovery_histogram", f"""WITH {HIST} SELECT fid, bin, round(mag, 9) AS mag, n_true, n_recovered, CAST(sum(n_true) OVER (PARTITION BY fid ORDER BY bin) AS BIGINT) AS cum_true,
  CAST(sum(n_recovered) OVER (PARTITION BY fid ORDER BY bin) AS BIGINT) AS cum_recovered FROM h""")
def recovery_histogram(t):
    return rounded(_histogram(t), 9, "mag")


def _limit_sql(name, fraction):
    return f"""{name} AS (SELECT fid, arg_min(m, bin) AS {name} FROM (SELECT fid, bin, CASE WHEN f0 IS NULL THEN mag ELSE m0 + (f0 - {fraction}) / (f0 - f) * (mag - m0) END AS m
      FROM s WHERE f < {fraction}) GROUP BY fid)"""


@query("figure_of_merit_magnitudes", f"""WITH {HIST}, q AS (SELECT *, n_recovered / CAST(n_true AS DOUBLE) AS f FROM h),
s AS (SELECT *, lag(f) OVER (PARTITION BY fid ORDER BY bin) AS f0, lag(mag) OVER (PARTITION BY fid ORDER BY bin) AS m0 FROM q),
{_limit_sql('m80', 0.8)}, {_limit_sql('m20', 0.2)}
SELECT i.fid, round(m80, 8) AS m80, round(m20, 8) AS m20 FROM (SELECT DISTINCT fid FROM h) i LEFT JOIN m80 USING (fid) LEFT JOIN m20 USING (fid)""")
def figure_of_merit_magnitudes(t):
    return rounded(evaluation.figure_of_merit_magnitudes(_histogram(t), "fid"), 8, "m80", "m20")


@query("false_positive_threshold", """WITH c AS (SELECT CAST(floor(fluxfit / fluxerr / 0.5) AS BIGINT) AS k, count(*) AS n FROM sources WHERE flags = 1 GROUP BY 1),
u AS (SELECT k, sum(n) OVER (ORDER BY k DESC) AS upto FROM c)
SELECT min(k) * 0.5e0 AS snr_threshold, CAST(max(upto) AS BIGINT) AS n_false FROM u WHERE upto <= 1000""")
def false_positive_threshold(t):
    d = t.sources.selectExpr("fluxfit / fluxerr AS snr", "flags = 0 AS is_true")
    return evaluation.false_positive_threshold(d, 100, 10.0, 0.5)


@query("normalize_features", """WITH s AS (SELECT avg(flux) AS fm, stddev_pop(flux) AS fs, avg(sharpness) AS sm, stddev_pop(sharpness) AS ss FROM scores)
SELECT sample_id, round((flux - fm) / (fs + 1e-6), 8) AS flux, round((sharpness - sm) / (ss + 1e-6), 8) AS sharpness FROM scores, s""")
def normalize_features(t):
    out = evaluation.normalize_features(t.scores.select("sample_id", "flux", "sharpness"), ["flux", "sharpness"])
    return rounded(out, 8, "flux", "sharpness")


@query("stratified_split", """WITH h AS (SELECT sample_id, y, md5(concat(CAST(sample_id AS VARCHAR), ':42')) AS h FROM scores),
r AS (SELECT sample_id, y, row_number() OVER (PARTITION BY y ORDER BY h, sample_id) AS r, count(*) OVER (PARTITION BY y) AS n FROM h),
z AS (SELECT *, round(n * 0.2) AS n_test FROM r)
SELECT sample_id, y, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + round((n - n_test) * 0.25) THEN 'val' ELSE 'train' END AS part FROM z""")
def stratified_split(t):
    return evaluation.stratified_split(t.scores.select("sample_id", "y"), "sample_id", "y", 0.2, 0.25)
