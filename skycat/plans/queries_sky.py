"""Registered queries: geometry, positional joins and sky tiles."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import geometry, healpix, naming, photometry, times
from ..operators import associate, images, schedule, spatial, tiles
from .registry import query

# --- SQL text of the geometry, used by the checking queries --------------------------------


def sql_vec(ra, dec):
    return (f"cos(radians({dec})) * cos(radians({ra}))", f"cos(radians({dec})) * sin(radians({ra}))", f"sin(radians({dec}))")


def sql_chord2(ra1, dec1, ra2, dec2):
    return "(" + " + ".join(f"pow(({a}) - ({b}), 2)" for a, b in zip(sql_vec(ra1, dec1), sql_vec(ra2, dec2))) + ")"


def sql_deg(chord2):
    return f"degrees(2 * asin(least(1e0, 0.5 * sqrt({chord2}))))"


def limit_of(radius):
    """Squared chord of an angle in degrees."""
    return (2 * math.sin(math.radians(radius) / 2)) ** 2


def within(radius, ra1, dec1, ra2, dec2):
    """Pairs within the radius; the declination band first."""
    limit = limit_of(radius)
    return (f"{dec2} BETWEEN {dec1} - {radius * 1.000001!r} AND {dec1} + {radius * 1.000001!r} "
            f"AND {sql_chord2(ra1, dec1, ra2, dec2)} <= {limit!r}")


R = 1.23456e-5  # search radius in degrees, away from the grid of the fixture positions


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- scalar geometry ---------------------------------------------------------------------


@query("to_unit_vector", "SELECT sid, " + ", ".join(f"round({e}, 9) AS {n}" for e, n in zip(sql_vec("ra", "dec"), "xyz")) + " FROM sources")
def to_unit_vector(t):
    x, y, z = geometry.unit_vector("ra", "dec")
    return t.sources.select("sid", *[F.round(c, 9).alias(n) for c, n in ((x, "x"), (y, "y"), (z, "z"))])


@query("from_unit_vector", f"""
WITH v AS (SELECT sid, {", ".join(f"{e} AS {n}" for e, n in zip(sql_vec("ra", "dec"), "xyz"))} FROM sources),
w AS (SELECT sid, degrees(atan2(y, x)) AS a, degrees(asin(greatest(-1e0, least(1e0, z)))) AS d FROM v)
SELECT sid, round(CASE WHEN a < 0 THEN a + 360 ELSE a END, 6) AS ra_back, round(d, 6) AS dec_back FROM w""")
def from_unit_vector(t):
    x, y, z = geometry.unit_vector("ra", "dec")
    v = t.sources.select("sid", x.alias("x"), y.alias("y"), z.alias("z"))
    ra, dec = geometry.from_unit_vector("x", "y", "z")
    return v.select("sid", F.round(ra, 6).alias("ra_back"), F.round(dec, 6).alias("dec_back"))


@query("angular_separation", """SELECT sid, round(degrees(2 * asin(sqrt(pow(sin(radians(dec - dec0) / 2), 2)
  + cos(radians(dec)) * cos(radians(dec0)) * pow(sin(radians(ra - ra0) / 2), 2)))), 10) AS sep FROM sources s JOIN objects o ON s.partkey = o.aid""")
def angular_separation(t):
    sep = geometry.angular_separation("ra", "dec", "ra0", "dec0")
    both = t.sources.select("sid", "partkey", "ra", "dec").join(t.objects.select(F.col("aid").alias("partkey"), "ra0", "dec0"), "partkey")
    return both.select("sid", F.round(sep, 10).alias("sep"))


# gnomonic projection written with vectors along north and east
TAN = """
WITH p AS (SELECT rid, ra0, dec0, xi, eta FROM (SELECT rid, ra0, dec0,
    radians({cd11} * u + {cd12} * v) AS xi, radians({cd21} * u + {cd22} * v) AS eta FROM (SELECT rid, ra0, dec0, rid % 360 AS rot,
    CAST(rid % 4088 AS DOUBLE) - 2044.5 AS u, CAST(rid * 7 % 4088 AS DOUBLE) - 2044.5 AS v FROM l2filemeta))),
w AS (SELECT rid, cos(radians(dec0)) * cos(radians(ra0)) - eta * sin(radians(dec0)) * cos(radians(ra0)) - xi * sin(radians(ra0)) AS x,
  cos(radians(dec0)) * sin(radians(ra0)) - eta * sin(radians(dec0)) * sin(radians(ra0)) + xi * cos(radians(ra0)) AS y,
  sin(radians(dec0)) + eta * cos(radians(dec0)) AS z FROM p)
SELECT rid, round(CASE WHEN atan2(y, x) < 0 THEN degrees(atan2(y, x)) + 360 ELSE degrees(atan2(y, x)) END, 9) AS ra,
  round(degrees(atan2(z, sqrt(x * x + y * y))), 9) AS dec FROM w"""
SCALE = "(0.11 / 3600e0)"


@query("tan_project", TAN.format(cd11=f"{SCALE} * cos(radians(rot))", cd12=f"-{SCALE} * sin(radians(rot))",
                                 cd21=f"{SCALE} * sin(radians(rot))", cd22=f"{SCALE} * cos(radians(rot))"))
def tan_project(t):
    m = t.l2filemeta.select("rid", "ra0", "dec0", (F.col("rid") % 4088).cast("double").alias("x"), (F.col("rid") * 7 % 4088).cast("double").alias("y"))
    s = 0.11 / 3600.0
    ra, dec = geometry.tan_project("x", "y", 2044.5, 2044.5, "ra0", "dec0", s, s, F.col("rid") % 360)
    return m.select("rid", F.round(ra, 9).alias("ra"), F.round(dec, 9).alias("dec"))


@query("tan_project_cd", TAN.format(cd11="-0.00003", cd12="0.000002", cd21="0.000001", cd22="0.00003"))
def tan_project_cd(t):
    m = t.l2filemeta.select("rid", "ra0", "dec0", (F.col("rid") % 4088).cast("double").alias("x"), (F.col("rid") * 7 % 4088).cast("double").alias("y"))
    ra, dec = geometry.tan_project_cd("x", "y", 2044.5, 2044.5, "ra0", "dec0", -0.00003, 0.000002, 0.000001, 0.00003)
    return m.select("rid", F.round(ra, 9).alias("ra"), F.round(dec, 9).alias("dec"))


@query("tan_deproject", """
WITH p AS (SELECT sid, ra, dec, mod(ra + 0.03, 360) AS a0, CASE WHEN dec > 0 THEN dec - 0.02 ELSE dec + 150.02 END AS d0, sid % 360 AS rot FROM sources),
q AS (SELECT *, sin(radians(d0)) * sin(radians(dec)) + cos(radians(d0)) * cos(radians(dec)) * cos(radians(ra - a0)) AS den FROM p),
s AS (SELECT sid, rot, den, cos(radians(dec)) * sin(radians(ra - a0)) / den AS xi,
   (cos(radians(d0)) * sin(radians(dec)) - sin(radians(d0)) * cos(radians(dec)) * cos(radians(ra - a0))) / den AS eta FROM q)
SELECT sid, CASE WHEN den <= 0 THEN -999999 ELSE round(2044.5 + degrees(xi * cos(radians(rot)) + eta * sin(radians(rot))) / (0.11 / 3600e0), 4) END AS x,
  CASE WHEN den <= 0 THEN -999999 ELSE round(2044.5 + degrees(eta * cos(radians(rot)) - xi * sin(radians(rot))) / (0.11 / 3600e0), 4) END AS y FROM s""")
def tan_deproject(t):
    s = 0.11 / 3600.0
    p = t.sources.selectExpr("sid", "ra", "dec", "mod(ra + 0.03, 360) AS a0", "CASE WHEN dec > 0 THEN dec - 0.02 ELSE dec + 150.02 END AS d0")
    x, y = geometry.tan_deproject("ra", "dec", 2044.5, 2044.5, "a0", "d0", s, s, F.col("sid") % 360)
    return p.select("sid", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query("image_corner_pixels", """SELECT rid, (n1 - 1) / 2e0 AS x0, (n2 - 1) / 2e0 AS y0, 0e0 AS x1, 0e0 AS y1, n1 - 1e0 AS x2, 0e0 AS y2,
  n1 - 1e0 AS x3, n2 - 1e0 AS y3, 0e0 AS x4, n2 - 1e0 AS y4 FROM (SELECT rid, 4088 + rid % 3 AS n1, 4088 + rid % 5 AS n2 FROM l2files)""")
def image_corner_pixels(t):
    d = t.l2files.selectExpr("rid", "4088 + rid % 3 AS n1", "4088 + rid % 5 AS n2")
    return d.select("rid", *[c.alias(f"{a}{i}") for i, xy in enumerate(geometry.image_corner_pixels("n1", "n2")) for a, c in zip("xy", xy)])


HEALPIX = """
WITH a AS (SELECT sid, sin(radians(dec)) AS z, ra / 90 AS q FROM sources),
b AS (SELECT *, CAST(floor(512 * (0.5 + q) - 512 * 0.75 * z) AS BIGINT) AS jp, CAST(floor(512 * (0.5 + q) + 512 * 0.75 * z) AS BIGINT) AS jm,
  CAST(least(floor(q), 3) AS BIGINT) AS c, 512 * sqrt(3 * (1 - abs(z))) AS r FROM a),
d AS (SELECT *, CAST(least(floor((q - c) * r), 511) AS BIGINT) AS u, CAST(least(floor((1 - (q - c)) * r), 511) AS BIGINT) AS v FROM b),
f AS (SELECT sid, CASE WHEN abs(z) <= 2 / 3e0 THEN CASE WHEN jp >> 9 = jm >> 9 THEN (jp >> 9) % 4 + 4 WHEN jp >> 9 < jm >> 9 THEN jp >> 9 ELSE (jm >> 9) + 8 END
    WHEN z > 0 THEN c ELSE c + 8 END AS face,
  CASE WHEN abs(z) <= 2 / 3e0 THEN jm & 511 WHEN z > 0 THEN 511 - v ELSE u END AS x,
  CASE WHEN abs(z) <= 2 / 3e0 THEN 511 - (jp & 511) WHEN z > 0 THEN 511 - u ELSE v END AS y FROM d)
"""
BITS = " + ".join(f"((x >> {i}) & 1) * {4 ** i} + ((y >> {i}) & 1) * {2 * 4 ** i}" for i in range(9))


@query("healpix_nested", HEALPIX + f"SELECT sid, face * 262144 + {BITS} AS hp9, (face * 262144 + {BITS}) >> 6 AS hp6 FROM f")
def healpix_nested(t):
    return t.sources.select("sid", healpix.healpix_nested("ra", "dec", 9).alias("hp9"), healpix.healpix_nested("ra", "dec", 6).alias("hp6"))


@query("mjd_to_jd", "SELECT expid, mjdobs + 2400000.5 AS jd FROM exposures")
def mjd_to_jd(t):
    return t.exposures.select("expid", times.mjd_to_jd("mjdobs").alias("jd"))


@query("doy_timestamp", "SELECT event_id, date_trunc('second', ts) AS stamp, round(epoch_us(date_trunc('second', ts)) / 86400000000e0 + 2440587.5, 7) AS jd FROM events")
def doy_timestamp(t):
    text = t.events.selectExpr("event_id", "date_format(ts, 'yyyy.DDD:HH:mm:ss') AS text").withColumn("stamp", times.doy_timestamp("text"))
    return text.select("event_id", F.col("stamp").cast("timestamp_ntz").alias("stamp"), F.round(times.timestamp_to_jd("stamp"), 7).alias("jd"))


@query("parse_visit_id", """SELECT o_orderkey, CAST(o_custkey % 100000 AS INT) AS program, CAST(o_orderkey % 100 AS INT) AS plan,
  CAST(o_orderkey % 1000 AS INT) AS pass, CAST(o_custkey % 1000 AS INT) AS segment FROM orders""")
def parse_visit_id(t):
    ids = t.orders.selectExpr("o_orderkey", "concat(lpad(CAST(o_custkey % 100000 AS STRING), 5, '0'), lpad(CAST(o_orderkey % 100 AS STRING), 2, '0'), "
                              "lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), lpad(CAST(o_custkey % 1000 AS STRING), 3, '0')) AS v")
    return ids.withColumns(naming.visit_id_parts("v")).drop("v")


@query("coalesce_orientation", "SELECT segment_id, coalesce(assigned_orient, nominal_orient) AS pa FROM segments")
def coalesce_orientation(t):
    return schedule.coalesce_orientation(t.segments).select("segment_id", "pa")


@query("mag_from_flux", "SELECT sid, round(-2.5 * log10(fluxfit) + 25, 9) AS mag FROM sources")
def mag_from_flux(t):
    return t.sources.select("sid", F.round(photometry.mag_from_flux("fluxfit", 25.0), 9).alias("mag"))


@query("mag_err", "SELECT sid, round(1.085736205 * fluxerr / fluxfit, 9) AS mag_err FROM sources")
def mag_err(t):
    return t.sources.select("sid", F.round(photometry.mag_error("fluxfit", "fluxerr"), 9).alias("mag_err"))


@query("snr", "SELECT sid, round(CASE WHEN fluxerr - 1 <> 0 THEN fluxfit / (fluxerr - 1) END, 9) AS snr FROM sources")
def snr(t):
    return t.sources.select("sid", F.round(photometry.snr("fluxfit", F.col("fluxerr") - 1), 9).alias("snr"))


@query("flux_from_mag", "SELECT truth_id, round(pow(10e0, -0.4 * (mag - 25)), 9) AS flux FROM truth")
def flux_from_mag(t):
    return t.truth.select("truth_id", F.round(photometry.flux_from_mag("mag", 25.0), 9).alias("flux"))


@query("alert_name", """
WITH a AS (SELECT o_orderkey, 22 + o_orderkey % 15 AS yr, o_orderkey * 700001 + 1 AS seq FROM orders)
SELECT o_orderkey, CASE WHEN yr < 24 OR yr > 34 THEN 'notsupported' WHEN seq - 1 > 8031810175 THEN 'idoutofrange'
  ELSE concat('SKY', CAST(yr AS VARCHAR), """ + ", ".join(f"chr(CAST(97 + ((seq - 1) // {26 ** k}) % 26 AS INT))" for k in range(6, -1, -1)) + """) END AS alertname FROM a""")
def alert_name(t):
    a = t.orders.selectExpr("o_orderkey", "22 + o_orderkey % 15 AS yr", "o_orderkey * 700001 + 1 AS seq")
    return a.select("o_orderkey", naming.alert_name("yr", "seq", "SKY").alias("alertname"))


@query("file_basename", "SELECT rid, regexp_extract(filename, '.+/(.+)', 1) AS basename FROM l2files")
def file_basename(t):
    return t.l2files.select("rid", naming.file_basename("filename").alias("basename"))


@query("infobits_flags", "SELECT rid, infobits & 1 = 1 AS bit0, (infobits >> 2) & 1 = 1 AS bit2, infobits & 6 AS low FROM l2files")
def infobits_flags(t):
    return t.l2files.select("rid", naming.has_bit("infobits", 0).alias("bit0"), naming.has_bit("infobits", 2).alias("bit2"),
                            F.col("infobits").bitwiseAND(F.lit(6)).alias("low"))


@query("sca_footprints", """
WITH p AS (SELECT rid, ra0 AS a0, dec0 AS d0, CAST(rid % 360 AS DOUBLE) AS pa, d.sca FROM l2filemeta m, (SELECT range + 1 AS sca FROM range(0, 18)) d),
c AS (SELECT rid, sca, a0, d0, pa, CASE sca """ + " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(schedule.DETECTOR_RA, 1)) + """ END AS ra,
  CASE sca """ + " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(schedule.DETECTOR_DEC, 1)) + """ END AS dec FROM p),
e AS (SELECT *, sin(radians(-45.6541)) * sin(radians(dec)) + cos(radians(-45.6541)) * cos(radians(dec)) * cos(radians(ra - 7.60523)) AS den FROM c),
k AS (SELECT rid, sca, a0, d0, pa, degrees(cos(radians(dec)) * sin(radians(ra - 7.60523)) / den) AS u,
  degrees((cos(radians(-45.6541)) * sin(radians(dec)) - sin(radians(-45.6541)) * cos(radians(dec)) * cos(radians(ra - 7.60523))) / den) AS v FROM e),
m AS (SELECT rid, sca, a0, d0, pa, tag, u + dx AS u, v + dy AS v FROM k, (SELECT 0 AS tag, 0e0 AS dx, 0e0 AS dy
  UNION ALL SELECT 1, -2043.5 * 0.11 / 3600, -2043.5 * 0.11 / 3600 UNION ALL SELECT 2, 2043.5 * 0.11 / 3600, -2043.5 * 0.11 / 3600
  UNION ALL SELECT 3, 2043.5 * 0.11 / 3600, 2043.5 * 0.11 / 3600 UNION ALL SELECT 4, -2043.5 * 0.11 / 3600, 2043.5 * 0.11 / 3600)),
w AS (SELECT rid, sca, tag, a0, d0, radians(u * cos(radians(pa)) - v * sin(radians(pa))) AS xi, radians(u * sin(radians(pa)) + v * cos(radians(pa))) AS eta FROM m),
g AS (SELECT rid, sca, tag, mod(a0 + degrees(atan2(xi, cos(radians(d0)) - eta * sin(radians(d0)))) + 360, 360) AS ra,
  degrees(atan2(sin(radians(d0)) + eta * cos(radians(d0)), sqrt(xi * xi + pow(cos(radians(d0)) - eta * sin(radians(d0)), 2)))) AS dec FROM w),
r AS (SELECT rid, sca, round(max(CASE WHEN tag = 0 THEN ra END), 6) AS sca_ra0, round(max(CASE WHEN tag = 0 THEN dec END), 6) AS sca_dec0,
  round(max(CASE WHEN tag = 1 THEN ra END), 6) AS sca_ra1, round(max(CASE WHEN tag = 1 THEN dec END), 6) AS sca_dec1,
  round(max(CASE WHEN tag = 2 THEN ra END), 6) AS sca_ra2, round(max(CASE WHEN tag = 2 THEN dec END), 6) AS sca_dec2,
  round(max(CASE WHEN tag = 4 THEN ra END), 6) AS sca_ra4, round(max(CASE WHEN tag = 4 THEN dec END), 6) AS sca_dec4,
  round(max(CASE WHEN tag = 3 THEN ra END), 6) AS sca_ra3, round(max(CASE WHEN tag = 3 THEN dec END), 6) AS sca_dec3 FROM g GROUP BY rid, sca),
z AS (SELECT *, CAST(floor((sca_dec0 + 90) / 2) AS BIGINT) AS zone FROM r),
n AS (SELECT *, CASE WHEN zone IN (0, 89) THEN 1 ELSE CAST(floor(180e0 * cos(radians(zone * 2e0 - 89e0))) AS BIGINT) END AS n FROM z)
SELECT rid, sca, sca_ra0, sca_dec0, sca_ra1, sca_dec1, sca_ra2, sca_dec2, sca_ra3, sca_dec3, sca_ra4, sca_dec4,
  zone * 1000 + 1 + CAST(floor(sca_ra0 / (360e0 / n) + CASE WHEN n = 1 THEN 0 ELSE 5e-1 END) AS BIGINT) % n AS sca_field FROM n""")
def sca_footprints(t):
    pointings = t.l2filemeta.select("rid", F.col("ra0").alias("ra"), F.col("dec0").alias("dec"), (F.col("rid") % 360).cast("double").alias("pa"))
    cols = [f"sca_{c}{i}" for i in range(5) for c in ("ra", "dec")]
    out = rounded(schedule.sca_footprints(pointings, schedule.detector_offsets()).select("rid", "sca", *cols), 6, *cols)
    return tiles.point_to_tile(out, t.tiles, ("sca_ra0", "sca_dec0"), "sca_field", 2.0)


# --- positional joins ----------------------------------------------------------------------


@query("cone_search", f"SELECT sid, ra, dec, round({sql_deg(sql_chord2('ra', 'dec', '180e0', '10e0'))}, 9) AS dist_deg FROM sources "
       f"WHERE {sql_chord2('ra', 'dec', '180e0', '10e0')} <= {limit_of(20.0)!r} ORDER BY dist_deg")
def cone_search(t):
    return rounded(spatial.cone_search(t.sources.select("sid", "ra", "dec"), 180.0, 10.0, 20.0), 9, "dist_deg")


@query("batch_cone_search", f"""SELECT reqid, sid, round({sql_deg(sql_chord2('p.ra', 'p.dec', 's.ra', 's.dec'))}, 9) AS dist_deg
  FROM positions p JOIN sources s ON {within(R, 'p.ra', 'p.dec', 's.ra', 's.dec')}""")
def batch_cone_search(t):
    catalog = t.sources.select("sid", F.col("ra").alias("s_ra"), F.col("dec").alias("s_dec"))
    out = spatial.batch_cone_search(t.positions, catalog, R, catalog_pos=("s_ra", "s_dec"))
    return rounded(out.select("reqid", "sid", "dist_deg"), 9, "dist_deg")


@query("sky_join_all_pairs", f"""SELECT sid, aid, round({sql_deg(sql_chord2('ra', 'dec', 'ra0', 'dec0'))}, 9) AS dist_deg
  FROM sources JOIN objects ON {within(R, 'ra', 'dec', 'ra0', 'dec0')}""")
def sky_join_all_pairs(t):
    out = spatial.sky_join_all_pairs(t.sources.select("sid", "ra", "dec"), t.objects.select("aid", "ra0", "dec0"), R)
    return rounded(out.select("sid", "aid", "dist_deg"), 9, "dist_deg")


@query("sky_join_all_pairs_dense", f"""SELECT aid, count(*) AS n, sum(sid % 1000000) AS checksum
  FROM dense_sources JOIN dense_objects ON {within(R, 'ra', 'dec', 'ra0', 'dec0')} GROUP BY aid""")
def sky_join_all_pairs_dense(t):
    out = spatial.sky_join_all_pairs(t.dense_sources.select("sid", "ra", "dec"), t.dense_objects, R, distance=None, crowded=True)
    return out.groupBy("aid").agg(F.count("*").alias("n"), F.sum(F.col("sid") % 1000000).alias("checksum"))


FLAT = "sqrt(pow((mod(o.ra0 - p.ra + 540, 360) - 180) * cos(radians(p.dec)), 2) + pow(o.dec0 - p.dec, 2))"


@query("sky_join_nearest", f"""
WITH d AS (SELECT p.sid, o.aid, {FLAT} AS dist FROM dense_sources p JOIN dense_objects o
             ON o.dec0 BETWEEN p.dec - 0.00002 AND p.dec + 0.00002 AND {FLAT} <= {R!r}),
b AS (SELECT sid, aid, dist, row_number() OVER (PARTITION BY sid ORDER BY dist, aid) AS n FROM d)
SELECT s.sid, b.aid, round(b.dist, 10) AS dist_deg FROM dense_sources s LEFT JOIN b ON s.sid = b.sid AND n = 1""")
def sky_join_nearest(t):
    out = spatial.sky_join_nearest(t.dense_sources.select("sid", "ra", "dec"), t.dense_objects, R, "sid", "aid")
    return rounded(out.select("sid", "aid", "dist_deg"), 10, "dist_deg")


def sql_inside(i):
    """Is point i of the image inside the tile a: equal signs against the four edges."""
    px, py, pz = sql_vec(f"b.ra{i}", f"b.dec{i}")
    sides = []
    for p, q in ((1, 2), (2, 3), (3, 4), (4, 1)):
        ax, ay, az = sql_vec(f"a.ra{p}", f"a.dec{p}")
        bx, by, bz = sql_vec(f"a.ra{q}", f"a.dec{q}")
        sides.append(f"sign({px} * (({ay}) * ({bz}) - ({az}) * ({by})) + {py} * (({az}) * ({bx}) - ({ax}) * ({bz})) + ({pz}) * (({ax}) * ({by}) - ({ay}) * ({bx})))")
    return f"(least({', '.join(sides)}) >= 0 OR greatest({', '.join(sides)}) <= 0)"


@query("overlapping_images", f"""
WITH c AS (SELECT a.rid, b.rid AS other_rid, b.mjdobs AS other_mjd, {sql_chord2('a.ra0', 'a.dec0', 'b.ra0', 'b.dec0')} AS c2,
    {" OR ".join(sql_inside(i) for i in range(5))} AS inside
  FROM l2filemeta a JOIN l2filemeta b ON a.fid = b.fid JOIN l2files f ON b.rid = f.rid
  WHERE f.vbest > 0 AND f.status > 0 AND b.mjdobs < a.mjdobs AND a.rid <> b.rid AND b.dec0 BETWEEN a.dec0 - 0.2 AND a.dec0 + 0.2)
SELECT rid, other_rid, other_mjd, round({sql_deg('c2')}, 8) AS dist_deg FROM c WHERE c2 <= {limit_of(0.18)!r} AND inside""")
def overlapping_images(t):
    targets = t.l2filemeta.withColumns({"start_mjd": F.lit(0.0), "end_mjd": F.col("mjdobs")})
    flags = t.l2files.select("rid", "vbest", "status")
    others = t.l2filemeta.join(flags, "rid").withColumnsRenamed({"rid": "other_rid", "fid": "other_fid", "mjdobs": "other_mjd"})
    return rounded(spatial.overlapping_images(targets, others), 8, "dist_deg")


def sql_half_planes(corners, point):
    """Is a point on the inner side of the great circles through neighbouring corners, in SQL."""
    px, py, pz = point
    sides = []
    for a, b in zip(corners, [*corners[1:], corners[0]]):
        (ax, ay, az), (bx, by, bz) = sql_vec(*a), sql_vec(*b)
        sides.append(f"({px}) * (({ay}) * ({bz}) - ({az}) * ({by})) + ({py}) * (({az}) * ({bx}) - ({ax}) * ({bz})) + ({pz}) * (({ax}) * ({by}) - ({ay}) * ({bx}))")
    return f"(least({', '.join(sides)}) >= 0)"


@query("polygon_search", f"""
WITH d AS (SELECT reqid, ra AS cra, dec AS cdec, 0.01e0 * pow(4e0, reqid % 5) AS s FROM positions)
SELECT reqid, aid FROM d JOIN objects o ON o.dec0 BETWEEN cdec - s * 1.01 AND cdec + s * 1.01
WHERE (abs(o.ra0 - cra) < 90 OR abs(o.ra0 - cra) > 270)
  AND {sql_half_planes([("cra + s", "cdec"), ("cra", "cdec + s"), ("cra - s", "cdec"), ("cra", "cdec - s")], sql_vec("o.ra0", "o.dec0"))}""")
def polygon_search(t):
    """Objects in a diamond around each requested position, of five sizes."""
    from ..operators.polygons import polygon_search as op

    d = t.positions.selectExpr("reqid", "ra AS cra", "dec AS cdec", "0.01D * pow(4D, reqid % 5) AS s")
    wrapped = lambda x: f"pmod({x}, 360D)"
    d = d.selectExpr("reqid", f"array({wrapped('cra + s')}, cra, {wrapped('cra - s')}, cra) AS ra", "array(cdec, cdec + s, cdec, cdec - s) AS dec")
    return op(d, t.objects.select("aid", "ra0", "dec0"), "reqid", 4, ("ra0", "dec0")).select("reqid", "aid")


@query("nearest_k", f"""
WITH c AS (SELECT a.rid, b.rid AS other_rid, {sql_chord2('a.ra0', 'a.dec0', 'b.ra0', 'b.dec0')} AS c2
  FROM l2filemeta a JOIN l2filemeta b ON a.fid = b.fid AND b.dec0 BETWEEN a.dec0 - 0.2 AND a.dec0 + 0.2 WHERE a.rid <> b.rid),
k AS (SELECT rid, other_rid, round({sql_deg('c2')}, 8) AS dist_deg FROM c WHERE c2 <= {limit_of(0.18)!r})
SELECT rid, other_rid, dist_deg, n AS rank FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY dist_deg, other_rid) AS n FROM k) WHERE n <= 3""")
def nearest_k(t):
    a = t.l2filemeta.select("rid", "fid", "ra0", "dec0")
    b = t.l2filemeta.select(F.col("rid").alias("other_rid"), F.col("fid").alias("other_fid"), F.col("ra0").alias("b_ra"), F.col("dec0").alias("b_dec"))
    pairs = spatial.sky_join_all_pairs(a, b, 0.18, ("ra0", "dec0"), ("b_ra", "b_dec"), on=[("fid", "other_fid")], repeat="left",
                                       keep=F.col("rid") != F.col("other_rid"))
    pairs = rounded(pairs.select("rid", "other_rid", "dist_deg"), 8, "dist_deg")
    return spatial.nearest_k(pairs, "rid", 3, ["dist_deg", "other_rid"])


@query("possible_overlapping_diffs", f"""
SELECT rtid AS field_id, pid, jd, round({sql_deg(sql_chord2('f_ra', 'cdec', 'd.ra0', 'd.dec0'))}, 8) AS dist_deg
FROM (SELECT rtid, cdec, CASE WHEN (ramin + ramax) / 2 < 0 THEN (ramin + ramax) / 2 + 360 ELSE (ramin + ramax) / 2 END AS f_ra FROM tiles) f
JOIN (SELECT d.* FROM diffimages d JOIN refimages r ON d.rfid = r.rfid WHERE r.vbest > 0 AND r.status > 0 AND d.vbest > 0 AND d.status > 0
      AND d.ppid = 15 AND jd >= 2450000) d ON {within(1.0, 'f_ra', 'cdec', 'd.ra0', 'd.dec0')}""")
def possible_overlapping_diffs(t):
    fields = t.tiles.selectExpr("rtid AS field_id", "CASE WHEN (ramin + ramax) / 2 < 0 THEN (ramin + ramax) / 2 + 360 ELSE (ramin + ramax) / 2 END AS f_ra", "cdec AS f_dec")
    out = images.possible_overlapping_diffs(fields, t.diffimages, t.refimages, 15, 2450000.0)
    return rounded(out.select("field_id", "pid", "jd", "dist_deg"), 8, "dist_deg")


# --- tiles -----------------------------------------------------------------------------------

TILE_OF = """zone * 1000 + 1 + CAST(floor({ra} / (360e0 / n) + CASE WHEN n = 1 THEN 0 ELSE 5e-1 END) AS BIGINT) % n"""


@query("point_to_tile", f"""
WITH z AS (SELECT sid, ra, CAST(floor((dec + 90) / 2) AS BIGINT) AS zone FROM sources),
n AS (SELECT *, CASE WHEN zone IN (0, 89) THEN 1 ELSE CAST(floor(180e0 * cos(radians(zone * 2e0 - 89e0))) AS BIGINT) END AS n FROM z)
SELECT sid, {TILE_OF.format(ra='ra')} AS field FROM n""")
def point_to_tile(t):
    return tiles.point_to_tile(t.sources.select("sid", "ra", "dec"), t.tiles, h=2.0).select("sid", "field")


@query("tile_neighbors", """
WITH t AS (SELECT rtid, rtid // 1000 AS zone, CASE WHEN ramin = ramax THEN 0e0 ELSE ramin END AS lo,
  CASE WHEN ramin = ramax THEN 360e0 ELSE ramax END AS hi, rtid % 1000 AS k, max(rtid % 1000) OVER (PARTITION BY rtid // 1000) AS n FROM tiles),
same AS (SELECT a.rtid, b.rtid AS neighbor FROM t a JOIN t b ON a.zone = b.zone AND ((a.k - b.k + a.n) % a.n IN (1, a.n - 1)) WHERE a.rtid <> b.rtid),
other AS (SELECT a.rtid, b.rtid AS neighbor FROM t a JOIN t b ON abs(a.zone - b.zone) = 1 JOIN (SELECT unnest([-360, 0, 360]) AS turn) s ON true
  WHERE b.lo + turn <= a.hi AND b.hi + turn >= a.lo)
SELECT rtid, neighbor FROM same UNION SELECT rtid, neighbor FROM other""")
def tile_neighbors(t):
    return tiles.tile_neighbors(t.tiles, 2.0)


@query("tile_bbox_overlap", """
WITH c AS (SELECT rid, least(dec0, dec1, dec2, dec3, dec4) AS dlo, greatest(dec0, dec1, dec2, dec3, dec4) AS dhi,
   greatest(ra0, ra1, ra2, ra3, ra4) - least(ra0, ra1, ra2, ra3, ra4) > 180 AS wraps, * FROM l2filemeta),
b AS (SELECT rid, dlo, dhi, least(""" + ", ".join(f"CASE WHEN wraps AND ra{i} > 180 THEN ra{i} - 360 ELSE ra{i} END" for i in range(5)) + """) AS rlo,
   greatest(""" + ", ".join(f"CASE WHEN wraps AND ra{i} > 180 THEN ra{i} - 360 ELSE ra{i} END" for i in range(5)) + """) AS rhi FROM c),
t AS (SELECT rtid, CASE WHEN ramin = ramax THEN 0e0 ELSE ramin END AS lo, CASE WHEN ramin = ramax THEN 360e0 ELSE ramax END AS hi, decmin, decmax FROM tiles)
SELECT DISTINCT rid, rtid FROM b JOIN t ON decmax > dlo AND decmin < dhi
WHERE (hi > rlo AND lo < rhi) OR (hi - 360 > rlo AND lo - 360 < rhi) OR (hi + 360 > rlo AND lo + 360 < rhi)""")
def tile_bbox_overlap(t):
    return tiles.tile_bbox_overlap(t.l2filemeta, t.tiles, h=2.0)


@query("tile_dec_bins", "SELECT cdec, count(*) AS nrabins, row_number() OVER (ORDER BY cdec) AS dbid FROM tiles GROUP BY cdec")
def tile_dec_bins(t):
    return tiles.tile_dec_bins(t.tiles)


@query("image_fields", f"""
WITH g AS (SELECT rid, ra0, dec0, gx, gy FROM l2filemeta, (SELECT unnest(list_append(range(0, 4088, 500), 4088)) AS gx),
   (SELECT unnest(list_append(range(0, 4088, 500), 4088)) AS gy)),
p AS (SELECT rid, ra0, dec0, radians(-0.00003 * (gx - 2043.5) + 0.000002 * (gy - 2043.5)) AS xi,
   radians(0.000001 * (gx - 2043.5) + 0.00003 * (gy - 2043.5)) AS eta FROM g),
s AS (SELECT rid, mod(ra0 + degrees(atan2(xi, cos(radians(dec0)) - eta * sin(radians(dec0)))) + 360, 360) AS ra,
   degrees(atan2(sin(radians(dec0)) + eta * cos(radians(dec0)), sqrt(xi * xi + pow(cos(radians(dec0)) - eta * sin(radians(dec0)), 2)))) AS dec FROM p),
z AS (SELECT rid, ra, CAST(floor((dec + 90) / 2) AS BIGINT) AS zone FROM s),
n AS (SELECT *, CASE WHEN zone IN (0, 89) THEN 1 ELSE CAST(floor(180e0 * cos(radians(zone * 2e0 - 89e0))) AS BIGINT) END AS n FROM z)
SELECT DISTINCT rid, {TILE_OF.format(ra='ra')} AS field FROM n""")
def image_fields(t):
    m = t.l2filemeta.selectExpr("rid", "4088 AS naxis1", "4088 AS naxis2", "2044.5e0 AS crpix1", "2044.5e0 AS crpix2", "ra0 AS crval1", "dec0 AS crval2",
                                "-0.00003e0 AS cd11", "0.000002e0 AS cd12", "0.000001e0 AS cd21", "0.00003e0 AS cd22")
    return tiles.image_fields(m, t.tiles, h=2.0)


def _on_plane(ra, dec):
    """(x, y) in arcseconds on the tangent plane at the first footprint's centre, in SQL."""
    sin0, cos0 = "sin(radians(p.dec0))", "cos(radians(p.dec0))"
    toward = f"({sin0} * sin(radians({dec})) + {cos0} * cos(radians({dec})) * cos(radians({ra} - p.ra0)))"
    return (f"degrees(cos(radians({dec})) * sin(radians({ra} - p.ra0)) / {toward}) * 3600",
            f"degrees(({cos0} * sin(radians({dec})) - {sin0} * cos(radians({dec})) * cos(radians({ra} - p.ra0))) / {toward}) * 3600")


def _listed(axis, prefix):
    return "[" + ", ".join(_on_plane(f"{prefix}ra{i}", f"{prefix}dec{i}")[axis] for i in range(1, 5)) + "]"


# the area shared by two convex polygons as the integral along the edges of each within the other; edges of both, on one
# meridian, count once: those of the first are taken as just inside, those of the second as just outside
OVERLAP = f"""WITH p AS (SELECT a.*, b.rid AS other_rid, {", ".join(f"b.{c}{i} AS o_{c}{i}" for i in range(5) for c in ("ra", "dec"))}
  FROM l2filemeta a JOIN l2filemeta b ON a.fid = b.fid AND {within(0.18, 'a.ra0', 'a.dec0', 'b.ra0', 'b.dec0')} WHERE a.rid <> b.rid),
c AS (SELECT rid, other_rid, {_listed(0, "p.")} AS ax, {_listed(1, "p.")} AS ay, {_listed(0, "p.o_")} AS bx, {_listed(1, "p.o_")} AS b_y FROM p),
s AS (SELECT *, list_sum([ax[i] * ay[i % 4 + 1] - ax[i % 4 + 1] * ay[i] FOR i IN [1, 2, 3, 4]]) / 2 AS sa, list_sum([bx[i] * b_y[i % 4 + 1] - bx[i % 4 + 1] * b_y[i] FOR i IN [1, 2, 3, 4]]) / 2 AS sb FROM c),
o AS (SELECT rid, other_rid, sa, sb, 0 AS poly, CASE WHEN sa < 0 THEN list_reverse(ax) ELSE ax END AS x, CASE WHEN sa < 0 THEN list_reverse(ay) ELSE ay END AS y FROM s
  UNION ALL SELECT rid, other_rid, sa, sb, 1, CASE WHEN sb < 0 THEN list_reverse(bx) ELSE bx END, CASE WHEN sb < 0 THEN list_reverse(b_y) ELSE b_y END FROM s),
e AS (SELECT rid, other_rid, sa, sb, poly, i, x[i] AS x0, y[i] AS y0, x[i % 4 + 1] AS x1, y[i % 4 + 1] AS y1 FROM o, (SELECT unnest([1, 2, 3, 4]) AS i)),
d AS (SELECT e.*, (g.x1 - g.x0) * (e.y0 - g.y0) - (g.y1 - g.y0) * (e.x0 - g.x0) + 1e-9 - 2e-9 * e.poly AS d0, (g.x1 - g.x0) * (e.y1 - g.y0) - (g.y1 - g.y0) * (e.x1 - g.x0) + 1e-9 - 2e-9 * e.poly AS d1
  FROM e JOIN e g ON e.rid = g.rid AND e.other_rid = g.other_rid AND e.poly <> g.poly),
r AS (SELECT rid, other_rid, sa, sb, poly, i, x0, y0, x1, y1, max(CASE WHEN d0 < 0 AND d1 >= 0 THEN d0 / (d0 - d1) ELSE 0 END) AS t0,
  min(CASE WHEN d0 >= 0 AND d1 < 0 THEN d0 / (d0 - d1) ELSE 1 END) AS t1, bool_or(d0 < 0 AND d1 < 0) AS away FROM d GROUP BY ALL),
q AS (SELECT rid, other_rid, sa, sb, sum(CASE WHEN away OR t0 >= t1 THEN 0 ELSE ((x0 + t0 * (x1 - x0)) * (y0 + t1 * (y1 - y0)) - (x0 + t1 * (x1 - x0)) * (y0 + t0 * (y1 - y0))) / 2 END) AS area
  FROM r GROUP BY rid, other_rid, sa, sb)
"""


def _footprint_pairs(t):
    a = t.l2filemeta.select("rid", "fid", "mjdobs", *[f"{c}{i}" for i in range(5) for c in ("ra", "dec")])
    b = a.withColumnsRenamed({"rid": "other_rid", "fid": "other_fid", "mjdobs": "other_mjd",
                              **{f"{c}{i}": f"o_{c}{i}" for i in range(5) for c in ("ra", "dec")}})
    return spatial.sky_join_all_pairs(a, b, 0.18, ("ra0", "dec0"), ("o_ra0", "o_dec0"), on=[("fid", "other_fid")], repeat="left",
                                      distance=None, keep=F.col("rid") != F.col("other_rid"))


@query("footprint_overlap_percent", OVERLAP + "SELECT rid, other_rid, round(100 * area / abs(sa), 6) AS percent FROM q")
def footprint_overlap_percent(t):
    from ..operators.overlap import footprint_overlap_percent as op

    return rounded(op(_footprint_pairs(t)).select("rid", "other_rid", "percent"), 6, "percent")


@query("footprint_overlaps", OVERLAP + "SELECT rid, other_rid, round(100 * area / abs(sa), 6) AS percent, round(100 * area / abs(sb), 6) AS other_percent FROM q")
def footprint_overlaps(t):
    """Both directions, by the clipper for general polygons."""
    from ..operators.clipping import footprint_overlaps as op

    return rounded(op(_footprint_pairs(t)).select("rid", "other_rid", "percent", "other_percent"), 6, "percent", "other_percent")


# --- pixel-space matches -----------------------------------------------------------------------


@query("catalog_match_nearest_pixel", """
WITH d AS (SELECT r.image_id, r.ref_id, s.sci_id, r.x - s.x AS dx, r.y - s.y AS dy, s.flux,
   pow(r.x - s.x, 2) + pow(r.y - s.y, 2) AS d2 FROM ref_catalog r JOIN sci_catalog s ON r.image_id = s.image_id
   WHERE abs(r.x - s.x) <= 60 AND abs(r.y - s.y) <= 60),
b AS (SELECT *, row_number() OVER (PARTITION BY image_id, ref_id ORDER BY round(d2, 6), sci_id) AS n FROM d WHERE d2 <= 3600)
SELECT image_id, ref_id, sci_id, round(dx, 6) AS dx, round(dy, 6) AS dy, flux, round(sqrt(d2), 6) AS distance FROM b WHERE n = 1""")
def catalog_match_nearest_pixel(t):
    out = spatial.catalog_match_nearest_pixel(t.ref_catalog.select("image_id", "ref_id", "x", "y"), t.sci_catalog, 60.0)
    return rounded(out, 6, "dx", "dy", "distance")


@query("isolated_sources", """SELECT a.image_id, a.ref_id FROM ref_catalog a
  WHERE mag <= 23.5 AND x > 100 AND x < 3987 AND y > 100 AND y < 3987 AND NOT EXISTS (SELECT 1 FROM ref_catalog b
   WHERE a.image_id = b.image_id AND a.ref_id <> b.ref_id AND abs(a.x - b.x) <= 10.5 AND abs(a.y - b.y) <= 10.5)""")
def isolated_sources(t):
    src = t.ref_catalog.select("image_id", F.col("ref_id").alias("src_id"), "x", "y", "mag")
    return spatial.isolated_sources(src, 10.5, 23.5, 100.0, 4088, 4088).select("image_id", F.col("src_id").alias("ref_id"))


@query("truth_match", """
WITH d AS (SELECT * REPLACE (CASE WHEN flux_err = 0 THEN 1e7 ELSE flux_err END AS flux_err) FROM detections WHERE flux > 0),
m AS (SELECT det_id, truth_id, pow(d.x - t.x, 2) + pow(d.y - t.y, 2) AS d2 FROM d JOIN truth t ON d.image_id = t.image_id
  WHERE abs(d.x - t.x) < 25 AND abs(d.y - t.y) < 25),
b AS (SELECT *, row_number() OVER (PARTITION BY det_id ORDER BY d2, truth_id) AS n FROM m WHERE d2 < 625)
SELECT d.det_id, d.image_id, round(d.flux / d.flux_err, 9) AS snr, b.truth_id, round(sqrt(b.d2), 6) AS distance, b.truth_id IS NOT NULL AS is_true
FROM d LEFT JOIN b ON d.det_id = b.det_id AND b.n = 1""")
def truth_match(t):
    out = spatial.truth_match(t.detections, t.truth, 25.0)
    out = rounded(out.select("det_id", "image_id", "snr", "truth_id", "distance", "is_true"), 9, "snr")
    return rounded(out, 6, "distance")


# --- association ---------------------------------------------------------------------------------


@query("association_pairs_once", f"""
SELECT s.sid, o.aid FROM (SELECT sid, ra, dec FROM sources WHERE flags = 0) s LEFT JOIN objects o ON {within(R, 's.ra', 's.dec', 'o.ra0', 'o.dec0')}""")
def association_pairs_once(t):
    clean = t.sources.filter("flags = 0").select("sid", "ra", "dec")
    pairs, unmatched = associate.association_pairs_once(t.objects, clean, R)
    return pairs.select("sid", "aid").unionByName(unmatched.select("sid", F.lit(None).cast("long").alias("aid")))


# At this radius all sources of a part are within reach of each other and of no other part, so
# the first batch of a part starts its objects and every later source joins all of them.
@query("associate_within_field", """
WITH c AS (SELECT field, partkey, sid, mjdobs * 100 + sca AS batch FROM sources WHERE flags = 0),
f AS (SELECT *, min(batch) OVER (PARTITION BY field, partkey) = batch AS is_first FROM c)
SELECT s.field, s.sid AS aid, m.sid FROM f s JOIN f m ON s.field = m.field AND s.partkey = m.partkey
WHERE s.is_first AND (s.sid = m.sid OR NOT m.is_first)""")
def associate_within_field(t):
    return associate.associate_within_field(t.sources.filter("flags = 0"), 3e-5)


def walked(radius: float, known: str = "", sources: str = "SELECT field, sid, ra, dec, mjdobs, expid, sca FROM sources WHERE flags = 0", zone: float = 1.0) -> str:
    """The walk in SQL: a recursion over the batches of all fields, with the objects as its keyed state; ``zone`` is the height of its zones of declination."""
    vec = [f"pow(({p}) - ({q}), 2)" for p, q in zip(sql_vec("s.ra", "s.dec"), sql_vec("o.ra", "o.dec"))]
    return f"""
WITH RECURSIVE src AS (SELECT field, sid, ra, dec, dense_rank() OVER (PARTITION BY field ORDER BY mjdobs, expid, sca) AS step FROM ({sources})),
st(aid, field, ra, dec, n, sids, step) USING KEY (aid) AS (
  {known or "SELECT sid, field, ra, dec, 1e0, [sid], step FROM src WHERE step = 1"}
  UNION
  (WITH once AS (SELECT s.* FROM src s WHERE s.step = (SELECT max(step) + 1 FROM st)),
   now AS (SELECT *, CAST(floor(dec / {zone!r}) AS BIGINT) + unnest([-1, 0, 1]) AS zone FROM once),
   pairs AS (SELECT o.aid, s.sid, s.step, s.ra - o.ra AS dra, s.dec - o.dec AS ddec FROM now s JOIN recurring.st o
     ON s.field = o.field AND s.zone = CAST(floor(o.dec / {zone!r}) AS BIGINT) WHERE {" + ".join(vec)} <= {limit_of(radius)!r}),
   moves AS (SELECT aid, step, list(sid) AS sids, count(*) AS k, sum(ddec) AS ddec,
     sum(CASE WHEN dra > 180 THEN dra - 360 WHEN dra < -180 THEN dra + 360 ELSE dra END) AS dra FROM pairs GROUP BY aid, step)
   SELECT o.aid, o.field, fmod(o.ra + m.dra / (o.n + m.k) + 360, 360), o.dec + m.ddec / (o.n + m.k), o.n + m.k, list_concat(o.sids, m.sids), m.step
     FROM moves m JOIN recurring.st o ON o.aid = m.aid
   UNION ALL SELECT s.sid, s.field, s.ra, s.dec, 1e0, [s.sid], s.step FROM once s WHERE s.sid NOT IN (SELECT sid FROM pairs)))
SELECT field, aid, unnest(sids) AS sid FROM st"""


@query("associate_small_radius", walked(R))
def associate_small_radius(t):
    return associate.associate_within_field(t.sources.filter("flags = 0"), R)


@query("associate_known_objects", walked(R, "SELECT aid, field, ra0 + 3e-6, dec0 - 2e-6, CAST(p_size AS DOUBLE), CAST([] AS BIGINT[]), 0 FROM objects"))
def associate_known_objects(t):
    """Continue from the objects of an earlier run."""
    known = t.objects.selectExpr("aid", "field", "ra0 + 3e-6 AS meanra", "dec0 - 2e-6 AS meandec", "p_size AS nsources")
    return associate.associate_within_field(t.sources.filter("flags = 0"), R, known)


@query("associate_large_groups", walked(R))
def associate_large_groups(t):
    """All groups that need a walk as rounds over the cluster."""
    return associate.associate_within_field(t.sources.filter("flags = 0"), R, max_group_rows=1)


@query("build_objects", """WITH c AS (SELECT field, partkey, sid, ra, dec, fluxfit, mjdobs * 100 + sca AS batch FROM sources WHERE flags = 0),
f AS (SELECT *, min(batch) OVER (PARTITION BY field, partkey) = batch AS is_first FROM c),
m AS (SELECT s.field, s.sid AS aid, m.sid, m.ra, m.dec, m.fluxfit FROM f s JOIN f m ON s.field = m.field AND s.partkey = m.partkey
  WHERE s.is_first AND (s.sid = m.sid OR NOT m.is_first))
SELECT m.aid, m.field, round(s.ra, 7) AS ra0, round(s.dec, 7) AS dec0, s.fluxfit AS flux0, count(*) AS nsources, round(avg(m.dec), 7) AS meandec,
  round(sum(m.fluxfit), 3) AS sumflux FROM m JOIN c s ON m.aid = s.sid GROUP BY m.aid, m.field, s.ra, s.dec, s.fluxfit""")
def build_objects(t):
    """Associate, then make the object table of the merges."""
    clean = t.sources.filter("flags = 0")
    out = associate.build_objects(associate.associate_within_field(clean, 3e-5).select("aid", "sid"), clean)
    return rounded(rounded(out.select("aid", "field", "ra0", "dec0", "flux0", "nsources", "meandec", (F.col("meanflux") * F.col("nsources")).alias("sumflux")), 7, "ra0", "dec0", "meandec"), 3, "sumflux")


@query("associate_dense_months", walked(R / 4, sources="SELECT 1 AS field, sid, ra, dec, floor(mjdobs / 30) AS mjdobs, 0 AS expid, 0 AS sca FROM dense_sources", zone=1e-5))
def associate_dense_months(t):
    """One crowded field, all sources of thirty days as one batch: a single group that the walk takes level by level."""
    months = t.dense_sources.selectExpr("sid", "1 AS field", "0 AS expid", "0 AS sca", "CAST(floor(mjdobs / 30) AS DOUBLE) AS mjdobs", "ra", "dec")
    return associate.associate_within_field(months, R / 4)


@query("associate_dense_field")
def associate_dense_field(t):
    crowded = t.dense_sources.withColumn("field", F.lit(1)).select("sid", "field", "expid", "sca", "mjdobs", "ra", "dec")
    return associate.associate_within_field(crowded, R / 4)


@query("associate_across_fields", f"""
WITH z AS (SELECT sid, ra, dec, flags, zone, CASE WHEN zone IN (0, 89) THEN 1 ELSE CAST(floor(180e0 * cos(radians(zone * 2e0 - 89e0))) AS BIGINT) END AS n
   FROM (SELECT *, CAST(floor((dec + 90) / 2) AS BIGINT) AS zone FROM sources)),
f AS (SELECT sid, ra, dec, flags, {TILE_OF.format(ra='ra')} AS tile FROM z),
zo AS (SELECT aid, ra0, dec0, zone, CASE WHEN zone IN (0, 89) THEN 1 ELSE CAST(floor(180e0 * cos(radians(zone * 2e0 - 89e0))) AS BIGINT) END AS n
   FROM (SELECT *, CAST(floor((dec0 + 90) / 2) AS BIGINT) AS zone FROM objects)),
g AS (SELECT aid, ra0, dec0, {TILE_OF.format(ra='ra0')} AS tile FROM zo)
SELECT g.tile AS field, aid, sid FROM f JOIN g ON {within(0.02, 'ra', 'dec', 'ra0', 'dec0')} WHERE f.tile <> g.tile AND flags = 0""")
def associate_across_fields(t):
    s = tiles.point_to_tile(t.sources.filter("flags = 0").select("sid", "ra", "dec"), t.tiles, h=2.0)
    o = tiles.point_to_tile(t.objects.select("aid", F.col("ra0").alias("meanra"), F.col("dec0").alias("meandec")), t.tiles, ("meanra", "meandec"), h=2.0)
    return associate.associate_across_fields(o, s, tiles.tile_neighbors(t.tiles, 2.0), 0.02)


@query("friends_of_friends", f"""
WITH RECURSIVE p AS (SELECT partkey * 100 + (sid // 100000000) % 100 AS g, sid, ra, dec FROM sources),
e AS (SELECT a.sid AS a, b.sid AS b FROM p a JOIN p b ON {within(R, 'a.ra', 'a.dec', 'b.ra', 'b.dec')}),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
SELECT a AS sid, min(b) AS "group" FROM reach GROUP BY a""")
def friends_of_friends(t):
    return associate.friends_of_friends(t.sources.select("sid", "ra", "dec"), "sid", R)


# --- tiles from the data -------------------------------------------------------------------------

QUADTREE = """WITH l AS (SELECT unnest(range(0, 9)) AS level),
n AS (SELECT level, CAST(floor(ra0 / (90e0 / pow(2, level))) AS BIGINT) AS ix, CAST(floor((dec0 + 90) / (90e0 / pow(2, level))) AS BIGINT) AS iy, count(*) AS n FROM objects, l GROUP BY ALL),
sp AS (SELECT level, ix, iy FROM n WHERE n > 40 AND level < 8),
c AS (SELECT level + 1 AS level, ix * 2 + i AS ix, iy * 2 + j AS iy FROM sp, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j)
  UNION ALL SELECT 0, i, j FROM (SELECT unnest([0, 1, 2, 3]) AS i), (SELECT unnest([0, 1]) AS j)),
q AS (SELECT c.level * 281474976710656 + c.iy * 16777216 + c.ix AS rtid, c.level, coalesce(n.n, 0) AS n, c.ix * 90e0 / pow(2, c.level) AS ramin, (c.ix + 1) * 90e0 / pow(2, c.level) AS ramax,
  c.iy * 90e0 / pow(2, c.level) - 90 AS decmin, (c.iy + 1) * 90e0 / pow(2, c.level) - 90 AS decmax, (c.iy + 0.5e0) * 90e0 / pow(2, c.level) - 90 AS cdec
  FROM c LEFT JOIN n ON n.level = c.level AND n.ix = c.ix AND n.iy = c.iy WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.level = c.level AND sp.ix = c.ix AND sp.iy = c.iy))
"""


def _quadtree(t):
    from ..operators.quadtree import quadtree_tiles as op

    return op(t.objects, 40, 8, ("ra0", "dec0"))


@query("quadtree_tiles", QUADTREE + "SELECT rtid, CAST(level AS INT) AS level, n, ramin, ramax, decmin, decmax, cdec FROM q")
def quadtree_tiles(t):
    return _quadtree(t).drop("ix", "iy")


@query("quadtree_neighbors", QUADTREE + """SELECT a.rtid, b.rtid AS neighbor FROM q a JOIN q b ON a.rtid <> b.rtid AND a.decmin <= b.decmax AND b.decmin <= a.decmax
  AND (a.ramin <= b.ramax AND b.ramin <= a.ramax OR a.ramin = 0 AND b.ramax = 360 OR b.ramin = 0 AND a.ramax = 360)""")
def quadtree_neighbors(t):
    from ..operators.quadtree import quadtree_neighbors as op

    return op(_quadtree(t))


@query("quadtree_dec_bins", QUADTREE + "SELECT cdec, count(*) AS nrabins, CAST(row_number() OVER (ORDER BY cdec) AS INT) AS dbid FROM q GROUP BY cdec")
def quadtree_dec_bins(t):
    return tiles.tile_dec_bins(_quadtree(t))


# --- moving objects --------------------------------------------------------------------------------

MOVING = """m AS (SELECT aid AS ss_id, 49800e0 + aid % 900 AS start_mjd, ra0 AS start_ra, dec0 AS start_dec, 50200e0 + aid % 900 AS stop_mjd,
  (ra0 + 2e-2) % 360 AS stop_ra, dec0 + 1e-2 AS stop_dec FROM objects)"""


def _along(axis):
    a, b = sql_vec("start_ra", "start_dec")[axis], sql_vec("stop_ra", "stop_dec")[axis]
    return f"(({a}) + (s.mjdobs - start_mjd) / (stop_mjd - start_mjd) * (({b}) - ({a})))"


@query("moving_object_matches", f"""WITH {MOVING},
p AS (SELECT s.sid, m.ss_id, s.ra, s.dec, {_along(0)} AS x, {_along(1)} AS y, {_along(2)} AS z FROM sources s JOIN m
  ON s.mjdobs >= start_mjd AND s.mjdobs < stop_mjd AND s.dec BETWEEN start_dec - 1e-1 AND start_dec + 1e-1),
d AS (SELECT sid, ss_id, """ + " + ".join(f"pow(({v}) - {c} / sqrt(x * x + y * y + z * z), 2)" for v, c in zip(sql_vec("ra", "dec"), "xyz")) + f""" AS c2 FROM p),
b AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY c2, ss_id) AS n FROM d WHERE c2 <= {limit_of(4e-3)!r})
SELECT sid, ss_id, round({sql_deg('c2')}, 8) AS dist_deg FROM b WHERE n = 1""")
def moving_object_matches(t):
    """Objects that drift away from where each part's sources lie, within four thousandths of a degree at the source's own time."""
    from ..operators.moving import moving_object_matches as op

    moving = t.objects.selectExpr("aid AS ss_id", "49800D + aid % 900 AS start_mjd", "ra0 AS start_ra", "dec0 AS start_dec", "50200D + aid % 900 AS stop_mjd",
                                  "pmod(ra0 + 2e-2D, 360D) AS stop_ra", "dec0 + 1e-2D AS stop_dec")
    return rounded(op(t.sources.select("sid", "mjdobs", "ra", "dec"), moving, 4e-3), 8, "dist_deg")
