"""Registered queries in SQL text only, through the functions of ``skycat.sql``."""

from __future__ import annotations

import re
import uuid

from ..sql import register
from .fixtures import BASE, FIXTURES
from .queries_images import VERSIONED
from .queries_sky import limit_of, sql_chord2, sql_deg
from .registry import query


def run(t, text: str):
    """The SQL text over views of the tables and fixtures that it names."""
    register(t.spark)
    tag = uuid.uuid4().hex
    names = [n for n in (*FIXTURES, *BASE) if re.search(rf"\b{n}\b", text)]
    for n in names:
        getattr(t, n).createOrReplaceTempView(f"{n}_{tag}")
        text = re.sub(rf"\b{n}\b", f"{n}_{tag}", text)
    out = t.spark.sql(text)
    for n in names:
        t.spark.catalog.dropTempView(f"{n}_{tag}")
    return out


@query("sql_cone_search", f"SELECT sid, ra, dec, round({sql_deg(sql_chord2('ra', 'dec', '180e0', '10e0'))}, 9) AS dist_deg FROM sources "
       f"WHERE {sql_chord2('ra', 'dec', '180e0', '10e0')} <= {limit_of(20.0)!r}")
def sql_cone_search(t):
    return run(t, "SELECT sid, ra, dec, round(dist_deg, 9) AS dist_deg FROM cone_search(TABLE(SELECT sid, ra, dec FROM sources), 180.0D, 10.0D, 20.0D)")


@query("sql_nearest", f"""SELECT aid, sid, d, CAST(n AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY aid ORDER BY d, sid) AS n FROM
  (SELECT o.aid, s.sid, round({sql_deg(sql_chord2('s.ra', 's.dec', 'o.ra0', 'o.dec0'))}, 8) AS d FROM sources s JOIN objects o ON s.partkey = o.aid)) WHERE n <= 3""")
def sql_nearest(t):
    """The three sources of each object that lie nearest to it."""
    return run(t, """SELECT aid, sid, d, rank FROM first_rows(TABLE(SELECT o.aid, s.sid, round(sky_distance(s.ra, s.dec, o.ra0, o.dec0), 8) AS d
  FROM sources s JOIN objects o ON s.partkey = o.aid) PARTITION BY (aid) ORDER BY (d, sid), 3)""")


@query("sql_versions", VERSIONED + """
SELECT rid, expid, version, CASE WHEN is_locked THEN 2
  WHEN NOT max(is_locked) OVER (PARTITION BY expid) AND version = max(version) OVER (PARTITION BY expid) THEN 1 ELSE 0 END AS vbest
FROM v""")
def sql_versions(t):
    return run(t, """SELECT rid, expid, version, vbest FROM best_versions(TABLE(SELECT o_orderkey AS rid, o_custkey AS expid, o_orderpriority = '1-URGENT' AS is_locked,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version FROM orders) PARTITION BY (expid) ORDER BY (is_locked DESC, version DESC))""")


@query("sql_scalars", """SELECT s.sid, round(-2.5 * log10(s.fluxfit) + 25, 9) AS mag, round(1.085736205 * s.fluxerr / s.fluxfit, 9) AS mag_err,
  round(CASE WHEN s.fluxerr - 1 <> 0 THEN s.fluxfit / (s.fluxerr - 1) END, 9) AS snr, round(pow(10e0, -0.4 * (s.id - 25)) / 1e9, 9) AS flux, s.mjdobs + 2400000.5 AS jd,
  (s.pid >> 2) & 1 = 1 AS bit2, regexp_extract(f.filename, '.+/(.+)', 1) AS basename,
  pow(s.ra - 180, 2) < 400 AND s.dec BETWEEN -20 AND 20 AND """ + f"{sql_chord2('s.ra', 's.dec', '180e0', '0e0')} <= {limit_of(19.0)!r}" + """ AS near,
  CASE WHEN 22 + s.pid % 15 < 24 OR 22 + s.pid % 15 > 34 THEN 'notsupported' WHEN s.pid * 700001 > 8031810175 THEN 'idoutofrange'
  ELSE concat('SKY', CAST(22 + s.pid % 15 AS VARCHAR), """ + ", ".join(f"chr(CAST(97 + (s.pid * 700001 // {26 ** k}) % 26 AS INT))" for k in range(6, -1, -1)) + """) END AS alertname
  FROM sources s JOIN l2files f ON s.pid = f.rid""")
def sql_scalars(t):
    return run(t, """SELECT s.sid, round(mag_from_flux(s.fluxfit, 25), 9) AS mag, round(mag_error(s.fluxfit, s.fluxerr), 9) AS mag_err,
  round(signal_to_noise(s.fluxfit, s.fluxerr - 1), 9) AS snr, round(flux_from_mag(s.id, 25) / 1e9D, 9) AS flux, mjd_to_jd(s.mjdobs) AS jd, has_bit(s.pid, 2) AS bit2,
  file_basename(f.filename) AS basename, in_cone(s.ra, s.dec, 180, 0, 19) AS near, alert_name(CAST(22 + s.pid % 15 AS INT), s.pid * 700001 + 1, 'SKY') AS alertname
  FROM sources s JOIN l2files f ON s.pid = f.rid""")
