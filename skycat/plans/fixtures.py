"""Survey tables derived from the driver's tables.

Each fixture is a projection (and filter) of another table, written once in expressions that
Spark SQL and the checking SQL share; only the spelling of a few functions differs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import small_methods

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations").split()


# {day:c}: days since 1970-01-01.  {int:x}: whole part of a quotient.  {sec:c}: seconds since 1970.
SPARK = {"day": "datediff({0}, DATE '1970-01-01')", "int": "CAST(floor({0}) AS BIGINT)",
         "sec": "CAST(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {0}) / 1000000.0 AS DOUBLE)"}
CHECK = {"day": "datediff('day', DATE '1970-01-01', CAST({0} AS DATE))", "int": "CAST(floor({0}) AS BIGINT)",
         "sec": "(epoch_us({0}) / 1000000.0)"}


def _spell(text: str, dialect: dict[str, str]) -> str:
    pattern = re.compile(r"\{(day|int|sec):([^{}]*)\}")
    while pattern.search(text):
        text = pattern.sub(lambda m: dialect[m[1]].format(m[2]), text)
    return text


# name: (table, expressions, filter)
FIXTURES: dict[str, tuple[str, str, str | None]] = {}


def fixture(name: str, table: str, exprs: str, where: str | None = None) -> None:
    FIXTURES[name] = (table, " ".join(exprs.split()), where)


def _split(exprs: str) -> list[str]:
    """Split at the commas outside brackets."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(exprs):
        depth += ch in "({"
        depth -= ch in ")}"
        if ch == "," and depth == 0:
            parts.append(exprs[start:i].strip())
            start = i + 1
    return parts + [exprs[start:].strip()]


class Catalog:
    """Driver tables and fixtures as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        small_methods(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name == "grid_ids":
            return self.spark.range(0, 16380).toDF("id")
        if name not in FIXTURES:
            raise AttributeError(name)
        table, exprs, where = FIXTURES[name]
        df = getattr(self, table)
        if where:
            df = df.where(_spell(where, SPARK))
        return df.selectExpr(*[_spell(e, SPARK) for e in _split(exprs)])


def with_fixtures(sql: str) -> str:
    """Put the fixtures a query names in front of it as common table expressions."""
    ctes: dict[str, str] = {}

    def need(text: str) -> None:
        for word in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text):
            if word in FIXTURES and word not in ctes:
                table, exprs, where = FIXTURES[word]
                need(table)
                source = "(SELECT range AS id FROM range(0, 16380))" if table == "grid_ids" else table
                body = f"SELECT {_spell(exprs, CHECK)} FROM {source}"
                if where:
                    body += f" WHERE {_spell(where, CHECK)}"
                ctes[word] = f"{word} AS ({body})"

    sql = _spell(sql.strip().rstrip(";"), CHECK)
    need(sql)
    if not ctes:
        return sql
    recursive = bool(re.match(r"WITH\s+RECURSIVE\b", sql, re.I))
    rest = re.sub(r"^WITH(\s+RECURSIVE)?\s", ",\n", sql, count=1, flags=re.I)
    if rest == sql:
        rest = "\n" + sql
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes.values()) + rest


POSITION = """
  CAST({k} * 7919 % 360000 AS DOUBLE) / 1000.0 AS {ra},
  CAST({k} * 104729 % 120000 - 60000 AS DOUBLE) / 1000.0 AS {dec}"""

# --- objects and sources -------------------------------------------------------------
fixture("objects_at", "part", "p_partkey AS aid, p_size, p_retailprice AS flux0,"
        + POSITION.format(k="p_partkey", ra="ra0", dec="dec0"))
fixture("objects", "objects_at", "*, CAST({int:dec0 + 90} * 360 + {int:ra0} AS BIGINT) AS field")
fixture("source_rows", "lineitem", """
  (l_orderkey * 8 + l_linenumber) * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) % 10000 * 10000
      + {day:l_shipdate} % 10000 AS sid,
  CAST(l_linenumber AS INT) AS id, l_orderkey AS pid, l_partkey AS partkey, l_linestatus = 'F' AS isdiffpos,
  CAST({day:l_shipdate} AS INT) AS expid, CAST(40587 + {day:l_shipdate} AS DOUBLE) AS mjdobs,
  CAST(l_linenumber % 8 + 1 AS SMALLINT) AS fid, CAST(l_suppkey % 18 + 1 AS SMALLINT) AS sca,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flags,
  l_extendedprice AS fluxfit, l_quantity AS fluxerr,
  CAST(l_partkey * 7919 % 360000 AS DOUBLE) / 1000.0
     + CAST((l_orderkey * 31 + l_linenumber * 17) % 2001 - 1000 AS DOUBLE) * 1.0314159265e-8 AS ra_jit,
  CAST(l_partkey * 104729 % 120000 - 60000 AS DOUBLE) / 1000.0
     + CAST((l_orderkey * 13 + l_linenumber * 29) % 2001 - 1000 AS DOUBLE) * 1.0314159265e-8 AS dec,
  CAST((l_orderkey * 37 + l_linenumber * 911 + l_suppkey * 13) % 40880 AS DOUBLE) / 10.0 AS xfit,
  CAST((l_orderkey * 53 + l_linenumber * 577 + l_suppkey * 29) % 40880 AS DOUBLE) / 10.0 AS yfit,
  l_discount * 50 + 0.5 AS redchi, 1 + l_tax * 20 AS elong, 0.3 + l_discount * 10 AS apfluxratio,
  l_extendedprice / l_quantity AS peak, l_discount AS sharpness, l_tax - 0.04 AS roundness1,
  CAST(l_linenumber * 7 AS INT) AS npix, l_shipdate AS dateobs, CAST(l_suppkey AS BIGINT) AS suppkey""")
fixture("source_positions", "source_rows", "*, (ra_jit + 360e0) % 360e0 AS ra")
fixture("sources", "source_positions", """
  sid, id, pid, partkey, isdiffpos, expid, mjdobs, fid, sca, flags, fluxfit, fluxerr, ra, dec,
  xfit, yfit, redchi, elong, apfluxratio, peak, sharpness, roundness1, npix, dateobs, suppkey,
  CAST({int:dec + 90} * 360 + {int:ra} AS BIGINT) AS field""")
# dense variant: the same jitter on positions packed closely, for many-to-many matches
fixture("dense_objects", "objects", "aid, ra0 / 100000.0 + 180.0 AS ra0, dec0 / 100000.0 AS dec0")
fixture("dense_sources", "source_rows", """sid, partkey, fid, mjdobs, expid, sca,
  CAST(partkey * 7919 % 360000 AS DOUBLE) / 100000000.0 + 180.0
     + (ra_jit - CAST(partkey * 7919 % 360000 AS DOUBLE) / 1000.0) AS ra,
  CAST(partkey * 104729 % 120000 - 60000 AS DOUBLE) / 100000000.0
     + (dec - CAST(partkey * 104729 % 120000 - 60000 AS DOUBLE) / 1000.0) AS dec""")
fixture("merges", "sources", "partkey AS aid, sid, pid, field")
fixture("repeated_merges", "lineitem", "l_partkey AS aid, l_suppkey AS sid, l_partkey % 97 AS field")

# --- image metadata ------------------------------------------------------------------
fixture("filters", "nation", """CAST(n_nationkey + 1 AS SMALLINT) AS fid,
  CASE n_nationkey WHEN 0 THEN 'F184' WHEN 1 THEN 'H158' WHEN 2 THEN 'J129' WHEN 3 THEN 'K213'
    WHEN 4 THEN 'R062' WHEN 5 THEN 'Y106' WHEN 6 THEN 'Z087' WHEN 7 THEN 'W146' END AS filter""", "n_nationkey < 8")
fixture("l2files", "orders", """o_orderkey AS rid, o_custkey AS expid, CAST(o_custkey % 18 + 1 AS SMALLINT) AS sca,
  CAST(o_orderkey % 8 + 1 AS SMALLINT) AS fid, o_custkey % 97 AS field, o_orderdate AS dateobs,
  CAST(40587 + {day:o_orderdate} AS DOUBLE) AS mjdobs,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 2 WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS vbest,
  CASE WHEN o_totalprice < 20000 THEN 0 ELSE 1 END AS status, o_totalprice / 1000.0 AS exptime,
  CAST(o_orderkey % 16 AS INT) AS infobits, concat('/data/night', CAST(o_custkey % 10 AS VARCHAR(9)), '/img_',
  CAST(o_orderkey AS VARCHAR(20)), '.fits') AS filename""")
CENTRE_RA = "(CAST((o_custkey * 7919 + o_orderkey % 7) % 3600 AS DOUBLE) / 10.0 + CAST(o_orderkey % 11 AS DOUBLE) / 100.0)"
CENTRE_DEC = "(CAST(o_custkey * 104729 % 1200 - 600 AS DOUBLE) / 10.0 + CAST(o_orderkey % 13 AS DOUBLE) / 100.0)"
CORNERS = ",".join(
    f"CASE WHEN {CENTRE_RA} + {dx} < 0 THEN {CENTRE_RA} + {dx} + 360.0 WHEN {CENTRE_RA} + {dx} >= 360.0"
    f" THEN {CENTRE_RA} + {dx} - 360.0 ELSE {CENTRE_RA} + {dx} END AS ra{i}, {CENTRE_DEC} + {dy} AS dec{i}"
    for i, (dx, dy) in enumerate([(0.0, 0.0), (-0.0625, -0.0625), (0.0625, -0.0625), (0.0625, 0.0625), (-0.0625, 0.0625)]))
fixture("l2filemeta", "orders", f"""o_orderkey AS rid, CAST(o_orderkey % 8 + 1 AS SMALLINT) AS fid,
  CAST(o_custkey % 18 + 1 AS SMALLINT) AS sca, CAST(40587 + {{day:o_orderdate}} AS DOUBLE) AS mjdobs, {CORNERS}""")
fixture("exposures", "orders", """o_orderkey AS expid, o_orderdate AS dateobs, o_custkey % 97 AS field,
  CAST(40587 + {day:o_orderdate} AS DOUBLE) AS mjdobs, CAST(o_orderkey % 8 + 1 AS SMALLINT) AS fid,
  o_totalprice / 1000.0 AS exptime, 1 AS status, CAST(o_orderkey % 16 AS INT) AS infobits""")
fixture("diffimages", "orders", f"""o_orderkey AS pid, o_orderkey AS rid, o_custkey AS expid,
  CAST(o_custkey % 18 + 1 AS SMALLINT) AS sca, CAST(o_orderkey % 8 + 1 AS SMALLINT) AS fid, o_custkey % 97 AS field,
  CASE WHEN o_orderkey % 3 = 0 THEN 17 ELSE 15 END AS ppid, o_custkey AS rfid,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS vbest, CASE WHEN o_totalprice < 20000 THEN 0 ELSE 1 END AS status,
  CAST(40587 + {{day:o_orderdate}} AS DOUBLE) + 2400000.5 AS jd, CAST(o_orderkey % 16 AS INT) AS infobitssci, {CORNERS}""")
fixture("refimages", "part", """p_partkey AS rfid, p_partkey % 97 AS field,
  CAST({int:p_partkey / 97} % 8 + 1 AS SMALLINT) AS fid, CASE WHEN {int:p_partkey / 776} % 2 = 0 THEN 15 ELSE 12 END AS ppid,
  {int:p_partkey / 1552} + 1 AS version, CASE WHEN {int:p_partkey / 1552} = 0 THEN 1 ELSE 0 END AS vbest,
  CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1 END AS status, CAST(p_partkey % 16 AS INT) AS infobits,
  concat('ref_', CAST(p_partkey AS VARCHAR(20)), '.fits') AS filename""")
fixture("refimmeta", "part", "p_partkey AS rfid, p_size AS nframes, CAST(p_partkey * 37 % 1000 AS DOUBLE) / 10.0 AS cov5percent")
fixture("refimimages", "lineitem", "l_partkey AS rfid, l_orderkey AS rid")
fixture("psfs", "supplier", """s_suppkey AS psfid, CAST(s_suppkey % 18 + 1 AS SMALLINT) AS sca,
  CAST({int:s_suppkey / 18} % 8 + 1 AS SMALLINT) AS fid, {int:s_suppkey / 144} + 1 AS version,
  CASE WHEN {int:s_suppkey / 144} = 0 THEN 1 ELSE 0 END AS vbest, CASE WHEN s_acctbal < 0 THEN 0 ELSE 1 END AS status,
  concat('psf_', CAST(s_suppkey AS VARCHAR(20)), '.fits') AS filename""")
fixture("swversions", "supplier", "s_suppkey AS svid, s_name AS release")

# --- jobs ----------------------------------------------------------------------------
fixture("jobs", "events", """event_id AS jid, user_id AS rid, CASE WHEN user_id % 2 = 0 THEN 15 ELSE 17 END AS ppid,
  ts AS launched, {sec:ts} AS launched_s, {sec:ts} + 30.0 + value AS started_s,
  CASE WHEN event_type = 'view' THEN NULL ELSE {sec:ts} + 30.0 + value * 11.0 END AS ended_s,
  CASE event_type WHEN 'error' THEN 64 WHEN 'view' THEN NULL WHEN 'purchase' THEN 33 ELSE 0 END AS exitcode,
  CASE event_type WHEN 'error' THEN -1 WHEN 'view' THEN 0 ELSE 1 END AS status""")

# --- schedule ------------------------------------------------------------------------
fixture("segments", "orders", """o_orderkey AS segment_id, o_orderkey % 5 AS program,
  o_orderkey % 3 AS plan, {int:o_orderkey / 3} AS pass, o_orderkey % 7 AS segment, o_orderstatus AS state,
  {sec:o_orderdate} AS start_s, {sec:o_orderdate} + o_totalprice / 2500.0 AS end_s,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice / 1000.0 END AS assigned_orient,
  CAST(o_custkey % 360 AS DOUBLE) AS nominal_orient""")
fixture("exposure_plan", "source_rows", """sid AS exposure_no, fluxerr AS duration, fluxerr - 0.5 AS exposure_time, fid,
  partkey % 5 AS target, pid % 5 AS program, pid % 3 AS plan, {int:pid / 3} AS pass, pid % 7 AS segment, mjdobs""")

# --- pixels --------------------------------------------------------------------------
fixture("pixels", "events", """user_id AS image_id, {int:event_id / 64} AS y, event_id % 64 AS x,
  CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS value""")
fixture("stack_pixels", "events", """CAST(event_id % 7 AS BIGINT) AS image_id, CAST(user_id AS BIGINT) AS y,
  CAST({int:event_id / 7} % 16 AS BIGINT) AS x,
  CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS value, value * 0.1 + 0.2 AS unc,
  {sec:ts} AS t, event_id""")
# a complete grid: 64 columns, one image
fixture("frame", "events", """CAST(0 AS BIGINT) AS image_id, {int:event_id / 64} AS y, event_id % 64 AS x,
  CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS value""")
fixture("ref_frame", "events", """CAST(0 AS BIGINT) AS image_id, {int:event_id / 64} AS y, event_id % 64 AS x,
  CAST(user_id % 40 AS DOUBLE) AS value""")
fixture("cov_frame", "events", """CAST(0 AS BIGINT) AS image_id, {int:event_id / 64} AS y, event_id % 64 AS x,
  CAST(event_id % 9 AS DOUBLE) / 2.0 AS value""")

# --- pixel-space catalogues ----------------------------------------------------------
fixture("sci_catalog", "source_rows", "CAST(suppkey % 50 AS BIGINT) AS image_id, sid AS sci_id, xfit AS x, yfit AS y, fluxfit AS flux")
fixture("ref_catalog", "orders", """o_custkey % 50 AS image_id, o_orderkey AS ref_id,
  CAST(o_orderkey * 7919 % 40880 AS DOUBLE) / 10.0 + 0.05 AS x, CAST(o_orderkey * 104729 % 40880 AS DOUBLE) / 10.0 + 0.05 AS y,
  o_totalprice AS flux, 19 + CAST(o_orderkey % 60 AS DOUBLE) / 10.0 AS mag, CAST(o_orderkey % 11 AS DOUBLE) / 10.0 AS class_star,
  CAST(o_orderkey % 130 AS DOUBLE) AS isoarea, 1 + CAST(o_orderkey % 5 AS DOUBLE) / 10.0 AS awin_bwin,
  CAST(o_orderkey % 37 - 1 AS DOUBLE) / 10.0 AS fwhm""")
fixture("truth", "orders", """o_custkey % 50 AS image_id, o_orderkey AS truth_id,
  CAST(o_orderkey * 7919 % 40880 AS DOUBLE) / 10.0 + 0.05 AS x, CAST(o_orderkey * 104729 % 40880 AS DOUBLE) / 10.0 + 0.05 AS y,
  20 + CAST(o_orderkey % 80 AS DOUBLE) / 10.0 AS mag, CAST(o_orderkey % 8 + 1 AS SMALLINT) AS fid""")
fixture("detections", "source_rows", """CAST(suppkey % 50 AS BIGINT) AS image_id, sid AS det_id, xfit AS x, yfit AS y,
  fluxfit - 20000 AS flux, CASE WHEN fluxerr < 3 THEN 0.0 ELSE fluxerr END AS flux_err, fid""")

# --- sky tiles: zones of 2 degrees, the first tile of a zone crosses the meridian -----
fixture("tile_grid", "grid_ids", """{int:id / 182} AS zone, id % 182 AS k,
  CASE WHEN {int:id / 182} = 0 OR {int:id / 182} = 89 THEN 1
       ELSE {int:180e0 * cos(radians({int:id / 182} * 2e0 - 89e0))} END AS n""")
fixture("tiles", "tile_grid", """zone * 1000 + k + 1 AS rtid,
  CASE WHEN n = 1 THEN 0e0 ELSE 360e0 / n * (k - 5e-1) END AS ramin,
  CASE WHEN n = 1 AND zone = 0 THEN 0e0 WHEN n = 1 THEN 360e0 ELSE 360e0 / n * (k + 5e-1) END AS ramax,
  zone * 2e0 - 90e0 AS decmin, zone * 2e0 - 88e0 AS decmax, zone * 2e0 - 89e0 AS cdec""", "k < n")

# --- requests, classifier scores -------------------------------------------------------
fixture("positions", "customer", """c_custkey AS reqid,
  CAST(c_custkey * 7919 % 360000 AS DOUBLE) / 1000.0 + 0.0000031 AS ra,
  CAST(c_custkey * 104729 % 120000 - 60000 AS DOUBLE) / 1000.0 + 0.0000042 AS dec""")
fixture("scores", "source_rows", """sid AS sample_id, CASE WHEN (partkey + id) % 10 < 3 THEN 1 ELSE 0 END AS y,
  CASE WHEN (partkey + id) % 10 < 3 THEN 0.3 ELSE 0.0 END + CAST(partkey * 31 % 7000 AS DOUBLE) / 10000.0 AS p,
  20 + CAST(partkey % 80 AS DOUBLE) / 10.0 AS mag, fid, fluxfit AS flux, peak, sharpness""")
