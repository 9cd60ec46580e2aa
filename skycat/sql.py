"""The library from SQL text.

``register(spark)`` adds scalar functions, which are SQL expressions and so stay inside code generation, and table functions that take
any table: their result has the table's own columns and one more.  The table functions see one row at a time in Python; for whole
catalogues the DataFrame operators (``spatial``, ``versions``) are the faster way to the same results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, SkipRestOfInputTableException

from .functions.naming import FIRST_YEAR, LAST_SEQUENCE_INDEX, LAST_YEAR, OUT_OF_RANGE, UNSUPPORTED_YEAR
from .functions.photometry import MAG_ERROR_FACTOR

_LETTERS = ", ".join(f"char(97 + pmod((seq - 1) div {26 ** k}, 26))" for k in range(6, -1, -1))

# name: (parameters, result, expression)
SCALARS = {
    "sky_distance": ("ra1 DOUBLE, dec1 DOUBLE, ra2 DOUBLE, dec2 DOUBLE", "DOUBLE",
                     "degrees(2 * asin(least(1D, sqrt(pow(sin(radians(dec1 - dec2) / 2), 2) + cos(radians(dec1)) * cos(radians(dec2)) * pow(sin(radians(ra1 - ra2) / 2), 2)))))"),
    "in_cone": ("ra DOUBLE, dec DOUBLE, ra0 DOUBLE, dec0 DOUBLE, radius DOUBLE", "BOOLEAN",
                "dec BETWEEN dec0 - radius - 1e-9D AND dec0 + radius + 1e-9D AND pow(sin(radians(dec - dec0) / 2), 2) "
                "+ cos(radians(dec)) * cos(radians(dec0)) * pow(sin(radians(ra - ra0) / 2), 2) <= pow(sin(radians(radius) / 2), 2)"),
    "mag_from_flux": ("flux DOUBLE, zero_point DOUBLE", "DOUBLE", "CASE WHEN flux > 0 THEN -2.5D * log10(flux) + zero_point END"),
    "mag_error": ("flux DOUBLE, flux_error DOUBLE", "DOUBLE", f"CASE WHEN flux <> 0 THEN {MAG_ERROR_FACTOR}D * flux_error / flux END"),
    "signal_to_noise": ("flux DOUBLE, flux_error DOUBLE", "DOUBLE", "CASE WHEN flux_error <> 0 THEN flux / flux_error END"),
    "flux_from_mag": ("mag DOUBLE, zero_point DOUBLE", "DOUBLE", "pow(10D, -0.4D * (mag - zero_point))"),
    "mjd_to_jd": ("mjd DOUBLE", "DOUBLE", "mjd + 2400000.5D"),
    "has_bit": ("flags BIGINT, bit INT", "BOOLEAN", "shiftright(flags, bit) & 1 = 1"),
    "file_basename": ("path STRING", "STRING", "nullif(regexp_extract(path, '.+/(.+)', 1), '')"),
    "alert_name": ("yr INT, seq BIGINT, prefix STRING", "STRING",
                   f"CASE WHEN yr NOT BETWEEN {FIRST_YEAR} AND {LAST_YEAR} THEN '{UNSUPPORTED_YEAR}' WHEN seq - 1 > {LAST_SEQUENCE_INDEX} THEN '{OUT_OF_RANGE}' "
                   f"ELSE concat(prefix, lpad(CAST(yr AS STRING), 2, '0'), {_LETTERS}) END"),
}


@dataclass
class _Places(AnalyzeResult):
    """Places of columns, handed from the analysis to the rows."""

    first: int = -1
    second: int = -1


def _table(argument: AnalyzeArgument) -> T.StructType:
    if not argument.isTable:
        raise ValueError("the first argument is a table: TABLE(...)")
    return argument.dataType


def _place(schema: T.StructType, argument: AnalyzeArgument | None, default: str) -> int:
    name = default if argument is None else argument.value
    if name not in schema.names:
        raise ValueError(f"the table has no column {name}")
    return schema.names.index(name)


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    if name in schema.names:
        raise ValueError(f"the table has a column {name} already")
    return T.StructType([*schema.fields, T.StructField(name, kind)])


class ConeSearch:
    """``cone_search(TABLE(t), ra, dec, radius [, ra_column => 'ra'] [, dec_column => 'dec'])``: rows within the radius, with dist_deg."""

    def __init__(self, places: _Places):
        self.ra, self.dec = places.first, places.second

    @staticmethod
    def analyze(rows: AnalyzeArgument, ra: AnalyzeArgument, dec: AnalyzeArgument, radius: AnalyzeArgument, ra_column: AnalyzeArgument | None = None,
                dec_column: AnalyzeArgument | None = None) -> _Places:
        schema = _table(rows)
        return _Places(_with(schema, "dist_deg", T.DoubleType()), first=_place(schema, ra_column, "ra"), second=_place(schema, dec_column, "dec"))

    def eval(self, row, ra, dec, radius, ra_column=None, dec_column=None):
        ra1, dec1 = row[self.ra], row[self.dec]
        if None in (ra1, dec1, ra, dec, radius):
            return
        dec1, dec0 = math.radians(dec1), math.radians(float(dec))
        h = math.sin((dec1 - dec0) / 2) ** 2 + math.cos(dec1) * math.cos(dec0) * math.sin(math.radians(ra1 - float(ra)) / 2) ** 2
        if h <= math.sin(math.radians(float(radius)) / 2) ** 2:
            yield (*row, math.degrees(2 * math.asin(min(1.0, math.sqrt(h)))))


class FirstRows:
    """``first_rows(TABLE(t) PARTITION BY (key) ORDER BY (distance, id), k)``: the first k rows of each key, with their rank: the nearest ones."""

    def __init__(self):
        self.rank = 0

    @staticmethod
    def analyze(rows: AnalyzeArgument, k: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(_with(_table(rows), "rank", T.IntegerType()))

    def eval(self, row, k):
        if self.rank >= k:
            raise SkipRestOfInputTableException  # the key's other rows are not looked at
        self.rank += 1
        yield (*row, self.rank)


class BestVersions:
    """``best_versions(TABLE(t) PARTITION BY (key) ORDER BY (is_locked DESC, version DESC))``: with vbest, 2 for locked versions, else 1 for the newest, else 0."""

    def __init__(self, places: _Places):
        self.locked, self.seen = places.first, False

    @staticmethod
    def analyze(rows: AnalyzeArgument, locked_column: AnalyzeArgument | None = None) -> _Places:
        schema = _table(rows)
        return _Places(_with(schema, "vbest", T.IntegerType()), first=_place(schema, locked_column, "is_locked"))

    def eval(self, row, locked_column=None):
        vbest = 2 if row[self.locked] else 0 if self.seen else 1
        self.seen = True
        yield (*row, vbest)


TABLES = {"cone_search": ConeSearch, "first_rows": FirstRows, "best_versions": BestVersions}


def register(spark: SparkSession) -> list[str]:
    """Add all functions to the session; returns their names."""
    for name, (parameters, result, expression) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {expression}")
    for name, handler in TABLES.items():
        spark.udtf.register(name, F.udtf(handler))
    return [*SCALARS, *TABLES]
