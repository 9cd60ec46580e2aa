"""Readers.  Each has a part that works on lines already in a DataFrame, so text that comes
from another system can be parsed without files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas

DETECTOR_DATE = "yyyyMMdd"


def file_path() -> Column:
    """The path of the file a scanned row comes from."""
    return F.col("_metadata.file_path")


def folder_name(path: Column) -> Column:
    """Name of the folder of a file; the value of a partition folder ``name=value``."""
    # cut at the slashes: a pattern that looks for the last folder tries every letter of the path before it
    name = F.substring_index(F.substring_index(F.substring_index(path, "/", -2), "/", 1), "=", -1)
    return F.url_decode(F.when(~path.contains("/"), "").otherwise(name))


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Text files as (file, value)."""
    return spark.read.option("recursiveFileLookup", True).text(path).select(file_path().alias("file"), "value")


def read_numbered_lines(spark: SparkSession, path) -> DataFrame:
    """Small text files (logs, configurations) as (file, line_no, value)."""
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return whole.select(file_path().alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value"))


def read_bundled_lines(spark: SparkSession, path) -> DataFrame:
    """Many small text files bundled in few, as lines ``file<tab>line number<tab>text``, as (file, line_no, value).  Other lines are left out."""
    parts = F.split("value", "\t", 3)
    rows = read_lines(spark, path).filter(F.col("value").rlike("^[^\t]+\t[0-9]+\t"))
    return rows.select(parts[0].alias("file"), parts[1].cast("long").alias("line_no"), parts[2].alias("value"))


def parameter_names(lines: list[str]) -> list[str]:
    """Column names of a catalogue from its parameter file: ``FLUX_RADIUS(1)`` is FLUX_RADIUS_1."""
    return [line.strip().replace("(", "_").replace(")", "") for line in lines if line.strip()]


def parse_ascii_catalog(lines: DataFrame, names: list[str], wanted: dict[str, str], corrupt: str | None = None) -> DataFrame:
    """Wanted columns (name: type) of whitespace-separated lines; lines starting with # are skipped.

    Other columns of ``lines`` are kept.  ``corrupt`` names a column for the text of lines that have too few or too many values, or a
    wanted value that is not of its type; it is null for good lines.
    """
    keep = [c for c in lines.columns if c != "value"]
    token = F.split(F.trim("value"), r"\s+")
    rows = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select(*keep, "value", token.alias("__t"))
    found = {n: F.get("__t", F.lit(names.index(n))).try_cast(kind) for n, kind in wanted.items()}
    out = [c.alias(n) for n, c in found.items()]
    if corrupt:
        bad = F.size("__t") != len(names)
        for c in found.values():
            bad = bad | c.isNull()
        out.append(F.when(bad, F.col("value")).alias(corrupt))
    return rows.select(*keep, *out)


def read_ascii_catalog(spark: SparkSession, path, names: list[str], wanted: dict[str, str], corrupt: str | None = None) -> DataFrame:
    return parse_ascii_catalog(read_lines(spark, path), names, wanted, corrupt)


def join_catalog_pair(main: DataFrame, finder: DataFrame, meta: DataFrame, keys: list[str]) -> DataFrame:
    """Main and finder catalogues joined on their keys and id, with table names and image metadata.

    ``meta``: pid and the image columns of each detection run; pid must be one of ``keys``.
    """
    both = main.join(finder, [*keys, "id"]).withColumnsRenamed(schemas.CATALOG_RENAMES)
    return both.join(meta, "pid")


def parse_positions(lines: DataFrame) -> DataFrame:
    """Request lines ``reqid,ra,dec``."""
    row = F.from_csv("value", schemas.POSITIONS)
    return lines.filter(~F.col("value").startswith("#")).select(row.alias("r")).select("r.*").filter("reqid IS NOT NULL")


def read_positions(spark: SparkSession, path, corrupt: str | None = None) -> DataFrame:
    """Request files; ``corrupt`` names a column for the text of lines that cannot be read as a request."""
    if corrupt is None:
        return spark.read.schema(schemas.POSITIONS).option("comment", "#").csv(path)
    schema = f"{schemas.POSITIONS}, {corrupt} string"
    return spark.read.schema(schema).option("comment", "#").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).csv(path)


def parse_injections(documents: DataFrame, value: str = "value") -> DataFrame:
    """JSON documents id -> source as rows, parameters as columns."""
    keep = [c for c in documents.columns if c != value]
    rows = documents.select(*keep, F.explode(F.from_json(value, schemas.INJECTIONS)).alias("id", "s"))
    return rows.select(*keep, "id", "s.type", "s.ra", "s.dec", "s.parameters.*")


def read_injections(spark: SparkSession, path) -> DataFrame:
    """JSON files, a document each, with the file of each source."""
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return parse_injections(whole.select(file_path().alias("file"), "value"))


def program_of_file(path: Column) -> Column:
    """Program number: the first three digits in a row in the file name."""
    return F.regexp_extract(F.substring_index(path, "/", -1), r"(\d{3})", 1).try_cast("int")


def parse_exposure_plan(lines: DataFrame, names: list[str], wanted: dict[str, str]) -> DataFrame:
    """Space-separated exposure tables (file, value) of many programs in one table.

    The header line and # lines are skipped; ``<no name>`` is one token.
    """
    # the lines are chosen before they are changed, and the patterns only tried where they can match
    header = F.trim("value").startswith(names[0]) & (F.split(F.trim("value"), r"\s+", 2)[0] == names[0])
    text = F.when(F.col("value").contains(" <no name>"), F.regexp_replace("value", r" <no name>\s*$", " <no_name>")).otherwise(F.col("value"))
    body = lines.filter(~header & ~F.col("value").startswith("#") & (F.trim("value") != "")).withColumn("value", text)
    return parse_ascii_catalog(body, names, wanted).withColumn("program", program_of_file(F.col("file"))).drop("file")


def parse_segments(rows: DataFrame) -> DataFrame:
    """Segment schedule rows (visit_id, start, end, duration, orientations) with typed columns."""
    from ..functions.naming import visit_id_parts
    from ..functions.times import doy_timestamp

    return (rows.withColumns(visit_id_parts("visit_id"))
            .withColumns({"segment_start": doy_timestamp("start").cast("timestamp_ntz"), "segment_end": doy_timestamp("end").cast("timestamp_ntz"),
                          "pa": F.coalesce("assigned_orient", "nominal_orient")})
            .drop("start", "end", "assigned_orient", "nominal_orient"))


def read_segment_schedule(spark: SparkSession, path) -> DataFrame:
    """Segment schedule CSV with a header; NA is no value."""
    raw = spark.read.option("header", True).option("nullValue", "NA").csv(path)
    rows = raw.select(F.col("`visit-id`").alias("visit_id"), "start", "end", F.col("duration").cast("double").alias("duration"),
                      F.col("`assigned orient`").cast("double").alias("assigned_orient"),
                      F.col("`nominal orient`").cast("double").alias("nominal_orient"))
    return parse_segments(rows)


def read_checksums(spark: SparkSession, path, by_folder: bool = False) -> DataFrame:
    """File name and md5 of the content of every file; ``by_folder`` takes the name of a file's folder for its own."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = folder_name(F.col("path")) if by_folder else F.substring_index("path", "/", -1)
    return files.select(name.alias("filename"), F.md5("content").alias("md5"))
