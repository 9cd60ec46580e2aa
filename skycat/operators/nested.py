"""Nested products: light curves per object and alert packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.photometry import snr
from ..session import cut_lineage
from .objects import recent_detections

# Filters with a summary block in the object record.
SUMMARY_FILTERS = ["F062", "F087", "F106", "F129", "F146", "F158", "F184", "F213"]

SUMMARY_FIELDS = {"PsfFluxMean": "double", "PsfFluxSigma": "double", "PsfFluxNdata": "int", "PsfFluxMin": "double",
                  "PsfFluxMax": "double"}

# Fixed format: fields of the records in order, with their types.
SOURCE_RECORD = """diaSourceId long, visit long, detector int, diaObjectId long, ssObjectId long, parentDiaSourceId long,
    midpointMjdTai double, ra double, dec double, raErr double, decErr double, x double, y double, xErr double, yErr double,
    band string, psfFlux double, psfFluxErr double, snr double, extendedness double, reliability double, flags long,
    apFlux double, apFluxErr double, trailFlux double, trailFluxErr double, trailLength double, trailAngle double,
    scienceFlux double, scienceFluxErr double, templateFlux double, templateFluxErr double, dipoleMeanFlux double,
    dipoleFluxErr double, dipoleLength double, dipoleAngle double, ixx double, iyy double, ixy double, ixxErr double,
    iyyErr double, ixyErr double, pixelFlags_saturated boolean, pixelFlags_bad boolean, pixelFlags_edge boolean,
    pixelFlags_cr boolean, timeProcessedMjdTai double, timeWithdrawnMjdTai double, sca int, field long, hp6 long, hp9 long,
    pid long, expid int, isdiffpos boolean, qfit double, cfit double, redchi double, npixfit int, sharpness double,
    roundness1 double, roundness2 double, peak double"""
FORCED_RECORD = """diaForcedSourceId long, diaObjectId long, visit long, detector int, ra double, dec double, band string,
    psfFlux double, psfFluxErr double, scienceFlux double, scienceFluxErr double, midpointMjdTai double,
    timeProcessedMjdTai double, timeWithdrawnMjdTai double"""

# Source columns that have another name in the record, and values of fields that may not be NULL.
SOURCE_NAMES = {"diaSourceId": "sid", "visit": "expid", "detector": "sca", "midpointMjdTai": "mjdobs", "x": "xfit", "y": "yfit",
                "xErr": "xerr", "yErr": "yerr", "psfFlux": "fluxfit", "psfFluxErr": "fluxerr"}
SOURCE_DEFAULTS = {"visit": 0, "detector": 0, "x": 0.0, "y": 0.0, "flags": 0, "sca": 0, "field": 0, "hp6": 0, "hp9": 0, "pid": 0,
                   "expid": 0, "isdiffpos": True}
# Fields that a source column of the same name fills; other fields of that name in the source table mean something else.
SOURCE_SAME = ("ra dec flags sca field hp6 hp9 pid expid isdiffpos qfit cfit redchi npixfit sharpness roundness1 roundness2 peak").split()
FORCED_NAMES = {"diaForcedSourceId": "forced_id", "diaObjectId": "aid", "visit": "expid", "detector": "sca", "psfFlux": "forcediffimflux",
                "psfFluxErr": "forcediffimfluxunc", "midpointMjdTai": "mjdobs", "timeProcessedMjdTai": "time_processed"}


def _fields(record: str) -> list[tuple[str, str]]:
    return [tuple(f.split()) for f in record.replace("\n", " ").split(",")]


def nest_lightcurves(objects: DataFrame, merges: DataFrame, sources: DataFrame, object_cols: list[str],
                     source_cols: list[str], chunk_days: float | None = 365.25) -> DataFrame:
    """Objects with their sources as a time-ordered array ``nested_lc_data``.

    One row per object and stretch of ``chunk_days`` (column ``chunk``), so that the array of an object
    with very many points stays small enough for one row; None gives one row per object.
    """
    point = F.struct("mjdobs", "sid", *[c for c in source_cols if c not in ("mjdobs", "sid")])
    rows = merges.select("aid", "sid").join(sources.select(*dict.fromkeys(["sid", "mjdobs", *source_cols])), "sid")
    keys = ["aid"]
    if chunk_days is not None:
        rows = rows.withColumn("chunk", F.floor(F.col("mjdobs") / chunk_days))
        keys.append("chunk")
    curves = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("nested_lc_data"))
    return objects.filter(F.col("nsources") > 0).select("aid", *[c for c in object_cols if c != "aid"]).join(curves, "aid")


def unnest_lightcurves(nested: DataFrame) -> DataFrame:
    """One row per point, with its position in the array."""
    others = [c for c in nested.columns if c != "nested_lc_data"]
    return nested.select(*others, F.posexplode("nested_lc_data").alias("pos", "p")).select(*others, "pos", "p.*")


def _optional(columns: list[str], name: str, kind: str) -> Column:
    return (F.col(name) if name in columns else F.lit(None)).cast(kind)


def _source_fields(columns: list[str], aid: Column, band: Column) -> dict[str, Column]:
    """The fields of a source record, in order, from the columns of a source row."""
    made = {"diaObjectId": aid, "band": band, "snr": snr(_optional(columns, "fluxfit", "double"), _optional(columns, "fluxerr", "double"))}
    fields = {}
    for name, kind in _fields(SOURCE_RECORD):
        value = made.get(name)
        if value is None:
            value = _optional(columns, SOURCE_NAMES.get(name, name if name in SOURCE_SAME else ""), kind)
        if name in SOURCE_DEFAULTS:
            value = F.coalesce(value, F.lit(SOURCE_DEFAULTS[name]))
        fields[name] = value.cast(kind)
    return fields


def dia_source(columns: list[str], aid: Column, band: Column) -> Column:
    """Source record as a struct, from the columns of a source row.

    ``columns`` tells which columns exist; fields without one become NULL or their default.
    """
    return F.struct(*[value.alias(name) for name, value in _source_fields(columns, aid, band).items()])


def _own_fields(columns: list[str]) -> list[str]:
    """The fields of a source record that are neither the same for all sources of an object nor known from sid, mjdobs and the other fields."""
    known = ("diaSourceId", "diaObjectId", "midpointMjdTai", "snr")
    return [name for name, _ in _fields(SOURCE_RECORD)
            if name == "band" or name not in known and SOURCE_NAMES.get(name, name if name in SOURCE_SAME else "") in columns]


def _whole_record(own: Column, names: list[str], aid: Column, sid: Column, mjd: Column) -> Column:
    """The source record from its own fields ``names``, its object, id and date."""
    made = _source_fields([], aid, F.lit(None)) | {name: own[name] for name in names} | {"diaSourceId": sid, "midpointMjdTai": mjd}
    if "psfFlux" in names and "psfFluxErr" in names:
        made["snr"] = snr(own["psfFlux"], own["psfFluxErr"])
    return F.struct(*[made[name].cast(kind).alias(name) for name, kind in _fields(SOURCE_RECORD)])


def dia_object(first_mjd: Column, last_mjd: Column, validity_mjd: Column) -> Column:
    """Object record as a struct, from the columns of an object row."""
    null = F.lit(None).cast("double")
    fields = {"diaObjectId": F.col("aid").cast("long"), "ra": F.col("ra0").cast("double"), "dec": F.col("dec0").cast("double"),
              "raErr": null, "decErr": null, "nDiaSources": F.coalesce("nsources", F.lit(0)).cast("int"),
              "firstDiaSourceMjdTai": first_mjd, "lastDiaSourceMjdTai": last_mjd, "validityStartMjdTai": validity_mjd.cast("double")}
    fields.update({band + name: F.lit(None).cast(kind) for band in SUMMARY_FILTERS for name, kind in SUMMARY_FIELDS.items()})
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def dia_forced_source(columns: list[str], ra: Column, dec: Column, band: Column) -> Column:
    """Forced-photometry record as a struct, at the position of its object."""
    made = {"ra": ra, "dec": dec, "band": band,
            "timeProcessedMjdTai": F.coalesce(_optional(columns, "time_processed", "double"), F.col("mjdobs").cast("double"))}
    fields = []
    for name, kind in _fields(FORCED_RECORD):
        value = made.get(name)
        if value is None:
            value = _optional(columns, FORCED_NAMES.get(name, ""), kind)
        if name in ("diaForcedSourceId", "visit", "detector"):
            value = F.coalesce(value, F.lit(0))
        fields.append(value.cast(kind).alias(name))
    return F.struct(*fields)


def with_filter_name(sources: DataFrame, filters: DataFrame) -> DataFrame:
    """Sources with the name of their filter; Spark broadcasts the filters if they are as few as they should be."""
    return sources.join(filters.select("fid", F.col("filter").alias("filter_name")), "fid")


def assemble_alerts(triggers: DataFrame, merges: DataFrame, objects: DataFrame, sources: DataFrame, filters: DataFrame,
                    days: float = 365.25, forced: DataFrame | None = None, until_trigger: bool = False) -> DataFrame:
    """Alert packets of all triggering sources in one plan.

    ``triggers``: sid of the new sources.  A source in several objects is reported with the
    smallest aid, one in none with a NULL object.  History is cut to the objects and dates asked for and
    listed once for each object, as the fields that differ from source to source; each trigger takes its
    part of the list of its object, and only the packets hold whole records.  So what is shuffled grows with the
    sources, not with the pairs of trigger and detection.  ``forced``: aid, forced_id, mjdobs, fid and the flux
    columns of forced photometry; its rows from ``days`` before the trigger on follow in time order.
    """
    asked_sids = cut_lineage(triggers.select("sid").distinct())
    columns = [*sources.columns, "filter_name"]
    names, fields = _own_fields(columns), _source_fields(columns, F.lit(None), F.col("filter_name"))
    records = with_filter_name(sources, filters).select("sid", "mjdobs", F.struct(*[fields[n].alias(n) for n in names]).alias("r"))
    owner = merges.select("aid", "sid").join(asked_sids, "sid", "left_semi").groupBy("sid").agg(F.min("aid").alias("aid"))
    # ids and dates of the triggers, read again by each of the next steps
    rows = cut_lineage(records.select("sid", F.col("mjdobs").alias("trigger_mjd")).join(asked_sids, "sid", "left_semi").join(owner, "sid", "left_outer"))
    packet = (records.withColumnRenamed("mjdobs", "trigger_mjd")
              .join(rows.groupBy("sid").agg(F.min("aid").alias("aid"), F.collect_list("trigger_mjd").alias("__dates")), "sid"))

    asked = rows.filter(F.col("aid").isNotNull()).select("aid", F.col("sid").alias("trigger_sid"), "trigger_mjd")
    past = recent_detections(asked, merges, records, days, ["r"])
    lists = past.groupBy("aid").agg(F.array_sort(F.collect_list(F.struct("mjdobs", "sid", "r"))).alias("__list"))

    def part(date: Column) -> Column:
        def wanted(s: Column) -> Column:
            near = (s["mjdobs"] >= date - days) & (s["sid"] != F.col("sid"))
            return near & (s["mjdobs"] <= date) if until_trigger else near
        return F.filter("__list", wanted)

    # a source that stands several times has the history of all its rows
    several = F.array_sort(F.flatten(F.transform("__dates", part)))
    full = packet.join(lists, "aid", "left_outer").withColumn("__h", F.when(F.size("__dates") > 1, several).otherwise(part(F.col("trigger_mjd"))))
    full = full.withColumn("__h", F.when(F.size("__h") > 0, F.col("__h"))).drop("__list", "__dates")
    full = full.withColumns({"first_prev": F.get("__h", F.lit(0))["mjdobs"], "last_prev": F.get("__h", F.size("__h") - 1)["mjdobs"]})
    full = full.withColumns({"diaSource": _whole_record(F.col("r"), names, F.col("aid"), F.col("sid"), F.col("trigger_mjd")),
                             "prvDiaSources": F.transform("__h", lambda s: _whole_record(s["r"], names, F.col("aid"), s["sid"], s["mjdobs"]))})

    known = objects.select("aid", "ra0", "dec0", "nsources", F.lit(True).alias("__known"))
    full = full.join(known, "aid", "left_outer")
    kind = "array<struct<" + ",".join(f"{n}:{'bigint' if k == 'long' else k}" for n, k in _fields(FORCED_RECORD)) + ">>"
    if forced is None:
        full = full.withColumn("prvDiaForcedSources", F.lit(None).cast(kind))
    else:
        full = full.join(forced_history(asked, forced, objects, filters, days), "sid", "left_outer")
    first = F.least("trigger_mjd", F.coalesce("first_prev", "trigger_mjd"))
    last = F.greatest("trigger_mjd", F.coalesce("last_prev", "trigger_mjd"))
    none = F.lit(None)
    return full.select(
        F.col("sid").alias("diaSourceId"), none.cast("string").alias("observation_reason"), none.cast("string").alias("target_name"),
        "diaSource", "prvDiaSources", F.col("prvDiaForcedSources").cast(kind).alias("prvDiaForcedSources"),
        F.when(F.col("__known"), dia_object(first, last, F.col("trigger_mjd"))).alias("diaObject"),
        none.cast("struct<ssObjectId:bigint>").alias("ssSource"), none.cast("struct<designation:string>").alias("mpc_orbits"),
        none.cast("binary").alias("cutoutDifference"), none.cast("binary").alias("cutoutScience"),
        none.cast("binary").alias("cutoutTemplate"))


def forced_history(asked: DataFrame, forced: DataFrame, objects: DataFrame, filters: DataFrame, days: float) -> DataFrame:
    """sid, prvDiaForcedSources of triggers ``asked`` (aid, trigger_sid, trigger_mjd): forced photometry of the object in time order."""
    oldest = asked.agg((F.min("trigger_mjd") - days).alias("m")).scalar()
    rows = forced.filter(F.col("mjdobs") >= oldest).join(asked.select("aid").distinct(), "aid", "left_semi")
    rows = with_filter_name(rows, filters).join(objects.select("aid", "ra0", "dec0"), "aid")
    record = dia_forced_source([*forced.columns, "filter_name"], F.col("ra0"), F.col("dec0"), F.col("filter_name"))
    rows = rows.select("aid", "mjdobs", record.alias("r"))
    pairs = asked.join(rows, "aid").filter(F.col("mjdobs") >= F.col("trigger_mjd") - days)
    point = F.struct("mjdobs", F.col("r.diaForcedSourceId").alias("id"), "r")
    lists = pairs.groupBy(F.col("trigger_sid").alias("sid")).agg(F.array_sort(F.collect_list(point)).alias("h"))
    return lists.select("sid", F.transform("h", lambda s: s["r"]).alias("prvDiaForcedSources"))


def catalog_to_records(rows: DataFrame, keys: list[str], columns: list[str], order: list[str], chunk: Column | None = None) -> DataFrame:
    """Catalogue rows as arrays of string structs, one array per key (and chunk)."""
    record = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    if chunk is not None:
        rows, keys = rows.withColumn("chunk", chunk), [*keys, "chunk"]
    listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, record.alias("r")))).alias("l"))
    return listed.select(*keys, F.transform("l", lambda s: s["r"]).alias("records"))
