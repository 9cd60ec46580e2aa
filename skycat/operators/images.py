"""Image metadata: best versions, selections by time, references and PSFs.

Look-ups take a table of keys and answer all of them in one join, where a caller would
otherwise send one query per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_best() -> Column:
    """Best version (1, or 2 when locked) of a product that was made."""
    return (F.col("vbest") > 0) & (F.col("status") > 0)


def filter_best(df: DataFrame) -> DataFrame:
    return df.filter(is_best())


def images_for_exposure(images: DataFrame, expid: int) -> DataFrame:
    return images.filter((F.col("expid") == expid) & (F.col("vbest") > 0)).select("rid", "sca", "fid", "mjdobs")


def images_in_datetime_range(images: DataFrame, start: str, end: str) -> DataFrame:
    """Best images with dateobs in [start, end), in time order."""
    when = (F.col("dateobs") >= F.lit(start).cast("timestamp_ntz")) & (F.col("dateobs") < F.lit(end).cast("timestamp_ntz"))
    return images.filter(when & (F.col("vbest") > 0)).select("rid", "sca", "fid", "mjdobs").orderBy("mjdobs")


def images_in_range_for_field_filter(images: DataFrame, start: str, end: str, field: int, fid: int) -> DataFrame:
    when = (F.col("dateobs") >= F.lit(start).cast("timestamp_ntz")) & (F.col("dateobs") < F.lit(end).cast("timestamp_ntz"))
    return (images.filter(when & (F.col("vbest") > 0) & (F.col("field") == field) & (F.col("fid") == fid))
            .select("rid", "sca", "field", "fid", "mjdobs").orderBy("mjdobs", "sca"))


def lookup(keys: DataFrame, table: DataFrame, on: str | list[str], columns: list[str]) -> DataFrame:
    """Columns of ``table`` for each key, NULL where the key is unknown."""
    on = [on] if isinstance(on, str) else on
    return keys.join(table.select(*on, *columns), on, "left_outer")


def distinct_filter_detector(images: DataFrame) -> DataFrame:
    return images.select("fid", "sca").distinct().orderBy("fid", "sca")


def distinct_fields(rows: DataFrame, condition: Column) -> DataFrame:
    return rows.filter(condition).select("field").distinct()


def best_reference_image(wanted: DataFrame, references: DataFrame, ppids: list[int]) -> DataFrame:
    """Best reference of each wanted (field, fid), trying pipelines in the given order.

    The references are turned to one row per (field, fid) first, so the wanted rows are
    joined once whatever the number of fallbacks.
    """
    best = filter_best(references).filter(F.col("ppid").isin(ppids))
    rank = F.array_position(F.array(*[F.lit(p) for p in ppids]), F.col("ppid").cast("int"))
    pick = best.groupBy("field", "fid").agg(
        F.min(F.struct(rank.alias("rank"), F.col("rfid"), F.col("ppid"), F.col("filename"), F.col("infobits"),
                       F.col("version"))).alias("b"))
    picked = pick.select("field", "fid", "b.rfid", F.col("b.ppid").alias("ref_ppid"), F.col("b.filename").alias("ref_filename"),
                         F.col("b.infobits").alias("ref_infobits"), F.col("b.version").alias("ref_version"))
    return wanted.join(picked, ["field", "fid"], "left_outer")


def best_psf(wanted: DataFrame, psfs: DataFrame) -> DataFrame:
    best = filter_best(psfs).select("sca", "fid", "psfid", F.col("filename").alias("psf_filename"))
    return wanted.join(best, ["sca", "fid"], "left_outer")


def best_difference_image(wanted: DataFrame, diffs: DataFrame) -> DataFrame:
    """Best difference image of each wanted (rid, ppid)."""
    best = filter_best(diffs).select("rid", "ppid", "pid", "rfid", "infobitssci")
    return wanted.join(best, ["rid", "ppid"], "left_outer")


def equi_join_meta(images: DataFrame, meta: DataFrame) -> DataFrame:
    return images.filter(F.col("vbest") > 0).select("rid").join(meta.select("rid", "ra0", "dec0"), "rid")


def superior_reference_join(images: DataFrame, references: DataFrame, refmeta: DataFrame, start: str, end: str,
                            min_frames: int, min_cov5percent: float) -> DataFrame:
    """Best images in a date range whose field and filter has a deep enough reference."""
    deep = (filter_best(references).select("rfid", "field", "fid")
            .join(refmeta.filter((F.col("cov5percent") >= min_cov5percent) & (F.col("nframes") >= min_frames)).select("rfid"), "rfid")
            .select("field", "fid", "rfid"))
    when = (F.col("dateobs") >= F.lit(start).cast("timestamp_ntz")) & (F.col("dateobs") < F.lit(end).cast("timestamp_ntz"))
    return (images.filter(when & (F.col("vbest") > 0)).join(deep, ["field", "fid"])
            .select("rid", "sca", "fid", "mjdobs").orderBy("mjdobs", "sca"))


def possible_overlapping_diffs(fields: DataFrame, diffs: DataFrame, references: DataFrame, ppid: int, jd_earliest: float,
                               radius_deg: float = 1.0) -> DataFrame:
    """Best difference images near each field centre, made with a best reference.

    ``fields``: field_id, f_ra, f_dec.
    """
    from .spatial import sky_join_all_pairs

    good = filter_best(diffs).filter((F.col("ppid") == ppid) & (F.col("jd") >= jd_earliest))
    refs = filter_best(references).select("rfid")
    good = good.join(refs, "rfid").select("pid", "expid", "sca", "fid", "jd", "rfid", "ra0", "dec0")
    return sky_join_all_pairs(fields, good, radius_deg, ("f_ra", "f_dec"), ("ra0", "dec0"), repeat="left")


def field_filter_frame_counts(images: DataFrame, start_mjd: float, end_mjd: float, min_frames: int, fid: int | None = None) -> DataFrame:
    keep = (F.col("mjdobs") >= start_mjd) & (F.col("mjdobs") < end_mjd) & (F.col("vbest") > 0)
    if fid is not None:
        keep = keep & (F.col("fid") == fid)
    return (images.filter(keep).groupBy("field", "fid").agg(F.count("*").alias("nframes"))
            .filter(F.col("nframes") >= min_frames).orderBy("field", "fid"))


def split_stage_one_two(images: DataFrame) -> DataFrame:
    """Stage 1 is the first image (mjdobs, sca, rid) of each field and filter, the rest is stage 2.

    The first key is found by a partial aggregate and joined back: no sort of a hot field.
    """
    first = images.groupBy("field", "fid").agg(F.min(F.struct("mjdobs", "sca", "rid"))["rid"].alias("first_rid"))
    return (images.join(first, ["field", "fid"])
            .select("rid", "field", "fid", F.when(F.col("rid") == F.col("first_rid"), 1).otherwise(2).alias("stage")))


def representative_image_per_field(images: DataFrame) -> DataFrame:
    """One image of each field: the earliest best one."""
    return (images.filter(F.col("vbest") > 0).groupBy("field")
            .agg(F.min(F.struct("mjdobs", "sca", "rid")).alias("m")).select("field", "m.rid", "m.mjdobs"))


def reference_counts(references: DataFrame, refmeta: DataFrame, min_frames: int = 10, min_cov5percent: float = 60.0) -> DataFrame:
    """Best references per filter, all and deep ones."""
    deep = (F.col("nframes") >= min_frames) & (F.col("cov5percent") >= min_cov5percent)
    return (filter_best(references).join(refmeta, "rfid").groupBy("fid")
            .agg(F.count("*").alias("n_refs"), F.count_if(deep).alias("n_deep")))


def reference_time_span(bridge: DataFrame, images: DataFrame) -> DataFrame:
    """Frames, first and last MJD of the inputs of each reference."""
    return (bridge.distinct().join(images.select("rid", "mjdobs"), "rid").groupBy("rfid")
            .agg(F.count("*").alias("nframes"), F.min("mjdobs").alias("mjdobsmin"), F.max("mjdobs").alias("mjdobsmax")))


def reference_exposure_total(bridge: DataFrame, images: DataFrame) -> DataFrame:
    """Total exposure time and JD range of the inputs of each reference."""
    from ..functions.times import mjd_to_jd

    return (bridge.distinct().join(images.select("rid", "mjdobs", "exptime"), "rid").groupBy("rfid")
            .agg(F.sum("exptime").alias("exptime_total"), mjd_to_jd(F.min("mjdobs")).alias("jd_start"),
                 mjd_to_jd(F.max("mjdobs")).alias("jd_end")))


def survey_span_summary(images: DataFrame) -> DataFrame:
    return images.agg(F.min("dateobs").alias("first_date"), F.max("dateobs").alias("last_date"),
                      F.min("mjdobs").alias("first_mjd"), F.max("mjdobs").alias("last_mjd"),
                      F.count_distinct("field").alias("n_fields"), (F.sum("exptime") / 86400.0).alias("exposure_days"))


def images_by_filter_name(images: DataFrame, filters: DataFrame) -> DataFrame:
    """Counts are taken before the join, so the join sees one row per filter."""
    return images.groupBy("fid").agg(F.count("*").alias("n_images")).join(filters, "fid")


def images_by_detector(images: DataFrame) -> DataFrame:
    return images.groupBy("sca", "fid").agg(F.count("*").alias("n_images"))


def fields_imaged_distribution(images: DataFrame, probs: list[float]) -> DataFrame:
    """Distribution of the number of images per field, per filter.

    Percentiles are taken of the histogram "how many fields have n images", which is as
    long as the largest count, not as the number of fields.
    """
    per_field = images.groupBy("fid", "field").agg(F.count("*").alias("n"))
    hist = per_field.groupBy("fid", "n").agg(F.count("*").alias("w"))
    n, w = F.col("n"), F.col("w")
    total = F.sum(w)
    mean = F.sum(n * w) / total
    aggs = [total.alias("n_fields"), F.sum(F.when(n >= 2, w).otherwise(0)).alias("n_multi"),
            F.sum(F.when(n == 1, w).otherwise(0)).alias("n_single"), mean.alias("mean_n"),
            F.sqrt(F.greatest(F.lit(0.0), F.sum(n * n * w) / total - mean * mean)).alias("std_n"),
            F.min(n).alias("min_n"), F.max(n).alias("max_n"), F.percentile(n, 0.5, w).alias("median_n")]
    aggs += [F.percentile(n, p, w).alias(f"pct{str(100 * p).rstrip('0').rstrip('.').replace('.', '_')}") for p in probs]
    return hist.groupBy("fid").agg(*aggs)


def ingest_listing_antijoin(listing: DataFrame, images: DataFrame) -> DataFrame:
    """Listed files whose base name is not yet ingested with a best version."""
    from ..functions.naming import file_basename

    done = images.filter(F.col("vbest") > 0).select(file_basename("filename").alias("basename"))
    return listing.withColumn("basename", file_basename("path")).join(done, "basename", "left_anti")


def upsert_exposures(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert or update by dateobs; the newest incoming row wins and keeps a known expid.

    ``existing`` has one row per dateobs; ``incoming`` carries ``arrived`` (order of arrival).
    One aggregate by key merges both, so the tables are shuffled once.
    """
    cols = [c for c in existing.columns if c not in ("dateobs", "expid")]
    both = (existing.withColumn("arrived", F.lit(-1).cast("long"))
            .unionByName(incoming.select("expid", "dateobs", *cols, F.col("arrived").cast("long"))))
    row = F.struct("arrived", "expid", *cols)
    merged = both.groupBy("dateobs").agg(F.max(row).alias("r"), F.min(row)["expid"].alias("expid"),
                                         F.count_if(F.col("arrived") >= 0).alias("n_incoming"),
                                         F.count_if(F.col("arrived") < 0).alias("n_existing"))
    action = (F.when(F.col("n_existing") == 0, "insert").when(F.col("n_incoming") > 0, "update").otherwise("keep"))
    return merged.select("expid", "dateobs", *[F.col("r." + c).alias(c) for c in cols], action.alias("action"))


def latest_software_version(versions: DataFrame) -> DataFrame:
    return versions.agg(F.max("svid").alias("svid"))
