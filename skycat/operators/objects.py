"""Objects of the catalogue: statistics, counts, light curves and pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import wrap_ra


def object_statistics(merges: DataFrame, sources: DataFrame, diffimages: DataFrame | None, compat: bool = False) -> DataFrame:
    """Mean and population standard deviation of position and flux per object.

    Sources of not-best images of ``diffimages`` do not count.  Where an object has members below
    10 and above 350 degrees, the latter are taken as negative; the mean is then brought back
    to [0, 360) unless ``compat``.  Both versions of ra are aggregated at once, so there is one
    shuffle on the object and hot objects are combined on the map side.
    """
    if diffimages is not None:
        sources = prune_not_best(sources, diffimages)
    rows = merges.select("aid", "sid").join(sources.select("sid", "ra", "dec", F.col("fluxfit").alias("flux")), "sid")
    west = F.when(F.col("ra") > 350.0, F.col("ra") - 360.0).otherwise(F.col("ra"))
    out = rows.groupBy("aid").agg(
        (F.bool_or(F.col("ra") < 10.0) & F.bool_or(F.col("ra") > 350.0)).alias("w"),
        F.avg("ra").alias("m0"), F.stddev_pop("ra").alias("s0"), F.avg(west).alias("m1"), F.stddev_pop(west).alias("s1"),
        F.avg("dec").alias("meandec"), F.stddev_pop("dec").alias("stdevdec"),
        F.avg("flux").alias("meanflux"), F.stddev_pop("flux").alias("stdevflux"), F.count("*").alias("nsources"))
    mean = F.when(F.col("w"), F.col("m1")).otherwise(F.col("m0"))
    return out.select("aid", (mean if compat else wrap_ra(mean)).alias("meanra"),
                      F.when(F.col("w"), F.col("s1")).otherwise(F.col("s0")).alias("stdevra"),
                      "meandec", "stdevdec", "meanflux", "stdevflux", "nsources")


def ra_offset(ra: Column, origin: Column) -> Column:
    """Signed difference in right ascension, the short way round."""
    return F.pmod(ra - origin + 540.0, F.lit(360.0)) - 180.0


def incremental_mean(objects: DataFrame, matched: DataFrame) -> DataFrame:
    """New mean position and count of objects after a batch of matches.

    ``objects``: aid, meanra, meandec, nsources; ``matched``: aid, ra, dec.  All matches of an
    object are added at once through offsets from the old mean, which are summed per object.
    """
    joined = matched.join(objects.select("aid", "meanra", "meandec"), "aid")
    delta = joined.groupBy("aid").agg(F.sum(ra_offset(F.col("ra"), F.col("meanra"))).alias("dra"),
                                      F.sum(F.col("dec") - F.col("meandec")).alias("ddec"), F.count("*").alias("k"))
    n = F.col("nsources") + F.coalesce("k", F.lit(0))
    return (objects.join(delta, "aid", "left_outer")
            .select("aid", wrap_ra(F.col("meanra") + F.coalesce(F.col("dra"), F.lit(0.0)) / n).alias("meanra"),
                    (F.col("meandec") + F.coalesce(F.col("ddec"), F.lit(0.0)) / n).alias("meandec"), n.alias("nsources")))


def per_band_object_summary(merges: DataFrame, sources: DataFrame, filters: dict[int, str]) -> DataFrame:
    """Flux mean, scatter, count, minimum and maximum per object and filter, one row per object."""
    rows = merges.select("aid", "sid").join(sources.select("sid", "fid", "fluxfit"), "sid")
    aggs = []
    for fid, name in filters.items():
        flux = F.when(F.col("fid") == fid, F.col("fluxfit"))
        aggs += [F.avg(flux).alias(f"{name}_mean"), F.stddev_pop(flux).alias(f"{name}_sigma"),
                 F.count(flux).alias(f"{name}_ndata"), F.min(flux).alias(f"{name}_min"), F.max(flux).alias(f"{name}_max")]
    return rows.groupBy("aid").agg(*aggs)


def count_by_field(df: DataFrame) -> DataFrame:
    """Rows per field and, with a NULL field, in total."""
    per_field = df.groupBy("field").agg(F.count("*").alias("n"))
    return per_field.rollup("field").agg(F.sum("n").alias("n"))


def orphan_objects(objects: DataFrame, merges: DataFrame) -> DataFrame:
    """Objects without a merge."""
    return objects.join(merges.select("aid"), "aid", "left_anti")


def merges_outside_field(merges: DataFrame, sources: DataFrame) -> DataFrame:
    """Merges per field whose source lies in another field."""
    other = sources.select("sid", F.col("field").alias("source_field"))
    return (merges.select("sid", "field").join(other, "sid").filter(F.col("field") != F.col("source_field"))
            .groupBy("field").agg(F.count("*").alias("n_outside")))


def prune_not_best(rows: DataFrame, diffimages: DataFrame) -> DataFrame:
    """Sources, or merges with their pid, of difference images that are still best."""
    return rows.join(diffimages.filter(F.col("vbest") != 0).select("pid"), "pid", "left_semi")


def prune_not_best_merges(merges: DataFrame, sources: DataFrame, diffimages: DataFrame) -> DataFrame:
    kept = prune_not_best(sources.select("sid", "pid"), diffimages)
    return merges.join(kept.select("sid"), "sid", "left_semi")


def prune_redundant_merges(merges: DataFrame) -> DataFrame:
    """One row per (aid, sid)."""
    return merges.dropDuplicates(["aid", "sid"])


def register_merge_once(merges: DataFrame, incoming: DataFrame) -> DataFrame:
    """Merges with the incoming ones that were not there yet."""
    fresh = incoming.select(*merges.columns).dropDuplicates(["aid", "sid"]).join(merges.select("aid", "sid"), ["aid", "sid"], "left_anti")
    return merges.unionByName(fresh.select(*merges.columns))


def drop_empty_fields(objects: DataFrame, merges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Objects and merges of the fields that have both."""
    f_objects, f_merges = objects.select("field").distinct(), merges.select("field").distinct()
    both = f_objects.join(f_merges, "field", "left_semi")
    return objects.join(both, "field", "left_semi"), merges.join(both, "field", "left_semi")


def lightcurve(merges: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources of each object in time order.

    The global sort is by range of (aid, mjdobs, sid): one hot object spreads over several
    ranges.
    """
    return (merges.select("aid", "sid").join(sources.select("sid", "mjdobs", "fid", "fluxfit", "fluxerr"), "sid")
            .select("aid", "mjdobs", "sid", "fid", "fluxfit", "fluxerr").orderBy("aid", "mjdobs", "sid"))


def previous_detections(triggers: DataFrame, merges: DataFrame, sources: DataFrame, days: float = 365.25,
                        columns: list[str] = ("mjdobs",), until_trigger: bool = False) -> DataFrame:
    """Other detections of the object of each trigger, from ``days`` before it on.

    ``triggers``: aid, trigger_sid, trigger_mjd.  ``until_trigger`` leaves out detections later than the
    trigger.  History is cut down before it is joined: merges to the objects asked for, and
    sources to the dates that the oldest trigger can reach, a predicate that prunes partitions by date.
    """
    wanted = (F.col("mjdobs") >= F.col("trigger_mjd") - days) & (F.col("sid") != F.col("trigger_sid"))
    if until_trigger:
        wanted = wanted & (F.col("mjdobs") <= F.col("trigger_mjd"))
    return triggers.join(recent_detections(triggers, merges, sources, days, columns), "aid").filter(wanted)


def recent_detections(triggers: DataFrame, merges: DataFrame, sources: DataFrame, days: float, columns: list[str] = ("mjdobs",)) -> DataFrame:
    """(aid, sid, mjdobs, columns): detections of the objects of the triggers, from ``days`` before the oldest trigger of the object on."""
    oldest = triggers.agg((F.min("trigger_mjd") - days).alias("m")).scalar()
    recent = sources.select("sid", *dict.fromkeys(["mjdobs", *columns])).filter(F.col("mjdobs") >= oldest)
    reach = triggers.groupBy("aid").agg((F.min("trigger_mjd") - days).alias("__oldest"))
    own = merges.select("aid", "sid").join(reach, "aid")
    return own.join(recent, "sid").filter(F.col("mjdobs") >= F.col("__oldest")).drop("__oldest")


def latest_triggers(merges: DataFrame, sources: DataFrame) -> DataFrame:
    """The latest detection of each object."""
    rows = merges.select("aid", "sid").join(sources.select("sid", "mjdobs"), "sid")
    return (rows.groupBy("aid").agg(F.max(F.struct("mjdobs", "sid")).alias("m"))
            .select("aid", F.col("m.sid").alias("trigger_sid"), F.col("m.mjdobs").alias("trigger_mjd")))
