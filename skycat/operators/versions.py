"""Version numbers, best flags and registration of products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe
from .sliced import row_number

EXIT_NO_INPUTS = 33  # fixed value: not enough inputs for a reference image
EXIT_ERRORS_FROM = 64  # fixed value: exit codes of failed jobs start here


def assign_version(incoming: DataFrame, existing: DataFrame | None, keys: list[str], order: list[str],
                   slice_of: Column | None = None) -> DataFrame:
    """Number incoming rows after the highest existing version of their key.

    ``slice_of`` (a monotone function of the order) keeps hot keys out of a single task.
    """
    if slice_of is None:
        numbered = incoming.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    else:
        numbered = row_number(incoming, keys, order, slice_of, "__n")
    if existing is None:
        return numbered.withColumnRenamed("__n", "version")
    top = existing.groupBy(*keys).agg(F.max("version").alias("__top"))
    return (join_null_safe(numbered, top, keys, "left_outer")
            .withColumn("version", F.coalesce("__top", F.lit(0)) + F.col("__n")).drop("__n", "__top"))


def resolve_vbest(versions: DataFrame, keys: list[str], locked: Column) -> DataFrame:
    """Best flag of each version: a locked version is 2 and the only best one of its key,
    without one the newest version is 1; all others are 0.

    The newest version and the lock come from one partial aggregate per key.  With several
    locked versions the result would be ambiguous; ``vbest_conflicts`` reports such keys.
    """
    state = versions.groupBy(*keys).agg(F.max("version").alias("__newest"), F.coalesce(F.max(locked), F.lit(False)).alias("__locked"))
    vbest = F.when(locked, 2).when(~F.col("__locked") & (F.col("version") == F.col("__newest")), 1).otherwise(0)
    return join_null_safe(versions, state, keys).withColumn("vbest", vbest).drop("__newest", "__locked")


def vbest_conflicts(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one version flagged best."""
    return (versions.groupBy(*keys).agg(F.count_if(F.col("vbest") > 0).alias("n_best")).filter(F.col("n_best") > 1))


def register_products(jobs: DataFrame, products: DataFrame, existing: DataFrame, keys: list[str], order: list[str],
                      slice_of: Column | None = None) -> DataFrame:
    """Add the products of finished jobs to a product table with new versions and best flags.

    Jobs that ended with 33 or from 64 up register nothing.  ``products`` has ``jid`` and the
    keys; ``existing`` has the keys, version and vbest.  Returns the whole new table.
    """
    usable = jobs.filter((F.col("exitcode") != EXIT_NO_INPUTS) & (F.col("exitcode") < EXIT_ERRORS_FROM)).select("jid")
    fresh = assign_version(products.join(usable, "jid", "left_semi"), existing, keys, order, slice_of)
    both = existing.withColumn("jid", F.lit(None).cast("long")).unionByName(
        fresh.withColumn("vbest", F.lit(0)).select("jid", *existing.columns))
    return resolve_vbest(both, keys, F.col("vbest") == 2)


def row_changes(table: DataFrame, files: DataFrame) -> DataFrame:
    """Stored checksum against the checksum of the file content (see ``sources.readers``)."""
    return (table.select("filename", "checksum").join(files.select("filename", F.col("md5").alias("found")), "filename", "left_outer")
            .withColumn("state", F.when(F.col("found").isNull(), "missing")
                        .when(F.col("found") == F.col("checksum"), "ok").otherwise("changed")))
