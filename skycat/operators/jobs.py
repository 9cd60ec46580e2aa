"""Reports over the job table, job logs and product listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NO_INPUTS = 33  # fixed value


def completed_jobs_on_date(jobs: DataFrame, day: str, ppid: int = 15, max_exit: int = 32) -> DataFrame:
    """Jobs that ended on a day with success."""
    d = F.lit(day).cast("date")
    end = F.col("ended")
    return jobs.filter((F.col("ppid") == ppid) & (end >= d) & (end < F.date_add(d, 1)) & (F.col("status") > 0)
                       & (F.col("exitcode") <= max_exit)).select("jid")


def open_jobs_on_date(jobs: DataFrame, day: str, ppid: int) -> DataFrame:
    """Jobs launched on a day that have not ended."""
    d = F.lit(day).cast("date")
    launched = F.col("launched")
    return jobs.filter((F.col("ppid") == ppid) & (launched >= d) & (launched < F.date_add(d, 1)) & (F.col("status") == 0)
                       & F.col("ended").isNull() & F.col("exitcode").isNull()).select("jid")


def job_exit_summary(jobs: DataFrame, day: str | None = None) -> DataFrame:
    """Jobs per launch day, pipeline and exit code."""
    out = jobs.withColumn("launch_day", F.to_date("launched"))
    if day is not None:
        out = out.filter(F.col("launch_day") == F.lit(day).cast("date"))
    return out.groupBy("launch_day", "ppid", "exitcode").agg(F.count("*").alias("n_jobs"))


def job_elapsed_profile(jobs: DataFrame, images: DataFrame, refmeta: DataFrame) -> DataFrame:
    """Queue wait and elapsed seconds against hour of start and number of reference frames.

    ``jobs``: jid, rid, launched_s, started_s, ended_s, exitcode; ``images``: rid, rfid.
    """
    ok = jobs.filter((F.col("exitcode") == 0) & F.col("ended_s").isNotNull())
    return (ok.join(images.select("rid", "rfid"), "rid").join(refmeta.select("rfid", "nframes"), "rfid")
            .withColumn("start_hour", F.floor(F.col("started_s") / 3600.0) % 24)
            .groupBy("start_hour", "nframes")
            .agg(F.count("*").alias("n_jobs"), F.avg(F.col("started_s") - F.col("launched_s")).alias("mean_wait_s"),
                 F.avg(F.col("ended_s") - F.col("started_s")).alias("mean_elapsed_s"),
                 F.max(F.col("ended_s") - F.col("started_s")).alias("max_elapsed_s")))


def missing_products_report(images: DataFrame, jobs: DataFrame, ppid: int = 15) -> DataFrame:
    """Best images without a completed job, or with more than one job.

    Jobs are counted per image before the join, so a hot image cannot fan out.
    """
    per_image = jobs.filter(F.col("ppid") == ppid).groupBy("rid").agg(
        F.count("*").alias("n_jobs"), F.count_if((F.col("status") > 0) & (F.col("exitcode") <= 32)).alias("n_done"))
    out = images.filter(F.col("vbest") > 0).select("rid").join(per_image, "rid", "left_outer").fillna(0, ["n_jobs", "n_done"])
    state = F.when(F.col("n_jobs") == 0, "no job").when(F.col("n_done") == 0, "not completed").when(F.col("n_jobs") > 1, "several jobs")
    return out.withColumn("problem", state).filter(F.col("problem").isNotNull())


def parse_job_logs(lines: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Last ``key = value`` of each wanted key per log.

    ``lines``: file, line_no, value (see ``sources.readers.read_numbered_lines``); ``keys``:
    output column by key.  One aggregate with ``max_by``: logs are never collected.
    """
    aggs = []
    for key, out in keys.items():
        hit = F.col("value").contains(key) & F.col("value").contains("=")
        text = F.split("value", r"\s*=\s*", 3)[1]
        aggs.append(F.max_by(F.when(hit, F.trim(text)), F.when(hit, F.col("line_no"))).alias(out))
    return lines.groupBy("file").agg(*aggs)


def parse_product_configs(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """INI lines (file, line_no, value) as (file, section, key, setting); the last one wins.

    ``tasks`` deals the files to that many tasks: the lines of a task are sorted, so their number bounds its memory.
    """
    if tasks is not None:
        lines = lines.repartition(tasks, "file")
    line = F.trim("value")
    head = F.regexp_extract(line, r"^\[(.+)\]$", 1)
    order = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    body = (lines.withColumn("__line", line)
            .withColumn("section", F.last(F.when(head != "", head), ignorenulls=True).over(order))
            .filter((~F.col("__line").rlike(r"^[#;\[]")) & F.col("__line").contains("=") & F.col("section").isNotNull())
            .withColumn("key", F.lower(F.trim(F.substring_index("__line", "=", 1))))
            .withColumn("setting", F.trim(F.regexp_extract("__line", r"^[^=]*=(.*)$", 1))))
    return body.groupBy("file", "section", "key").agg(F.max_by("setting", "line_no").alias("setting"))


def config_columns(settings: DataFrame, wanted: dict[tuple[str, str], tuple[str, str]]) -> DataFrame:
    """One typed row per file: ``wanted`` maps (section, key) to (column, type).

    The type ``pt_time`` reads local times like ``2026-04-10T11:12:59 PT``.
    """
    aggs = []
    for (section, key), (name, kind) in wanted.items():
        text = F.max(F.when((F.col("section") == section) & (F.col("key") == key), F.col("setting")))
        if kind == "pt_time":
            value = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(text, " PT$", ""), "T", " "), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
        else:
            value = text.try_cast(kind)
        aggs.append(value.alias(name))
    return settings.groupBy("file").agg(*aggs)


def product_inventory(listing: DataFrame, reference_name: str, difference_name: str) -> DataFrame:
    """Per job: are the reference and the difference product in the listing?

    ``listing``: object keys ``<date>/jid<n>/<file>`` in column ``path``.
    """
    parts = listing.select(F.regexp_extract("path", r"/jid(\d+)/", 1).alias("j"), F.substring_index("path", "/", -1).alias("name"))
    return (parts.filter(F.col("j") != "").groupBy(F.col("j").cast("long").alias("jid"))
            .agg(F.bool_or(F.col("name") == reference_name).alias("reference_found"),
                 F.bool_or(F.col("name") == difference_name).alias("difference_found")))


def insufficient_inputs(configs: DataFrame) -> DataFrame:
    """Exit code 33 for jobs with neither a reference nor inputs to make one.

    ``configs``: jid, rfid_text ("None" when absent), n_images_to_coadd, exitcode.
    """
    none = F.col("rfid_text").isNull() | (F.col("rfid_text") == "None")
    return configs.withColumn("exitcode", F.when(none & (F.col("n_images_to_coadd") == 0), NO_INPUTS).otherwise(F.col("exitcode")))
