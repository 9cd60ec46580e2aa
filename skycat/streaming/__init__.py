"""Structured Streaming twins of the catalogue steps.

State lives in tables of the shared folder, one folder per micro-batch number, and a batch
always starts from the tables of the batch before.  A batch that is repeated after a failure
overwrites its own folder, so results are the same as without the failure.  Keyed state inside
Spark would put a busy field in one task; here each batch is a distributed job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.geometry import wrap_ra
from ..operators.associate import associate_within_field
from ..operators.nested import assemble_alerts
from ..operators.objects import ra_offset

OBJECTS = "aid long, field long, ra0 double, dec0 double, flux0 double, meanra double, meandec double, nsources long, last_mjd double"


def nightly_window_counts(sources: DataFrame, time: str = "dateobs", late: str | None = None) -> DataFrame:
    """Detections per day and detector; works on a stream and on a table.

    Without ``late`` every row counts, however late it comes, and all days stay in the state.  With it, a stream
    forgets days older than that before the newest row, and rows that come later still are lost.
    """
    rows = sources.withWatermark(time, late) if sources.isStreaming and late else sources
    return (rows.groupBy(F.window(time, "1 day"), "sca").agg(F.count("*").alias("n"))
            .select(F.col("window.start").alias("day"), "sca", "n"))


def _latest(spark: SparkSession, folder: str, epoch: int, schema: str) -> DataFrame:
    if epoch == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/objects/epoch={epoch - 1}")


def associate_batch(spark: SparkSession, batch: DataFrame, epoch: int, folder: str, radius_deg: float,
                    horizon_days: float | None = None) -> None:
    """Match a batch of sources with the objects of the batch before; write merges and objects.

    With ``horizon_days``, objects not seen for that long leave the state (their merges stay), and a source that
    returns later starts a new object; without it the result is that of the batch.
    """
    batch = batch.filter(F.col("flags") == 0)
    old = _latest(spark, folder, epoch, OBJECTS)
    active = old.join(batch.select("field").distinct(), "field", "left_semi")
    merges = associate_within_field(batch, radius_deg, active)
    merges.write.mode("overwrite").parquet(f"{folder}/merges/epoch={epoch}")
    merges = spark.read.parquet(f"{folder}/merges/epoch={epoch}")

    rows = merges.select("aid", "sid").join(batch.select("sid", "ra", "dec", "mjdobs"), "sid")
    started = (merges.filter("aid = sid").select("aid", "sid").join(batch, "sid")
               .select("aid", F.col("field").cast("long").alias("field"), F.col("ra").alias("ra0"), F.col("dec").alias("dec0"),
                       F.col("fluxfit").cast("double").alias("flux0"), F.col("ra").alias("meanra"), F.col("dec").alias("meandec"),
                       F.lit(0).cast("long").alias("nsources"), F.col("mjdobs").alias("last_mjd")))
    base = old.unionByName(started)
    delta = rows.join(base.select("aid", F.col("meanra").alias("__r"), F.col("meandec").alias("__d")), "aid").groupBy("aid").agg(
        F.sum(ra_offset(F.col("ra"), F.col("__r"))).alias("dra"), F.sum(F.col("dec") - F.col("__d")).alias("ddec"),
        F.count("*").alias("k"), F.max("mjdobs").alias("seen"))
    n = F.col("nsources") + F.coalesce("k", F.lit(0))
    moved = base.join(delta, "aid", "left_outer").select(
        "aid", "field", "ra0", "dec0", "flux0", wrap_ra(F.col("meanra") + F.coalesce(F.col("dra") / n, F.lit(0.0))).alias("meanra"),
        (F.col("meandec") + F.coalesce(F.col("ddec") / n, F.lit(0.0))).alias("meandec"), n.alias("nsources"),
        F.greatest("last_mjd", "seen").alias("last_mjd"))
    if horizon_days is not None:
        moved = moved.filter(F.col("last_mjd") >= moved.agg(F.max("last_mjd").alias("m")).scalar() - horizon_days)
    moved.write.mode("overwrite").parquet(f"{folder}/objects/epoch={epoch}")


def _run(stream: DataFrame, work: Callable[[DataFrame, int], None], folder: str) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(work).option("checkpointLocation", f"{folder}/_stream")
            .trigger(availableNow=True).start())


def streaming_association(sources: DataFrame, folder: str, radius_deg: float, horizon_days: float | None = None) -> StreamingQuery:
    """Attach arriving sources to objects or start new ones.  Results are in ``folder``."""
    spark = sources.sparkSession
    return _run(sources, lambda batch, epoch: associate_batch(spark, batch, epoch, folder, radius_deg, horizon_days), folder)


def alert_stream_out(sources: DataFrame, folder: str, merges: DataFrame, objects: DataFrame, history: DataFrame,
                     filters: DataFrame, servers: str | None = None, topic: str | None = None) -> StreamingQuery:
    """Publish an alert for every arriving source, to files or to Kafka."""
    from ..sources.writers import write_alerts

    def work(batch: DataFrame, epoch: int) -> None:
        alerts = assemble_alerts(batch, merges, objects, history, filters)
        write_alerts(alerts, f"{folder}/alerts/epoch={epoch}", topic, servers)

    return _run(sources, work, folder)


def alert_stream_in(spark: SparkSession, folder: str | None = None, schema=None, servers: str | None = None,
                    topic: str = "alerts", packets: str = "json") -> DataFrame:
    """Stream of alert packets from files, or from Kafka where the connector is installed.

    ``packets``: ``avro`` for Avro container files, or messages of Avro bytes; otherwise nested Parquet, or JSON messages.
    """
    from ..sources import avro

    if servers is not None:
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
               .option("startingOffsets", "earliest").load())
        if packets == "avro":
            return avro.decode_rows(raw, schema)
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("a")).select("a.*")
    if packets == "avro":
        avro.register(spark)
        return spark.readStream.format("skycat_avro").schema(schema).load(folder)
    return spark.readStream.schema(schema).parquet(folder)
