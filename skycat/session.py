"""Session settings and the folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on: adaptive execution splits hot join keys and
# picks the number of shuffle partitions from the data that was really written.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    # positional expressions make long generated methods, and the JVM compiles none over 8000 bytes: Spark shall split those stages
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def small_methods(spark: SparkSession) -> None:
    """Let Spark split stages whose generated methods the JVM would not compile, unless the session has a limit of its own.

    Without it a positional join runs through a method that stays interpreted, row by row.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, RECOMMENDED[key])


def local_session(cpus: str = "8", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skycat")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session without
    that setting gets a temporary folder: executors elsewhere could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="skycat-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Loops need this: a plan that grows with each round, or the constraints a checkpoint carries
    along, would make planning slower and slower.  The table survives the loss of executors.
    """
    path = f"{shared_folder(df.sparkSession)}/skycat-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._skycat_table = path
    _TABLES.append(path)
    return out


_TABLES: list[str] = []  # intermediate tables of this driver that still exist


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _TABLES:
        _TABLES.remove(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that nothing reads any more, such as the round before in a loop."""
    for df in tables:
        _delete(df.sparkSession, df._skycat_table)


def drop_intermediate(spark: SparkSession) -> int:
    """Delete all intermediate tables of this driver; call it once the results that read them are stored."""
    left = list(_TABLES)
    for path in left:
        _delete(spark, path)
    return len(left)
