"""Association with keyed state against one walk over all sources."""

import random

import pytest
from pyspark.sql import functions as F

from skycat.operators import associate, objects
from skycat.streaming import state
from tests import brute

SCHEMA = "sid long, field long, expid long, sca int, mjdobs double, ra double, dec double, fluxfit double, flags int"
R = 1e-3


def night(rnd, number, first_sid, n=60, fields=2):
    out = []
    for i in range(n):
        sca = rnd.randrange(1, 4)
        out.append((first_sid + i, rnd.randrange(fields), number, sca, 60000.0 + number, (rnd.gauss(0, 4 * R)) % 360, 10 + rnd.gauss(0, 4 * R), float(i), int(i % 17 == 0)))
    return out


def put(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).withColumn("dateobs", F.expr("timestamp_millis(cast((mjdobs - 40587) * 86400000 AS long))")).coalesce(2).write.parquet(f"{folder}/in/{name}")


def stream(spark, folder, one_by_one=False):
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/in/*").schema).option("recursiveFileLookup", True)
    return (reader.option("maxFilesPerTrigger", 2) if one_by_one else reader).parquet(f"{folder}/in")


def merges_of(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/merges").select("field", "aid", "sid").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_nights_with_restarts_equal_one_walk(spark, tmp_path):
    rnd, rows = random.Random(3), []
    for number in range(4):
        part = night(rnd, number, 1000 * number)
        rows += part
        put(spark, tmp_path, part, f"n{number}")
        state.associate_with_state(stream(spark, tmp_path), str(tmp_path), R).awaitTermination()  # each call is a restart from the state
    clean = [r for r in rows if r[8] == 0]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    got = merges_of(spark, tmp_path)
    assert got == brute.walk([dict(zip(names, r)) for r in clean], R)
    whole = spark.createDataFrame(clean, SCHEMA)
    assert got == {tuple(r) for r in associate.associate_within_field(whole, R).collect()}
    held = {r["aid"]: r for r in state.state_objects(spark, str(tmp_path)).collect()}
    stats = {r["aid"]: r for r in objects.object_statistics(spark.createDataFrame(sorted(got), "field long, aid long, sid long"), whole, None).collect()}
    assert set(held) == set(stats)
    by_sid = {r[0]: r for r in clean}
    for aid, o in held.items():
        assert o["nsources"] == stats[aid]["nsources"] and o["meandec"] == pytest.approx(stats[aid]["meandec"], abs=1e-9)
        assert (o["ra0"], o["dec0"], o["flux0"]) == by_sid[aid][5:8]
        assert o["last_mjd"] == max(by_sid[s][4] for _, a, s in got if a == aid)


def test_only_touched_cells_are_written(spark, tmp_path):
    rnd = random.Random(4)
    first = [(i, 0, 0, 1, 60000.0, 10.0 + 0.5 * i, 0.0, 1.0, 0) for i in range(80)]
    put(spark, tmp_path, first, "n0")
    state.associate_with_state(stream(spark, tmp_path), str(tmp_path), R).awaitTermination()
    put(spark, tmp_path, [(1000, 0, 1, 1, 60001.0, 10.0 + rnd.uniform(-R / 2, R / 2), 0.0, 1.0, 0)], "n1")
    query = state.associate_with_state(stream(spark, tmp_path), str(tmp_path), R)
    query.awaitTermination()
    updated = [s["numRowsUpdated"] for p in query.recentProgress for s in p["stateOperators"]]
    assert 1 <= sum(updated) <= 3  # of 80 cells; the count of entries is a row too
    assert merges_of(spark, tmp_path) == {(0, i, i) for i in range(80)} | {(0, 0, 1000)}


def test_old_objects_leave_the_state(spark, tmp_path):
    def at(sid, mjd):
        return (sid, 0, int(mjd), 1, 60000.0 + mjd, 50.0, 5.0, 1.0, 0)

    for i, mjd in enumerate((0, 5, 40, 41)):
        put(spark, tmp_path, [at(i, mjd)], f"n{i}")
        state.associate_with_state(stream(spark, tmp_path), str(tmp_path), R, horizon_days=10).awaitTermination()
    assert merges_of(spark, tmp_path) == {(0, 0, 0), (0, 0, 1), (0, 2, 2), (0, 2, 3)}
    assert {r["aid"] for r in state.state_objects(spark, str(tmp_path)).collect()} == {2}


def test_stream_of_nothing(spark, tmp_path):
    put(spark, tmp_path, [(1, 0, 0, 1, 60000.0, 1.0, 1.0, 1.0, 1)], "n0")
    state.associate_with_state(stream(spark, tmp_path), str(tmp_path), R).awaitTermination()
    assert merges_of(spark, tmp_path) == set()
