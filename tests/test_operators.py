"""Edge cases that the shared tables do not reach."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skycat import streaming
from skycat.functions.geometry import tan_deproject
from skycat.operators import associate, evaluation, jobs, nested, objects, pixels, quantiles, schedule, sliced, tiles, versions
from skycat.sources import readers, writers


def test_percentiles_of_large_and_small_groups(spark):
    rnd = random.Random(1)
    data = {1: [rnd.gauss(0, 1) for _ in range(3000)], 2: [5.0], 3: [1.0, 2.0], 4: [float(rnd.randrange(4)) for _ in range(2500)]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [(5, None)], "k int, v double")
    probs = {"a": 0.0, "b": 0.16, "c": 0.5, "d": 0.84, "e": 0.999, "f": 1.0}
    got = {r.k: r for r in quantiles.exact_percentiles(df, ["k"], "v", probs, accuracy=200).collect()}
    assert set(got) == {1, 2, 3, 4}
    for k, vs in data.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.percentile(vs, 100 * p), abs=1e-12)


def test_running_sums_with_hot_keys(spark):
    rows = [(i % 10 != 0, i, float(i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "k boolean, i long, v double")
    got = {r.i: r.s for r in sliced.running_sum(df, ["k"], ["i"], F.floor(F.col("i") / 50), F.col("v"), "s").collect()}
    total = {True: 0.0, False: 0.0}
    for k, i, v in rows:
        total[k] += v
        assert got[i] == pytest.approx(total[k])


def test_locked_versions_stay_best(spark):
    rows = [(1, 1, 0), (1, 2, 1), (2, 1, 2), (2, 2, 0)]
    df = spark.createDataFrame(rows, "k int, version int, old int")
    got = {(r.k, r.version): r.vbest for r in versions.resolve_vbest(df, ["k"], F.col("old") == 2).collect()}
    assert got == {(1, 1): 0, (1, 2): 1, (2, 1): 2, (2, 2): 0}


def test_mean_across_the_meridian(spark):
    merges = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 4)], "aid long, sid long")
    sources = spark.createDataFrame([(1, 1, 359.9, 1.0, 1.0), (2, 1, 0.1, 1.0, 3.0), (3, 2, 50.0, 1.0, 9.0), (4, 1, 100.0, 0.0, 1.0)],
                                    "sid long, pid long, ra double, dec double, fluxfit double")
    diffs = spark.createDataFrame([(1, 1), (2, 0)], "pid long, vbest int")
    got = {r.aid: r for r in objects.object_statistics(merges, sources, diffs).collect()}
    assert got[1].nsources == 2 and got[1].stdevra == pytest.approx(0.1)
    assert min(got[1].meanra, 360 - got[1].meanra) == pytest.approx(0, abs=1e-9)
    moved = objects.incremental_mean(spark.createDataFrame([(1, 359.9, 0.0, 1)], "aid long, meanra double, meandec double, nsources long"),
                                     spark.createDataFrame([(1, 0.3, 0.3)], "aid long, ra double, dec double")).first()
    assert moved.meanra == pytest.approx(0.1) and moved.meandec == pytest.approx(0.15) and moved.nsources == 2


def test_tile_lookup_at_the_published_position(spark):
    t = spark.createDataFrame([(5321355, 11.0213394165039, 11.1128044128418, -43.8541564941406, -43.7548179626465), (7, -1.0, 1.0, 0.0, 1.0)],
                              "rtid long, ramin double, ramax double, decmin double, decmax double")
    p = spark.createDataFrame([(1, 11.1, -43.8), (2, 359.5, 0.5), (3, 0.999, 0.0), (4, 1.0, 0.5), (5, 0.0, 1.0)], "k int, ra double, dec double")
    got = {r.k: r.field for r in tiles.point_to_tile(p, t, h=0.1).collect()}
    assert got == {1: 5321355, 2: 7, 3: 7, 4: None, 5: None}


def test_tile_caps(spark):
    caps = [(1, 0.0, 360.0, 89.0, 90.0), (2, -90.0, 90.0, 88.0, 89.0), (3, 90.0, 270.0, 88.0, 89.0)]
    caps += [(10, -90.0, 90.0, -89.0, -88.0), (11, 90.0, 270.0, -89.0, -88.0), (12, 0.0, 0.0, -90.0, -89.0)]
    t = spark.createDataFrame(caps, "rtid long, ramin double, ramax double, decmin double, decmax double")
    got = {}
    for r in tiles.tile_neighbors(t, 1.0).collect():
        got.setdefault(r.rtid, set()).add(r.neighbor)
    assert got[1] == {2, 3} and got[2] == {1, 3} and got[12] == {10, 11} and got[10] == {11, 12}
    p = spark.createDataFrame([(1, 200.0, 89.5), (2, 300.0, -89.5), (3, 10.0, 90.0), (4, 10.0, -90.0)], "k int, ra double, dec double")
    assert {r.k: r.field for r in tiles.point_to_tile(p, t).collect()} == {1: 1, 2: 12, 3: 1, 4: 12}


def test_dropping_overruns_one_by_one(spark):
    rnd = random.Random(3)
    rows = []
    for seg in range(30):
        for i in range(rnd.randrange(1, 8)):
            rows.append((seg, i, 100.0, 100.0 + 10 * (seg % 6), float(rnd.randrange(1, 20)), float(rnd.randrange(1, 25))))
    df = spark.createDataFrame(rows, "segment_id int, i int, start_s double, end_s double, duration double, exposure_time double")
    started = schedule.exposure_start_times(df, ["i"])
    got = {(r.segment_id, r.i) for r in schedule.drop_overruns(started, ["i"]).collect()}
    want = set()
    for seg in range(30):
        mine, at = [], 100.0
        for r in [r for r in rows if r[0] == seg]:
            mine.append((r[1], at, r[5], r[3]))
            at += r[4]
        while mine and mine[-1][1] + mine[-1][2] > mine[-1][3]:
            mine.pop()
        want |= {(seg, m[0]) for m in mine}
    assert got == want


def test_clip_correction_restores_the_variance():
    a = np.random.default_rng(0).normal(size=400000)
    sigma = 0.5 * (np.percentile(a, 84) - np.percentile(a, 16))
    kept = a[np.abs(a - np.median(a)) <= 2.0 * sigma]
    assert kept.var() * pixels.clip_correction(2.0) == pytest.approx(1.0, abs=0.01)


def test_flat_and_empty_images(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 0, 0, 3.0), (1, 0, 1, 3.0), (2, 0, 0, nan), (2, 0, 1, nan)], "image_id long, y long, x long, value double")
    m = {r.image_id: r for r in pixels.image_moments(df).collect()}
    assert m[1].skew is None and m[1].kurtosis is None and m[2].mean is None
    s = {r.image_id: r for r in pixels.pixel_clipped_stats(df).collect()}
    assert s[1].nkept == 2 and s[1].clippedstd == 0 and s[2].nancount == 2 and s[2].nkept == 0
    b = pixels.background_clipped_mean(df, 1, 1).collect()
    assert {r.image_id for r in b} == {1, 2}
    assert all(math.isnan(r.value) for r in pixels.normalize_pixels(df).filter("image_id = 2").collect() if r.value is not None)


def test_threshold_edges(spark):
    rnd = random.Random(6)
    data = [(int(rnd.random() < 0.4), rnd.randrange(0, 21) / 20) for _ in range(300)] + [(1, 0.0), (0, 1.0)]
    df = spark.createDataFrame(data, "y int, p double")
    for r in evaluation.threshold_counts(df, 21).collect():
        t = r.step / 20
        assert (r.tp, r.fp) == (sum(1 for y, p in data if p > t and y), sum(1 for y, p in data if p > t and not y))
    pos, neg = [p for y, p in data if y], [p for y, p in data if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert evaluation.roc_auc(df).first().roc_auc == pytest.approx(auc)


def test_files_are_read(spark, tmp_path):
    (tmp_path / "job_1.log").write_text("start\nterminating_exitcode = 1\naws_batch_job_id = abc\nterminating_exitcode = 0\n")
    lines = readers.read_numbered_lines(spark, str(tmp_path / "*.log"))
    got = jobs.parse_job_logs(lines, {"aws_batch_job_id": "batch", "terminating_exitcode": "code"}).first()
    assert (got.batch, got.code) == ("abc", "0")
    (tmp_path / "cat.txt").write_text("# 1 A\n  1 2.5   x\n2\t3.5 y\n")
    rows = readers.read_ascii_catalog(spark, str(tmp_path / "cat.txt"), ["A", "B", "C"], {"C": "string", "A": "int"}).drop("file").collect()
    assert sorted((r.A, r.C) for r in rows) == [(1, "x"), (2, "y")]
    (tmp_path / "schedule.csv").write_text("visit-id,start,end,duration,assigned orient,nominal orient,gap,ra,dec\n"
                                           "0099401112183,2026.365:07:22:37,2026.365:08:22:37,3600,NA,12.5,0,1,2\n")
    seg = readers.read_segment_schedule(spark, str(tmp_path / "schedule.csv")).first()
    assert (seg.program, seg.plan, seg["pass"], seg.segment, seg.pa) == (994, 1, 112, 183, 12.5)
    assert str(seg.segment_start) == "2026-12-31 07:22:37"
    (tmp_path / "req.csv").write_text("1,8.573549,-42.316955\n2,1.0,2.0\n")
    assert readers.read_positions(spark, str(tmp_path / "req.csv")).count() == 2
    (tmp_path / "inj.json").write_text('{"7": {"type": "gaussian", "ra": 1.0, "dec": 2.0,\n "parameters": {"sigma": 3.0, "magnitude": 20.0}}}')
    inj = readers.read_injections(spark, str(tmp_path / "inj.json")).first()
    assert (inj.id, inj.type, inj.sigma, inj.period) == ("7", "gaussian", 3.0, None)
    sums = readers.read_checksums(spark, str(tmp_path / "req.csv")).first()
    import hashlib
    assert sums.md5 == hashlib.md5((tmp_path / "req.csv").read_bytes()).hexdigest()


def test_catalogue_files_have_a_fixed_number_of_rows(spark, tmp_path):
    df = spark.range(2500).select(F.col("id").alias("sid"), F.rand(1).alias("v"))
    writers.write_source_catalog(df, str(tmp_path / "c"), rows_per_file=300)
    per_file = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per_file) == 2500 and max(r["count"] for r in per_file) <= 300


def test_stream_of_nights_equals_one_walk(spark, tmp_path):
    rnd = random.Random(8)
    cols = "sid long, field long, expid long, sca int, mjdobs double, ra double, dec double, fluxfit double, flags int"
    rows = [(i, rnd.randrange(2), i // 40, rnd.randrange(1, 3), 60000.0 + i // 40, (rnd.gauss(0, 8e-4)) % 360, 10 + rnd.gauss(0, 8e-4), 1.0, 0) for i in range(160)]
    for night in range(4):
        part = [r for r in rows if r[2] == night]
        spark.createDataFrame(part, cols).coalesce(1).write.parquet(str(tmp_path / "in" / f"n{night}"))
    stream = spark.readStream.schema(cols).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    streaming.streaming_association(stream, str(tmp_path / "out"), 1e-3).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / "merges")).select("field", "aid", "sid").collect()}
    whole = spark.createDataFrame(rows, cols)
    assert got == {tuple(r) for r in associate.associate_within_field(whole, 1e-3).collect()}
    last = spark.read.parquet(str(tmp_path / "out" / "objects" / "epoch=3"))
    merges = spark.createDataFrame(list(got), "field long, aid long, sid long")
    stats = {r.aid: r for r in objects.object_statistics(merges, whole, None).collect()}
    for r in last.collect():
        assert r.nsources == stats[r.aid].nsources and r.meandec == pytest.approx(stats[r.aid].meandec, abs=1e-9)


def test_window_counts_of_a_stream_equal_the_table(spark, tmp_path):
    rows = spark.range(400).selectExpr("timestamp_seconds(1700000000 + id * 3000) AS dateobs", "CAST(id % 3 AS INT) AS sca")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    counts = streaming.nightly_window_counts(stream, late="30 days")
    (counts.writeStream.outputMode("complete").format("memory").queryName("nightly").trigger(availableNow=True).start().awaitTermination())
    assert {tuple(r) for r in spark.table("nightly").collect()} == {tuple(r) for r in streaming.nightly_window_counts(rows).collect()}


def test_date_slices_follow_the_dates(spark):
    """Four slices of about equal size whatever the dates, each with the partitions of its rows."""
    from skycat.plans.queries_objects import date_slices

    rows = spark.range(400, numPartitions=4).selectExpr("id AS sid", "cast(id % 40 AS double) AS mjdobs")
    parts = date_slices(rows, 4)
    dates = [sorted(r["mjdobs"] for r in p.collect()) for p in parts]
    assert len(parts) == 4 and all(60 <= len(d) <= 140 for d in dates) and sum(map(len, dates)) == 400
    assert all(a[-1] < b[0] for a, b in zip(dates, dates[1:])) and all(p.rdd.getNumPartitions() == 4 for p in parts)
    assert [p.count() for p in date_slices(rows.withColumn("mjdobs", F.lit(7.0)), 4)] in ([0, 400], [400])


def _alert_input(spark):
    """Sources of three objects, one source twice and one source in two objects."""
    sources = spark.createDataFrame([(1, 100.0, 7, 1, 5.0, 1.0, 10.0, 20.0), (2, 150.0, 8, 1, 6.0, 2.0, 10.0, 20.0), (3, 700.0, 9, 2, 7.0, 1.0, 10.0, 20.0),
                                     (4, 120.0, 7, 2, 8.0, 0.0, 11.0, 21.0), (4, 120.0, 7, 2, 8.0, 0.0, 11.0, 21.0), (5, 130.0, 6, 1, 9.0, 1.0, 11.0, 21.0),
                                     (6, 140.0, 6, 1, 9.0, 1.0, 12.0, 22.0)],
                                    "sid long, mjdobs double, expid long, fid long, fluxfit double, fluxerr double, ra double, dec double")
    merges = spark.createDataFrame([(10, 1), (10, 2), (10, 3), (11, 4), (11, 5), (10, 5)], "aid long, sid long")
    objects = spark.createDataFrame([(10, 10.0, 20.0, 3), (11, 11.0, 21.0, 2)], "aid long, ra0 double, dec0 double, nsources long")
    filters = spark.createDataFrame([(1, "F184"), (2, "H158")], "fid long, filter string")
    return sources, merges, objects, filters


def test_alert_history_from_lists(spark):
    sources, merges, objects, filters = _alert_input(spark)
    for until in (False, True):
        rows = nested.assemble_alerts(sources.select("sid"), merges, objects, sources, filters, until_trigger=until).collect()
        seen = sorted((r["diaSourceId"], None if r["prvDiaSources"] is None else [p["diaSourceId"] for p in r["prvDiaSources"]]) for r in rows)
        # source 5 is reported with object 10; source 4 stands twice, and its history holds the detections for each of its rows
        later = {1: [5, 2, 3], 2: [1, 5, 3], 3: None, 4: [5, 5], 5: [1, 2, 3], 6: None}
        before = {1: None, 2: [1, 5], 3: None, 4: None, 5: [1], 6: None}
        assert seen == [(s, (before if until else later)[s]) for s in (1, 2, 3, 4, 4, 5, 6)]
        for r in rows:
            for p in [r["diaSource"], *(r["prvDiaSources"] or [])]:
                flux = {1: 5.0, 2: 6.0, 3: 7.0, 4: 8.0, 5: 9.0, 6: 9.0}[p["diaSourceId"]]
                assert p["psfFlux"] == flux and p["band"] == ("H158" if p["diaSourceId"] in (3, 4) else "F184")
                assert p["diaObjectId"] == r["diaSource"]["diaObjectId"] and p["visit"] == p["expid"] and p["hp9"] == 0 and p["apFlux"] is None
    assert {r["diaSourceId"]: r["diaSource"]["snr"] for r in rows}[2] == 3.0


def test_alert_records_are_shuffled_as_their_own_fields(spark):
    sources, merges, objects, filters = _alert_input(spark)
    plan = nested.assemble_alerts(sources.select("sid"), merges, objects, sources, filters)._jdf.queryExecution().executedPlan().toString()
    gathered = [line for line in plan.splitlines() if "collect_list" in line]
    assert gathered and not any("apFlux" in line or "dipoleAngle" in line for line in gathered)


def test_stamps_are_filtered_in_arrays(spark):
    rnd = random.Random(4)
    grid = {(y, x): rnd.choice([None, float("nan"), rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.gauss(0, 1)]) for y in range(12) for x in range(9)}
    rows = [(0, y, x, v) for (y, x), v in grid.items()] + [(0, 5, 5, 0.5), (1, 3, 3, None)]  # a pixel that stands twice, an image without values
    cands = [(0, 1, 0, 0), (0, 2, 5, 4), (0, 3, 11, 8), (0, 3, 10, 8), (0, 4, 50, 50), (1, 5, 3, 3)]  # candidate 3 stands twice
    df = pixels.stamp_metrics(spark.createDataFrame(cands, "image_id long, cand_id long, y long, x long"),
                              spark.createDataFrame(rows, "image_id long, y long, x long, value double"))
    assert "lambdafunction" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {r.cand_id: r for r in df.collect()}
    assert set(got) == {1, 2, 3, 5}
    for c in got:
        stamp = [(y - cy, x - cx, None if v is None or v != v else v) for im, k, cy, cx in cands if k == c for i, y, x, v in rows
                 if i == im and abs(y - cy) <= 2 and abs(x - cx) <= 2]
        near = [[v for b, a, v in stamp if abs(b - dy) <= 1 and abs(a - dx) <= 1 and v is not None] for dy, dx, _ in stamp]
        smooth = [float(np.median(n)) for n in near if n]
        size = sum(abs(v) for v in smooth)
        assert got[c].sumrat == (pytest.approx(sum(smooth) / size) if size else None)
        assert (got[c].n_negative, got[c].n_bad) == (sum(v is not None and v < 0 for *_, v in stamp), sum(v is None for *_, v in stamp))


def test_job_logs_are_bundled(spark, tmp_path):
    from skycat.plans.queries import QUERIES

    rows = [(i, i % 40 if i % 41 else None, "error" if i % 3 == 0 else "click") for i in range(200)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    logs = QUERIES["parse_job_logs"](spark, str(tmp_path))
    assert len(logs.inputFiles()) < 40
    last = {}
    for i, user, kind in rows:
        last["__HIVE_DEFAULT_PARTITION__" if user is None else f"job_{user}.log"] = (str(i), "64" if kind == "error" else "0")
    assert {r.file: (r.batch_id, r.exit_code) for r in logs.collect()} == last


def test_catalog_files_are_packed(spark, tmp_path):
    from skycat.plans import queries_objects
    from skycat.plans.fixtures import Catalog

    lines = spark.range(1000).selectExpr("concat_ws(' ', id, 'x') AS value")
    folder = queries_objects._files(Catalog(spark, str(tmp_path)), lines, packed=True)
    back = readers.read_lines(spark, folder)
    assert all(name.endswith(".gz") for name in back.inputFiles())
    assert sorted(r.value for r in back.collect()) == sorted(r.value for r in lines.collect())
