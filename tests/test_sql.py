"""Functions of the SQL surface."""

import math

import pytest
from pyspark.sql.udtf import SkipRestOfInputTableException

from skycat import sql
from skycat.operators import spatial, versions


def test_functions_are_called_from_text(spark):
    assert set(sql.register(spark)) == {*sql.SCALARS, *sql.TABLES}
    spark.createDataFrame([(1, 10.0, 5.0, "x"), (2, 350.0, 5.0, None), (3, None, 5.0, "y"), (4, 0.5, 5.0, "z"), (5, 0.0, 90.0, "p")], "k int, ra double, dec double, dist string").createOrReplaceTempView("places")
    got = spark.sql("SELECT * FROM cone_search(TABLE(places), 0.0D, 5.0D, 11.0D)")
    assert got.columns == ["k", "ra", "dec", "dist", "dist_deg"]
    want = {r["k"]: r["dist_deg"] for r in spatial.cone_search(spark.table("places"), 0.0, 5.0, 11.0).collect()}
    assert {r["k"]: pytest.approx(r["dist_deg"], abs=1e-9) for r in got.collect()} == want and set(want) == {1, 2, 4}
    renamed = spark.sql("SELECT k FROM cone_search(TABLE(SELECT k, ra AS a, dec AS d FROM places), 0.0D, 90.0D, 0.1D, ra_column => 'a', dec_column => 'd')")
    assert [r["k"] for r in renamed.collect()] == [5]
    for bad in ("cone_search(TABLE(SELECT k FROM places), 0, 0, 1)", "cone_search(TABLE(SELECT *, 1 AS dist_deg FROM places), 0, 0, 1)", "cone_search(1, 0, 0, 1)"):
        with pytest.raises(Exception, match="column|table"):
            spark.sql(f"SELECT * FROM {bad}").collect()
    one = spark.sql("SELECT sky_distance(0, 89, 180, 89) AS d, mag_from_flux(-1, 25) AS m, mag_from_flux(100, 25) AS n, signal_to_noise(1, 0) AS s, file_basename('a/b.fits') AS f, "
                    "file_basename('b') AS g, alert_name(25, 1, 'AB') AS a, alert_name(20, 1, 'AB') AS u, has_bit(5, 2) AS b, in_cone(359.9, 0, 0.1, 0, 0.3) AS c").first()
    assert one["d"] == pytest.approx(2.0) and one["m"] is None and one["n"] == 20.0 and one["s"] is None and (one["f"], one["g"]) == ("b.fits", None)
    assert (one["a"], one["u"], one["b"], one["c"]) == ("AB25aaaaaaa", "notsupported", True, True)


def test_tables_by_key(spark):
    sql.register(spark)
    rows = [(k % 3, k, bool(k == 4), math.sin(k)) for k in range(12)]
    spark.createDataFrame(rows, "key int, version int, is_locked boolean, d double").createOrReplaceTempView("products")
    got = spark.sql("SELECT key, version, vbest FROM best_versions(TABLE(products) PARTITION BY (key) ORDER BY (is_locked DESC, version DESC))").collect()
    want = versions.resolve_vbest(spark.table("products"), ["key"], spark.table("products")["is_locked"]).select("key", "version", "vbest").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    first = spark.sql("SELECT key, version, rank FROM first_rows(TABLE(products) PARTITION BY (key) ORDER BY (d, version), 2)").collect()
    assert {tuple(r) for r in first} == {(k, v, i + 1) for k in range(3) for i, (_, v) in enumerate(sorted((d, v) for key, v, _, d in rows if key == k)[:2])}


def test_first_rows_stop_after_k():
    first = sql.FirstRows()
    assert [list(first.eval((7, d), 2)) for d in (0.1, 0.2)] == [[(7, 0.1, 1)], [(7, 0.2, 2)]]
    with pytest.raises(SkipRestOfInputTableException):  # Spark then passes over the key's other rows
        list(first.eval((7, 0.3), 2))
