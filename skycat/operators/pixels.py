"""Operators over pixel tables (image_id, y, x, value); NaN marks a pixel without value."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .quantiles import exact_percentiles

PIXEL = ["image_id", "y", "x"]


def number(c: str) -> Column:
    """The value, NULL where it is NaN."""
    return F.when(~F.isnan(F.col(c)), F.col(c))


def clip_correction(n_sigma: float) -> float:
    """Factor that restores the variance of normal data clipped at ``n_sigma``.

    The clip limit is in units of half the distance of the 16th and 84th percentile.
    """
    normal = NormalDist()
    a = n_sigma * normal.inv_cdf(0.84)
    inside = 2 * normal.cdf(a) - 1
    return 1.0 / (1.0 - 2 * a * math.exp(-a * a / 2) / math.sqrt(2 * math.pi) / inside)


def pixel_clipped_stats(pixels: DataFrame, n_sigma: float = 3.0, saturation: float = 50000.0) -> DataFrame:
    """Robust statistics of each image with rejection beyond median +- ``n_sigma`` sigma."""
    rows = pixels.select("image_id", number("value").alias("v"))
    pct = exact_percentiles(rows, ["image_id"], "v", {"p16": 0.16, "gmed": 0.5, "p84": 0.84})
    pct = pct.withColumn("gsigma", 0.5 * (F.col("p84") - F.col("p16"))).select("image_id", "gmed", "gsigma")
    v = F.col("v")
    kept = F.when(F.abs(v - F.col("gmed")) <= n_sigma * F.col("gsigma"), v)
    out = rows.join(pct, "image_id", "left_outer").groupBy("image_id").agg(
        F.any_value("gmed").alias("gmed"), F.any_value("gsigma").alias("gsigma"), F.min(v).alias("gdatamin"),
        F.max(v).alias("gdatamax"), F.count_if(v >= saturation).alias("satcount"),
        F.count_if(v.isNull()).alias("nancount"), F.count("*").alias("pixcount"), F.avg(kept).alias("clippedavg"),
        (F.stddev_pop(kept) * math.sqrt(clip_correction(n_sigma))).alias("clippedstd"), F.count(kept).alias("nkept"))
    return out.withColumn("noutliers", F.col("pixcount") - F.col("nancount") - F.col("nkept"))


def _percentile(a: Column, n: Column, p: float) -> Column:
    """Interpolated percentile of a sorted array of length ``n``."""
    rank = F.lit(p) * (n - 1)
    low = F.floor(rank).cast("int")
    first = F.get(a, low)
    return F.when(rank > low, first + (F.get(a, low + 1) - first) * (rank - low)).otherwise(first)


def _with_clipped(df: DataFrame, p_low: float, p_high: float, n_sigma: float, strict: bool) -> DataFrame:
    """Add the sorted values, half the percentile distance and the kept values of ``values``."""
    def pct(p):
        return _percentile(F.col("__a"), F.size("__a"), p)

    df = df.withColumn("__a", F.array_sort("values"))
    df = df.withColumns({"__m": pct(0.5), "__s": 0.5 * (pct(p_high) - pct(p_low))})
    limit = n_sigma * F.col("__s")

    def inside(v):
        off = F.abs(v - F.col("__m"))
        return off < limit if strict else off <= limit

    return df.withColumn("__k", F.filter("__a", inside))


def _mean(a: str) -> Column:
    total = F.aggregate(F.col(a), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(a) > 0, total / F.size(a))


def _sample_std(a: str, mean: Column) -> Column:
    squares = F.aggregate(F.col(a), F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
    return F.when(F.size(a) > 1, F.sqrt(squares / (F.size(a) - 1))).when(F.size(a) == 1, 0.0)


def _window_values(pixels: DataFrame, half: int, step: int, reflect: bool) -> DataFrame:
    """Per grid point (multiples of ``step``) the valid values of its (2*half+1)^2 window.

    Each pixel is sent to the grid points it belongs to; an array is never longer than the
    window.  ``reflect`` mirrors the image at its borders, else windows are cut there.
    """
    rows = pixels.select(*PIXEL, number("value").alias("v"))
    size = pixels.groupBy("image_id").agg((F.max("y") + 1).alias("__ny"), (F.max("x") + 1).alias("__nx"))
    rows = rows.join(size, "image_id")
    for axis, n in (("y", "__ny"), ("x", "__nx")):
        c = F.col(axis)
        places = F.array(c)
        if reflect:
            low = F.when((c >= 1) & (c <= half), F.array(-c)).otherwise(F.array().cast("array<bigint>"))
            high = F.when((c <= F.col(n) - 2) & (c >= F.col(n) - 1 - half), F.array(2 * F.col(n) - 2 - c)).otherwise(F.array().cast("array<bigint>"))
            places = F.concat(places.cast("array<bigint>"), low.cast("array<bigint>"), high.cast("array<bigint>"))
        rows = rows.withColumn(axis, F.explode(places))
        c = F.col(axis)
        first = F.greatest(F.ceil((c - half) / step), F.lit(0).cast("long"))
        last = F.least(F.floor((c + half) / step), F.floor((F.col(n) - 1) / step))
        rows = rows.withColumn("g" + axis, F.explode(F.when(first <= last, F.sequence(first, last))))
    return rows.groupBy("image_id", "gy", "gx").agg(F.collect_list("v").alias("values"), F.count_if(F.col("v").isNull()).alias("n_bad"))


def background_clipped_mean(pixels: DataFrame, half: int, step: int, n_sigma: float = 3.0, bad_percent: float = 100.0,
                            pothole: float | None = None) -> DataFrame:
    """Local background on a coarse grid: clipped mean of a window, NULL with too many bad pixels.

    Bounds are exclusive, sigma comes from the percentiles 15.9 and 84.1, the error of the mean
    from the sample standard deviation.  Values at or below ``pothole`` are bad.
    """
    if pothole is not None:
        pixels = pixels.withColumn("value", F.when(F.col("value") > pothole, F.col("value")).otherwise(F.lit(float("nan"))))
    tolerance = int(bad_percent * (2 * half + 1) ** 2 * 0.01)
    df = _with_clipped(_window_values(pixels, half, step, True), 0.159, 0.841, n_sigma, True)
    df = df.withColumn("__mean", _mean("__k"))
    df = df.withColumn("__std", _sample_std("__k", F.col("__mean")))
    good = (F.col("n_bad") <= tolerance) & (F.size("__a") > 0)
    return df.select("image_id", (F.col("gy") * step).alias("y"), (F.col("gx") * step).alias("x"), "n_bad",
                     F.when(good, F.col("__mean")).alias("background"),
                     F.when(good, F.try_divide(F.col("__std"), F.sqrt(F.size("__k")))).alias("background_unc"),
                     F.when(good, F.col("__s")).alias("scale"), F.when(good, F.size("__k")).alias("n_used"),
                     F.when(good, F.size("__a") - F.size("__k")).alias("n_rejected"))


def background_global(pixels: DataFrame, n_sigma: float = 3.0) -> DataFrame:
    """The same statistics over whole images."""
    rows = pixels.select("image_id", number("value").alias("v"))
    pct = exact_percentiles(rows, ["image_id"], "v", {"p1": 0.159, "med": 0.5, "p2": 0.841})
    pct = pct.withColumn("scale", 0.5 * (F.col("p2") - F.col("p1"))).select("image_id", "med", "scale")
    kept = F.when(F.abs(F.col("v") - F.col("med")) < n_sigma * F.col("scale"), F.col("v"))
    return rows.join(pct, "image_id").groupBy("image_id").agg(
        F.avg(kept).alias("background"), F.try_divide(F.stddev_samp(kept), F.sqrt(F.count(kept))).alias("background_unc"),
        F.any_value("scale").alias("scale"), F.count(kept).alias("n_used"),
        (F.count("v") - F.count(kept)).alias("n_rejected"), F.count_if(F.col("v").isNull()).alias("n_bad"))


def local_clipped_average(pixels: DataFrame, half: int = 1, n_sigma: float = 3.0) -> DataFrame:
    """Clipped mean of the window around each pixel that has a value."""
    windows = _window_values(pixels, half, 1, False)
    centres = pixels.filter(~F.isnan("value")).select("image_id", F.col("y").cast("long").alias("gy"), F.col("x").cast("long").alias("gx"))
    df = _with_clipped(windows.join(centres, ["image_id", "gy", "gx"], "left_semi"), 0.16, 0.84, n_sigma, False)
    return df.select("image_id", F.col("gy").alias("y"), F.col("gx").alias("x"), _mean("__k").alias("value"))


def image_moments(pixels: DataFrame, sample_sigma: bool = True) -> DataFrame:
    """Mean, standard deviation, skew and excess kurtosis per image; NULL moments at sigma 0.

    Spark's aggregates use the population sigma; the sample sigma only rescales them.
    """
    v = number("value")
    n = F.count(v)
    shrink = F.when(n > 1, (n - 1) / n) if sample_sigma else F.lit(1.0)
    std = F.stddev_samp(v) if sample_sigma else F.stddev_pop(v)
    flat = F.coalesce(std, F.lit(0.0)) == 0
    return pixels.groupBy("image_id").agg(
        n.alias("n"), F.avg(v).alias("mean"), std.alias("sigma"),
        F.when(~flat, F.skewness(v) * F.pow(shrink, 1.5)).alias("skew"),
        F.when(~flat, (F.kurtosis(v) + 3.0) * shrink * shrink - 3.0).alias("kurtosis"))


def coverage_depth_percent(coverage: DataFrame, depth: float = 5.0) -> DataFrame:
    """Percentage of full depth reached, pixels deeper than ``depth`` counting as full."""
    return coverage.groupBy("image_id").agg(
        (100.0 * F.sum(F.least(F.col("value"), F.lit(depth))) / (depth * F.count("*"))).alias("cov5percent"))


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.select(*PIXEL, F.col("value").alias(name))


def mask_by_coverage(pixels: DataFrame, coverage: DataFrame, threshold: float) -> DataFrame:
    """NaN where the coverage is below the threshold (or itself NaN)."""
    deep = (F.col("cov") >= threshold) & ~F.isnan("cov")
    return (_named(pixels, "value").join(_named(coverage, "cov"), PIXEL)
            .select(*PIXEL, F.when(deep, F.col("value")).otherwise(F.lit(float("nan"))).alias("value")))


def naive_difference(science: DataFrame, reference: DataFrame) -> DataFrame:
    return (_named(science, "sci").join(_named(reference, "ref"), PIXEL)
            .select(*PIXEL, (F.col("sci") - F.col("ref")).alias("value")))


def pixel_uncertainty(science: DataFrame, reference: DataFrame, coverage: DataFrame, sigma: DataFrame, gain: float,
                      min_coverage: float) -> DataFrame:
    """Uncertainty of a difference image from photon noise and background scatter.

    ``sigma``: image_id, sigma.  Coverage below ``min_coverage`` counts as 1; where the result
    is undefined sigma itself is taken.
    """
    rows = (_named(science, "sci").join(_named(reference, "ref"), PIXEL).join(_named(coverage, "cov"), PIXEL)
            .join(sigma.select("image_id", "sigma"), "image_id"))
    depth = F.when((F.col("cov") >= min_coverage) & ~F.isnan("cov"), F.col("cov")).otherwise(1.0)
    unc = F.sqrt(F.abs("sci") / gain + F.abs("ref") / (gain * depth) + F.col("sigma") * F.col("sigma"))
    return rows.select(*PIXEL, F.nanvl(unc, F.col("sigma")).alias("value"))


def simple_uncertainty(pixels: DataFrame, gain: float, exposure_time: float, read_noise: float) -> DataFrame:
    """Uncertainty of a rate image from photon and read noise."""
    unc = F.sqrt(F.abs("value") * exposure_time / gain + read_noise * read_noise) / exposure_time
    return pixels.select(*PIXEL, unc.alias("value"))


def coadd_pixels(stack: DataFrame, combine: str = "mean", order: str = "image_id") -> DataFrame:
    """Combine aligned images per output pixel: value, uncertainty and coverage.

    ``stack``: image_id, y, x, value, unc; ``combine``: mean, sum, median, min, max, first or
    last (in the given order).  Pixels without any value become NaN with coverage 0.
    """
    v = number("value")
    valid = F.when(v.isNotNull(), F.col(order))
    variance = F.sum(F.when(v.isNotNull(), F.col("unc") * F.col("unc")))
    coverage = F.count(v)
    nan = F.lit(float("nan"))
    how = {"mean": F.avg(v), "sum": F.sum(v), "min": F.min(v), "max": F.max(v), "first": F.min_by(v, valid),
           "last": F.max_by(v, valid)}
    scale = F.lit(1.0) if combine == "sum" else coverage.cast("double")
    unc = F.when(coverage > 0, F.sqrt(variance) / scale).otherwise(nan).alias("unc")
    if combine == "median":
        out = stack.groupBy("y", "x").agg(unc, coverage.alias("coverage"))
        middle = exact_percentiles(stack.withColumn("value", v), ["y", "x"], "value", {"value": 0.5})
        return (out.join(middle, ["y", "x"], "left_outer")
                .select("y", "x", F.coalesce("value", nan).alias("value"), "unc", "coverage"))
    return stack.groupBy("y", "x").agg(F.coalesce(how[combine], nan).alias("value"), unc, coverage.alias("coverage"))


def normalize_pixels(pixels: DataFrame) -> DataFrame:
    """Divide by the sum of the image; NaN pixels stay NaN."""
    total = pixels.groupBy("image_id").agg(F.sum(number("value")).alias("__total"))
    return pixels.join(total, "image_id").select(*PIXEL, F.try_divide(F.col("value"), F.col("__total")).alias("value"))


def fill_nan_pixels(pixels: DataFrame, fill: float) -> DataFrame:
    """Replace NaN and remember where it was in ``was_nan``."""
    return pixels.select(*PIXEL, F.nanvl("value", F.lit(fill)).alias("value"), F.isnan("value").alias("was_nan"))


def restore_nan_pixels(filled: DataFrame) -> DataFrame:
    return filled.select(*PIXEL, F.when(F.col("was_nan"), F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))


def transpose_pixels(pixels: DataFrame) -> DataFrame:
    return pixels.select("image_id", F.col("x").alias("y"), F.col("y").alias("x"), "value")


def scale_pixels(pixels: DataFrame, factor: float) -> DataFrame:
    return pixels.withColumn("value", F.col("value") * factor)


def stamp_metrics(candidates: DataFrame, pixels: DataFrame, half: int = 2) -> DataFrame:
    """Metrics of the cutout around each candidate (image_id, cand_id, y, x).

    n_negative and n_bad count pixels; sumrat is the sum over the sum of absolute values of the
    3x3 median-filtered cutout.  A cutout is an array of at most (2*half+1)^2 pixels.
    """
    offsets = F.sequence(F.lit(-half), F.lit(half))
    asked = (candidates.select("image_id", "cand_id", F.col("y").alias("c_y"), F.col("x").alias("c_x"))
             .withColumn("dy", F.explode(offsets)).withColumn("dx", F.explode(offsets))
             .withColumns({"y": F.col("c_y") + F.col("dy"), "x": F.col("c_x") + F.col("dx")}))
    cut = asked.join(pixels.select(*PIXEL, number("value").alias("v")), PIXEL)
    stamp = cut.groupBy("image_id", "cand_id").agg(
        F.count_if(F.col("v") < 0).alias("n_negative"), F.count_if(F.col("v").isNull()).alias("n_bad"),
        F.collect_list(F.struct("dy", "dx", "v")).alias("s"))

    return stamp.select("image_id", "cand_id", "n_negative", "n_bad", smoothed_ratio(F.col("s.dy"), F.col("s.dx"), F.col("s.v")).alias("sumrat"))


STAMP_CELLS = 1_000_000  # pairs of pixels of cutouts taken at once


@F.pandas_udf(DoubleType())
def smoothed_ratio(dy: pd.Series, dx: pd.Series, v: pd.Series) -> pd.Series:
    """Sum over sum of absolute values of the 3x3 median-filtered cutouts; NULL where that is nothing.  Cutouts of one size are filtered together."""
    out, size = np.full(len(v), np.nan), v.map(len).to_numpy()
    for n in np.unique(size[size > 0]).tolist():
        of = np.flatnonzero(size == n)
        step, rows = max(1, STAMP_CELLS // (n * n)), max(1, STAMP_CELLS // n)
        for at in range(0, len(of), step):
            some = of[at:at + step]
            y, x, value = (np.stack([np.asarray(c.iloc[i], float) for i in some]) for c in (dy, dx, v))
            total, whole = np.zeros(len(some)), np.zeros(len(some))
            for a in range(0, n, rows):
                near = (np.abs(y[:, a:a + rows, None] - y[:, None]) <= 1) & (np.abs(x[:, a:a + rows, None] - x[:, None]) <= 1) & ~np.isnan(value)[:, None]
                ordered, k = np.sort(np.where(near, value[:, None], np.inf), axis=2), near.sum(axis=2)
                low, high = np.maximum(k - 1, 0) // 2, k // 2
                low, high = (np.take_along_axis(ordered, np.minimum(i, n - 1)[:, :, None], 2)[:, :, 0] for i in (low, high))
                with np.errstate(invalid="ignore"):
                    middle = np.where(k % 2 == 1, low, low + (high - low) * 0.5)
                middle = np.where(k > 0, middle, 0.0)
                total += middle.sum(axis=1)
                whole += np.abs(middle).sum(axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                out[some] = np.where(whole > 0, total / whole, np.nan)
    return pd.Series(out).astype(object).where(~np.isnan(out), None)


def forced_flux_weights(positions: DataFrame, pixels: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted sum of the pixels around each position (image_id, req_id, y, x).

    ``weights``: dy, dx, weight, a small point-spread table that becomes one array; NaN pixels
    do not count.
    """
    table = weights.agg(F.collect_list(F.struct("dy", "dx", "weight")).alias("w"))
    asked = positions.withColumn("w", F.explode(table.scalar()))
    asked = asked.select("image_id", "req_id", (F.col("y") + F.col("w.dy")).alias("y"), (F.col("x") + F.col("w.dx")).alias("x"),
                         F.col("w.weight").alias("weight"))
    hit = asked.join(pixels.select(*PIXEL, number("value").alias("v")), PIXEL)
    return hit.groupBy("image_id", "req_id").agg(F.sum(F.col("v") * F.col("weight")).alias("flux"), F.count("v").alias("n_pixels"))
