"""Detection quality: cuts, truth matching summaries, recovery and classifier metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe


def ref_point_source_filter(catalog: DataFrame, mag_min: float, mag_max: float, zero_point: float, min_class_star: float = 0.5,
                            max_isoarea: float = 100.0, max_elongation: float = 1.3) -> DataFrame:
    """Point-like reference sources in a magnitude range, with their flux."""
    keep = (F.col("mag").between(mag_min, mag_max) & (F.col("class_star") >= min_class_star)
            & (F.col("isoarea") <= max_isoarea) & (F.col("awin_bwin") <= max_elongation))
    return catalog.filter(keep).withColumn("flux_ref", F.pow(F.lit(10.0), 0.4 * (zero_point - F.col("mag"))))


def gain_match_scale(matches: DataFrame, defaults: DataFrame, min_matches: int = 20) -> DataFrame:
    """Flux scale and registration errors per image from matched reference and science sources.

    ``matches``: image_id, flux_ref, flux_sci, dx, dy; ``defaults``: image_id, zp_ref, zp_sci,
    default_rms.  With fewer than ``min_matches`` matches the scale follows from the zero points
    and the errors are the defaults.  Offsets need three matches.
    """
    from .quantiles import exact_percentiles

    good = F.col("flux_sci") > 0
    rows = matches.withColumn("ratio", F.when(good, F.col("flux_ref") / F.col("flux_sci")))
    sums = rows.groupBy("image_id").agg(F.count("*").alias("n"), F.sqrt(F.avg(F.col("dx") * F.col("dx"))).alias("rx"),
                                        F.sqrt(F.avg(F.col("dy") * F.col("dy"))).alias("ry"))
    # one pass of the percentile operator for all three medians
    stacked = rows.select("image_id", F.explode(F.array(*[F.struct(F.lit(n).alias("what"), F.col(n).alias("v"))
                                                          for n in ("ratio", "dx", "dy")])).alias("s")).select("image_id", "s.*")
    medians = exact_percentiles(stacked, ["image_id", "what"], "v", {"m": 0.5}).groupBy("image_id").agg(
        *[F.max(F.when(F.col("what") == n, F.col("m"))).alias("med_" + n) for n in ("ratio", "dx", "dy")])
    out = defaults.join(sums, "image_id", "left_outer").join(medians, "image_id", "left_outer")
    n = F.coalesce("n", F.lit(0))
    enough = n >= min_matches
    three = n >= 3
    return out.select(
        "image_id", n.alias("n_matches"),
        F.when(enough, F.col("med_ratio")).otherwise(F.pow(F.lit(10.0), 0.4 * (F.col("zp_ref") - F.col("zp_sci")))).alias("scale"),
        F.when(enough, F.when(three, F.col("rx")).otherwise(0.0)).otherwise(F.col("default_rms")).alias("dx_rms"),
        F.when(enough, F.when(three, F.col("ry")).otherwise(0.0)).otherwise(F.col("default_rms")).alias("dy_rms"),
        F.when(enough & three, F.col("med_dx")).otherwise(0.0).alias("dx_median"),
        F.when(enough & three, F.col("med_dy")).otherwise(0.0).alias("dy_median"))


def forced_flux_calibration(lightcurves: DataFrame) -> DataFrame:
    """Median ratio of true to measured flux per request, for PSF and aperture fluxes.

    ``lightcurves``: reqid, true_flux, psf_flux, aper_flux.  Points without a true flux or with
    a zero flux are left out.
    """
    from .quantiles import exact_percentiles

    def known(c):
        return F.col(c).isNotNull() & ~F.isnan(c)

    rows = lightcurves.filter(known("true_flux"))
    used = (F.col("psf_flux") != 0) & (F.col("aper_flux") != 0)
    ratios = rows.filter(used).select("reqid", F.explode(F.array(
        F.struct(F.lit("psf").alias("what"), (F.col("true_flux") / F.col("psf_flux")).alias("v")),
        F.struct(F.lit("aper").alias("what"), (F.col("true_flux") / F.col("aper_flux")).alias("v")))).alias("s")).select("reqid", "s.*")
    medians = exact_percentiles(ratios, ["reqid", "what"], "v", {"m": 0.5}).groupBy("reqid").agg(
        *[F.max(F.when(F.col("what") == w, F.col("m"))).alias(f"{w}_ratio") for w in ("psf", "aper")])
    return rows.groupBy("reqid").agg(F.count("*").alias("n_true")).join(medians, "reqid", "left_outer")


def catalog_fwhm_summary(catalog: DataFrame, fallback: float = 2.0) -> DataFrame:
    """Smallest, largest and median FWHM per catalogue; a negative median becomes the fallback."""
    from .quantiles import exact_percentiles

    rows = catalog.select("image_id", F.when(~F.isnan("fwhm"), F.col("fwhm")).alias("fwhm"))
    out = rows.groupBy("image_id").agg(F.min("fwhm").alias("fwhm_min"), F.max("fwhm").alias("fwhm_max"))
    out = out.join(exact_percentiles(rows, ["image_id"], "fwhm", {"fwhm_median": 0.5}), "image_id", "left_outer")
    return out.withColumn("fwhm_used", F.when(F.col("fwhm_median") < 0, fallback).otherwise(F.col("fwhm_median")))


def candidate_quality_cuts(candidates: DataFrame, naxis1: int, naxis2: int, edge: float = 5.0, min_snr: float = 5.0,
                           max_elong: float = 2.0, ratio: tuple[float, float] = (0.35, 1.2), max_chi: float = 10.0,
                           max_mag_diff: float = 0.3) -> DataFrame:
    """Candidates with the stage they reach: 0 fails the catalogue cuts, 1 fails the PSF cuts, 2 passes."""
    near = F.least(F.col("x"), F.col("y"), naxis1 - 1 - F.col("x"), naxis2 - 1 - F.col("y"))
    first = ((near > edge) & (F.col("snr") >= min_snr) & (F.col("elong") <= max_elong)
             & F.col("apfluxratio").between(*ratio))
    second = (F.col("redchi") > 0) & (F.col("redchi") < max_chi) & (F.abs(F.col("magap") - F.col("magpsf")) < max_mag_diff)
    return candidates.withColumn("stage", F.when(~F.coalesce(first, F.lit(False)), 0).when(~F.coalesce(second, F.lit(False)), 1).otherwise(2))


def stage_counts(staged: DataFrame, key: str, matched: str) -> DataFrame:
    """Matched and unmatched candidates that survive each stage, with percentages."""
    aggs = []
    for name, want in (("matched", True), ("unmatched", False)):
        for stage in range(3):
            aggs.append(F.count_if((F.col(matched) == want) & (F.col("stage") >= stage)).alias(f"{name}{stage}"))
    out = staged.groupBy(key).agg(*aggs)
    for name in ("matched", "unmatched"):
        for stage in (1, 2):
            share = F.when(F.col(f"{name}0") > 0, 100.0 * F.col(f"{name}{stage}") / F.col(f"{name}0"))
            out = out.withColumn(f"{name}{stage}_pct", share)
    return out


def catalog_case_summary(counts: DataFrame) -> DataFrame:
    """Mean, population scatter and 95 % margin of source and match counts per filter and case.

    ``counts``: filter, case, n_sources, n_matches; NaN and NULL counts are ignored.
    """
    aggs = []
    for c in ("n_sources", "n_matches"):
        v = F.when(~F.isnan(c), F.col(c))
        aggs += [F.avg(v).alias(f"{c}_mean"), F.stddev_pop(v).alias(f"{c}_std"),
                 F.try_divide(1.96 * F.stddev_pop(v), F.sqrt(F.count(v))).alias(f"{c}_margin")]
    return counts.groupBy("filter", "case").agg(F.count(F.when(~F.isnan("n_sources"), 1)).alias("sample_size"), *aggs)


def detection_confusion(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Injected sources found by neither, one or both catalogues.

    ``first`` and ``second``: the key of the injected source and a flag ``found``.
    """
    both = first.select(key, F.col("found").alias("a")).join(second.select(key, F.col("found").alias("b")), key)
    return both.agg(F.count_if("a").alias("first_true"), F.count_if(~F.col("a")).alias("first_false"),
                    F.count_if("b").alias("second_true"), F.count_if(~F.col("b")).alias("second_false"),
                    F.count_if(F.col("a") & ~F.col("b")).alias("only_first"), F.count_if(~F.col("a") & F.col("b")).alias("only_second"))


def with_score(scores: DataFrame) -> DataFrame:
    """The rows that can be counted: those with a label and a score that is a number."""
    return scores.filter(F.col("y").isNotNull() & F.col("p").isNotNull() & ~F.isnan("p"))


def threshold_counts(scores: DataFrame, n_thresholds: int, keys: list[str] = ()) -> DataFrame:
    """True and false positives and negatives at evenly spaced thresholds in [0, 1].

    ``scores``: y (0 or 1) and p; a row is predicted positive when p > threshold.  Rows without a
    label or with a NULL or NaN score are left out, as in the other metrics.  Each row is
    counted once, at the number of thresholds below it; the counts are then summed over the
    thresholds, of which there are few.
    """
    scores, last = with_score(scores), n_thresholds - 1
    p = F.col("p")
    guess = F.greatest(F.lit(0).cast("long"), F.least(F.ceil(p * last), F.lit(n_thresholds).cast("long")))
    # the product may be off by a rounding step: compare with the threshold itself
    below = (F.when((guess >= 1) & ~(p > (guess - 1) / last), guess - 1)
             .when((guess <= last) & (p > guess / last), guess + 1).otherwise(guess))
    keys = list(keys)
    per = scores.withColumn("__k", below).groupBy(*keys, "__k").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    steps = (scores.select(*keys).distinct() if keys else scores.sparkSession.range(1).drop("id")).select(
        *keys, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_thresholds).cast("long"))).alias("__k"))
    filled = steps.join(per, [*keys, "__k"], "left_outer").fillna(0, ["pos", "neg"])
    down = Window.partitionBy(*keys).orderBy(F.desc("__k")).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(*keys)
    out = filled.select(*keys, F.col("__k").alias("step"), F.coalesce(F.sum("pos").over(down), F.lit(0)).alias("tp"),
                        F.coalesce(F.sum("neg").over(down), F.lit(0)).alias("fp"),
                        F.sum("pos").over(total).alias("__p"), F.sum("neg").over(total).alias("__n"))
    return (out.filter(F.col("step") <= last)
            .select(*keys, "step", (F.col("step") / last).alias("threshold"), "tp", "fp",
                    (F.col("__p") - F.col("tp")).alias("fn"), (F.col("__n") - F.col("fp")).alias("tn")))


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and accuracy; 0 where a denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = counts.withColumns({"precision": F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0),
                              "recall": F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0),
                              "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn)})
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def precision_recall_curve(scores: DataFrame, n_thresholds: int) -> DataFrame:
    return with_rates(threshold_counts(scores, n_thresholds)).select("step", "threshold", "precision", "recall")


def closest_to_precision(curve: DataFrame, targets: list[float]) -> DataFrame:
    """For each target precision the curve point closest to it, the first one on ties."""
    asked = curve.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))
    gap = F.abs(F.col("precision") - F.col("target"))
    best = asked.groupBy("target").agg(F.min(F.struct(gap.alias("gap"), "step", "threshold", "precision", "recall")).alias("b"))
    return best.select("target", "b.threshold", "b.precision", "b.recall")


def best_f1(scores: DataFrame, n_thresholds: int = 1000) -> DataFrame:
    """Metrics at the threshold with the best F1, the first one on ties."""
    rates = with_rates(threshold_counts(scores, n_thresholds))
    best = rates.agg(F.max(F.struct("f1", (-F.col("step")).alias("s"), "threshold", "precision", "recall", "accuracy", "tp", "fp", "fn", "tn")).alias("b"))
    return best.select("b.threshold", "b.f1", "b.precision", "b.recall", "b.accuracy", "b.tp", "b.fp", "b.fn", "b.tn")


def classifier_metrics(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, rates and area under the ROC curve at a threshold."""
    scores, hit = with_score(scores), F.col("p") > threshold
    counts = scores.agg(F.count_if(hit & (F.col("y") == 1)).alias("tp"), F.count_if(hit & (F.col("y") != 1)).alias("fp"),
                        F.count_if(~hit & (F.col("y") == 1)).alias("fn"), F.count_if(~hit & (F.col("y") != 1)).alias("tn"))
    return with_rates(counts).withColumn("roc_auc", roc_auc(scores).scalar())


def metrics_at_precision(scores: DataFrame, target: float = 0.6, n_thresholds: int = 1000) -> DataFrame:
    """Metrics at the threshold whose precision is closest to ``target``, the first one on ties."""
    rates = with_rates(threshold_counts(scores, n_thresholds))
    gap = F.abs(F.col("precision") - target)
    best = rates.agg(F.min(F.struct(gap.alias("gap"), "step", "threshold", "precision", "recall", "f1", "accuracy", "tp", "fp", "fn", "tn")).alias("b"))
    return best.select(*[f"b.{c}" for c in ("threshold", "precision", "recall", "f1", "accuracy", "tp", "fp", "fn", "tn")])


def pr_auc(scores: DataFrame, slices: int = 1000) -> DataFrame:
    """Area under the curve of precision over recall by trapezoids: one row, NULL without positives.

    The points are the distinct scores from the top, and recall 0 with precision 1 before them.  Equal
    scores are counted first; running counts come from slices, so scores are not sorted in one task.
    """
    from .sliced import running_sum

    per = with_score(scores).groupBy("p").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count("*").alias("n")).withColumn("__q", -F.col("p"))
    place = -F.floor(F.col("p") * slices)  # does not decrease along -p
    upto = running_sum(running_sum(per, [], ["__q"], place, F.col("pos"), "tp"), [], ["__q"], place, F.col("n"), "seen")
    # the point before a score is known from its own counts
    before = F.when(F.col("seen") > F.col("n"), (F.col("tp") - F.col("pos")) / (F.col("seen") - F.col("n"))).otherwise(1.0)
    area = F.sum(F.col("pos") * (F.col("tp") / F.col("seen") + before) / 2)
    total = F.sum("pos")
    return upto.agg(F.when(total > 0, area / total).alias("pr_auc"))


def pixel_cuts(candidates: DataFrame, metrics: DataFrame, max_negative: int = 18, max_bad: int = 12, min_sumrat: float = 0.25) -> DataFrame:
    """``candidates`` (image_id, cand_id, stage) with stage 3 for those of stage 2 whose cutout passes too.

    ``metrics``: image_id, cand_id, n_negative, n_bad, sumrat.  A candidate without a cutout stays at its stage.
    """
    near = metrics.select("image_id", "cand_id", "n_negative", "n_bad", "sumrat")
    good = (F.col("n_negative") <= max_negative) & (F.col("n_bad") <= max_bad) & (F.col("sumrat") >= min_sumrat)
    out = candidates.join(near, ["image_id", "cand_id"], "left_outer")
    return out.withColumn("stage", F.when((F.col("stage") == 2) & F.coalesce(good, F.lit(False)), 3).otherwise(F.col("stage")))


def roc_auc(scores: DataFrame, slices: int = 1000) -> DataFrame:
    """Area under the ROC curve by ranks: one row, NULL with a single class.

    Equal scores are counted first.  Ranks come from counts per slice of the score range plus
    the order inside a slice, so the scores are never sorted in one task.
    """
    from .sliced import running_sum

    per = with_score(scores).groupBy("p").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    below = running_sum(per, [], ["p"], F.floor(F.col("p") * slices), F.col("neg"), "upto")
    wins = F.sum(F.col("pos") * (F.col("upto") - F.col("neg") / 2.0))
    pairs = F.sum("pos") * F.sum("neg")
    return below.agg(F.when(pairs > 0, wins / pairs).alias("roc_auc"))


def recovery_histogram(truth: DataFrame, key: str, bins: int = 29) -> DataFrame:
    """Injected and recovered sources per magnitude bin and key, with running totals.

    ``truth``: the key, mag and ``recovered``.  Bins are equal between the extremes of the key.
    """
    limits = truth.groupBy(key).agg(F.min("mag").alias("__lo"), F.max("mag").alias("__hi"))
    place = F.floor((F.col("mag") - F.col("__lo")) * bins / (F.col("__hi") - F.col("__lo")))
    index = F.when(F.col("__hi") == F.col("__lo"), 0).otherwise(F.least(place, F.lit(bins - 1).cast("long")))
    per = (truth.join(limits, key).withColumn("bin", index).groupBy(key, "bin")
           .agg(F.count("*").alias("n_true"), F.count_if("recovered").alias("n_recovered"),
                F.any_value("__lo").alias("__lo"), F.any_value("__hi").alias("__hi")))
    run = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    width = (F.col("__hi") - F.col("__lo")) / bins
    return per.select(key, "bin", (F.col("__lo") + (F.col("bin") + 0.5) * width).alias("mag"), "n_true", "n_recovered",
                      F.sum("n_true").over(run).alias("cum_true"), F.sum("n_recovered").over(run).alias("cum_recovered"))


def limiting_magnitude(histogram: DataFrame, key: str, fraction: float) -> DataFrame:
    """Magnitude at which the recovered fraction first falls below ``fraction``, interpolated.

    NULL where it never does, the centre of the first bin where it starts below.
    """
    share = F.col("n_recovered") / F.col("n_true")
    order = Window.partitionBy(key).orderBy("bin")
    steps = (histogram.withColumn("f", share).withColumns({"f0": F.lag("f").over(order), "m0": F.lag("mag").over(order)}))
    cross = F.when(F.col("f") < fraction, F.when(F.col("f0").isNull(), F.col("mag")).otherwise(
        F.col("m0") + F.try_divide(F.col("f0") - fraction, F.col("f0") - F.col("f")) * (F.col("mag") - F.col("m0"))))
    return steps.groupBy(key).agg(F.min(F.when(F.col("f") < fraction, F.struct("bin", cross.alias("m")))).alias("c")).select(
        key, F.col("c.m").alias("mag_limit"))


def figure_of_merit_magnitudes(histogram: DataFrame, key: str) -> DataFrame:
    """Magnitudes at which 80 % and 20 % of the injected sources are recovered."""
    m80 = limiting_magnitude(histogram, key, 0.8).withColumnRenamed("mag_limit", "m80")
    m20 = limiting_magnitude(histogram, key, 0.2).withColumnRenamed("mag_limit", "m20")
    return m80.join(m20, key)


def false_positive_threshold(detections: DataFrame, n_images: int, rate: float = 10.0, step: float = 0.1) -> DataFrame:
    """Lowest signal-to-noise threshold (a multiple of ``step``) with at most ``rate`` false detections per image.

    ``detections``: snr and ``is_true``; false ones are counted per step first.
    """
    from .sliced import running_sum

    per = (detections.filter(~F.col("is_true")).groupBy((-F.floor(F.col("snr") / step)).alias("k"))
           .agg(F.count("*").alias("n")))
    kept = running_sum(per, [], ["k"], F.floor(F.col("k") / 1000), F.col("n"), "upto").filter(F.col("upto") <= rate * n_images)
    return kept.agg((-F.max("k") * step).alias("snr_threshold"), F.max("upto").alias("n_false"))


def normalize_features(features: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as z-scores with 1e-6 added to the population scatter."""
    stats = features.agg(F.struct(*[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_pop(c).alias(f"{c}_s") for c in columns]).alias("s"))
    one = stats.scalar()
    return features.withColumn("__s", one).withColumns(
        {c: (F.col(c) - F.col(f"__s.{c}_m")) / (F.col(f"__s.{c}_s") + 1e-6) for c in columns}).drop("__s")


def stratified_split(samples: DataFrame, key: str, label: str, test_size: float, val_size: float, seed: int = 42) -> DataFrame:
    """Add ``part`` (train, val or test) with the same shares in every label.

    Rows are ranked by a hash of key and seed.  The hash is cut in 4096 slices, so a label with
    most of the rows is ranked in many tasks.  ``val_size`` is a share of what is not test.
    """
    from .sliced import row_number

    hashed = samples.withColumn("__h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))
    ranked = row_number(hashed, [label], ["__h", key], F.substring("__h", 1, 3), "__r")
    totals = samples.groupBy(label).agg(F.count("*").alias("__n"))
    n_test = F.round(F.col("__n") * test_size)
    n_val = F.round((F.col("__n") - n_test) * val_size)
    part = F.when(F.col("__r") <= n_test, "test").when(F.col("__r") <= n_test + n_val, "val").otherwise("train")
    return join_null_safe(ranked, totals, [label]).withColumn("part", part).drop("__h", "__r", "__n")
