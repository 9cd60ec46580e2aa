"""Magnitudes, signal to noise and injected light-curve models."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import col

MAG_ERROR_FACTOR = 1.085736205  # fixed value: 2.5 / ln(10)


def mag_from_flux(flux, zero_point) -> Column:
    """Magnitude of a flux; NULL for a flux that is not positive."""
    return F.when(col(flux) > 0, -2.5 * F.log10(col(flux)) + col(zero_point))


def mag_error(flux, flux_error) -> Column:
    return F.when(col(flux) != 0, MAG_ERROR_FACTOR * col(flux_error) / col(flux))


def snr(flux, flux_error) -> Column:
    """Flux over its error; NULL when the error is zero."""
    return F.when(col(flux_error) != 0, col(flux) / col(flux_error))


def flux_from_mag(mag, zero_point) -> Column:
    return F.pow(F.lit(10.0), -0.4 * (col(mag) - col(zero_point)))
