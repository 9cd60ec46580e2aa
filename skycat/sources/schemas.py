"""Schemas of the survey tables (DDL strings)."""

SOURCES = ("sid bigint, id int, pid bigint, isdiffpos boolean, ra double, dec double, xfit float, yfit float, fluxfit float, "
           "xerr float, yerr float, fluxerr float, npixfit smallint, qfit float, cfit float, redchi float, flags smallint, "
           "sharpness float, roundness1 float, roundness2 float, npix smallint, peak float, field bigint, hp6 bigint, "
           "hp9 bigint, expid int, fid smallint, sca smallint, mjdobs double")

MERGES = "aid bigint, sid bigint, field bigint"

OBJECTS = ("aid bigint, ra0 double, dec0 double, flux0 float, meanra double, stdevra double, meandec double, stdevdec double, "
           "meanflux double, stdevflux double, nsources bigint, field bigint, hp6 bigint, hp9 bigint")

SKYTILES = "rtid bigint, cra double, cdec double, ramin double, ramax double, decmin double, decmax double"

POSITIONS = "reqid bigint, ra double, dec double"

# Columns of the detection catalogues that differ from the names in the sources table.
CATALOG_RENAMES = {"x_fit": "xfit", "y_fit": "yfit", "flux_fit": "fluxfit", "x_err": "xerr", "y_err": "yerr",
                   "flux_err": "fluxerr", "n_pixels_fit": "npixfit", "reduced_chi2": "redchi", "n_pixels": "npix"}

INJECTIONS = ("map<string, struct<type: string, ra: double, dec: double, parameters: struct<period: double, amplitude: double, "
              "magnitude: double, phase: double, peak_time: double, peak_amplitude: double, sigma: double>>>")
