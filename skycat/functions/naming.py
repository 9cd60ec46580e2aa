"""Identifiers: alert names, visit ids, file names and flag bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import col

# Fixed values of the alert naming scheme.
FIRST_NAME_NUMBER = 321272407  # number of the name aaaaaaa
LAST_SEQUENCE_INDEX = 8031810175  # index of the name zzzzzzz
FIRST_YEAR, LAST_YEAR = 24, 34
UNSUPPORTED_YEAR = "notsupported"
OUT_OF_RANGE = "idoutofrange"

VISIT_ID = r"^(\d{5})(\d{2})(\d{3})(\d{3})$"  # fixed format: program, plan, pass, segment


def alert_name(year, sequence, prefix: str) -> Column:
    """Name of the ``sequence``-th alert (from 1) of a two-digit year, after the survey's ``prefix``.

    Seven-letter names count as a..z, aa..zz and so on.  Among names of one length the
    letters are plain base-26 digits of the distance from the first name of that length.
    """
    index = col(sequence).cast("long") - 1
    letters = []
    for power in range(6, -1, -1):
        digit = F.pmod(F.floor(index / F.lit(26 ** power)), F.lit(26))
        letters.append(F.char((digit + 97).cast("long")))
    name = F.concat(F.lit(prefix), F.lpad(col(year).cast("string"), 2, "0"), *letters)
    return (F.when(~col(year).between(FIRST_YEAR, LAST_YEAR), UNSUPPORTED_YEAR)
            .when(index > LAST_SEQUENCE_INDEX, OUT_OF_RANGE).otherwise(name))


def file_basename(path) -> Column:
    """The part after the last slash; NULL without a folder part."""
    found = F.regexp_extract(col(path), r".+/(.+)", 1)
    return F.when(found != "", found)


def visit_id_parts(visit_id) -> dict[str, Column]:
    """program, plan, pass and segment numbers of a 13-digit visit id."""
    names = ("program", "plan", "pass", "segment")
    return {n: F.regexp_extract(col(visit_id), VISIT_ID, i + 1).try_cast("int") for i, n in enumerate(names)}


def has_bit(flags, bit: int) -> Column:
    """Is ``bit`` (0 is the lowest) set?"""
    return F.shiftright(col(flags), bit).bitwiseAND(F.lit(1)) == 1
