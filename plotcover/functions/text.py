"""String and date expressions: identifiers, segment numbers, site codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalise_id(col: Column | str) -> Column:
    """A GUID compared regardless of braces and letter case (op F6):
    ``{ab-12}``, ``AB-12`` and ``ab-12`` all read ``AB-12``."""
    return F.upper(F.regexp_replace(_c(col).cast("string"), r"[{}]", ""))


def segment_number(col: Column | str = "segment") -> Column:
    """First run of digits in a segment label as a number, for sorting
    (op T1); no digits, or no label, give NULL."""
    digits = F.regexp_extract(_c(col), r"([0-9]+)", 1)
    return digits.try_cast("long")


# A site code is '<segment>_<point>' or '<segment>-<point>', zero padded or
# not (op D2): '01_1', '1_1' and '01-01' name the same site.
SITE_CODE_PATTERN = r"^\s*([0-9]+)[_-]([0-9]+)\s*$"


def site_segment(col: Column | str = "location_name") -> Column:
    """Segment number of a site code, NULL if the text is not a site code."""
    return F.regexp_extract(_c(col), SITE_CODE_PATTERN, 1).try_cast("int")


def site_point(col: Column | str = "location_name") -> Column:
    """Point number of a site code, NULL if the text is not a site code."""
    return F.regexp_extract(_c(col), SITE_CODE_PATTERN, 2).try_cast("int")


def format_site_code(segment: Column, point: Column, separator: str = "_",
                     point_width: int = 1) -> Column:
    """Site code text from its numbers (op T2): '01_1'."""
    return F.format_string(f"%02d{separator}%0{point_width}d", segment, point)


def year_of(col: Column | str) -> Column:
    """Calendar year of a date (op T4)."""
    return F.year(_c(col))


def contains_word(col: Column | str, word: str) -> Column:
    """Case-sensitive substring test (op T3); a missing text gives False."""
    return F.coalesce(F.contains(_c(col), F.lit(word)), F.lit(False))
