"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, plus the four separators Python also strips
_SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends (Spark's trim removes blanks only)."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def style_name(raw: str) -> str:
    """Snake-case form of one column name, for planning a select list."""
    kept = re.sub(r"[^a-zA-Z 0-9_]", "", raw).strip(" ")
    return re.sub(r" +", "_", kept).lower()


def style_name_column(raw: Column) -> Column:
    """`style_name` for names that are data, such as question texts."""
    kept = F.trim(F.regexp_replace(raw, "[^a-zA-Z 0-9_]", ""))
    return F.lower(F.regexp_replace(kept, " +", "_"))


def sha256_text(value: Column, missing: str = "None") -> Column:
    """Hex digest of the text of a value; a missing value is hashed as a text too."""
    return F.sha2(F.coalesce(value.cast("string"), F.lit(missing)), 256)


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.contains(F.lower(text), F.lit(part.lower()))


def missing_as(value: Column, default: object) -> Column:
    """Value, or a default of the same type where it is missing."""
    return F.coalesce(value, F.lit(default))


def thousands(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number, 0)


def paid_flag(value: Column, paid_texts: tuple[str, ...]) -> Column:
    """`paid` or `not`, from a flag that may be boolean, number or text."""
    return F.when(value.cast("string").isin(*paid_texts), "paid").otherwise("not")


def video_url(video_id: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video_id)


def status_url(account: str, status_id: Column) -> Column:
    return F.concat(F.lit(f"https://twitter.com/{account}/status/"), status_id)
