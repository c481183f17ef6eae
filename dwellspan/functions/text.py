"""Names and numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cyrillic capitals and the Latin ones that look the same.
CYRILLIC = "АВЕКМНОРСТУХІЅЈЁҮԌԤ"
LATIN = "ABEKMHOPCTYXISJEYGP"

NOT_ALNUM = r"[^\p{L}\p{N}]"


def norm_alnum(s: Column) -> Column:
    """Upper case, letters and digits only."""
    return F.regexp_replace(F.upper(s), NOT_ALNUM, "")


def norm_name(s: Column) -> Column:
    """As norm_alnum, with Cyrillic lookalikes as Latin letters."""
    return F.regexp_replace(F.translate(F.upper(s), CYRILLIC, LATIN), NOT_ALNUM, "")


def norm_cyrillic(s: Column) -> Column:
    """Upper case, Latin lookalikes as Cyrillic letters, without spaces and dots."""
    return F.regexp_replace(F.translate(F.upper(s), "ABEKMHOPCTYX", "АВЕКМНОРСТУХ"), r"[ .]", "")


def norm_spaced(s: Column) -> Column:
    """Upper case; what is no letter or digit becomes one space."""
    return F.trim(F.regexp_replace(F.upper(s), r"[^\p{L}\p{N}]+", " "))


def digit_share(norm: Column) -> Column:
    return F.regexp_count(norm, F.lit("[0-9]")) / F.greatest(F.length(norm), F.lit(1))


def truthy(s: Column, default: bool = True) -> Column:
    """Booleans written as text; null and blank give the default."""
    t = F.lower(F.trim(s.cast("string")))
    return F.when(t.isNull() | (t == ""), F.lit(default)).otherwise(t.isin("true", "1", "yes"))


def mmss(seconds: Column) -> Column:
    whole = F.round(seconds).cast("long")
    return F.format_string("%02d:%02d", F.floor(whole / 60), whole % 60)


def duration(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("long")
    return F.when(seconds.isNull(), "-").otherwise(F.format_string("%d:%02d (%.1f s)", F.floor(whole / 60), whole % 60, seconds.cast("double")))


def number(x: Column, digits: int = 1) -> Column:
    return F.when(x.isNull(), "-").otherwise(F.format_string(f"%.{digits}f", x.cast("double")))


def plural(n: Column, one: str, few: str, many: str) -> Column:
    """The Slavic form of a noun behind a number."""
    ten, hundred = n % 10, n % 100
    return F.when((ten == 1) & (hundred != 11), one).when(ten.between(2, 4) & ~hundred.between(12, 14), few).otherwise(many)


def distance_label(d: Column) -> Column:
    return F.when(d.isNull(), "-").when(d < 0.35, "centre").when(d < 0.6, "middle").otherwise("edge")
