"""Scalar column functions (built-in Spark expressions only; all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def zero_pad(c, width: int = 5) -> Column:
    """Left-pad with zeros to ``width``, never truncating (bare ``lpad`` truncates)."""
    c = _c(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def region_label(state, county) -> Column:
    """'state, county'; NULL if either part is NULL."""
    return F.concat(_c(state), F.lit(", "), _c(county))


def last_part(c, sep: str = "<br>") -> Column:
    """Text after the last separator (the whole text when there is none)."""
    return F.element_at(F.split(_c(c), sep, -1), -1)


def pad_four(c) -> Column:
    """Prefix one '0' only when the text has exactly four characters."""
    c = _c(c)
    return F.when(F.length(c) == 4, F.concat(F.lit("0"), c)).otherwise(c)


def clear_unreliable(c, word: str = "unreliable") -> Column:
    """The whole cell becomes '0' when it contains ``word`` in any case."""
    c = _c(c)
    return F.when(c.rlike(f"(?i){word}"), F.lit("0")).otherwise(c)


def coerce_numeric(c) -> Column:
    """Text to double; unparsable text becomes NULL (ANSI-safe ``try_cast``)."""
    return _c(c).try_cast("double")


def mm_ss(seconds) -> Column:
    """Seconds to 'M:SS': whole minutes, then the remaining seconds rounded half to even.
    Keeps the quirk that a remainder rounding up to 60 reads 'M:60'."""
    s = _c(seconds).cast("double")
    minutes = F.floor(s / 60.0)
    frac = s / 60.0 - minutes
    secs = F.bround(frac * 60.0, 0).cast("int")
    return F.concat(minutes.cast("bigint").cast("string"), F.lit(":"), F.lpad(secs.cast("string"), 2, "0"))


def seek_step(seconds, segment_seconds: float = 5.0) -> Column:
    """Position in seconds to a segment number, rounded half to even."""
    return F.bround(_c(seconds).cast("double") / float(segment_seconds), 0).cast("bigint")


def seek_uri(path, seconds, lead: float = 5.0) -> Column:
    """'path#t=' + max(0, s - lead): 0 is written as an integer, other values as decimals."""
    t = _c(seconds).cast("double") - float(lead)
    text = F.when(t > 0, t.cast("string")).otherwise(F.lit("0"))
    return F.concat(_c(path), F.lit("#t="), text)
