"""Text helpers with the trimming and blank rules the log format relies on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters trimmed off log fields (everything up to the space character).
CONTROL_CHARS = "".join(chr(c) for c in range(0x21))

# Characters that count as white space when testing for blank text.
WHITESPACE = "".join(
    chr(c)
    for c in [
        0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x1680,
        0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2008, 0x2009, 0x200A,
        0x2028, 0x2029, 0x205F, 0x3000,
    ]
)


def trim_controls(c: Column) -> Column:
    """Text without leading and trailing characters up to U+0020.

    Most texts need no trimming, which a look at the bytes of both ends tells faster than the trim itself.
    """
    raw, space = c.cast("binary"), F.lit(b" ")
    clean = (F.substring(raw, 1, 1) > space) & (F.substring(raw, -1, 1) > space)
    return F.when(clean, c).otherwise(F.btrim(c, F.lit(CONTROL_CHARS)))


def is_blank(c: Column) -> Column:
    """True for null, empty and all-white-space text; never null.

    Nearly always the first character settles it: none from U+0021 to U+167F is white space.
    """
    visible = F.ascii(c).between(0x21, 0x167F)
    return F.when(c.isNull(), True).when(visible, False).otherwise(F.btrim(c, F.lit(WHITESPACE)) == "")


def blank_to(c: Column, default: str) -> Column:
    return F.when(is_blank(c), F.lit(default)).otherwise(c)


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def url_decode(c: Column) -> Column:
    """UTF-8 URL decoding with `+` as space; null when an escape is malformed."""
    return F.try_url_decode(c)


def whole_number(c: Column) -> Column:
    """A plain decimal integer as bigint, anything else (padding, fractions, overflow) null."""
    number = c.try_cast("bigint")
    return F.when((number.cast("string") == c) | c.rlike(r"^[+-]?[0-9]+$"), number)
