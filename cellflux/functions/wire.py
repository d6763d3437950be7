"""One record as one line of tab-separated text, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.schema import RECORD_FIELDS, SEPARATOR

# The characters a producer's strip removes at both ends of a line.
STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Text such as "12.70": a whole number written with a fraction.
_WITH_FRACTION = (
    r"^[\x00-\x20]*(?<sign>[+-]?)(?<whole>[0-9]*)\.[0-9]*[\x00-\x20]*$"
)


def field_value(text: Column, data_type: T.DataType) -> Column:
    """A text field as a number; NULL where it is not one, whatever the ANSI mode.

    Blank fields, the usual way to leave a measure out, are tested before the
    cast: a failing cast costs a JVM exception per field. Integer fields written
    with a fraction are cut to the whole part.
    """
    text = F.nullif(text, F.lit(""))
    value = text.try_cast(data_type)
    if isinstance(data_type, T.IntegralType):
        whole = F.regexp_replace(text, _WITH_FRACTION, "${sign}0${whole}")
        value = F.coalesce(value, whole.try_cast(data_type))
    return value


def record_line(fields: list[str] = RECORD_FIELDS) -> Column:
    """The record as one line. NULL is written as an empty field, so no field shifts."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in fields]
    return F.concat_ws(SEPARATOR, *texts)


def strip_line(line: str | Column) -> Column:
    """The line without white space at its ends. This also removes trailing empty fields."""
    return F.btrim(line, F.lit(STRIPPED))
