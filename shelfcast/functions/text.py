"""Text expressions: stripping, null tokens, postcodes, file stems, URL masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes. Spark's plain trim removes spaces only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spellings of "nothing" in provider feeds, besides NULL and blank text.
NULL_TOKENS = ("null", "none", "n/a", "-")

# A full UK postcode; group 1 is the outward code.
POSTCODE = r"^\s*([A-Z]{1,2}\d[A-Z\d]?)\s*(\d[A-Z]{2})\s*$"

# The API key is the path segment after /json/.
KEY_IN_PATH = r"(/json/)[^/]+(/)"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank(c: Column) -> Column:
    """True for NULL, empty and whitespace-only text; never NULL."""
    return F.coalesce(strip(c) == "", F.lit(True))


def null_or_empty(c: Column) -> Column:
    """True for NULL and the empty string only; never NULL."""
    return F.coalesce(c == "", F.lit(True))


def clean(c: Column) -> Column:
    """Stripped text, with every spelling of "nothing" mapped to NULL."""
    text = strip(c)
    return F.when(~F.lower(text).isin("", *NULL_TOKENS), text)


def outward_code(c: Column) -> Column:
    """``N1 9GU`` -> ``N1``; NULL for anything that is not one whole postcode."""
    return F.nullif(F.regexp_extract(F.upper(c), POSTCODE, 1), F.lit(""))


def file_name(path: Column) -> Column:
    """The last segment of a path."""
    return F.substring_index(path, "/", -1)


def decoded(path: Column) -> Column:
    """A path as it is on storage; ``_metadata`` columns give it percent-encoded."""
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def stem(name: Column) -> Column:
    """A file name without its ``.csv`` or ``.parquet`` ending."""
    return F.regexp_replace(file_name(name), r"\.(csv|parquet)$", "")


def mask_url_key(url: Column) -> Column:
    """Replace the credential segment of an API URL."""
    return F.regexp_replace(url, KEY_IN_PATH, "$1***$2")
