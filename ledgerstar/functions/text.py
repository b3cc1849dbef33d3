"""Text cleaning as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Every character Python's str.strip() and \s treat as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set for java.util.regex: (?U) adds the Unicode spaces, \x1c-\x1f the separators.
_SPACE = r"[\s\x1c-\x1f]"
# Letters that have case, which is what title casing looks at.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def column_name(name: str) -> str:
    """Source header to snake case: runs of other characters become one underscore."""
    return "_".join(re.findall(r"[a-z0-9]+", name.lower()))


def squeeze(c: Column) -> Column:
    """Trim and turn every run of white space into one blank."""
    return F.trim(F.regexp_replace(c, f"(?U){_SPACE}+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    return blank_to_null(squeeze(c))


def identifier(c: Column) -> Column:
    return F.upper(clean_text(c))


def title(c: Column) -> Column:
    """Title case that restarts after every character without case.

    ``initcap`` only restarts after a blank, so it leaves ``O'brien`` alone.
    """
    runs = F.regexp_extract_all(F.lower(c), F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def proper_name(c: Column) -> Column:
    return title(clean_text(c))


def five_digits(c: Column, otherwise: Column) -> Column:
    """First five digits of c where there are that many."""
    digits = F.regexp_replace(c, "[^0-9]+", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5)).otherwise(otherwise)


def zip_code(c: Column) -> Column:
    """First five digits, or else the cleaned text."""
    return five_digits(c, clean_text(c))


def natural_key(c: Column) -> Column:
    """Null and empty keys share one member; dimensions and fact both call this."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("UNKNOWN"))


def row_hash(*values: Column) -> Column:
    """SHA-256 hex of the values joined by a pipe, nulls as empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(v, F.lit("")) for v in values]), 256)


def county_key(c: Column) -> Column:
    """County name reduced to lower-case words without the word county."""
    words = F.regexp_replace(c, r"(?i)\bcounty\b", "")
    words = F.lower(F.trim(F.regexp_replace(words, "[^0-9a-zA-Z]+", " ")))
    return F.nullif(words, F.lit(""))


def county_fips(c: Column, state_prefix: str) -> Column:
    """County number to a five-digit FIPS code within one state."""
    code = F.trim(c, F.lit(WHITE_SPACE))
    number = code.try_cast("decimal(38,0)")
    return F.when(code.rlike(f"^{state_prefix}[0-9]{{3}}$"), code).when(
        code.rlike("^[0-9]+$") & number.between(1, 999),
        F.concat(F.lit(state_prefix), F.lpad(number.cast("string"), 3, "0")),
    )
