"""Column functions whose results must equal the Postgres ones.

Spark's own casts differ silently in several places (truncation, rounding of
fractions, word case), so the models go through these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def varchar(c: Column | str, n: int) -> Column:
    """Cast to text and silently cut to ``n`` characters."""
    return F.substring(_col(c).cast("string"), 1, n)


def int_round(c: Column | str) -> Column:
    """Numeric to int, halves away from zero (a plain Spark cast truncates)."""
    return F.round(_col(c)).cast("int")


def to_money(c: Column | str, precision: int = 10) -> Column:
    return _col(c).cast(f"decimal({precision},2)")


def to_zip(c: Column | str) -> Column:
    """Zip prefix as decimal(5,0); text that is no number or too long is an error."""
    return _col(c).cast("decimal(5,0)")


def _one_char_upper(c: Column) -> Column:
    """Upper case of one character; one without a single upper-case form (ß) stays."""
    upper = F.upper(c)
    return F.when(F.length(upper) == 1, upper).otherwise(c)


def word_case(c: Column | str) -> Column:
    """Upper-case the first character of each alphanumeric run, lower-case the rest.

    Spark's ``initcap`` starts a word only after white space; here every
    character that is neither letter nor digit ends one.
    """
    pieces = F.split(_col(c), r"(?<=[^\p{L}\p{N}])")
    cased = F.transform(
        pieces,
        lambda x: F.concat(
            _one_char_upper(F.substring(x, 1, 1)), F.lower(x.substr(F.lit(2), F.length(x)))
        ),
    )
    return F.array_join(cased, "")


def display_name(c: Column | str) -> Column:
    """``some_category`` to ``Some Category``."""
    return word_case(F.replace(_col(c), F.lit("_"), F.lit(" ")))


def clean_label(c: Column | str) -> Column:
    """Trim and lower-case a label, so spelling variants collapse."""
    return F.lower(F.trim(_col(c)))


def parse_timestamp(c: Column | str, kind: str = "timestamp_ntz") -> Column:
    """Text to timestamp; anything unparsable (``NaT`` too) becomes null."""
    return _col(c).try_cast(kind)


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the parts joined by ``-``; a null part gets a fixed stand-in."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
