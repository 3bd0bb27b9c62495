"""Column-level scalar functions (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "java_split", "split_fields", "to_int", "to_double", "join_tags", "bars_to_blanks",
    "tokenize", "log10_count", "halve_score", "half_star_bucket", "name_to_uid",
    "first_word", "comma_list", "dot", "norm", "cosine", "now_epoch_seconds",
    "append_separated", "epoch_seconds", "epoch_of", "yearmonth_of_epoch", "round_sim", "round_score",
    "SIM_DIGITS", "SCORE_DIGITS",
]

# Similarities are rounded to SIM_DIGITS places before any cut or rank so that
# summation order cannot decide a comparison; scores leave at SCORE_DIGITS.
SIM_DIGITS = 9
SCORE_DIGITS = 6


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def java_split(col, pattern: str) -> Column:
    """``String.split(regex)`` semantics: trailing empty strings are dropped; the
    empty string gives [""]; a string made only of delimiters gives []."""
    c = _c(col)
    stripped = F.regexp_replace(c, "(?:" + pattern + ")+$", "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, pattern)))


def split_fields(col, pattern: str) -> Column:
    """Positional field split (F1), keeping every field like Spark's ``split``."""
    return F.split(_c(col), pattern, -1)


def to_int(col, strict: bool = True) -> Column:
    c = F.trim(_c(col))
    return c.cast("int") if strict else c.try_cast("int")


def to_double(col, strict: bool = True) -> Column:
    c = F.trim(_c(col))
    return c.cast("double") if strict else c.try_cast("double")


def join_tags(col, sep: str = "|") -> Column:
    """join an array of strings with a separator."""
    return F.concat_ws(sep, _c(col))


def bars_to_blanks(col) -> Column:
    """every vertical bar becomes a blank."""
    return F.translate(_c(col), "|", " ")


def tokenize(col) -> Column:
    """lower-case, split on single white space (Tokenizer semantics)."""
    return java_split(F.lower(_c(col)), r"\s")


def log10_count(col) -> Column:
    """base-10 logarithm of max(count, 1)."""
    return F.log10(F.greatest(_c(col), F.lit(1)).cast("double"))


def halve_score(col) -> Column:
    """incoming 10-point score to the 5-point scale, two decimals, half up."""
    return F.round(_c(col) / F.lit(2.0), 2)


def half_star_bucket(col) -> Column:
    """round-half-up of score / 0.5, i.e. the histogram slot (0..10)."""
    return F.floor(_c(col) / F.lit(0.5) + F.lit(0.5)).cast("int")


def name_to_uid(col) -> Column:
    """F8: 32-bit polynomial string hash (h = 31 h + c) of a user name."""
    codes = F.transform(F.split(_c(col), ""), lambda ch: F.ascii(ch).cast("long"))
    h = F.aggregate(codes, F.lit(0).cast("long"),
                    lambda acc, x: F.pmod(acc * F.lit(31) + x, F.lit(4294967296)))
    return F.when(h >= F.lit(2147483648), h - F.lit(4294967296)).otherwise(h).cast("int")


def first_word(col) -> Column:
    """text before the first blank."""
    return F.split(_c(col), " ", 2).getItem(0)


def comma_list(col) -> Column:
    """comma separated list to array."""
    return java_split(_c(col), ",")


def dot(a, b) -> Column:
    """dot product of two equally long numeric arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x),
                              F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def cosine(a, b) -> Column:
    """cosine similarity; NULL (not NaN, not an error) for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def now_epoch_seconds() -> Column:
    """F12."""
    return F.unix_timestamp()


def append_separated(old, new, sep: str = "|") -> Column:
    """append to a separated string, or start one when there is none."""
    return F.concat_ws(sep, _c(old), _c(new))


def epoch_seconds(col) -> Column:
    """Epoch seconds of a wall-clock (NTZ) timestamp, read as UTC whatever the
    session time zone is (floor for times before the second ends)."""
    c = _c(col).cast("timestamp_ntz")
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_diff("SECOND", epoch, c).cast("int")


def epoch_of(text: str) -> Column:
    """Epoch seconds of a 'yyyy-MM-dd HH:mm:ss' wall-clock literal, as UTC."""
    return epoch_seconds(F.lit(text).cast("timestamp_ntz"))


def yearmonth_of_epoch(seconds) -> Column:
    """yyyyMM (UTC) of epoch seconds, independent of the session time zone."""
    day = F.date_from_unix_date(F.floor(_c(seconds) / F.lit(86400)).cast("int"))
    return F.date_format(day, "yyyyMM").cast("int")


def round_sim(col) -> Column:
    return F.round(_c(col), SIM_DIGITS)


def round_score(col) -> Column:
    return F.round(_c(col), SCORE_DIGITS)
