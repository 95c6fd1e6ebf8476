"""Column expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted formats and words of the retail tables.
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
PHONE_PATTERN = (
    r"^(\+?\d{1,3}[\s.-]?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}$"
)
PERCENT_PATTERN = r"^\d+(\.\d+)?$"
MONEY_SIGNS = r"[$,]"
PHONE_NOISE = r"[^\d+]"
COUNTRY_PREFIX = "+1"
TRUE_WORDS = ["true", "yes", "y"]

# Age limits and their labels.
AGE_LABELS = [(30, "Spring Chicken"), (65, "Senior Dev")]
AGE_LABEL_ABOVE = "DEAD"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def valid_or_null(value: Column | str, pattern: str) -> Column:
    """The text when it matches the pattern, else null."""
    value = _column(value)
    return F.when(value.rlike(pattern), value)


def email_or_null(value: Column | str) -> Column:
    return valid_or_null(F.trim(_column(value)), EMAIL_PATTERN)


def phone_or_null(value: Column | str, dedupe_country_code: bool = False) -> Column:
    """A valid phone number as ``+`` and digits; numbers without ``+`` get ``+1``.

    A number that already spells out country code 1 gets a second one, unless
    ``dedupe_country_code`` is set.
    """
    digits = F.regexp_replace(
        valid_or_null(F.trim(_column(value)), PHONE_PATTERN), PHONE_NOISE, ""
    )
    prefixed = F.concat(F.lit(COUNTRY_PREFIX), digits)
    if dedupe_country_code:
        spelled_out = digits.startswith("1") & (F.length(digits) == 11)
        prefixed = F.when(spelled_out, F.concat(F.lit("+"), digits)).otherwise(prefixed)
    return F.when(digits.startswith("+"), digits).otherwise(prefixed)


def money(value: Column | str, money_type: str = "decimal(18,2)") -> Column:
    """``"$1,234.50"`` as a decimal; unreadable text is null."""
    return F.regexp_replace(_column(value), MONEY_SIGNS, "").try_cast(money_type)


def percent(value: Column | str) -> Column:
    """Unsigned number text as a double between 0 and 100; other text is null."""
    number = valid_or_null(value, PERCENT_PATTERN).try_cast("double")
    return clamp(number, 0, 100)


def clamp(value: Column | str, low: float, high: float) -> Column:
    """Limit a double to a range; null stays null."""
    value = _column(value)
    return (
        F.when(value > high, F.lit(float(high)))
        .when(value < low, F.lit(float(low)))
        .otherwise(value)
    )


def at_least_zero(value: Column | str, null_as_zero: bool = True) -> Column:
    """Raise negatives to 0, and by default nulls too."""
    value = _column(value)
    floored = F.greatest(value, F.lit(0))
    return floored if null_as_zero else F.when(value.isNotNull(), floored)


def truth(value: Column | str, trim: bool = False) -> Column:
    """True for an accepted word in any case, else false, also for null."""
    value = _column(value)
    word = F.lower(F.trim(value) if trim else value)
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).otherwise(F.lit(False))


def label_bucket(
    value: Column | str,
    limits: Sequence[tuple[float, str]] = tuple(AGE_LABELS),
    above: str = AGE_LABEL_ABOVE,
) -> Column:
    """Label of the first limit the value lies below, else ``above``."""
    value = _column(value)
    (limit, label), *rest = limits
    chain = F.when(value < limit, label)
    for limit, label in rest:
        chain = chain.when(value < limit, label)
    return chain.otherwise(above)


def format_label(template: str, *columns: Column | str) -> Column:
    """Fill ``{}`` places of a template; a missing value reads ``None``."""
    pieces = template.split("{}")
    if len(pieces) != len(columns) + 1:
        raise ValueError("as many columns as {} places are needed")
    parts = [F.lit(pieces[0])]
    for column, text in zip(columns, pieces[1:]):
        parts += [F.coalesce(_column(column).cast("string"), F.lit("None")), F.lit(text)]
    return F.concat(*parts)


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, or 0 for a zero (or missing) denominator."""
    below = _column(denominator)
    return F.when(below != 0, _column(numerator) / below).otherwise(F.lit(0.0))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Difference in whole seconds, each side cut to its second."""
    return F.unix_timestamp(_column(later).cast("timestamp")) - F.unix_timestamp(
        _column(earlier).cast("timestamp")
    )
