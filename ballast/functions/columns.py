"""Scalar column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ballast.params import DEFAULT, RiskParams


def tidy(column: Column, places: int = 2) -> Column:
    """Round for a report; float sums depend on summation order in the last bits."""
    return F.round(column, places)


def deficiency(excess: Column) -> Column:
    """Amount by which the account falls short, NULL when it does not."""
    return F.when(excess < 0, -excess)


def standing(excess: Column, total_mv: Column, params: RiskParams = DEFAULT) -> Column:
    return (
        F.when(excess < 0, "DEFICIENT")
        .when(excess < total_mv * F.lit(params.warning_pct), "WARNING")
        .otherwise("GOOD")
    )


def is_warning(excess: Column, total_mv: Column, params: RiskParams = DEFAULT) -> Column:
    return (excess >= 0) & (excess < total_mv * F.lit(params.warning_pct))


def guarded_ratio(part: Column, whole: Column) -> Column:
    """part / whole for a positive whole, else 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since the epoch; the session runs in UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def minutes_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(60_000_000.0)


def stable_id(*parts: Column | str) -> Column:
    """Id that a retried task mints again unchanged. A missing part is marked, and a separator inside a part escaped."""

    def piece(part: Column | str) -> Column:
        text = (F.col(part) if isinstance(part, str) else part).cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))  # no pattern: ids are made by the million
        return F.coalesce(escaped, F.lit("\\N"))

    return F.sha2(F.concat_ws("|", *map(piece, parts)), 256)


def hour_parts(ts: Column) -> dict[str, Column]:
    """Partition columns of the audit log, zero padded."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def percent_text(ratio: Column, pattern: str = "%.1f%%") -> Column:
    return F.format_string(pattern, ratio * F.lit(100.0))


def dollars_text(amount: Column, places: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, places))


def fixed_text(amount: Column, places: int = 2) -> Column:
    """Decimal text rounded half up; via DECIMAL, so that ties do not hang on binary digits."""
    exact = amount.cast("decimal(24,6)")
    return F.round(exact, places).cast(f"decimal(24,{places})").cast("string")


def grouped_text(amount: Column) -> Column:
    """Whole units with thousands separators."""
    return F.format_number(F.round(amount.cast("decimal(24,6)"), 0), 0)
