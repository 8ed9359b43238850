"""Display columns for reports: labels, reasons, formatted numbers, titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import LONG_DATE, MONTH_DAY, SHORT_DATE, WEEKDAY_DATE
from .exact import round_half_up


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_label(name: Column | str) -> Column:
    """``sleep_efficiency`` -> ``Sleep Efficiency``."""
    return F.initcap(F.regexp_replace(_c(name), "_", " "))


def fmt1(x: Column | str) -> Column:
    """``%.1f`` of the value rounded half-up to 1 decimal (so the text never
    depends on how a binary fraction prints)."""
    return _text("%.1f", round_half_up(_c(x), 1))


def fmt0(x: Column | str) -> Column:
    """``%.0f`` of the value rounded half-up."""
    return _text("%.0f", round_half_up(_c(x), 0))


def _text(form: str, x: Column) -> Column:
    """Formatted value; NULL stays NULL."""
    return F.when(x.isNotNull(), F.format_string(form, x))


def plain_number(x: Column | str) -> Column:
    """A number as it was given: 85.0, 72.25 (never in exponent form for targets' sizes)."""
    return _c(x).cast("double").cast("string")


def pct0(x: Column | str) -> Column:
    """``20%``."""
    return F.concat(fmt0(x), F.lit("%"))


def hours_text(x: Column | str) -> Column:
    """``7.3 hours``."""
    return F.concat(fmt1(x), F.lit(" hours"))


def sessions_text(n: Column | str) -> Column:
    """``4 sessions``."""
    return F.concat(_c(n).cast("string"), F.lit(" sessions"))


def avg_text(x: Column | str) -> Column:
    """``(avg: 83.9)``."""
    return F.concat(F.lit("(avg: "), fmt1(x), F.lit(")"))


def ratio_text(n: Column | str, m: Column | str) -> Column:
    return F.concat_ws("/", _c(n).cast("string"), _c(m).cast("string"))


# Trend arrows by trend class.
TREND_ARROWS = {"improving": "▲", "declining": "▼", "stable": "▶"}


def trend_arrow(direction: Column | str) -> Column:
    d = _c(direction)
    return (F.when(d == "improving", F.lit(TREND_ARROWS["improving"]))
            .when(d == "declining", F.lit(TREND_ARROWS["declining"]))
            .otherwise(F.lit(TREND_ARROWS["stable"])))


def below_target_reason(target: Column | str) -> Column:
    """``Below target of 85.0``: the target as it was given."""
    return F.concat(F.lit("Below target of "), plain_number(target))


def declined_reason(pct: Column | str) -> Column:
    """``Declined 18.5% over period`` from an unrounded percent change."""
    return F.concat(F.lit("Declined "), fmt1(F.abs(round_half_up(_c(pct), 1))), F.lit("% over period"))


def report_subject(period_type: Column | str, start: Column | str, end: Column | str) -> Column:
    """``Weekly Health Report: Jan 06 - Jan 12, 2025``."""
    p = _c(period_type)
    kind = F.when(p == "weekly", F.lit("Weekly")).otherwise(F.lit("Monthly"))
    return F.concat(kind, F.lit(" Health Report: "), F.date_format(_c(start), SHORT_DATE),
                    F.lit(" - "), F.date_format(_c(end), LONG_DATE))


def period_header(start: Column | str, end: Column | str) -> Column:
    """``January 06 — January 12, 2025``."""
    return F.concat(F.date_format(_c(start), MONTH_DAY), F.lit(" — "),
                    F.date_format(_c(end), MONTH_DAY + ", yyyy"))


def pct_text(pct: Column | str) -> Column:
    """Absolute percent with one decimal and a percent sign: ``18.6%``."""
    return F.concat(fmt1(F.abs(_c(pct))), F.lit("%"))


def best_line(metric: Column | str, value: Column | str, day: Column | str) -> Column:
    """``Readiness Score: 85.0 on Sunday, Jan 05``."""
    return F.concat(title_label(metric), F.lit(": "), fmt1(value), F.lit(" on "),
                    F.date_format(_c(day), WEEKDAY_DATE))


def audit_status(rows: Column | str, exists: Column | None = None) -> Column:
    """Audit cell: ``ok`` when rows > 0, ``empty`` when 0, ``missing`` when absent."""
    r = _c(rows)
    st = F.when(r > 0, F.lit("ok")).otherwise(F.lit("empty"))
    if exists is not None:
        st = F.when(~exists, F.lit("missing")).otherwise(st)
    return st
