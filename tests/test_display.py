import datetime as dt

from pyspark.sql import functions as F

from daypulse.functions import dates, display


def one(spark, col, schema, value):
    return spark.createDataFrame([(value,)], schema).select(col).first()[0]


def test_title_and_numbers(spark):
    assert one(spark, display.title_label("m"), "m string", "sleep_efficiency") == "Sleep Efficiency"
    assert one(spark, display.title_label("m"), "m string", "avg_spo2_pct") == "Avg Spo2 Pct"
    assert one(spark, display.fmt1("x"), "x double", 72.45) == "72.5"
    assert one(spark, display.fmt1("x"), "x double", 117.37499999999999) == "117.4"
    assert one(spark, display.fmt0("x"), "x double", 84.97) == "85"
    assert one(spark, display.pct_text("x"), "x double", -18.55) == "18.6%"
    assert one(spark, display.ratio_text(F.lit(27), F.lit(30)), "x int", 1) == "27/30"


def test_reasons_and_arrows(spark):
    assert one(spark, display.below_target_reason(F.lit(85.0)), "x int", 1) == "Below target of 85.0"
    assert one(spark, display.declined_reason("x"), "x double", -18.5479) == "Declined 18.5% over period"
    assert one(spark, display.declined_reason("x"), "x double", -35.26) == "Declined 35.3% over period"
    arrows = [one(spark, display.trend_arrow("t"), "t string", t) for t in ("improving", "declining", "stable")]
    assert arrows == ["▲", "▼", "▶"]


def test_dates_and_titles(spark):
    d = dt.date(2025, 1, 6)
    assert one(spark, dates.day_label("d"), "d date", d) == "Mon 1/6"
    assert one(spark, F.date_format("d", dates.SHORT_DATE), "d date", d) == "Jan 06"
    assert one(spark, F.date_format("d", dates.MONTH_DAY), "d date", d) == "January 06"
    assert one(spark, F.date_format("d", dates.WEEKDAY_DATE), "d date", d) == "Monday, Jan 06"
    subj = display.report_subject(F.lit("weekly"), F.lit(d), F.lit(dt.date(2025, 1, 12)))
    assert one(spark, subj, "x int", 1) == "Weekly Health Report: Jan 06 - Jan 12, 2025"
    subj = display.report_subject(F.lit("monthly"), F.lit(dt.date(2024, 12, 1)), F.lit(dt.date(2024, 12, 31)))
    assert one(spark, subj, "x int", 1) == "Monthly Health Report: Dec 01 - Dec 31, 2024"
    head = display.period_header(F.lit(d), F.lit(dt.date(2025, 1, 12)))
    assert one(spark, head, "x int", 1) == "January 06 — January 12, 2025"
    line = display.best_line(F.lit("readiness_score"), F.lit(85.0), F.lit(dt.date(2025, 1, 5)))
    assert one(spark, line, "x int", 1) == "Readiness Score: 85.0 on Sunday, Jan 05"


def test_audit_status(spark):
    df = spark.createDataFrame([(3, True), (0, True), (0, False)], "rows int, ex boolean")
    got = [r[0] for r in df.select(display.audit_status("rows", F.col("ex"))).collect()]
    assert got == ["ok", "empty", "missing"]
