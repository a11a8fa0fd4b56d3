import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import (activity, add_months, code_as_org_id, day_boundaries,
                                  is_valid_json, json_path_text, month_boundaries, org_code,
                                  recency, second_boundaries, week_boundaries)


def _type(v):
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "bigint"
    if isinstance(v, float):
        return "double"
    return "string"


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} {_type(v)}" for k, v in cols.items())
    row = spark.createDataFrame([tuple(cols.values())], schema).select(expr.alias("r"))
    return row.collect()[0]["r"]


def ntz(text):
    return F.to_timestamp_ntz(F.lit(text))


@pytest.mark.parametrize("start,end,months", [
    ("2024-01-31 10:00:00", "2024-02-28 09:00:00", 1),   # boundary, not whole months
    ("2024-01-01 00:00:00", "2024-01-31 23:59:59", 0),
    ("2023-11-15 00:00:00", "2024-02-01 00:00:00", 3),
])
def test_month_boundaries(spark, start, end, months):
    assert one(spark, month_boundaries(ntz(start), ntz(end)), x=1) == months


def test_second_boundaries(spark):
    assert one(spark, second_boundaries(ntz("2024-01-01 00:00:00.9"), ntz("2024-01-01 00:00:02.1")), x=1) == 2


def test_day_boundaries_use_dates(spark):
    assert one(spark, day_boundaries(ntz("2024-01-01 23:59:00"), ntz("2024-01-02 00:01:00")), x=1) == 1


@pytest.mark.parametrize("start,end,weeks", [
    ("2024-01-07 12:00:00", "2024-01-08 01:00:00", 1),   # Sunday -> Monday crosses a week
    ("2024-01-06 12:00:00", "2024-01-07 01:00:00", 0),   # Saturday -> Sunday does not
    ("2024-01-01 00:00:00", "2024-01-29 00:00:00", 4),
])
def test_week_boundaries_monday(spark, start, end, weeks):
    assert one(spark, week_boundaries(ntz(start), ntz(end)), x=1) == weeks


def test_add_months_clamps_and_keeps_time(spark):
    assert one(spark, add_months(ntz("2023-01-31 10:30:00"), 1), x=1) == dt.datetime(2023, 2, 28, 10, 30)


@pytest.mark.parametrize("text,valid", [
    ('{"content_ids":[1]}', True), ("[1,2]", True), ("3", True), ('"s"', True), ("{}", True),
    ('{"a":1} x', False), ('{"a":1}}', False), ('{"a":1}{"b":2}', False), ('{"k":', False),
    ("", False), (None, False), ("{'a':1}", False),
])
def test_strict_json(spark, text, valid):
    assert one(spark, is_valid_json(F.col("j")), j=text) is valid


@pytest.mark.parametrize("text,value", [
    ('{"content_ids":[12]}', "[12]"), ('{"content_ids":["7"]}', '["7"]'),
    ('{"content_ids":[]}', "[]"), ('{"other":1}', None),
])
def test_json_path_text(spark, text, value):
    assert one(spark, json_path_text(F.col("j"), "content_ids"), j=text) == value


@pytest.mark.parametrize("url,code", [
    ("https://www.example.com/group-register?orgt1=abc", "abc"),
    ("https://www.example.com/group-register?orgt1=12&x=1", "12&x=1"),   # rest of the URL
    ("https://www.example.com/group-register?orgt1=", ""),
])
def test_org_code(spark, url, code):
    assert one(spark, org_code(F.col("u")), u=url) == code


@pytest.mark.parametrize("code,org", [
    ("abc", None), ("", None), ("-12", None), ("007", 7), ("1234", None), ("12&x=1", None),
    ("5", 5), ("999", 999),
])
def test_code_as_org_id(spark, code, org):
    assert one(spark, code_as_org_id(F.col("c")), c=code) == org


@pytest.mark.parametrize("days,level,score", [
    (-1, "A", 4), (7, "A", 4), (8, "B", 3), (30, "B", 3), (31, "C", 2), (90, "C", 2), (91, "D", 1),
    (None, None, None)])
def test_recency_band(spark, days, level, score):
    lv, sc = recency(F.col("d").cast("int"))
    assert one(spark, F.struct(lv, sc), d=days) == (level, score)


@pytest.mark.parametrize("value,level,score", [
    (0.0, "D", 1), (0.1, "C", 2), (2.0, "B", 3), (4.9, "B", 3), (5.0, "A", 4), (1.0, "C", 2)])
def test_frequency_band(spark, value, level, score):
    lv, sc = activity(F.col("v"), (5, 2), "D")
    assert one(spark, F.struct(lv, sc), v=value) == (level, score)


@pytest.mark.parametrize("minutes,level,score", [
    (0, "D", 1), (9.9, "C", 2), (10, "B", 3), (59.9, "B", 3), (60, "A", 4)])
def test_intensity_band(spark, minutes, level, score):
    lv, sc = activity(F.col("v").cast("double"), (60, 10), "D")
    assert one(spark, F.struct(lv, sc), v=minutes) == (level, score)


def test_monthly_zero_level_is_null(spark):
    lv, sc = activity(F.col("v"), (5, 2), None)
    assert one(spark, F.struct(lv, sc), v=0) == (None, 1)
