"""Truth tables of the column functions, and the zip form of the unnesting."""

import pytest
from pyspark.sql import functions as F

from metermill.functions import scalars as S
from metermill.operators.unnest import explode_levels, zip_explode


def applied(spark, function, values, dtype="string"):
    frame = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in frame.select(function(F.col("v"))).collect()]


@pytest.mark.parametrize("function, table", [
    (S.primary_source, {"Visual": "Visual", "Remote": "Remoto", "LocalRF": "LAN", "Optical": "Optical",
                        "Manually Estimated": "Visual", "LegacySystem": "HES", "Other": "Other", None: None}),
    (S.reset_unit, {"Times": "Count", "times": "times", None: None}),
    (S.consumption_unit, {"Degree": "°", "kWh": "kWh", None: None}),
    (S.measure_unit, {"Current": "A", "Voltage": "V", "Power Factor Angle": "°", "Frequency": "Hz", "Other": "", None: ""}),
    (S.status_value, {"true": "0", "false": "false", "12": "12", None: None}),
    (S.is_reported_status, {"true": True, "false": False, "12": True, None: True}),
])
def test_translations(spark, function, table):
    assert applied(spark, function, list(table)) == list(table.values())


def test_service_point_takes_texts_and_numbers_under_ansi(spark):
    frame = spark.createDataFrame([("north 7", 1), (None, 2), (None, None)], "sdp string, irn long")
    found = [r[0] for r in frame.select(S.service_point(F.col("sdp"), F.col("irn"))).collect()]
    assert found == ["north 7", "2", None]


def test_spaced_is_null_when_any_part_is(spark):
    frame = spark.createDataFrame(
        [("a", "b", "c"), (None, "b", "c"), ("a", None, "c"), ("a", "b", None)], "x string, y string, z string")
    assert [r[0] for r in frame.select(S.spaced(*map(F.col, "xyz"))).collect()] == ["a b c", None, None, None]


def test_multiplier_text(spark):
    assert applied(spark, S.multiplier_text, ["1", "", None]) == [
        "'MultiplierValues':{ 'ct': '', 'pt':'', 'ke':'1', 'sf': ''}",
        "'MultiplierValues':{ 'ct': '', 'pt':'', 'ke':'', 'sf': ''}", None]


def test_source_translation_is_idempotent_where_nothing_is_renamed(spark):
    kept = ["Visual", "Optical", "Remoto", "LAN", "HES", "Other"]
    assert applied(spark, lambda c: S.primary_source(S.primary_source(c)), kept) == kept


def test_zip_and_explode_agree(spark):
    frame = spark.sql("""
        SELECT * FROM VALUES
          (1, array(named_struct('a', 1, 'b', 'x'), named_struct('a', CAST(NULL AS INT), 'b', 'y'))),
          (2, CAST(array() AS array<struct<a:int,b:string>>)),
          (3, CAST(NULL AS array<struct<a:int,b:string>>)),
          (4, array(CAST(NULL AS struct<a:int,b:string>))) AS t(id, items)""")
    zipped = zip_explode(frame.select("id", F.col("items.a").alias("a"), F.col("items.b").alias("b")), ["a", "b"])
    direct, (item,) = explode_levels(frame, "items")
    wanted = {(1, 1, "x"), (1, None, "y"), (4, None, None)}
    assert {tuple(r) for r in zipped.select("id", "zipped.a", "zipped.b").collect()} == wanted
    assert {tuple(r) for r in direct.select("id", item["a"], item["b"]).collect()} == wanted
