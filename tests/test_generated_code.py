"""What keeps translations in compiled code: arrays are built once, and no method outgrows the compiler."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from metermill import kind_named, translate
from metermill.sources.options import short_methods
from metermill.workload.documents import register_documents

LIMIT = "spark.sql.codegen.hugeMethodLimit"
NUMBERS = (None, 0, 1, 2, 3, 4, 7)


@pytest.fixture(scope="module")
def lines(tmp_path_factory):
    """Line items with each number of readings, and one whose number is NULL."""
    folder, n = tmp_path_factory.mktemp("lines"), len(NUMBERS)
    keys = pa.array(range(n), pa.int64())
    pq.write_table(pa.table({
        "l_orderkey": keys, "l_partkey": keys, "l_suppkey": keys, "l_linenumber": pa.array(NUMBERS, pa.int32()),
        "l_quantity": pa.array([2.0] * n), "l_extendedprice": pa.array([3.0] * n), "l_returnflag": ["A"] * n,
        "l_linestatus": ["O"] * n, "l_shipdate": pa.array([dt.datetime(2020, 1, 1)] * n, pa.timestamp("us"))}),
        folder / "lineitem.parquet")
    return str(folder)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["ConsumptionData", "CumulativeDemandData"])
def test_a_derived_array_is_built_once(spark, lines, kind):
    readings = translate(register_documents(spark, lines), kind_named(kind))
    assert plan(readings).count("Tier1") == 1
    found = [row.deviceId for row in readings.select("deviceId").collect()]
    assert sorted(found) == [key for key, number in enumerate(NUMBERS) for _ in range((number or 0) % 4)]


def test_methods_stay_short_unless_the_session_says_otherwise(spark, lines):
    own = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        translate(register_documents(spark, lines), kind_named("ConsumptionData"))
        assert spark.conf.get(LIMIT) == "8000"
        spark.conf.set(LIMIT, "20000")
        short_methods(spark)
        assert spark.conf.get(LIMIT) == "20000"
    finally:
        spark.conf.set(LIMIT, own)
