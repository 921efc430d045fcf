"""The hand-written exports through the readers, the kinds and both feed plans."""

import datetime as dt

import pytest
from exports import CODES, FLAGS_IN_ORDER, write_exports
from pyspark.sql import types as T

from metermill import KINDS, fused_feed, kind_named, read_documents, translate, unified_feed
from metermill.operators.sets import widening
from metermill.schemas import CANONICAL_COLUMNS, FEED_COLUMNS

ROWS = {"MaxDemandData": 2, "DemandResetCount": 2, "ConsumptionData": 2, "CoincidentDemandData": 1,
        "CumulativeDemandData": 1, "DemandReset": 10, "InstrumentationValue": 5, "LoadProfileSummary": 1,
        "OutageCountSummary": 2, "ReverseEnergySummary": 1, "EventData": 3, "IntervalData": 33, "Statuses": 4}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write_exports(tmp_path_factory.mktemp("exports"))


@pytest.fixture(scope="module")
def documents(spark, folder):
    return read_documents(spark, folder).cache()


def rows(documents, kind):
    return translate(documents, kind_named(kind)).collect()


def one(found, **wanted):
    (row,) = [r for r in found if all(r[k] == v for k, v in wanted.items())]
    return row


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_documents(documents):
    assert sorted(r._Irn for r in documents.collect()) == [1, 2, 3, 4, *range(10, 18)]


def test_readers_agree(spark, folder, documents):
    for other in (read_documents(spark, folder, split_files=False), read_documents(spark, folder, lenient=True)):
        assert other.schema == documents.schema
        assert sorted(map(repr, other.collect())) == sorted(map(repr, documents.collect()))


@pytest.mark.parametrize("kind", KINDS, ids=lambda k: k.name)
def test_row_counts_and_columns(documents, kind):
    readings = translate(documents, kind)
    assert tuple(readings.columns) == CANONICAL_COLUMNS
    assert readings.count() == ROWS[kind.name]


def test_max_demand(documents):
    total = one(rows(documents, "MaxDemandData"), variableId="kW Delivered Total")
    assert total.asDict() == {
        **dict.fromkeys(CANONICAL_COLUMNS, ""), "servicePointId": "point A", "readingType": "Registros",
        "variableId": "kW Delivered Total", "deviceId": 101, "meteringType": "Main",
        "readingDateSource": dt.datetime(2020, 1, 2, 3, 4, 5), "readingLocalTime": dt.datetime(2020, 1, 2, 3, 4, 5),
        "unitOfMeasure": "kW", "ke": 1, "readingsValue": 61.625, "primarySource": "Remoto", "owner": "PRIMEREAD",
        "guidFile": "Nombre del archivo", "estatus": "Activo"}
    tier = one(rows(documents, "MaxDemandData"), variableId="kW Delivered TierB")
    assert tier.readingLocalTime == dt.datetime(2020, 1, 1, 10) and tier.ke is None


def test_consumption_has_no_time_fallback_and_renames_units_last(documents):
    found = rows(documents, "ConsumptionData")
    degree = one(found, unitOfMeasure="°")
    assert (degree.variableId, degree.readingLocalTime, degree.readingsValue) == ("Degree Received TierA", None, 530117)
    assert one(found, unitOfMeasure="kWh").variableId is None  # blank direction
    assert degree.owner == degree.guidFile == "sacar del Path"


def test_resets(documents):
    counts = rows(documents, "DemandResetCount")
    assert {(r.unitOfMeasure, r.readingsValue, r.variableId) for r in counts} == {
        ("Count", 14, "Demand Reset"), ("Other", 15, "Demand Reset")}
    resets = [r for r in rows(documents, "DemandReset") if r.deviceId == 101]
    assert {r.readingLocalTime for r in resets} == {dt.datetime(2020, 1, 1, 14), None}
    assert {(r.readingType, r.readingsValue) for r in resets} == {("Eventos", "0")}


def test_sources(documents):
    found = {r.deviceId: r.primarySource for r in rows(documents, "DemandReset") if r.deviceId < 100}
    assert found == {0: "Visual", 1: "Remoto", 2: "LAN", 3: "Optical", 4: "Visual", 5: "HES", 6: "Unheard", 7: None}


def test_service_point_falls_back_to_the_meter(documents):
    assert {r.servicePointId for r in rows(documents, "LoadProfileSummary")} == {"103"}


def test_instrumentation(documents):
    found = {(r.variableId, r.unitOfMeasure) for r in rows(documents, "InstrumentationValue")}
    assert found == {(None, ""), (None, "A"), ("Voltage B", "V"), ("Power Factor Angle C", "°"), ("Frequency C", "Hz")}


def test_load_profile_and_reverse_energy_have_blank_times(documents):
    profile, = rows(documents, "LoadProfileSummary")
    reverse, = rows(documents, "ReverseEnergySummary")
    assert profile.readingLocalTime == reverse.readingLocalTime == reverse.readingDateSource == ""
    assert (profile.ke, profile.readingsValue, reverse.readingsValue) == (0.01, 8093.4, 3)


def test_outages_report_the_current_value_twice(documents):
    found = {(r.readingLocalTime, r.readingsValue) for r in rows(documents, "OutageCountSummary")}
    # Of a child that the schema has once, the last is kept.
    assert found == {(dt.datetime(2020, 1, 1, 2), 35), (dt.datetime(2019, 1, 1, 2), 35)}


def test_statuses(documents):
    found = {(r.variableId, r.readingsValue, r.eventsCode) for r in rows(documents, "Statuses")}
    assert found == {("Tamper Alert Tilt", "0", 1), ("Service Count & more", "2217", 3), ("Service Unknown", None, 4),
                     (None, "9", 5)}
    sample = one(rows(documents, "Statuses"), eventsCode=1)
    assert sample.readingLocalTime == dt.datetime(2020, 1, 2, 3, 4, 7)
    assert (sample.logNumber, sample.version, sample.owner, sample.guidFile) == ("1", "Original", "", "")


def test_events(documents):
    found = {(r.variableId, r.readingLocalTime, r.readingsValue) for r in rows(documents, "EventData")}
    assert found == {("a", dt.datetime(2020, 1, 1, 6), -17), ("b", dt.datetime(2020, 1, 1, 6), None),
                     ("c", dt.datetime(2020, 1, 1, 7), 3)}


def test_interval_quality(documents):
    found = {r.readingLocalTime.minute: "/".join(
        (r.qualityCodesSystemId, r.qualityCodesCategorization, r.qualityCodesIndex, r.dstStatus))
        for r in rows(documents, "IntervalData")}
    for at, flag in enumerate(FLAGS_IN_ORDER):
        assert found[at] == CODES[flag], flag
    for at, flag in enumerate(FLAGS_IN_ORDER[:-1]):
        assert found[20 + at] == CODES[flag], f"{flag} precedes {FLAGS_IN_ORDER[at + 1]}"
    assert [found[at] for at in (40, 41, 42, 43)] == ["1/2/0/", "1/4/3/", "///", "1/4/16/1"]


def test_interval_columns(documents):
    row = rows(documents, "IntervalData")[0]
    assert (row.readingType, row.variableId, row.channel, row.intervalSize, row.ke) == (
        "Perfiles de carga", "kWh Delivered", 1, 15, 0.01)


def test_feed(documents):
    feed = unified_feed(documents)
    assert tuple(feed.columns) == FEED_COLUMNS
    assert feed.count() == sum(ROWS.values())
    assert {f.dataType.simpleString() for f in feed.schema.fields if f.name != "deviceId"} == {"string"}
    found = feed.collect()
    values = {(r.variableId, r.readingsValue) for r in found}
    # Whole-number registers become doubles in the feed; other whole numbers do not.
    assert {("Demand Reset", "14.0"), ("Degree Received TierA", "530117.0"), ("Outage count", "35"),
            ("Reverse energy summary", "3"), ("a", "-17"), ("Demand Reset", "0")} <= values
    assert one(found, variableId="kW Delivered Total", readingsValue="61.625").multiplier == (
        "'MultiplierValues':{ 'ct': '', 'pt':'', 'ke':'1', 'sf': ''}")
    assert one(found, variableId="kW Delivered TierB").multiplier is None
    assert one(found, variableId="kWh Delivered", readingType="Registros").multiplier == (
        "'MultiplierValues':{ 'ct': '', 'pt':'', 'ke':'0.01', 'sf': ''}")
    assert one(found, variableId="a").readingLocalTime == "2020-01-01 06:00:00"


def test_fused_feed_is_the_union(documents):
    assert fused_feed(documents).columns == unified_feed(documents).columns
    assert same(fused_feed(documents), unified_feed(documents))


def test_fused_feed_of_some_kinds_and_own_owner(documents):
    kinds = [kind_named("Statuses"), kind_named("EventData")]
    fused = fused_feed(documents, kinds, owner="o'wner", guid_file="a\\b")
    assert same(fused, unified_feed(documents, kinds, owner="o'wner", guid_file="a\\b"))
    assert {(r.owner, r.guidFile) for r in fused.collect()} == {("o'wner", "a\\b")}


@pytest.mark.parametrize("length", [1, 2, 7])
def test_slices_give_the_same_feed(documents, length):
    assert same(fused_feed(documents, slice_readings=length), unified_feed(documents))


def test_narrowed_schema_gives_the_same_feed(spark, folder, documents):
    assert same(fused_feed(read_documents(spark, folder, kinds=KINDS)), unified_feed(documents))


LONG, DOUBLE, TEXT = T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize("types, paths", [
    ([LONG, DOUBLE, TEXT], [[DOUBLE, TEXT], [TEXT], []]),
    ([LONG, TEXT, DOUBLE], [[TEXT], [], [TEXT]]),
    ([DOUBLE, LONG], [[], [DOUBLE]]),
    ([LONG, LONG], [[], []]),
    ([T.TimestampType(), TEXT], [[TEXT], []]),
    ([T.BooleanType(), LONG], [[TEXT], [TEXT]]),
])
def test_widening(types, paths):
    assert widening(types) == paths


@pytest.mark.parametrize("names, value", [
    (["ConsumptionData"], "7"), (["ConsumptionData", "MaxDemandData"], "7.0"), (["MaxDemandData", "ConsumptionData"], "7.0"),
    (["ConsumptionData", "DemandReset", "MaxDemandData"], "7"), (["ConsumptionData", "MaxDemandData", "DemandReset"], "7.0"),
    (["DemandReset", "MaxDemandData", "ConsumptionData"], "7"),
])
def test_texts_of_some_kinds(documents, names, value):
    kinds = [kind_named(name) for name in names]
    feed = unified_feed(documents, kinds)
    assert same(feed, fused_feed(documents, kinds))
    assert value in {row.readingsValue for row in feed.filter("unitOfMeasure = 'kWh'").collect()}
