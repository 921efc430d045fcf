"""Meter documents derived from the test tables.

Each table row becomes one document whose readings are built from that row, so deriving them needs no
join or grouping: it scales with the tables and no key can pile rows up in one task.  Line items make
register meters, orders make reset and outage meters, events make instrumentation, status, event and
interval meters.  How many readings of a kind a document holds varies by row, from none.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metermill.schemas import QUALITY_FLAGS
from metermill.sources.documents import write_documents
from metermill.sources.sinks import working_folder

SOURCES = ("Visual", "Remote", "LocalRF", "Optical", "Manually Estimated", "LegacySystem", "Other", None)
MEASURES = {"click": "Current", "view": "Voltage", "purchase": "Power Factor Angle", "signup": "Frequency"}

_exported: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _time(local: Column) -> Column:
    return local.cast("timestamp")


def _after(local: Column, amount: int, unit: str) -> Column:
    return _time(local + F.expr(f"INTERVAL {amount} {unit}"))


def _choose(number: Column, values: tuple[str | None, ...]) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), number.cast("int"))


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _some(elements: list[Column], count: Column) -> Column:
    """The first ``count`` of the elements; NULL, which shows without building them, where the count is."""
    count = count.cast("int")
    return F.when(count.isNotNull(), F.slice(F.array(*elements), F.lit(1), F.coalesce(count, F.lit(0))))


def _struct(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _header(key: Column, meter: Column, time: Column, source: Column) -> list[Column]:
    return [
        key.alias("_Irn"),
        time.alias("_CollectionTime"),
        source.alias("_Source"),
        _struct(_MeterIrn=meter,
                _SdpIdent=_unless(meter % 3 == 0, F.concat(F.lit("SDP"), meter.cast("string")))).alias("Meter"),
    ]


def register_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    number, shipped = F.col("l_linenumber"), F.col("l_shipdate")
    count = number % 4

    def family(spec: str, unit, direction: str, value) -> Column:
        def element(i: int) -> Column:
            return F.struct(
                _struct(_UOM=unit(i), _Direction=F.col(direction), _TouBucket=F.lit(f"Tier{i}"),
                        _MeasurementPeriod=F.lit("Current"),
                        _Multiplier=_unless((number + i) % 7 == 0, F.lit(i).cast("long"))).alias(spec),
                _struct(_TimeStamp=F.lit(None).cast("timestamp") if i % 2 else _after(shipped, i, "HOURS"),
                        _Value=value(i)).alias("Reading"))
        return _some([element(i) for i in (1, 2, 3)], count)

    def kilowatts(i: int) -> Column:
        return _unless((number + i) % 5 == 0, F.lit("kW"))

    def consumed(i: int) -> Column:
        return F.when((number + i) % 5 == 0, F.lit(None)).when((number + i) % 3 == 0, "Degree").otherwise("kWh")

    return lines.select(
        *_header(F.col("l_orderkey"), F.col("l_suppkey"), _time(shipped), _choose(F.col("l_partkey") % 8, SOURCES)),
        _unless(F.col("l_returnflag") == "N",
                family("MaxDemandSpec", kilowatts, "l_returnflag", lambda i: F.col("l_quantity"))
                ).alias("MaxDemandData"),
        family("ConsumptionSpec", consumed, "l_linestatus",
               lambda i: F.col("l_quantity").cast("long") * i).alias("ConsumptionData"),
        family("CoincidentDemandSpec", kilowatts, "l_linestatus",
               lambda i: F.col("l_extendedprice")).alias("CoincidentDemandData"),
        family("CumulativeDemandSpec", kilowatts, "l_linestatus",
               lambda i: _unless((number + i) % 6 == 0, F.col("l_quantity") + i)).alias("CumulativeDemandData"))


def reset_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, customer, ordered = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    source = (F.when(key % 7 == 0, "Optical").when(key % 11 == 0, "Other").when(key % 13 == 0, F.lit(None))
              .otherwise(_choose(F.substring("o_orderpriority", 1, 1).cast("int") - 1,
                                 ("Visual", "Remote", "LocalRF", "Manually Estimated", "LegacySystem"))))
    counts = [_struct(_Count=key % 100 + i,
                      _TimeStamp=_unless((key + i) % 5 == 0, _after(ordered, i, "DAYS")),
                      _UOM=F.when((key + i) % 7 == 0, F.lit(None)).when((key + i) % 2 == 0, "Times").otherwise("Other"))
              for i in (1, 2)]
    resets = [_struct(_TimeStamp=_unless((customer + i) % 4 == 0, _after(ordered, i, "HOURS"))) for i in (1, 2)]
    profiles = [_struct(Channel=_struct(
        _UOM=F.concat("o_orderstatus", F.lit("Wh")),
        _Direction=_unless((key + i) % 5 == 0, F.lit("Delivered")),
        _Multiplier=_unless((key + i) % 7 == 0, F.lit(i * 0.5)),
        _SumOfIntervalValues=F.col("o_totalprice"))) for i in (1, 2, 3)]
    outages = [_struct(OutageCount=_struct(
        _ReadingTime=_after(ordered, i, "HOURS"), _Value=key % 50,
        _PreviousReadingTime=_unless((key + i) % 4 == 0, _after(ordered, -i, "DAYS")),
        _PreviousValue=key % 50 - 1)) for i in (1, 2, 3)]
    reversals = [_struct(ReverseEnergy=_struct(_CurrentValue=customer * i, _PreviousValue=customer))
                 for i in (1, 2)]
    return orders.select(
        *_header(key, customer, _time(ordered), source),
        _some(counts, key % 3).alias("DemandResetCount"),
        _some(resets, customer % 3).alias("DemandReset"),
        _some(profiles, key % 4).alias("LoadProfileSummary"),
        _some(outages, customer % 4).alias("OutageCountSummary"),
        _unless(F.col("o_orderstatus") == "F", _some(reversals, key % 2 + 1)).alias("ReverseEnergySummary"))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    key, kind, value = F.col("event_id"), F.col("event_type"), F.col("value")
    # Exports carry whole seconds.
    at = F.date_trunc("second", "ts").cast("timestamp_ntz")
    counter = F.regexp_extract("props", "[0-9]+", 0).cast("long")

    name = reduce(lambda chain, item: chain.when(kind == item[0], item[1]), MEASURES.items(), F.when(F.lit(False), ""))
    measures = [_struct(_Name=F.lit("Energy") if i == 3 else name,
                        _Phase=_unless((key + i) % 2 == 1, F.lit(f"P{i}")),
                        _Timestamp=_after(at, i, "MINUTES"), _Value=value) for i in (1, 2, 3)]

    def status(group: int, i: int) -> Column:
        number = (key + group + i) % 4
        return _struct(_Category=kind, _Id=F.lit(10 * group + i).cast("long"),
                       _Name=_unless((key + i) % 9 == 0, F.lit(f"Status {i}")), _Type=F.lit("bool"),
                       _Value=F.when(number == 0, "true").when(number == 1, "false")
                       .when(number == 3, (key % 100).cast("string")))

    statuses = [_struct(Status=_some([status(g, i) for i in (1, 2)], (key + g) % 3)) for g in (1, 2)]

    def event(v: int) -> Column:
        attributes = [_struct(_Name=F.lit(f"k{a}"), _Value=counter * a - 50) for a in (1, 2)]
        return _struct(EventAttribute=_unless((key + v) % 5 == 0, _some(attributes, key % 2 + 1)),
                       _DiscoveredAt=_after(at, 1, "HOURS"), _Source=F.lit("Event Log"),
                       _TimeStamp=_unless((key + v) % 4 == 0, _after(at, v, "MINUTES")))

    groups = [_struct(Event=_some([event(v) for v in (1, 2)], (key + g) % 2 + 1),
                      EventSpec=_struct(_Type=kind)) for g in (1, 2)]

    # As higher-order functions: written out, the flags of all readings outgrow one generated method.
    def interval_reading(c: Column, r: Column) -> Column:
        first, second = (key * 3 + c * 5 + r) % 17, F.when(key % 3 == 0, (key + r) % 16)
        flags = {f"_{flag}": F.when((first == i) | second.eqNullSafe(F.lit(i)), key % 2)
                 for i, flag in enumerate(QUALITY_FLAGS)}
        return _struct(QualityFlags=_unless((first == 16) & (key % 3 != 0), _struct(**flags)),
                       _RawReading=value,
                       _TimeStamp=_time(at + F.make_dt_interval(mins=(r * 15).cast("int"))))

    def interval(c: Column) -> Column:
        readings = F.sequence(F.lit(1), (key + c) % 3 + 1)
        return _struct(
            IntervalSpec=_struct(_Channel=c, _Direction=_unless((key + c) % 11 == 0, F.lit("Delivered")),
                                 _Interval=c * 15, _Multiplier=F.lit(0.01), _UOM=F.lit("kWh")),
            Reading=F.transform(readings, lambda r: interval_reading(c, r)))

    intervals = F.when(key.isNotNull(), F.transform(F.sequence(F.lit(1), F.coalesce(key % 2 + 1, F.lit(1))), interval))

    return events.select(
        *_header(key, F.col("user_id"), _time(at), _choose(key % 8, SOURCES)),
        _some(measures, key % 3 + 1).alias("InstrumentationValue"),
        _unless(key % 6 == 0, _some(statuses, key % 2 + 1)).alias("Statuses"),
        _some(groups, key % 3).alias("EventData"),
        intervals.alias("IntervalData"))


def meter_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents.  A family that a meter does not have is NULL."""
    parts = [make(spark, sf_dir) for make in (register_documents, reset_documents, event_documents)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def long_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long document for each supplier: 2,500 interval readings in one element, 300 events and 200 resets."""
    suppliers = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("long")
    start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")

    def times(count: int, of: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), of)

    def at(n: Column) -> Column:
        return _time(start + F.make_dt_interval(mins=n))

    interval = _struct(
        IntervalSpec=_struct(_Channel=F.lit(1).cast("long"), _Direction=F.lit("Delivered"), _UOM=F.lit("kWh")),
        Reading=times(2500, lambda n: _struct(_RawReading=((key * 7 + n) % 1000).cast("double") + 0.5, _TimeStamp=at(n))))
    events = _struct(Event=times(300, lambda n: _struct(
        EventAttribute=F.array(_struct(_Name=F.concat(F.lit("k"), (n % 3).cast("string")), _Value=key + n)), _TimeStamp=at(n))))
    return suppliers.select(
        *_header(key, key, _time(start), F.lit("Visual")), times(200, lambda n: _struct(_TimeStamp=at(n))).alias("DemandReset"),
        F.array(events).alias("EventData"), F.array(interval).alias("IntervalData"))


def exported(spark: SparkSession, sf_dir: str, name: str, make, documents_per_file: int = 50_000) -> str:
    """The folder with these documents as XML exports; written once per session.

    Missing service points are written as blank attributes, as meter exports do.  As text the exports are over thirty times
    their tables, so they are compressed, in files short enough for a task each.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _exported:
        path = working_folder(spark)
        blank = F.coalesce("Meter._SdpIdent", F.lit(""))
        write_documents(make(spark, sf_dir).withColumn("Meter", F.col("Meter").withField("_SdpIdent", blank)), path,
                        "gzip", documents_per_file)
        _exported[key] = path
    return _exported[key]
