"""Input and output schemas.

One ``<MeterReadings>`` element is one input row.  XML attributes become fields with a leading
underscore; every element that carries attributes also gets the ``_valueTag`` text field.
"""

from __future__ import annotations

from pyspark.sql import types as T

ROOT_TAG = "AMRDEF"
ROW_TAG = "MeterReadings"
VALUE_TAG = "_valueTag"

# The sixteen interval quality flags, in schema order.
QUALITY_FLAGS = (
    "ClockSetBackward", "ClockSetForward", "CompleteOutage", "DST", "InvalidTime", "InvalidValue",
    "LongInterval", "PartialInterval", "PartialOutage", "PulseOverflow", "Restoration",
    "SkippedInterval", "SuspectedOutage", "Tamper", "TestMode", "TimeChanged",
)

# The canonical reading, in output order.
CANONICAL_COLUMNS = (
    "servicePointId", "readingType", "variableId", "deviceId", "meteringType", "readingUtcLocalTime",
    "readingDateSource", "readingLocalTime", "dstStatus", "channel", "unitOfMeasure",
    "qualityCodesSystemId", "qualityCodesCategorization", "qualityCodesIndex", "intervalSize",
    "logNumber", "ct", "pt", "ke", "sf", "version", "readingsValue", "primarySource", "owner",
    "guidFile", "estatus", "registersNumber", "eventsCode", "agentId", "agentDescription",
)

# The feed folds these four into one trailing ``multiplier`` text.
MULTIPLIER_PARTS = ("ct", "pt", "ke", "sf")
FEED_COLUMNS = tuple(c for c in CANONICAL_COLUMNS if c not in MULTIPLIER_PARTS) + ("multiplier",)

_SIMPLE = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _element(children: dict[str, T.DataType] | None = None, **attributes: str) -> T.StructType:
    """An XML element: child elements, then attributes (``Name="type"``), then the value tag."""
    fields = [T.StructField(name, dtype) for name, dtype in (children or {}).items()]
    if attributes:
        fields += [T.StructField(f"_{name}", _SIMPLE[dtype]) for name, dtype in attributes.items()]
        fields.append(T.StructField(VALUE_TAG, T.StringType()))
    return T.StructType(fields)


def _many(element: T.StructType) -> T.ArrayType:
    return T.ArrayType(element)


def _register(spec: str, value: str) -> T.ArrayType:
    """The shape the four register families share: a spec element and one reading."""
    return _many(_element({
        spec: _element(Direction="string", MeasurementPeriod="string", Multiplier="long",
                       TouBucket="string", UOM="string"),
        "Reading": _element(TimeStamp="timestamp", Value=value),
    }))


def document_schema() -> T.StructType:
    """The explicit read schema of a meter document."""
    attribute = _element(Name="string", Value="long")
    event = _element({"EventAttribute": _many(attribute)}, DiscoveredAt="timestamp",
                     EventInfo="string", Source="string", TimeStamp="timestamp")
    status = _element(Category="string", Id="long", Name="string", Type="string", Value="string")
    interval_spec = _element(Channel="long", Direction="string", Interval="long", Multiplier="double",
                             TimestampEnd="timestamp", TimestampStart="timestamp", UOM="string")
    interval_reading = _element(
        {"QualityFlags": _element(**{flag: "long" for flag in QUALITY_FLAGS})},
        RawReading="double", TimeStamp="timestamp")
    channel = _element(Direction="string", FirstIntervalTimestamp="timestamp", IntervalSeconds="long",
                       Multiplier="double", NumIntervalsRead="long",
                       ReadingRangeEndTimestamp="timestamp", ReadingRangeStartTimestamp="timestamp",
                       SumOfIntervalValues="double", UOM="string")
    outage = _element(PreviousReadingTime="timestamp", PreviousValue="long",
                      ReadingTime="timestamp", Value="long")
    meter = _element(
        AccountIdent="string", AccountName="string", Description="string", InstallDate="timestamp",
        IsActive="boolean", Location="string", MediaType="string", MeterIrn="long",
        MeterName="string", MeterType="string", ObservesDaylightSavings="boolean",
        RemovalDate="string", SdpIdent="string", SerialNumber="long", TimeZoneIndex="long",
        TimeZoneOffset="long", Timezone="string")
    clock = _element(ActiveDayType="string", ActiveSeason="string", ActiveTier="string",
                     DaylightAdjustmentInEffectAtMeter="boolean", MeterTime="timestamp",
                     ServerTime="timestamp")
    children = {
        "Clock": clock,
        "CoincidentDemandData": _register("CoincidentDemandSpec", "double"),
        "ConsumptionData": _register("ConsumptionSpec", "long"),
        "CumulativeDemandData": _register("CumulativeDemandSpec", "double"),
        "DemandReset": _many(_element(TimeStamp="timestamp")),
        "DemandResetCount": _many(_element(Count="long", TimeStamp="timestamp", UOM="string")),
        "EventData": _many(_element({
            "Event": _many(event), "EventSpec": _element(Category="string", Type="string")})),
        "InstrumentationValue": _many(_element(
            Name="string", Phase="string", Timestamp="timestamp", Value="double")),
        "IntervalData": _many(_element({
            "IntervalSpec": interval_spec, "Reading": _many(interval_reading)})),
        "LoadProfileSummary": _many(_element({"Channel": channel})),
        "MaxDemandData": _register("MaxDemandSpec", "double"),
        "Meter": meter,
        "OutageCountSummary": _many(_element({"OutageCount": outage})),
        "ReadingQualityIndicator": _many(_element(Name="string", Value="boolean")),
        "ReverseEnergySummary": _many(_element({
            "ReverseEnergy": _element(CurrentValue="long", PreviousValue="long")})),
        "Statuses": _many(_element({"Status": _many(status)})),
    }
    header = _element(CollectionTime="timestamp", Initiator="string", Irn="long", Purpose="string",
                      Source="string", SourceIrn="long", SourceName="string")
    fields = [T.StructField(name, dtype) for name, dtype in children.items()]
    return T.StructType(fields + [f for f in header.fields if f.name != VALUE_TAG])
