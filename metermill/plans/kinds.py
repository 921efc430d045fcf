"""The reading kinds, declared.

A kind says where its readings are nested, which columns they fill, and which columns are constant.
Everything it leaves out is "".  The same declaration drives both the exploding plan
(``plans.translate``) and the single-scan plan (``plans.feed``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from metermill.functions import scalars as S
from metermill.functions.quality import quality_rule
from metermill.operators.unnest import Step

# Reading types and constant texts of the canonical reading.
REGISTERS = "Registros"
EVENTS = "Eventos"
LOAD_PROFILES = "Perfiles de carga"
METERING_TYPE = "Main"
STATUS = "Activo"
NAMED_FILE = {"owner": "PRIMEREAD", "guidFile": "Nombre del archivo"}
FROM_PATH = {"owner": "sacar del Path", "guidFile": "sacar del Path"}
LOGGED = {"logNumber": "1", "version": "Original"}

# What a reading may fill besides the document's columns.  ``time`` feeds both reading times and
# ``quality`` (a rule position) the DST status and the three quality codes.
READING_FIELDS = ("variableId", "time", "unitOfMeasure", "channel", "quality", "intervalSize", "ke",
                  "readingsValue", "eventsCode")


@dataclass(frozen=True)
class ReadingKind:
    name: str
    directory: str
    array: str
    # (document time, element of level 0, element of level 1, ...) -> READING_FIELDS subset
    reading: Callable[..., dict[str, Column]]
    constants: dict[str, str]
    steps: tuple[Step, ...] = ()
    keep: Callable[..., Column] | None = None
    written: bool = True
    skipped_when_empty: bool = False


def _register(spec: str, document_time_fallback: bool, unit: Callable[[Column], Column] = lambda u: u):
    """Readings of the four register families."""

    def reading(document_time: Column, e: Column) -> dict[str, Column]:
        about, measured = e[spec], e["Reading"]
        time = measured["_TimeStamp"]
        return {
            "variableId": S.spaced(about["_UOM"], about["_Direction"], about["_TouBucket"]),
            "time": S.first_time(time, document_time) if document_time_fallback else time,
            "unitOfMeasure": unit(about["_UOM"]),
            "ke": about["_Multiplier"],
            "readingsValue": measured["_Value"],
        }

    return reading


def _reset_count(_: Column, e: Column) -> dict[str, Column]:
    return {"time": e["_TimeStamp"], "unitOfMeasure": S.reset_unit(e["_UOM"]), "readingsValue": e["_Count"]}


def _reset(_: Column, e: Column) -> dict[str, Column]:
    return {"time": e["_TimeStamp"]}


def _instrumentation(_: Column, e: Column) -> dict[str, Column]:
    return {
        "variableId": S.spaced(e["_Name"], e["_Phase"]),
        "time": e["_Timestamp"],
        "unitOfMeasure": S.measure_unit(e["_Name"]),
        "readingsValue": e["_Value"],
    }


def _load_profile(_: Column, e: Column) -> dict[str, Column]:
    channel = e["Channel"]
    return {
        "variableId": S.spaced(channel["_UOM"], channel["_Direction"]),
        "unitOfMeasure": channel["_UOM"],
        "ke": channel["_Multiplier"],
        "readingsValue": channel["_SumOfIntervalValues"],
    }


def _outage(_: Column, e: Column, time: Column) -> dict[str, Column]:
    # The previous reading carries the current value too; the previous value is never reported.
    return {"time": time, "readingsValue": e["OutageCount"]["_Value"]}


def current_outage_times(e: Column) -> Column:
    return F.array(e["OutageCount"]["_ReadingTime"])


def previous_outage_times(e: Column) -> Column:
    return F.array(e["OutageCount"]["_PreviousReadingTime"])


def _both_outage_times(e: Column) -> Column:
    return F.array(e["OutageCount"]["_ReadingTime"], e["OutageCount"]["_PreviousReadingTime"])


def _reverse_energy(_: Column, e: Column) -> dict[str, Column]:
    return {"readingsValue": e["ReverseEnergy"]["_CurrentValue"]}


def _event(_: Column, _group: Column, event: Column, attribute: Column) -> dict[str, Column]:
    return {
        "variableId": attribute["_Name"],
        "time": S.first_time(event["_TimeStamp"], event["_DiscoveredAt"]),
        "readingsValue": attribute["_Value"],
    }


def _interval(_: Column, e: Column, measured: Column) -> dict[str, Column]:
    about = e["IntervalSpec"]
    return {
        "variableId": S.spaced(about["_UOM"], about["_Direction"]),
        "time": measured["_TimeStamp"],
        "unitOfMeasure": about["_UOM"],
        "channel": about["_Channel"],
        "quality": quality_rule(measured["QualityFlags"]),
        "intervalSize": about["_Interval"],
        "ke": about["_Multiplier"],
        "readingsValue": measured["_RawReading"],
    }


def _status(document_time: Column, _group: Column, status: Column) -> dict[str, Column]:
    return {
        "variableId": S.spaced(status["_Category"], status["_Name"]),
        "time": document_time,
        "readingsValue": S.status_value(status["_Value"]),
        "eventsCode": status["_Id"],
    }


MAX_DEMAND = ReadingKind(
    "MaxDemandData", "MaxDemandDataReadings", "MaxDemandData",
    _register("MaxDemandSpec", document_time_fallback=True),
    {"readingType": REGISTERS, **NAMED_FILE})

DEMAND_RESET_COUNT = ReadingKind(
    "DemandResetCount", "DemandResetCountReadings", "DemandResetCount", _reset_count,
    {"readingType": REGISTERS, "variableId": "Demand Reset", **FROM_PATH})

CONSUMPTION = ReadingKind(
    "ConsumptionData", "ConsumptionDataReadings", "ConsumptionData",
    _register("ConsumptionSpec", document_time_fallback=False, unit=S.consumption_unit),
    {"readingType": REGISTERS, **FROM_PATH})

COINCIDENT_DEMAND = ReadingKind(
    "CoincidentDemandData", "CoincidentDemandDataReadings", "CoincidentDemandData",
    _register("CoincidentDemandSpec", document_time_fallback=True),
    {"readingType": REGISTERS, **FROM_PATH})

CUMULATIVE_DEMAND = ReadingKind(
    "CumulativeDemandData", "CumulativeDemandDataReadings", "CumulativeDemandData",
    _register("CumulativeDemandSpec", document_time_fallback=True),
    {"readingType": REGISTERS, **FROM_PATH})

DEMAND_RESET = ReadingKind(
    "DemandReset", "DemandResetReadings", "DemandReset", _reset,
    {"readingType": EVENTS, "variableId": "Demand Reset", "readingsValue": "0", **FROM_PATH})

INSTRUMENTATION = ReadingKind(
    "InstrumentationValue", "InstrumentationValueReadings", "InstrumentationValue", _instrumentation,
    {"readingType": REGISTERS, **FROM_PATH})

LOAD_PROFILE = ReadingKind(
    "LoadProfileSummary", "LoadProfileSummaryReadings", "LoadProfileSummary", _load_profile,
    {"readingType": REGISTERS, **FROM_PATH})

OUTAGE_COUNT = ReadingKind(
    "OutageCountSummary", "OutageCountReadings", "OutageCountSummary", _outage,
    {"readingType": EVENTS, "variableId": "Outage count", "unitOfMeasure": "Count", **FROM_PATH},
    steps=(_both_outage_times,))

REVERSE_ENERGY = ReadingKind(
    "ReverseEnergySummary", "ReverseEnergySummaryReadings", "ReverseEnergySummary", _reverse_energy,
    {"readingType": REGISTERS, "variableId": "Reverse energy summary", **FROM_PATH})

EVENT = ReadingKind(
    "EventData", "EventDataReadings", "EventData", _event,
    {"readingType": EVENTS, **NAMED_FILE},
    steps=(lambda group: group["Event"], lambda event: event["EventAttribute"]),
    written=False)

INTERVAL = ReadingKind(
    "IntervalData", "IntervalDataReadings", "IntervalData", _interval,
    {"readingType": LOAD_PROFILES, **LOGGED},
    steps=(lambda e: e["Reading"],),
    skipped_when_empty=True)

STATUSES = ReadingKind(
    "Statuses", "StatusReadings", "Statuses", _status,
    {"readingType": EVENTS, **LOGGED},
    steps=(lambda group: group["Status"],),
    keep=lambda _group, status: S.is_reported_status(status["_Value"]),
    skipped_when_empty=True)

# In the order in which the feed unites them.
KINDS = (MAX_DEMAND, DEMAND_RESET_COUNT, CONSUMPTION, COINCIDENT_DEMAND, CUMULATIVE_DEMAND, DEMAND_RESET,
         INSTRUMENTATION, LOAD_PROFILE, OUTAGE_COUNT, REVERSE_ENERGY, EVENT, INTERVAL, STATUSES)


def kind_named(name: str) -> ReadingKind:
    for kind in KINDS:
        if kind.name == name:
            return kind
    raise KeyError(f"no reading kind {name!r}; there are: {', '.join(k.name for k in KINDS)}")
