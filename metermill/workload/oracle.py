"""Flat SQL for what the queries return, written from the rules that derive the documents.

Nothing here nests: the expected rows come from joining a table row with the numbers of its readings, so
the SQL checks unnesting and translation independently of the Spark plans.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from metermill.schemas import CANONICAL_COLUMNS, MULTIPLIER_PARTS


def numbers(name: str, last: int) -> str:
    return "(VALUES " + ", ".join(f"({i})" for i in range(1, last + 1)) + f") {name}_({name})"


def point(meter: str) -> str:
    return f"CASE WHEN {meter} % 3 = 0 THEN CAST({meter} AS VARCHAR) ELSE 'SDP' || {meter} END"


def chosen(number: str, texts: list[str]) -> str:
    cases = " ".join(f"WHEN {at} THEN '{text}'" for at, text in enumerate(texts))
    return f"CASE {number} {cases} END"


RAW = ["Visual", "Remote", "LocalRF", "Optical", "Manually Estimated", "LegacySystem", "Other"]
TRANSLATED = ["Visual", "Remoto", "LAN", "Optical", "Visual", "HES", "Other"]


def order_source(texts: list[str]) -> str:
    """Sources of order documents; ``texts`` in the order of RAW."""
    visual, remote, local, optical, manual, legacy, other = texts
    by_priority = chosen("CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1", [visual, remote, local, manual, legacy])
    return (f"CASE WHEN o_orderkey % 7 = 0 THEN '{optical}' WHEN o_orderkey % 11 = 0 THEN '{other}' "
            f"WHEN o_orderkey % 13 = 0 THEN NULL ELSE {by_priority} END")


@dataclass(frozen=True)
class Documents:
    table: str
    key: str
    meter: str
    time: str
    source: str
    primary: str


LINES = Documents("lineitem", "l_orderkey", "l_suppkey", "l_shipdate",
                  chosen("l_partkey % 8", RAW), chosen("l_partkey % 8", TRANSLATED))
ORDERS = Documents("orders", "o_orderkey", "o_custkey", "o_orderdate", order_source(RAW), order_source(TRANSLATED))
EVENTS = Documents(
    "(SELECT *, date_trunc('second', ts) AS read_at, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS counter"
    " FROM events) readers", "event_id", "user_id", "read_at",
    chosen("event_id % 8", RAW), chosen("event_id % 8", TRANSLATED))
ALL_DOCUMENTS = (LINES, ORDERS, EVENTS)


@dataclass(frozen=True)
class Expected:
    """The readings of one kind: joins that number them, a filter, and the columns they fill."""

    documents: Documents
    joins: str
    where: str = "TRUE"
    values: dict[str, str] = field(default_factory=dict)
    feed_value_as_double: bool = False


def text(value: str) -> str:
    return f"'{value}'"


def spaced(*parts: str) -> str:
    return " || ' ' || ".join(f"({p})" for p in parts)


NAMED = {"owner": text("PRIMEREAD"), "guidFile": text("Nombre del archivo")}
PATH = {"owner": text("sacar del Path"), "guidFile": text("sacar del Path")}
LOGGED = {"logNumber": text("1"), "version": text("Original")}
REGISTERS = {"readingType": text("Registros")}
EVENT_TYPE = {"readingType": text("Eventos")}


def times(value: str) -> dict[str, str]:
    return {"readingDateSource": value, "readingLocalTime": value}


LINE_JOINS = f"JOIN {numbers('i', 3)} ON i <= l_linenumber % 4"
LINE_TIME = "CASE WHEN i % 2 = 0 THEN l_shipdate + to_hours(i) END"
LINE_KE = "CASE WHEN (l_linenumber + i) % 7 <> 0 THEN CAST(i AS BIGINT) END"
KILOWATTS = "CASE WHEN (l_linenumber + i) % 5 <> 0 THEN 'kW' END"
CONSUMED = ("CASE WHEN (l_linenumber + i) % 5 = 0 THEN NULL WHEN (l_linenumber + i) % 3 = 0 THEN '{}' "
            "ELSE 'kWh' END")


def register(unit: str, shown: str, direction: str, value: str, fallback: bool, file: dict[str, str], **more) -> Expected:
    time = f"COALESCE({LINE_TIME}, l_shipdate)" if fallback else LINE_TIME
    return Expected(LINES, LINE_JOINS, values={
        **REGISTERS, **times(time), **file, "variableId": spaced(unit, direction, "'Tier' || i"),
        "unitOfMeasure": shown, "ke": LINE_KE, "readingsValue": value}, **more)


MAX_DEMAND = register(KILOWATTS, KILOWATTS, "l_returnflag", "l_quantity", True, NAMED)
MAX_DEMAND = Expected(LINES, LINE_JOINS, "l_returnflag <> 'N'", MAX_DEMAND.values)
CONSUMPTION = register(CONSUMED.format("Degree"), CONSUMED.format("°"), "l_linestatus",
                       "CAST(l_quantity AS BIGINT) * i", False, PATH, feed_value_as_double=True)
COINCIDENT = register(KILOWATTS, KILOWATTS, "l_linestatus", "l_extendedprice", True, PATH)
CUMULATIVE = register(KILOWATTS, KILOWATTS, "l_linestatus",
                      "CASE WHEN (l_linenumber + i) % 6 <> 0 THEN l_quantity + i END", True, PATH)

RESET_COUNT_TIME = "CASE WHEN (o_orderkey + i) % 5 <> 0 THEN o_orderdate + to_days(i) END"
RESET_COUNT_UNIT = ("CASE WHEN (o_orderkey + i) % 7 = 0 THEN NULL WHEN (o_orderkey + i) % 2 = 0 THEN '{}' "
                    "ELSE 'Other' END")
RESET_COUNT = Expected(ORDERS, f"JOIN {numbers('i', 2)} ON i <= o_orderkey % 3", values={
    **REGISTERS, **times(RESET_COUNT_TIME), **PATH, "variableId": text("Demand Reset"),
    "unitOfMeasure": RESET_COUNT_UNIT.format("Count"), "readingsValue": "o_orderkey % 100 + i"},
    feed_value_as_double=True)

RESET_TIME = "CASE WHEN (o_custkey + i) % 4 <> 0 THEN o_orderdate + to_hours(i) END"
RESET = Expected(ORDERS, f"JOIN {numbers('i', 2)} ON i <= o_custkey % 3", values={
    **EVENT_TYPE, **times(RESET_TIME), **PATH, "variableId": text("Demand Reset"), "readingsValue": text("0")})

LOAD_PROFILE = Expected(ORDERS, f"JOIN {numbers('i', 3)} ON i <= o_orderkey % 4", values={
    **REGISTERS, **PATH, "unitOfMeasure": "o_orderstatus || 'Wh'",
    "variableId": spaced("o_orderstatus || 'Wh'", "CASE WHEN (o_orderkey + i) % 5 <> 0 THEN 'Delivered' END"),
    "ke": "CASE WHEN (o_orderkey + i) % 7 <> 0 THEN CAST(i AS DOUBLE) * CAST(0.5 AS DOUBLE) END",
    "readingsValue": "o_totalprice"})


def outage(time: str, joins: str = "") -> Expected:
    return Expected(ORDERS, f"JOIN {numbers('i', 3)} ON i <= o_custkey % 4 {joins}", values={
        **EVENT_TYPE, **times(time), **PATH, "variableId": text("Outage count"), "unitOfMeasure": text("Count"),
        "readingsValue": "o_orderkey % 50"})


OUTAGE_TIME = "o_orderdate + to_hours(i)"
OUTAGE_BEFORE = "CASE WHEN (o_orderkey + i) % 4 <> 0 THEN o_orderdate - to_days(i) END"
OUTAGE_NOW, OUTAGE_PREVIOUS = outage(OUTAGE_TIME), outage(OUTAGE_BEFORE)
OUTAGE = outage(f"CASE WHEN w = 1 THEN {OUTAGE_TIME} ELSE {OUTAGE_BEFORE} END", f"JOIN {numbers('w', 2)} ON TRUE")

REVERSE_ENERGY = Expected(
    ORDERS, f"JOIN {numbers('i', 2)} ON i <= o_orderkey % 2 + 1", "o_orderstatus <> 'F'",
    {**REGISTERS, **PATH, "variableId": text("Reverse energy summary"), "readingsValue": "o_custkey * i"})

MEASURE = ("CASE WHEN i = 3 THEN 'Energy' WHEN event_type = 'click' THEN 'Current' WHEN event_type = 'view' "
           "THEN 'Voltage' WHEN event_type = 'purchase' THEN 'Power Factor Angle' "
           "WHEN event_type = 'signup' THEN 'Frequency' END")
MEASURE_UNIT = ("CASE WHEN i = 3 THEN '' WHEN event_type = 'click' THEN 'A' WHEN event_type = 'view' THEN 'V' "
                "WHEN event_type = 'purchase' THEN '°' WHEN event_type = 'signup' THEN 'Hz' ELSE '' END")
INSTRUMENTATION = Expected(EVENTS, f"JOIN {numbers('i', 3)} ON i <= event_id % 3 + 1", values={
    **REGISTERS, **times("read_at + to_minutes(i)"), **PATH, "unitOfMeasure": MEASURE_UNIT,
    "variableId": spaced(MEASURE, "CASE WHEN (event_id + i) % 2 <> 1 THEN 'P' || i END"), "readingsValue": "value"})

STATUS_JOINS = (f"JOIN {numbers('g', 2)} ON g <= event_id % 2 + 1 "
                f"JOIN {numbers('i', 2)} ON i <= (event_id + g) % 3")
STATUS_NUMBER = "(event_id + g + i) % 4"
STATUS_NAME = "CASE WHEN (event_id + i) % 9 <> 0 THEN 'Status ' || i END"
STATUSES = Expected(EVENTS, STATUS_JOINS, f"event_id % 6 <> 0 AND {STATUS_NUMBER} <> 1", {
    **EVENT_TYPE, **times("read_at"), **LOGGED, "variableId": spaced("event_type", STATUS_NAME),
    "readingsValue": f"CASE {STATUS_NUMBER} WHEN 0 THEN '0' WHEN 3 THEN CAST(event_id % 100 AS VARCHAR) END",
    "eventsCode": "CAST(10 * g + i AS BIGINT)"})

EVENT_JOINS = (f"JOIN {numbers('g', 2)} ON g <= event_id % 3 "
               f"JOIN {numbers('v', 2)} ON v <= (event_id + g) % 2 + 1")
EVENT_TIME = "CASE WHEN (event_id + v) % 4 <> 0 THEN read_at + to_minutes(v) ELSE read_at + to_hours(1) END"
EVENT = Expected(
    EVENTS, f"{EVENT_JOINS} JOIN {numbers('a', 2)} ON a <= event_id % 2 + 1", "(event_id + v) % 5 <> 0",
    {**EVENT_TYPE, **times(EVENT_TIME), **NAMED, "variableId": "'k' || a", "readingsValue": "counter * a - 50"})

# Flag position in the schema -> precedence and codes.
FLAG_TABLE = """(VALUES
    (0, 2, '1', '4', '128', ''), (1, 4, '1', '4', '64', ''), (2, 8, '1', '2', '32', ''),
    (3, 14, '1', '4', '16', '1'), (4, 6, '1', '1', '9', ''), (5, 15, '2', '5', '256', ''),
    (6, 3, '1', '4', '3', ''), (7, 5, '1', '4', '2', ''), (8, 12, '1', '2', '32', ''),
    (9, 9, '1', '4', '1', ''), (10, 13, '1', '2', '0', ''), (11, 7, '1', '4', '4', ''),
    (12, 13, '1', '2', '0', ''), (13, 11, '1', '3', '0', ''), (14, 10, '1', '4', '5', ''),
    (15, 1, '2', '4', '9', '')) {0}(flag, rank, system, category, idx, dst)"""
INTERVAL_JOINS = (
    f"JOIN {numbers('c', 2)} ON c <= event_id % 2 + 1 JOIN {numbers('r', 3)} ON r <= (event_id + c) % 3 + 1 "
    f"LEFT JOIN {FLAG_TABLE.format('f')} ON f.flag = (event_id * 3 + c * 5 + r) % 17 "
    f"LEFT JOIN {FLAG_TABLE.format('s')} ON event_id % 3 = 0 AND s.flag = (event_id + r) % 16")


def flag_code(column: str) -> str:
    return (f"COALESCE(CASE WHEN COALESCE(f.rank, 99) <= COALESCE(s.rank, 99) THEN f.{column} "
            f"ELSE s.{column} END, '')")


QUALITY = {"qualityCodesSystemId": flag_code("system"), "qualityCodesCategorization": flag_code("category"),
           "qualityCodesIndex": flag_code("idx"), "dstStatus": flag_code("dst")}
INTERVAL = Expected(EVENTS, INTERVAL_JOINS, values={
    "readingType": text("Perfiles de carga"), **times("read_at + to_minutes(15 * r)"), **LOGGED, **QUALITY,
    "variableId": spaced("'kWh'", "CASE WHEN (event_id + c) % 11 <> 0 THEN 'Delivered' END"),
    "channel": "CAST(c AS BIGINT)", "unitOfMeasure": text("kWh"), "intervalSize": "CAST(15 * c AS BIGINT)",
    "ke": "CAST(0.01 AS DOUBLE)", "readingsValue": "value"})

# In the feed's order.
EXPECTED = {
    "MaxDemandData": MAX_DEMAND, "DemandResetCount": RESET_COUNT, "ConsumptionData": CONSUMPTION,
    "CoincidentDemandData": COINCIDENT, "CumulativeDemandData": CUMULATIVE, "DemandReset": RESET,
    "InstrumentationValue": INSTRUMENTATION, "LoadProfileSummary": LOAD_PROFILE, "OutageCountSummary": OUTAGE,
    "ReverseEnergySummary": REVERSE_ENERGY, "EventData": EVENT, "IntervalData": INTERVAL, "Statuses": STATUSES,
}


def select(documents: Documents, columns: dict[str, str], joins: str = "", where: str = "TRUE") -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {listed} FROM {documents.table} {joins} WHERE {where}"


def columns_of(kind: Expected) -> dict[str, str]:
    documents = kind.documents
    values = {"meteringType": text("Main"), "estatus": text("Activo"), **kind.values,
              "servicePointId": point(documents.meter), "deviceId": documents.meter,
              "primarySource": documents.primary}
    return {name: values.get(name, "''") for name in CANONICAL_COLUMNS}


def kind_sql(kind: Expected, only: tuple[str, ...] = CANONICAL_COLUMNS) -> str:
    columns = columns_of(kind)
    return select(kind.documents, {name: columns[name] for name in only}, kind.joins, kind.where)


def feed_columns(kind: Expected) -> dict[str, str]:
    columns = columns_of(kind)
    if kind.feed_value_as_double:
        columns["readingsValue"] = f"CAST({columns['readingsValue']} AS DOUBLE)"
    texts = {name: sql if name == "deviceId" else f"CAST({sql} AS VARCHAR)" for name, sql in columns.items()}
    multiplier = "'''MultiplierValues'':{ ''ct'': '''', ''pt'':'''', ''ke'':''' || " + texts["ke"] + " || ''', ''sf'': ''''}'"
    return {**{n: s for n, s in texts.items() if n not in MULTIPLIER_PARTS}, "multiplier": multiplier}


def canonical_text_sql(kinds: list[Expected]) -> str:
    """The thirty columns of several kinds, with the texts that the feed has."""
    branches = []
    for kind in kinds:
        feed = feed_columns(kind)
        columns = {name: feed.get(name, f"CAST({sql} AS VARCHAR)") for name, sql in columns_of(kind).items()}
        branches.append(select(kind.documents, columns, kind.joins, kind.where))
    return " UNION ALL ".join(branches)


def feed_sql(kinds: list[Expected], blank_as_null: bool = False, device_as_text: bool = False) -> str:
    branches = []
    for kind in kinds:
        columns = feed_columns(kind)
        if device_as_text:
            columns["deviceId"] = f"CAST({columns['deviceId']} AS VARCHAR)"
        if blank_as_null:
            columns = {n: s if n == "deviceId" else f"NULLIF({s}, '')" for n, s in columns.items()}
        branches.append(select(kind.documents, columns, kind.joins, kind.where))
    return " UNION ALL ".join(branches)


def documents_sql(columns, where: str = "TRUE") -> str:
    """A select over all documents; ``columns`` maps a ``Documents`` to its columns."""
    return " UNION ALL ".join(select(d, columns(d), where=where) for d in ALL_DOCUMENTS)
