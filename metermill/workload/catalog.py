"""The registered queries, each next to the SQL that gives the same rows."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metermill.functions import scalars as S
from metermill.functions.quality import quality_codes, quality_rule
from metermill.job import translate_export
from metermill.operators.sets import union_all
from metermill.operators.unnest import explode_levels, zip_explode
from metermill.plans import kinds as K
from metermill.plans.feed import feed_branches, fused_feed, unified_feed, with_multiplier
from metermill.plans.translate import translate
from metermill.schemas import document_schema
from metermill.sources.documents import read_documents
from metermill.sources.schema_files import export_schema, infer_schema, load_schema, schema_rows
from metermill.sources.sinks import working_folder, write_csv
from metermill.workload import oracle as O
from metermill.workload.documents import (event_documents, exported, long_documents, meter_documents, register_documents,
                                          reset_documents)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        ORACLE[name] = sql
        return run

    return register


def _folder(spark: SparkSession) -> str:
    return working_folder(spark)


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


# --- Sources and sinks ---------------------------------------------------------------------------

def _scan_sql(documents: O.Documents) -> dict[str, str]:
    nested = {"buckets": "''", "consumed": "''", "counts": "''", "channels": "''", "measures": "0",
              "event_groups": "0", "readings": "0"}
    if documents is O.LINES:
        value = "CAST(CAST(l_quantity AS BIGINT) * {} AS VARCHAR)".format
        nested |= {"buckets": O.chosen("l_linenumber % 4", ["", "Tier1", "Tier1,Tier2", "Tier1,Tier2,Tier3"]),
                   "consumed": f"CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN {value(1)} "
                               f"WHEN 2 THEN {value(1)} || ',' || {value(2)} "
                               f"ELSE {value(1)} || ',' || {value(2)} || ',' || {value(3)} END"}
    elif documents is O.ORDERS:
        nested |= {"counts": _COUNTS}
    else:
        nested |= {"channels": O.chosen("event_id % 2", ["1", "1,2"]), "measures": "event_id % 3 + 1",
                   "event_groups": "event_id % 3",
                   "readings": "(event_id + 1) % 3 + 1 + CASE WHEN event_id % 2 = 1 THEN (event_id + 2) % 3 + 1 ELSE 0 END"}
    nested |= {n: f"CAST({nested[n]} AS INTEGER)" for n in ("measures", "event_groups", "readings")}
    return {"irn": documents.key, "meter": documents.meter, "source": documents.source, "collected": documents.time, **nested}


_COUNTS = ("CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN CAST(o_orderkey % 100 + 1 AS VARCHAR) "
           "ELSE (o_orderkey % 100 + 1) || ',' || (o_orderkey % 100 + 2) END")
_SCAN = O.documents_sql(_scan_sql)


def _scan(documents: DataFrame) -> DataFrame:
    def joined(path: str) -> Column:
        return F.coalesce(F.array_join(F.col(path).cast("array<string>"), ","), F.lit(""))

    def size(array: Column) -> Column:
        return F.when(array.isNull(), 0).otherwise(F.size(array))

    return documents.select(
        F.col("_Irn").alias("irn"), F.col("Meter._MeterIrn").alias("meter"), F.col("_Source").alias("source"),
        F.col("_CollectionTime").alias("collected"), joined("ConsumptionData.ConsumptionSpec._TouBucket").alias("buckets"),
        joined("ConsumptionData.Reading._Value").alias("consumed"), joined("DemandResetCount._Count").alias("counts"),
        joined("IntervalData.IntervalSpec._Channel").alias("channels"),
        size(F.col("InstrumentationValue")).alias("measures"), size(F.col("EventData")).alias("event_groups"),
        size(F.flatten("IntervalData.Reading")).alias("readings"))


def _exports(spark: SparkSession, sf_dir: str) -> str:
    return exported(spark, sf_dir, "all", meter_documents)


@query("s1_xml_scan", _SCAN)
def _(spark, sf_dir):
    return _scan(read_documents(spark, _exports(spark, sf_dir)))


@query("s1_xml_scan_whole_files", _SCAN)
def _(spark, sf_dir):
    return _scan(read_documents(spark, _exports(spark, sf_dir), split_files=False))


@query("s1_xml_scan_lenient", _SCAN)
def _(spark, sf_dir):
    return _scan(read_documents(spark, _exports(spark, sf_dir), lenient=True))


@query("s2_blank_attribute", O.documents_sql(lambda d: {
    "irn": d.key, "sdp": f"CASE WHEN {d.meter} % 3 <> 0 THEN 'SDP' || {d.meter} END", "missing": f"{d.meter} % 3 = 0"}))
def _(spark, sf_dir):
    sdp = F.col("Meter._SdpIdent")
    return read_documents(spark, _exports(spark, sf_dir)).select(
        F.col("_Irn").alias("irn"), sdp.alias("sdp"), sdp.isNull().alias("missing"))


@query("s3_schema_load", _SCAN)
def _(spark, sf_dir):
    # A schema file encoded twice: a JSON string that holds the schema's JSON.
    path = _folder(spark)
    encoded = json.dumps(document_schema().json())
    spark.createDataFrame([(encoded,)], "value string").coalesce(1).write.text(path)
    return _scan(read_documents(spark, _exports(spark, sf_dir), load_schema(spark, path)))


@query("s4_schema_inference", _SCAN)
def _(spark, sf_dir):
    exports = _exports(spark, sf_dir)
    return _scan(read_documents(spark, exports, infer_schema(spark, exports, documents=10_000)))


@query("s5_schema_export", _SCAN)
def _(spark, sf_dir):
    path = _folder(spark)
    export_schema(spark, document_schema(), path)
    return _scan(read_documents(spark, _exports(spark, sf_dir), load_schema(spark, path)))


def _with_fields(spark: SparkSession, schema: T.StructType, documents: DataFrame) -> DataFrame:
    """The fields of a schema, each with the number of documents that were read with it."""
    fields = spark.createDataFrame(schema_rows(schema), "path string, type string, nullable boolean")
    return fields.withColumn("documents", F.lit(documents.count()).cast("long"))


def _fields_sql(rows: list[tuple[str, str, bool]]) -> str:
    values = ", ".join(f"('{path}', '{kind}', {nullable})" for path, kind, nullable in rows)
    counts = " + ".join(f"(SELECT count(*) FROM {table})" for table in ("lineitem", "orders", "events"))
    return f"SELECT path, type, nullable, {counts} AS documents FROM (VALUES {values}) AS fields(path, type, nullable)"


_FIELDS = _fields_sql(schema_rows(document_schema()))


@query("s3_schema_fields", _FIELDS)
def _(spark, sf_dir):
    path = _folder(spark)
    spark.createDataFrame([(json.dumps(document_schema().json()),)], "value string").coalesce(1).write.text(path)
    schema = load_schema(spark, path)
    return _with_fields(spark, schema, read_documents(spark, _exports(spark, sf_dir), schema))


#: Fields that the documents made from the test tables never have, besides texts of elements and most of the meter's.
_NEVER = {"_Initiator", "_Purpose", "_SourceIrn", "_SourceName", "EventData[].Event[]._EventInfo", "EventData[].EventSpec._Category",
          *(f"IntervalData[].IntervalSpec._Timestamp{end}" for end in ("Start", "End")),
          *(f"LoadProfileSummary[].Channel._{name}" for name in (
              "FirstIntervalTimestamp", "IntervalSeconds", "NumIntervalsRead", "ReadingRangeStartTimestamp",
              "ReadingRangeEndTimestamp"))}


def _is_written(path: str) -> bool:
    child, last = path.split(".")[0].removesuffix("[]"), path.rpartition(".")[2]
    if child == "Meter":
        return last in ("Meter", "_MeterIrn", "_SdpIdent")
    return path not in _NEVER and last != "_valueTag" and child not in ("Clock", "ReadingQualityIndicator")


@query("s4_schema_fields", _fields_sql([row for row in schema_rows(document_schema()) if _is_written(row[0])]))
def _(spark, sf_dir):
    exports = _exports(spark, sf_dir)
    schema = infer_schema(spark, exports, documents=10_000)
    return _with_fields(spark, schema, read_documents(spark, exports, schema))


@query("s5_schema_fields", _FIELDS)
def _(spark, sf_dir):
    path = _folder(spark)
    export_schema(spark, document_schema(), path)
    schema = load_schema(spark, path)
    return _with_fields(spark, schema, read_documents(spark, _exports(spark, sf_dir), schema))


def _kind_csv(spark: SparkSession, path: str, written: DataFrame) -> DataFrame:
    """A kind's CSV directory, read back with the types that were written."""
    return spark.read.option("header", True).schema(written.schema).csv(path)


def _blank_as_null(columns: dict[str, str]) -> dict[str, str]:
    return {n: s if n == "deviceId" else f"NULLIF(CAST({s} AS VARCHAR), '')" for n, s in columns.items()}


def _kind_csv_sql(name: str, kind: O.Expected) -> str:
    return O.select(kind.documents, {"kind": f"'{name}'", **_blank_as_null(O.columns_of(kind))}, kind.joins, kind.where)


def _tagged(kind: str, readings: DataFrame) -> DataFrame:
    texts = [F.col(n) if n == "deviceId" else F.col(n).cast("string").alias(n) for n in readings.columns]
    return readings.select(F.lit(kind).alias("kind"), *texts)


@query("s6_csv_kind", _kind_csv_sql("MaxDemandData", O.MAX_DEMAND))
def _(spark, sf_dir):
    path, readings = _folder(spark), translate(register_documents(spark, sf_dir), K.MAX_DEMAND)
    write_csv(readings, path)
    return _tagged("MaxDemandData", _kind_csv(spark, path, readings))


@query("job_export_to_kind_csv", " UNION ALL ".join(
    _kind_csv_sql(name, kind) for name, kind in O.EXPECTED.items() if K.kind_named(name).written))
def _(spark, sf_dir):
    documents = meter_documents(spark, sf_dir)
    written = translate_export(spark, _exports(spark, sf_dir), _folder(spark), compression="gzip")
    return union_all([_tagged(name, _kind_csv(spark, path, translate(documents, K.kind_named(name))))
                      for name, path in written.kinds.items()])


@query("s7_csv_feed", O.feed_sql(list(O.EXPECTED.values()), blank_as_null=True))
def _(spark, sf_dir):
    path = _folder(spark)
    write_csv(unified_feed(meter_documents(spark, sf_dir)), path, compression="gzip")
    return _read_csv(spark, path).withColumn("deviceId", F.col("deviceId").cast("long"))


@query("s8_event_sink", O.kind_sql(O.EVENT, ("servicePointId", "deviceId", "variableId", "readingsValue", "owner")))
def _(spark, sf_dir):
    written = translate_export(spark, _exports(spark, sf_dir), _folder(spark), kinds=[K.EVENT],
                               write_events=True, compression="gzip")
    return _read_csv(spark, written.kinds["EventData"]).select(
        "servicePointId", F.col("deviceId").cast("long"), "variableId", F.col("readingsValue").cast("long"), "owner")


# --- Projections ---------------------------------------------------------------------------------

@query("p1_document_columns", O.documents_sql(lambda d: {
    "MeterReadings_Irn": d.key, "MeterReadings_Source": d.source, "MeterReadings_CollectionTime": d.time}))
def _(spark, sf_dir):
    return meter_documents(spark, sf_dir).select(
        F.col("_Irn").alias("MeterReadings_Irn"), F.col("_Source").alias("MeterReadings_Source"),
        F.col("_CollectionTime").alias("MeterReadings_CollectionTime"))


@query("p2_struct_fields", O.documents_sql(lambda d: {
    "Meter_MeterIrn": d.meter, "Meter_SdpIdent": f"CASE WHEN {d.meter} % 3 <> 0 THEN 'SDP' || {d.meter} END"}))
def _(spark, sf_dir):
    return meter_documents(spark, sf_dir).select(
        F.col("Meter._MeterIrn").alias("Meter_MeterIrn"), F.col("Meter._SdpIdent").alias("Meter_SdpIdent"))


@query("p3_array_field", O.select(O.ORDERS, {
    "irn": "o_orderkey",
    "counts": _COUNTS}))
def _(spark, sf_dir):
    counts = F.col("DemandResetCount._Count").cast("array<string>")
    return reset_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), F.array_join(counts, ",").alias("counts"))


@query("p4_nested_array_field", O.select(O.LINES, {
    "irn": "l_orderkey", "buckets": O.chosen("l_linenumber % 4", ["", "Tier1", "Tier1,Tier2", "Tier1,Tier2,Tier3"])}))
def _(spark, sf_dir):
    buckets = F.col("ConsumptionData.ConsumptionSpec._TouBucket")
    return register_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), F.array_join(buckets, ",").alias("buckets"))


@query("p5_case_insensitive_field", O.select(O.EVENTS, {"irn": "event_id", "first_time": "read_at + to_minutes(1)"}))
def _(spark, sf_dir):
    # The field is _Timestamp.
    return event_documents(spark, sf_dir).select(
        F.col("_Irn").alias("irn"), F.get(F.col("InstrumentationValue._TimeStamp"), F.lit(0)).alias("first_time"))


_CONSTANT_COLUMNS = ("deviceId", "readingType", "variableId", "meteringType", "readingUtcLocalTime", "dstStatus",
                     "channel", "ct", "pt", "sf", "version", "owner", "guidFile", "estatus", "registersNumber",
                     "agentId", "agentDescription")


@query("p6_constant_columns", O.kind_sql(O.RESET, _CONSTANT_COLUMNS))
def _(spark, sf_dir):
    return translate(reset_documents(spark, sf_dir), K.DEMAND_RESET).select(*_CONSTANT_COLUMNS)


@query("p7_narrowing_select", O.kind_sql(O.MAX_DEMAND, ("deviceId", "readingLocalTime", "readingsValue")))
def _(spark, sf_dir):
    return translate(meter_documents(spark, sf_dir), K.MAX_DEMAND).select("deviceId", "readingLocalTime", "readingsValue")


@query("p8_canonical_select", O.canonical_text_sql(list(O.EXPECTED.values())))
def _(spark, sf_dir):
    documents = meter_documents(spark, sf_dir)
    return union_all(feed_branches([translate(documents, k) for k in K.KINDS]))


@query("p9_column_overwrite", O.select(O.LINES, {"irn": "l_orderkey", "unit": O.CONSUMED.format("°")}, O.LINE_JOINS))
def _(spark, sf_dir):
    documents = register_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "ConsumptionData")
    rows, (element,) = explode_levels(documents, "ConsumptionData")
    rows = rows.select("irn", element["ConsumptionSpec"]["_UOM"].alias("unit"))
    return rows.withColumn("unit", S.consumption_unit(F.col("unit")))


@query("p10_column_drop", O.feed_sql([O.LOAD_PROFILE]))
def _(spark, sf_dir):
    readings = translate(reset_documents(spark, sf_dir), K.LOAD_PROFILE)
    return with_multiplier(*feed_branches([readings]))


# --- Filters -------------------------------------------------------------------------------------

def _max_demand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = register_documents(spark, sf_dir).select("_Irn", "_CollectionTime", "MaxDemandData")
    rows, (element,) = explode_levels(documents, "MaxDemandData")
    return rows.select(F.col("_Irn").alias("irn"), "_CollectionTime", element["Reading"]["_TimeStamp"].alias("own_time"))


@query("f1_null_test", O.select(O.LINES, {"irn": "l_orderkey", "missing": "i % 2 = 1"}, O.LINE_JOINS, O.MAX_DEMAND.where))
def _(spark, sf_dir):
    return _max_demand_rows(spark, sf_dir).select("irn", F.col("own_time").isNull().alias("missing"))


@query("f2_equality", O.select(O.ORDERS, {
    "irn": "o_orderkey", "is_times": f"CASE WHEN {O.RESET_COUNT_UNIT.format('Times')} = 'Times' THEN 1 ELSE 0 END"},
    O.RESET_COUNT.joins))
def _(spark, sf_dir):
    documents = reset_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "DemandResetCount")
    rows, (element,) = explode_levels(documents, "DemandResetCount")
    return rows.select("irn", F.when(element["_UOM"] == "Times", 1).otherwise(0).alias("is_times"))


def _status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = event_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "_CollectionTime", "Statuses")
    rows, (_group, status) = explode_levels(documents, "Statuses", K.STATUSES.steps)
    return rows.select("irn", "_CollectionTime", status["_Id"].alias("id"), status["_Category"].alias("category"),
                       status["_Name"].alias("name"), status["_Value"].alias("value"))


_STATUS_RAW = (f"CASE {O.STATUS_NUMBER} WHEN 0 THEN 'true' WHEN 1 THEN 'false' "
               "WHEN 3 THEN CAST(event_id % 100 AS VARCHAR) END")


@query("f3_status_filter", O.select(O.EVENTS, {"irn": "event_id", "id": "10 * g + i", "value": _STATUS_RAW},
                                    O.STATUS_JOINS, O.STATUSES.where))
def _(spark, sf_dir):
    rows = _status_rows(spark, sf_dir).select("irn", "id", "value")
    return rows.filter(S.is_reported_status(F.col("value")))


@query("f4_empty_parents", O.select(O.ORDERS, {"irn": "o_orderkey", "at": O.RESET_TIME}, O.RESET.joins))
def _(spark, sf_dir):
    documents = reset_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "DemandReset")
    rows, (element,) = explode_levels(documents, "DemandReset")
    return rows.select("irn", element["_TimeStamp"].alias("at"))


@query("f5_skip_empty_kinds", O.feed_sql([O.MAX_DEMAND, O.CONSUMPTION, O.COINCIDENT, O.CUMULATIVE]))
def _(spark, sf_dir):
    # Register meters hold no status and no interval; their kinds are left out of the union.
    documents = meter_documents(spark, sf_dir).filter(F.col("ConsumptionData").isNotNull())
    kinds = [k for k in K.KINDS if not (k.skipped_when_empty and translate(documents, k).isEmpty())]
    return unified_feed(documents, kinds)


@query("f6_missing_family", O.select(O.EVENTS, {"irn": "event_id", "statuses": "(event_id + g) % 3"},
                                     f"JOIN {O.numbers('g', 2)} ON g <= event_id % 2 + 1", "event_id % 6 <> 0"))
def _(spark, sf_dir):
    documents = event_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "Statuses")
    rows, (group,) = explode_levels(documents, "Statuses")
    return rows.select("irn", F.size(group["Status"]).alias("statuses"))


# --- Generators ----------------------------------------------------------------------------------

@query("a1_zip_explode_six", O.select(O.LINES, {
    "irn": "l_orderkey", "bucket": "'Tier' || i", "direction": "l_linestatus", "unit": O.CONSUMED.format("Degree"),
    "value": "CAST(l_quantity AS BIGINT) * i", "multiplier": O.LINE_KE, "at": O.LINE_TIME}, O.LINE_JOINS))
def _(spark, sf_dir):
    spec, reading = "ConsumptionData.ConsumptionSpec", "ConsumptionData.Reading"
    arrays = register_documents(spark, sf_dir).select(
        F.col("_Irn").alias("irn"), F.col(f"{spec}._TouBucket").alias("bucket"),
        F.col(f"{spec}._Direction").alias("direction"), F.col(f"{spec}._UOM").alias("unit"),
        F.col(f"{reading}._Value").alias("value"), F.col(f"{spec}._Multiplier").alias("multiplier"),
        F.col(f"{reading}._TimeStamp").alias("at"))
    names = ["bucket", "direction", "unit", "value", "multiplier", "at"]
    return zip_explode(arrays, names).select("irn", "zipped.*")


@query("a2_zip_explode", O.select(O.ORDERS, {
    "irn": "o_orderkey", "count": "o_orderkey % 100 + i", "at": O.RESET_COUNT_TIME,
    "unit": O.RESET_COUNT_UNIT.format("Times")}, O.RESET_COUNT.joins))
def _(spark, sf_dir):
    arrays = reset_documents(spark, sf_dir).select(
        F.col("_Irn").alias("irn"), F.col("DemandResetCount._Count").alias("count"),
        F.col("DemandResetCount._TimeStamp").alias("at"), F.col("DemandResetCount._UOM").alias("unit"))
    return zip_explode(arrays, ["count", "at", "unit"]).select("irn", "zipped.*")


@query("a3_zip_single", O.select(O.ORDERS, {"irn": "o_orderkey", "at": O.RESET_TIME}, O.RESET.joins))
def _(spark, sf_dir):
    arrays = reset_documents(spark, sf_dir).select(
        F.col("_Irn").alias("irn"), F.col("DemandReset._TimeStamp").alias("at"))
    return zip_explode(arrays, ["at"]).select("irn", "zipped.*")


@query("a4_double_explode", O.select(O.EVENTS, {
    "irn": "event_id", "at": "CASE WHEN (event_id + v) % 4 <> 0 THEN read_at + to_minutes(v) END",
    "discovered": "read_at + to_hours(1)"}, O.EVENT_JOINS))
def _(spark, sf_dir):
    documents = event_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "EventData")
    rows, (_group, event) = explode_levels(documents, "EventData", K.EVENT.steps[:1])
    return rows.select("irn", event["_TimeStamp"].alias("at"), event["_DiscoveredAt"].alias("discovered"))


@query("a5_attribute_unnest", O.select(O.EVENTS, {"irn": "event_id", "name": "'k' || a", "value": "counter * a - 50"},
                                       O.EVENT.joins, O.EVENT.where))
def _(spark, sf_dir):
    documents = event_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "EventData")
    rows, (_group, _event, attribute) = explode_levels(documents, "EventData", K.EVENT.steps)
    return rows.select("irn", attribute["_Name"].alias("name"), attribute["_Value"].alias("value"))


@query("a6_status_unnest", O.select(O.EVENTS, {
    "irn": "event_id", "id": "10 * g + i", "category": "event_type", "name": O.STATUS_NAME, "value": _STATUS_RAW},
    O.STATUS_JOINS, "event_id % 6 <> 0"))
def _(spark, sf_dir):
    return _status_rows(spark, sf_dir).drop("_CollectionTime")


def _interval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = event_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "IntervalData")
    rows, (about, reading) = explode_levels(documents, "IntervalData", K.INTERVAL.steps)
    return rows.select("irn", about["IntervalSpec"].alias("spec"), reading.alias("reading"))


@query("a7_interval_unnest", O.select(O.EVENTS, {
    "irn": "event_id", "channel": "c", "direction": "CASE WHEN (event_id + c) % 11 <> 0 THEN 'Delivered' END",
    "at": "read_at + to_minutes(15 * r)", "value": "value"}, O.INTERVAL_JOINS))
def _(spark, sf_dir):
    return _interval_rows(spark, sf_dir).select(
        "irn", F.col("spec._Channel").alias("channel"), F.col("spec._Direction").alias("direction"),
        F.col("reading._TimeStamp").alias("at"), F.col("reading._RawReading").alias("value"))


@query("a8_exploded_struct_fields", O.select(O.ORDERS, {
    "irn": "o_orderkey", "now": O.OUTAGE_TIME, "before": O.OUTAGE_BEFORE, "value": "o_orderkey % 50",
    "value_before": "o_orderkey % 50 - 1"}, O.OUTAGE_NOW.joins))
def _(spark, sf_dir):
    documents = reset_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "OutageCountSummary")
    rows, (_element,) = explode_levels(documents, "OutageCountSummary")
    outage = "element0.OutageCount"
    return rows.select("irn", F.col(f"{outage}._ReadingTime").alias("now"),
                       F.col(f"{outage}._PreviousReadingTime").alias("before"), F.col(f"{outage}._Value").alias("value"),
                       F.col(f"{outage}._PreviousValue").alias("value_before"))


# --- Scalars -------------------------------------------------------------------------------------

@query("c1_source", O.documents_sql(lambda d: {"irn": d.key, "source": d.source, "primary_source": d.primary}))
def _(spark, sf_dir):
    return meter_documents(spark, sf_dir).select(
        F.col("_Irn").alias("irn"), F.col("_Source").alias("source"),
        S.primary_source(F.col("_Source")).alias("primary_source"))


@query("c2_service_point", O.documents_sql(lambda d: {"irn": d.key, "service_point": O.point(d.meter)}))
def _(spark, sf_dir):
    return meter_documents(spark, sf_dir).select(
        F.col("_Irn").alias("irn"),
        S.service_point(F.col("Meter._SdpIdent"), F.col("Meter._MeterIrn")).alias("service_point"))


@query("c3_time_fallback", O.select(O.LINES, {"irn": "l_orderkey", "at": f"COALESCE({O.LINE_TIME}, l_shipdate)"},
                                    O.LINE_JOINS, O.MAX_DEMAND.where))
def _(spark, sf_dir):
    return _max_demand_rows(spark, sf_dir).select(
        "irn", S.first_time(F.col("own_time"), F.col("_CollectionTime")).alias("at"))


@query("c4_event_time", O.select(O.EVENTS, {"irn": "event_id", "at": O.EVENT_TIME}, O.EVENT_JOINS))
def _(spark, sf_dir):
    documents = event_documents(spark, sf_dir).select(F.col("_Irn").alias("irn"), "EventData")
    rows, (_group, event) = explode_levels(documents, "EventData", K.EVENT.steps[:1])
    return rows.select("irn", S.first_time(event["_TimeStamp"], event["_DiscoveredAt"]).alias("at"))


@query("c5_document_time", O.kind_sql(O.STATUSES, ("deviceId", "readingLocalTime", "readingDateSource")))
def _(spark, sf_dir):
    return translate(event_documents(spark, sf_dir), K.STATUSES).select(
        "deviceId", "readingLocalTime", "readingDateSource")


@query("c6_reset_unit", O.kind_sql(O.RESET_COUNT, ("deviceId", "unitOfMeasure")))
def _(spark, sf_dir):
    return translate(reset_documents(spark, sf_dir), K.DEMAND_RESET_COUNT).select("deviceId", "unitOfMeasure")


@query("c7_consumption_unit", O.kind_sql(O.CONSUMPTION, ("deviceId", "variableId", "unitOfMeasure")))
def _(spark, sf_dir):
    return translate(register_documents(spark, sf_dir), K.CONSUMPTION).select("deviceId", "variableId", "unitOfMeasure")


@query("c8_measure_unit", O.select(O.EVENTS, {"name": O.MEASURE, "unit": O.MEASURE_UNIT}, O.INSTRUMENTATION.joins))
def _(spark, sf_dir):
    rows, (element,) = explode_levels(event_documents(spark, sf_dir).select("InstrumentationValue"), "InstrumentationValue")
    return rows.select(element["_Name"].alias("name"), S.measure_unit(element["_Name"]).alias("unit"))


@query("c9_status_value", O.select(O.EVENTS, {
    "irn": "event_id", "value": _STATUS_RAW,
    "translated": f"CASE WHEN {_STATUS_RAW} = 'true' THEN '0' ELSE {_STATUS_RAW} END"},
    O.STATUS_JOINS, "event_id % 6 <> 0"))
def _(spark, sf_dir):
    return _status_rows(spark, sf_dir).select("irn", "value", S.status_value(F.col("value")).alias("translated"))


_QUALITY_COLUMNS = ("qualityCodesSystemId", "qualityCodesCategorization", "qualityCodesIndex")


@query("c10_quality", O.select(O.EVENTS, {"irn": "event_id", **{n: O.QUALITY[n] for n in _QUALITY_COLUMNS}},
                               O.INTERVAL_JOINS))
def _(spark, sf_dir):
    rows = _interval_rows(spark, sf_dir).select("irn", quality_rule(F.col("reading.QualityFlags")).alias("rule"))
    codes = quality_codes(F.col("rule"))
    return rows.select("irn", *[codes[n].alias(n) for n in _QUALITY_COLUMNS])


@query("c11_dst_status", O.select(O.EVENTS, {"irn": "event_id", "dst": O.QUALITY["dstStatus"]}, O.INTERVAL_JOINS))
def _(spark, sf_dir):
    rule = quality_rule(F.col("reading.QualityFlags"))
    return _interval_rows(spark, sf_dir).select("irn", quality_codes(rule)["dstStatus"].alias("dst"))


@query("c12_variable_three_parts", O.kind_sql(O.COINCIDENT, ("deviceId", "variableId")))
def _(spark, sf_dir):
    return translate(register_documents(spark, sf_dir), K.COINCIDENT_DEMAND).select("deviceId", "variableId")


@query("c13_variable_two_parts", O.kind_sql(O.INSTRUMENTATION, ("deviceId", "variableId")))
def _(spark, sf_dir):
    return translate(event_documents(spark, sf_dir), K.INSTRUMENTATION).select("deviceId", "variableId")


@query("c14_variable_missing_part", O.kind_sql(O.STATUSES, ("deviceId", "variableId"))
       + " UNION ALL " + O.kind_sql(O.INTERVAL, ("deviceId", "variableId")))
def _(spark, sf_dir):
    documents = event_documents(spark, sf_dir)
    return union_all([translate(documents, k).select("deviceId", "variableId") for k in (K.STATUSES, K.INTERVAL)])


@query("c15_multiplier_text", " UNION ALL ".join(
    O.select(k.documents, {n: O.feed_columns(k)[n] for n in ("deviceId", "multiplier")}, k.joins, k.where)
    for k in O.EXPECTED.values()))
def _(spark, sf_dir):
    return unified_feed(meter_documents(spark, sf_dir)).select("deviceId", "multiplier")


_TEXT_COLUMNS = ("deviceId", "readingLocalTime", "channel", "intervalSize", "readingsValue", "eventsCode")


def _text_sql(kinds: list[O.Expected]) -> str:
    return " UNION ALL ".join(O.select(k.documents, {n: O.feed_columns(k)[n] for n in _TEXT_COLUMNS}, k.joins, k.where)
                              for k in kinds)


@query("c16_text_casts", _text_sql(list(O.EXPECTED.values())))
def _(spark, sf_dir):
    documents = meter_documents(spark, sf_dir)
    return union_all([one.select(*_TEXT_COLUMNS) for one in feed_branches([translate(documents, k) for k in K.KINDS])])


# --- Set operators -------------------------------------------------------------------------------

CURRENT_OUTAGES = replace(K.OUTAGE_COUNT, steps=(K.current_outage_times,))
PREVIOUS_OUTAGES = replace(K.OUTAGE_COUNT, steps=(K.previous_outage_times,))


@query("u1_two_branch_union", O.kind_sql(O.OUTAGE_NOW) + " UNION ALL " + O.kind_sql(O.OUTAGE_PREVIOUS))
def _(spark, sf_dir):
    documents = reset_documents(spark, sf_dir)
    return translate(documents, CURRENT_OUTAGES).union(translate(documents, PREVIOUS_OUTAGES))


_UNITED = ("deviceId", "readingType", "variableId", "unitOfMeasure", "primarySource", "owner")


@query("u2_union_all", " UNION ALL ".join(O.kind_sql(k, _UNITED) for k in O.EXPECTED.values()))
def _(spark, sf_dir):
    # Columns of one type in all kinds, so that nothing but the union is at work.
    documents = meter_documents(spark, sf_dir)
    return union_all([translate(documents, k).select(*_UNITED) for k in K.KINDS])


def _widened_sql(order: list[O.Expected], whole: set[str]) -> str:
    """The texts of a union in another order: whole numbers that no double comes before a text stay whole."""
    return _text_sql([replace(k, feed_value_as_double=name not in whole and k.feed_value_as_double)
                      for name, k in ((n, k) for k in order for n, own in O.EXPECTED.items() if own is k)])


@query("u3_widening_texts_first", _widened_sql([O.CONSUMPTION, O.RESET, O.RESET_COUNT, O.MAX_DEMAND],
                                               {"ConsumptionData", "DemandResetCount"}))
def _(spark, sf_dir):
    # A reset's value is a text: consumption and counts meet it before any double.
    kinds = (K.CONSUMPTION, K.DEMAND_RESET, K.DEMAND_RESET_COUNT, K.MAX_DEMAND)
    return unified_feed(meter_documents(spark, sf_dir), kinds).select(*_TEXT_COLUMNS)


@query("u3_widening_fused", _widened_sql([O.RESET_COUNT, O.STATUSES, O.CONSUMPTION, O.INTERVAL],
                                         {"ConsumptionData", "DemandResetCount"}))
def _(spark, sf_dir):
    kinds = (K.DEMAND_RESET_COUNT, K.STATUSES, K.CONSUMPTION, K.INTERVAL)
    return fused_feed(meter_documents(spark, sf_dir), kinds).select(*_TEXT_COLUMNS)


@query("u3_type_widening", _text_sql(list(O.EXPECTED.values())))
def _(spark, sf_dir):
    return unified_feed(meter_documents(spark, sf_dir)).select(*_TEXT_COLUMNS)


# --- Reading kinds and the feed ------------------------------------------------------------------

def _kind_query(kind: K.ReadingKind) -> Query:
    return lambda spark, sf_dir: translate(meter_documents(spark, sf_dir), kind)


_KIND_KEYS = {
    "k1_max_demand": (K.MAX_DEMAND, O.MAX_DEMAND),
    "k2_demand_reset_count": (K.DEMAND_RESET_COUNT, O.RESET_COUNT),
    "k3_consumption": (K.CONSUMPTION, O.CONSUMPTION),
    "k4_coincident_demand": (K.COINCIDENT_DEMAND, O.COINCIDENT),
    "k5_cumulative_demand": (K.CUMULATIVE_DEMAND, O.CUMULATIVE),
    "k6_demand_reset": (K.DEMAND_RESET, O.RESET),
    "k7_instrumentation": (K.INSTRUMENTATION, O.INSTRUMENTATION),
    "k8_statuses": (K.STATUSES, O.STATUSES),
    "k9_load_profile": (K.LOAD_PROFILE, O.LOAD_PROFILE),
    "k10_outage_count": (K.OUTAGE_COUNT, O.OUTAGE),
    "k10a_outage_current": (CURRENT_OUTAGES, O.OUTAGE_NOW),
    "k10b_outage_previous": (PREVIOUS_OUTAGES, O.OUTAGE_PREVIOUS),
    "k11_reverse_energy": (K.REVERSE_ENERGY, O.REVERSE_ENERGY),
    "k12_events": (K.EVENT, O.EVENT),
    "k13_intervals": (K.INTERVAL, O.INTERVAL),
}
for _name, (_kind, _expected) in _KIND_KEYS.items():
    query(_name, O.kind_sql(_expected))(_kind_query(_kind))

_FEED = O.feed_sql(list(O.EXPECTED.values()))


@query("k14_feed", _FEED)
def feed(spark, sf_dir):
    return unified_feed(meter_documents(spark, sf_dir))


@query("k14_feed_fused", _FEED)
def _(spark, sf_dir):
    return fused_feed(meter_documents(spark, sf_dir))


@query("k14_feed_fused_from_xml", _FEED)
def _(spark, sf_dir):
    return fused_feed(read_documents(spark, _exports(spark, sf_dir), kinds=K.KINDS))


@query("job_export_to_feed_csv", O.feed_sql(list(O.EXPECTED.values()), blank_as_null=True))
def _(spark, sf_dir):
    written = translate_export(spark, _exports(spark, sf_dir), _folder(spark), compression="gzip")
    return _read_csv(spark, written.feed).withColumn("deviceId", F.col("deviceId").cast("long"))


def _long_sql(name: str, columns: dict[str, str], per_document: int) -> str:
    meter = "CAST(s_suppkey AS BIGINT)"
    values = {"kind": f"'{name}'", "deviceId": meter, "primarySource": "'Visual'", **columns}
    listed = ", ".join(f"{sql} AS {column}" for column, sql in values.items())
    return f"SELECT {listed} FROM supplier, (SELECT unnest(range({per_document})) AS n)"


@query("job_oversized_documents", " UNION ALL ".join((
    _long_sql("IntervalData", {"variableId": "'kWh Delivered'", "readingsValue": "CAST((s_suppkey * 7 + n) % 1000 AS VARCHAR) || '.5'"}, 2500),
    _long_sql("EventData", {"variableId": "'k' || n % 3", "readingsValue": "CAST(s_suppkey + n AS VARCHAR)"}, 300),
    _long_sql("DemandReset", {"variableId": "'Demand Reset'", "readingsValue": "'0'"}, 200))))
def _(spark, sf_dir):
    # Documents of some 300 KB each, which the job is told to cut from 100 KB on.
    exports = exported(spark, sf_dir, "long", long_documents, documents_per_file=200)
    kinds = (K.DEMAND_RESET, K.EVENT, K.INTERVAL)
    written = translate_export(spark, exports, _folder(spark), kinds=kinds, write_events=True, whole_bytes=100_000,
                               compression="gzip")
    return union_all([_read_csv(spark, path).select(
        F.lit(name).alias("kind"), F.col("deviceId").cast("long"), "primarySource", "variableId", "readingsValue")
        for name, path in written.kinds.items()])


@query("q7_owner_and_guid", O.select(O.LINES, {"deviceId": "l_suppkey", "owner": "'utility'", "guidFile": "'run 7'"},
                                     O.MAX_DEMAND.joins, O.MAX_DEMAND.where))
def _(spark, sf_dir):
    readings = translate(register_documents(spark, sf_dir), K.MAX_DEMAND, owner="utility", guid_file=F.lit("run 7"))
    return readings.select("deviceId", "owner", "guidFile")
