"""Reading exports: splits, comments, encodings, bad values, schemas."""

import json
import random

import pytest
from exports import write_exports
from pyspark.sql import functions as F

from metermill import document_schema, kind_named, read_documents
from metermill.sources.documents import document_texts, schema_for, write_documents
from metermill.sources.schema_files import export_schema, infer_schema, load_schema, schema_rows
from metermill.workload.documents import event_documents

HEAD = '<?xml version="1.0"?><AMRDEF>'


def export(tmp_path, body, head=HEAD, encoding="utf-8"):
    path = tmp_path / "export.xml"
    path.write_text(head + body + "</AMRDEF>", encoding=encoding)
    return str(path)


def document(irn, inside=""):
    return f'<MeterReadings Irn="{irn}"><Meter MeterIrn="{irn}"/>{inside}</MeterReadings>'


def irns(documents):
    return sorted(r._Irn for r in documents.select("_Irn").collect())


def test_one_file_is_read_in_many_splits(spark, tmp_path):
    path = export(tmp_path, "\r".join(document(n, f'<DemandReset TimeStamp="2020-01-01 00:00:{n % 60:02d}"/>')
                                      for n in range(2000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        documents = read_documents(spark, path)
        assert documents.rdd.getNumPartitions() > 10
        assert irns(documents) == list(range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_documents_without_content_and_comments(spark, tmp_path):
    body = ('<MeterReadings Irn="1"/><MeterReadings Irn="2" Source="a>b" />' + document(3)
            + "<!-- " + "<MeterReadings Irn='9'/> -->" + document(4, "<!-- inside --><Clock/>")
            + '<MeterReadings Irn="5"></MeterReadings\n><MeterReadings Irn="6"/>')
    path = export(tmp_path, body)
    assert irns(read_documents(spark, path)) == irns(read_documents(spark, path, split_files=False)) == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("body, why", [
    (document(1) + "<!-- " + document(2) + document(3) + " -->" + document(4), "comment spans documents"),
    (document(1, "<Clock><![CDATA[</MeterReadings>]]></Clock>"), "CDATA"),
])
def test_hidden_tags_fail_the_split_read(spark, tmp_path, body, why):
    path = export(tmp_path, body)
    with pytest.raises(Exception, match=why):
        read_documents(spark, path).collect()
    assert 1 in irns(read_documents(spark, path, split_files=False))


@pytest.mark.parametrize("encoding", ["iso-8859-1", "utf-16"])
def test_other_encodings_fail_the_split_read(spark, tmp_path, encoding):
    path = export(tmp_path, document(1), f'<?xml version="1.0" encoding="{encoding}"?><AMRDEF>', encoding)
    with pytest.raises(Exception, match="UTF-8"):
        read_documents(spark, path).collect()


def test_bad_values(spark, tmp_path):
    path = export(tmp_path, document(1, '<DemandResetCount Count="x" UOM="Times" TimeStamp="never"/>'
                                        '<DemandResetCount Count="2" UOM="Times"/>'))
    for split in (True, False):
        with pytest.raises(Exception):
            read_documents(spark, path, split_files=split).collect()
        (row,) = read_documents(spark, path, split_files=split, lenient=True).collect()
        assert [(c._Count, c._UOM, c._TimeStamp) for c in row.DemandResetCount] == [(None, "Times", None), (2, "Times", None)]


def test_file_name(spark, tmp_path):
    path = export(tmp_path, document(1))
    for split in (True, False):
        (row,) = read_documents(spark, path, split_files=split, file_name=True).collect()
        assert row._FileName == "export.xml"


def test_schema_round_trip(spark, tmp_path):
    schema = document_schema()
    export_schema(spark, schema, str(tmp_path / "raw"))
    assert load_schema(spark, str(tmp_path / "raw")) == schema
    twice = tmp_path / "twice.json"
    twice.write_text(json.dumps(schema.json()))
    assert load_schema(spark, str(twice)) == schema
    pretty = tmp_path / "pretty.json"
    pretty.write_text(json.dumps(json.loads(schema.json()), indent=2))
    assert load_schema(spark, str(pretty)) == schema


def test_inferred_schema_has_the_sample_types(spark, tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    inferred = infer_schema(spark, write_exports(folder))
    declared = document_schema()
    for name in ("DemandReset", "EventData", "InstrumentationValue", "MaxDemandData", "_CollectionTime", "_Irn"):
        assert inferred[name].dataType.typeName() == declared[name].dataType.typeName(), name
    interval = inferred["IntervalData"].dataType
    interval = getattr(interval, "elementType", interval)
    flags = interval["Reading"].dataType.elementType["QualityFlags"].dataType
    assert set(flags.names) - {"_valueTag"} == set(
        declared["IntervalData"].dataType.elementType["Reading"].dataType.elementType["QualityFlags"].dataType.names
    ) - {"_valueTag"}


def test_inference_from_a_sample_of_documents(spark, tmp_path):
    write_exports(tmp_path)
    assert infer_schema(spark, str(tmp_path), documents=1000) == infer_schema(spark, str(tmp_path))
    (tmp_path / "more").mkdir()
    for n in range(3):
        text = "\n".join(document(k, f'<DemandResetCount Count="{k}"/>' * (k % 3) + (f'<Own A="{k}.5"/>' if k % 50 == 7 else ""))
                         for k in range(100 * n, 100 * n + 100))
        (tmp_path / "more" / f"{n}.xml").write_text(f"<AMRDEF>{text}</AMRDEF>")
    path = str(tmp_path / "more")
    assert infer_schema(spark, path, documents=300) == infer_schema(spark, path)
    # A smaller sample is that of the documents taken, wherever they are.
    taken = document_texts(spark, path).orderBy(F.xxhash64("text")).limit(12).collect()
    (tmp_path / "taken.xml").write_text("<AMRDEF>" + "".join(row.text for row in taken) + "</AMRDEF>")
    assert infer_schema(spark, path, documents=12) == infer_schema(spark, str(tmp_path / "taken.xml"))
    (tmp_path / "none.xml").write_text("<AMRDEF></AMRDEF>")
    assert infer_schema(spark, str(tmp_path / "none.xml"), documents=5).fields == []


def test_schema_rows():
    rows = {path: (kind, nullable) for path, kind, nullable in schema_rows(document_schema())}
    assert rows["_Irn"] == ("long", True) and rows["IntervalData"] == ("array", True)
    assert rows["IntervalData[].Reading[].QualityFlags._DST"] == ("long", True) and rows["Meter._SdpIdent"][0] == "string"
    assert len(rows) == len(schema_rows(document_schema())) and "Meter[]" not in rows


def test_schema_for_kinds():
    narrow = schema_for([kind_named("DemandReset")])
    assert set(narrow.names) == {"Meter", "_CollectionTime", "_Source", "DemandReset"}
    assert narrow["Meter"].dataType.names == ["_MeterIrn", "_SdpIdent"]
    assert narrow["DemandReset"].dataType.elementType.names == ["_TimeStamp"]


def test_written_documents_read_back(spark, tmp_path):
    documents = event_documents(spark, "/root/testdata/sf0.001")
    write_documents(documents, str(tmp_path / "out"))
    back = read_documents(spark, str(tmp_path / "out"))
    columns = ["_Irn", "_CollectionTime", "_Source", "InstrumentationValue._Value", "InstrumentationValue._Timestamp"]
    assert sorted(map(repr, back.select(*columns).collect())) == sorted(map(repr, documents.select(*columns).collect()))


def random_export(rng) -> str:
    """Documents in all the forms XML allows, with comments and white space between and inside them."""
    comments = ["", "", "<!-- plain -->", "<!-- <MeterReadings Irn='-1'/> -->", "<!-- > ' \" -->", "<?note x?>"]
    spaces = ["", "\r", "\n\n", " \t "]

    def gap():
        return rng.choice(spaces) + rng.choice(comments) + rng.choice(spaces)

    def one():
        quote = rng.choice("'\"")
        attributes = f" Irn={quote}{rng.randrange(1000)}{quote} Source={quote}a&gt;b > c/{quote}"
        if rng.random() < 0.3:
            return f"<MeterReadings{attributes}{rng.choice(['', ' '])}/>"
        inside = gap().join(f'<DemandResetCount Count="{rng.randrange(9)}" UOM="{rng.choice(["Times", ""])}"/>'
                            for _ in range(rng.randrange(4)))
        return f"<MeterReadings{attributes}>{inside}</MeterReadings{rng.choice(['', '', ' ', chr(10)])}>"

    body = "".join(gap() + one() for _ in range(rng.randrange(6)))
    return rng.choice(['<?xml version="1.0"?>', ""]) + gap() + "<AMRDEF>" + body + gap() + "</AMRDEF>"


def test_random_exports_read_the_same_both_ways(spark, tmp_path):
    rng = random.Random(7)
    for n in range(150):
        (tmp_path / f"{n}.xml").write_text(random_export(rng), encoding="utf-8", newline="")
    columns = ["_FileName", "_Irn", "_Source", "DemandResetCount"]
    split, whole = (sorted(map(repr, read_documents(spark, str(tmp_path), split_files=way, file_name=True)
                               .select(*columns).collect())) for way in (True, False))
    assert split == whole and len(split) > 200
