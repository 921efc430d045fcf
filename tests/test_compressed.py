"""Compressed exports and outputs: the same rows, in files short enough for a task each."""

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from exports import write_exports
from pyspark.sql import functions as F

from metermill import KINDS, read_documents, translate_export
from metermill.sources.documents import write_documents
from metermill.sources.sinks import write_csv
from metermill.workload import documents as D


def write_suppliers(folder: Path, rows: int) -> str:
    pq.write_table(pa.table({"s_suppkey": list(range(1, rows + 1))}), folder / "supplier.parquet")
    return str(folder)


def names(folder) -> list[str]:
    return sorted(file.name for file in Path(folder).iterdir() if file.name.startswith("part-"))


def meters(documents) -> list[int]:
    return sorted(row[0] for row in documents.select("Meter._MeterIrn").collect())


def test_compressed_exports_are_short_files_that_hold_all(spark, tmp_path):
    folder, irn = str(tmp_path / "exports"), F.col("id")
    documents = spark.range(10).coalesce(1).select(irn.alias("_Irn"), F.struct(irn.alias("_MeterIrn")).alias("Meter"))
    write_documents(documents, folder, "gzip", 4)
    assert len(names(folder)) == 3 and all(name.endswith(".xml.gz") for name in names(folder))
    for split in (True, False):
        assert meters(read_documents(spark, folder, split_files=split)) == list(range(10))


def test_the_workload_exports_are_compressed(spark, tmp_path):
    sf = write_suppliers(tmp_path, 3)
    folder = D.exported(spark, sf, "long", D.long_documents, documents_per_file=2).removeprefix("file:")
    assert len(names(folder)) >= 2 and all(name.endswith(".xml.gz") for name in names(folder))
    text = sum(len(str(row)) for row in D.long_documents(spark, sf).collect())
    assert sum((Path(folder) / name).stat().st_size for name in names(folder)) * 10 < text


def test_long_documents_of_short_compressed_files_are_read(spark, tmp_path):
    """A file shorter than whole_bytes may hold a document that is longer."""
    folder = str(tmp_path / "exports")
    write_documents(D.long_documents(spark, write_suppliers(tmp_path, 2)).coalesce(1), folder, "gzip")
    assert sum((Path(folder) / name).stat().st_size for name in names(folder)) < 100_000
    cut = read_documents(spark, folder, kinds=KINDS, whole_bytes=100_000)
    assert set(meters(cut)) >= {1, 2}
    assert cut.select(F.sum(F.size("DemandReset")).alias("n")).first().n >= 400


def test_the_job_writes_compressed_directories(spark, tmp_path):
    (tmp_path / "in").mkdir()
    source = write_exports(tmp_path / "in")
    plain = translate_export(spark, source, str(tmp_path / "plain"))
    small = translate_export(spark, source, str(tmp_path / "small"), compression="gzip")
    assert all(name.endswith(".csv") for name in names(plain.feed))
    assert names(small.feed) and all(name.endswith(".csv.gz") for name in names(small.feed))

    def rows(path):
        return sorted(map(str, spark.read.option("header", True).csv(path).collect()))

    assert rows(small.feed) == rows(plain.feed)
    assert small.kinds.keys() == plain.kinds.keys()
    assert all(rows(small.kinds[kind]) == rows(plain.kinds[kind]) for kind in plain.kinds)


def test_compressed_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("metermill.sources.sinks.COMPRESSED_ROWS", 4)
    write_csv(spark.range(10).coalesce(1), str(tmp_path / "out"), compression="gzip")
    assert len(names(tmp_path / "out")) == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 10
