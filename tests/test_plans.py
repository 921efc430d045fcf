"""The shape of the plans: no shuffle, pruned scans, one parse."""

import pytest
from exports import write_exports

from metermill import KINDS, fused_feed, kind_named, read_documents, translate, unified_feed
from metermill.sources.sinks import stage
from metermill.workload.documents import meter_documents

SF = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    documents = read_documents(spark, write_exports(folder), kinds=KINDS)
    return stage(documents, str(tmp_path_factory.mktemp("staged") / "documents"))


@pytest.mark.parametrize("kind", KINDS, ids=lambda k: k.name)
def test_a_kind_reads_its_own_family_without_shuffle(staged, kind):
    text = plan(translate(staged, kind))
    assert "Exchange" not in text
    assert text.count("FileScan") == 1
    scanned = text[text.index("ReadSchema"):]
    assert not [other.array for other in KINDS if other.array != kind.array and f"{other.array}:" in scanned]
    assert f"IsNotNull({kind.array})" in text


def test_feeds_do_not_shuffle(staged):
    assert "Exchange" not in plan(unified_feed(staged)) + plan(fused_feed(staged))
    assert plan(unified_feed(staged)).count("FileScan") == len(KINDS)
    assert plan(fused_feed(staged)).count("FileScan") == 1


def test_the_fused_feed_parses_xml_once(spark, tmp_path):
    text = plan(fused_feed(read_documents(spark, write_exports(tmp_path), kinds=KINDS)))
    assert text.count("from_xml(") == 1
    assert "Exchange" not in text


@pytest.mark.parametrize("name, table", [("MaxDemandData", "lineitem"), ("DemandReset", "orders"), ("Statuses", "events")])
def test_families_that_documents_lack_are_not_scanned(spark, name, table):
    text = plan(translate(meter_documents(spark, SF), kind_named(name)))
    assert text.count("FileScan") == 1 and f"{table}.parquet" in text


def test_explodes_stay_in_generated_code(staged):
    text = plan(translate(staged, kind_named("IntervalData")))
    assert "*(1) Generate explode" in text
