"""Benchmark: the translation job's stages over all meter documents of one scale factor.

Setup (not timed) writes the documents as XML exports and parses them once.  Timed are, each to completion, short ones as
medians of several:

* ``stage_xml``: exports -> Parquet, the only parse of the job
* one entry per reading kind, and the feed as a union, from the staged documents
* ``feed_fused_staged`` and ``feed_fused_xml``: the single-scan feed from Parquet and from XML
* ``feed_union_xml``: the feed with one parse per kind, as a script without staging would have it
* ``stage_xml_uncut`` and ``stage_xml_source``: staging without cutting, and through Spark's XML source
* ``job``: exports -> staged Parquet -> one CSV directory per kind and the feed

Prints one line of JSON.  ``value`` is their sum without ``COMPARED``, which are there to compare with.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from statistics import median

from pyspark.sql import DataFrame, SparkSession

from metermill import KINDS, fused_feed, read_documents, translate, translate_export, unified_feed
from metermill.sources.fragments import WHOLE_BYTES
from metermill.sources.sinks import stage, working_folder
from metermill.workload.documents import exported, meter_documents

COMPARED = {"stage_xml", "stage_xml_uncut", "stage_xml_source", "feed_union_xml"}  # the job stages too


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("metermill-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object], times: int = 1) -> object:
        """The median of several times, as single ones vary by a fifth."""
        taken = []
        for _ in range(times):
            began = time.perf_counter()
            result = work()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(median(taken), 3)
        return result

    def drain(readings: Callable[[], DataFrame]) -> Callable[[], None]:
        return lambda: readings().write.format("noop").mode("overwrite").save()

    exports = exported(spark, sf_dir, "all", meter_documents)
    documents = read_documents(spark, exports, kinds=KINDS, whole_bytes=WHOLE_BYTES)
    uncut = read_documents(spark, exports, kinds=KINDS)
    stage(uncut, working_folder(spark))  # the first parse of a session also warms it up
    staged = timed("stage_xml", lambda: stage(documents, working_folder(spark)), 2)
    timed("stage_xml_uncut", lambda: stage(uncut, working_folder(spark)), 2)
    for kind in KINDS:
        timed(f"kind_{kind.name}", drain(lambda kind=kind: translate(staged, kind)), 3)
    timed("feed_union_staged", drain(lambda: unified_feed(staged)), 3)
    timed("feed_fused_staged", drain(lambda: fused_feed(staged)), 3)
    timed("feed_fused_xml", drain(lambda: fused_feed(documents)))
    timed("feed_union_xml", drain(lambda: unified_feed(documents)))
    timed("stage_xml_source", lambda: stage(
        read_documents(spark, exports, kinds=KINDS, split_files=False), working_folder(spark)))
    timed("job", lambda: translate_export(spark, exports, working_folder(spark)))
    print(json.dumps({
        "metric": "meter_translation_total", "value": round(sum(s for n, s in seconds.items() if n not in COMPARED), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
