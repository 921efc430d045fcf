"""WARC archives and their index: written, read back, and merged into one ordered history of captures.

Archives hold one gzip member per record.  Whoever reads them back sorts the captures it saw by URL key, time and id: a
run.  The runs are cut at the same keys, and each range of keys merges its pieces of all runs through a loser tree.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, fresh_folder, staged
from .files import new_file, opened, write_file

#: Bytes of payload after which an archive is closed, at the next record.
ARCHIVE_BYTES = 8 << 20
FIRST_CAPTURE = datetime(2020, 1, 1, tzinfo=timezone.utc)
ENTRY = ("url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, file string, offset long, length long")


def url_key(url: Column) -> Column:
    """The key that sorts a host's pages together: reversed host labels, then port, path and query, in lower case."""
    plain = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_replace(F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://([^/?#:]*)", 1), r"^www\.", "")
    rest = F.regexp_replace(plain, r"^[a-z][a-z0-9+.-]*://[^/?#:]*|#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def with_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """The pages with payload_digest (hexadecimal SHA-1) and refers_to: null for what is archived whole.

    Of equal payloads the smallest page_id is archived whole.  Minima are combined before the shuffle; only payloads that
    occur more than once are joined back.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                        F.sha2(payload, 256).alias("same"), F.sha1(payload).alias("payload_digest"))
    first = (rows.filter(F.octet_length("html") >= least_bytes).filter("page_id is not null")
             .groupBy("same").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
             .filter("copies > 1").select("same", "first"))
    joined = rows.join(first, "same", "left")
    return joined.select("page_id", "url", "html", "payload_digest",
                         F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None) -> bytes:
    payload = html.encode()
    captured = FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % (1 << 30))
    name = "none" if page_id is None else str(page_id)
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:metermill:page:{name}>"),
            ("WARC-Date", captured.strftime("%Y-%m-%dT%H:%M:%SZ")),
            ("WARC-Target-URI", "".join(" " if one in "\r\n" else one for one in url or "")),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
            ("Content-Type", "text/html")]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:metermill:page:{refers_to}>"), ("X-Payload-Length", str(len(payload)))]
        payload = b""
    head.append(("Content-Length", str(len(payload))))
    lines = "".join(f"{key}: {value}\r\n" for key, value in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + payload + b"\r\n\r\n"


def written(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """(file, records) of the archives that hold pages (page_id, url, html)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, records, size = io.BytesIO(), 0, 0

        def close() -> pa.RecordBatch:
            write_file(name := new_file(folder, ".warc.gz"), out.getvalue())
            return pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([records], pa.int64())})

        for batch in blocks(batches, "html"):
            for row in zip(*(batch.column(name).to_pylist() for name in
                             ("page_id", "url", "html", "payload_digest", "refers_to")), strict=True):
                data = record(*row)
                out.write(gzip.compress(data, 4, mtime=0))
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out, records, size = io.BytesIO(), 0, 0
        if records:
            yield close()

    return with_revisits(pages, least_bytes).mapInArrow(write, "file string, records long")


def members(name: str) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of each gzip member, read piece by piece."""
    system, path = opened(name)
    with system.open_input_stream(path, compression=None) as file:
        begin, fed, left = 0, 0, b""
        while True:
            inflate, parts = zlib.decompressobj(31), []
            while not inflate.eof:
                left = left or file.read(1 << 20)
                if not left:
                    if parts or fed > begin:
                        raise ValueError(f"{name} ends within a record")
                    return
                parts.append(inflate.decompress(left))
                fed += len(left) - len(inflate.unused_data)
                left = inflate.unused_data
            yield begin, fed - begin, b"".join(parts)
            begin = fed


def parsed(data: bytes) -> dict[str, object]:
    """What the index keeps of a record; a payload that isn't what its headers say is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    payload = rest[:size]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = fields["WARC-Type"] == "response"
    if not first.startswith("WARC/") or rest[size:] != b"\r\n\r\n" or (
            whole and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def number(field: str) -> int | None:
        name = fields[field].rpartition(":")[2].rstrip(">")
        return None if name == "none" else int(name)

    return {"captured": fields["WARC-Date"], "url": fields["WARC-Target-URI"], "page_id": number("WARC-Record-ID"),
            "payload_bytes": size if whole else int(fields["X-Payload-Length"]), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": None if whole else number("WARC-Refers-To")}


def captures(archives: DataFrame) -> DataFrame:
    """Every record of the archives (file), with its place."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                found = [parsed(data) | {"file": name, "offset": offset, "length": length}
                         for offset, length, data in members(name)]
                yield pa.RecordBatch.from_pylist(found, SEEN)

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("file").repartition(parts, "file").mapInArrow(
        read, ENTRY.replace("url_key string", "url string"))


SEEN = pa.schema([("url", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()),
                  ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                  ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def loser_tree(runs: Sequence[Sequence], key) -> Iterator[tuple[int, int]]:
    """(run, place) of all items of k sorted runs in order; equal keys by run.

    Each inner node keeps the loser of its match; after the winner's run moves on, only the matches on its way to the root
    are played again.
    """
    k = len(runs)
    at = [0] * k

    def head(run: int) -> tuple:
        return (0, key(runs[run][at[run]]), run) if run < k and at[run] < len(runs[run]) else (1, (), run)

    heads = [head(run) for run in range(k)]
    tree = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        one, other = winners[2 * node], winners[2 * node + 1]
        winners[node], tree[node] = (one, other) if heads[one] < heads[other] else (other, one)
    best = winners[1] if k > 1 else 0
    while k and not heads[best][0]:
        yield best, at[best]
        at[best] += 1
        heads[best] = head(best)
        node = (best + k) // 2
        while node:
            if heads[tree[node]] < heads[best]:
                best, tree[node] = tree[node], best
            node //= 2


def history(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, captured, file, offset, length,
    range, place) of every row of pages (page_id, url, html), from the archives written for them, in the order of the
    capture history: by url_key, captured and page_id; range and place tell it.

    A null html is an empty payload, a null url an empty one.  Of records with equal payloads of at least least_bytes the
    smallest page_id is a response, the others are revisits of it.  Rows without page_id are responses, dated as page 0;
    of rows that repeat the smallest page_id all are responses.  No rows write no archive.  Other columns are not looked at.

    One URL may hold any share of the captures: ranges are cut by time and id within it too.
    """
    archives = staged(written(pages, fresh_folder(pages.sparkSession, "archives"), least_bytes), "archive-list")
    runs = staged(captures(archives).withColumn("url_key", url_key(F.col("url"))).drop("url")
                  .withColumn("run", F.spark_partition_id()).sortWithinPartitions("url_key", "captured", "page_id"),
                  "runs")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["url_key", "captured", "page_id"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), MERGED_FROM)
        keys = list(zip(rows.column("url_key").to_pylist(), rows.column("captured").to_pylist(),
                        [(one is not None, one or 0) for one in rows.column("page_id").to_pylist()], strict=True))
        members: dict[int, list[int]] = {}
        for place, run in enumerate(rows.column("run").to_pylist()):
            members.setdefault(run, []).append(place)
        own = [members[run] for run in sorted(members)]
        taken = pa.array([own[run][place] for run, place in loser_tree(own, keys.__getitem__)], pa.int64())
        merged = rows.drop_columns(["run"]).take(taken)
        yield from merged.append_column("place", pa.array(range(len(merged)), pa.int64())).to_batches()

    columns = [part.split()[0] for part in ENTRY.split(", ")]
    ranged = (runs.select(*columns, "run").repartitionByRange(parts, *order)
              .sortWithinPartitions("run", *order).mapInArrow(merge, ENTRY + ", place long"))
    return ranged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured",
                         "file", "offset", "length", F.spark_partition_id().alias("range"), "place")


MERGED_FROM = pa.schema([("url_key", pa.string()), *list(SEEN)[1:], ("run", pa.int32())])
