"""WARC archives with revisit records, and their external capture index.

Pages are written as WARC records by Spark's own writer, so that any store it knows can
hold the archives, and read back by it. Each archive gives one run of captures sorted by
URL key and time. The runs are dealt out by ranges of the key, and every range is merged
from its runs' slices by a loser tree, which yields the histories of all URLs in order.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import map_batches, saved, shared_folder, small_batches, split_join

#: Payloads of fewer bytes are always stored; records of one archive at most.
SMALLEST, RECORDS = 1000, 1000
#: Captures of the index that one task merges, about.
RANGE_ROWS = 100_000
#: Pages carry no time of capture: it is taken from the id, as seconds after this.
EPOCH, SPAN = datetime(2000, 1, 1), 10**9
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURES = "run string, url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_ID = re.compile(rb"<urn:page:(-?\d+|null)>")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def url_key(url: str) -> str:
    """The host's labels from the last to the first, then path and query."""
    found = re.match(r"(?s).*?://([^/?#]*)([^#]*)", url)
    return f"{','.join(reversed(_lower(found[1]).split('.')))}){found[2]}" if found else ")"


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def captured(page_id: int | None) -> str:
    return (EPOCH + timedelta(seconds=(page_id or 0) % SPAN)).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id: int | None, url: str | None, html: str, digest: str, size: int, refers: int | None, revisit: bool) -> str:
    """A WARC/1.1 record without its last line end, which the writer adds."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {captured(page_id)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers)}", f"WARC-Profile: {PROFILE}"]
    body = http if revisit else http + html
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else size)}"]
    return "\r\n".join(lines) + "\r\n\r\n" + body + "\r\n"


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write one record per page into gzipped archives below ``folder``.

    Of equal payloads of ``SMALLEST`` bytes or more, the page of the largest id is the
    response and others revisit it; where that id is repeated, each of its rows is a
    response. A null html is an empty payload; a null url has no target header.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    again = (rows.where(F.col("size") >= SMALLEST).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("response"))
             .where("n > 1").select("digest", "response"))

    def start():
        def work(batch: pa.RecordBatch):
            out = []
            for page, url, text, digest, size, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "size", "response"))):
                revisit = refers is not None and page != refers
                out.append(record(page, url, text, digest, size, refers, revisit))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        return work
    joined = split_join(rows, again, ["digest"], "left")
    (map_batches(joined.select("page_id", "url", "html", "digest", "size", "response"), start, "value string").write
     .option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(folder))


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    while line := stream.readline():
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError("no WARC record where one should begin")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.partition(b":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers[b"content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record is cut off")
        yield headers, block


def read_captures(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of each archive below ``folder``, payloads checked against their digests."""
    def number(value: bytes) -> int | None:
        found = _ID.fullmatch(value)[1]
        return None if found == b"null" else int(found)

    def start():
        def work(batch: pa.RecordBatch):
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = []
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    for headers, block in records(stream):
                        kind = headers[b"warc-type"].decode()
                        digest = base64.b32decode(headers[b"warc-payload-digest"].removeprefix(b"sha1:")).hex()
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"a payload in {path} differs from its digest")
                        url = headers.get(b"warc-target-uri", b"").decode()
                        rows.append((path, url_key(url), headers[b"warc-date"].decode(), number(headers[b"warc-record-id"]), size, digest, kind,
                                     number(headers[b"warc-refers-to"]) if kind == "revisit" else None))
                rows.sort(key=lambda r: (r[1], r[2], r[3] is not None, r[3] or 0))
                types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types],
                                                 names=[c.split()[0] for c in _CAPTURES.split(", ")])
        return work
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return map_batches(files, start, _CAPTURES)


def loser_merge(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs by a tree of losers: one comparison per level for each item."""
    heads = [iter(run) for run in runs]
    k = len(runs)
    end = (1,)
    keys = [(0, item, i) if (item := next(h, None)) is not None else end for i, h in enumerate(heads)]
    tree = [-1] * k  # tree[0] is the winner, the other nodes keep the loser of their match

    def play(leaf: int) -> None:
        winner, node = leaf, (leaf + k) // 2
        while node > 0:
            other = tree[node]
            if other == -1:
                tree[node] = winner
                return
            if keys[other] < keys[winner]:
                tree[node], winner = winner, other
            node //= 2
        tree[0] = winner

    for leaf in range(k):
        play(leaf)
    while k and keys[tree[0]] != end:
        best = tree[0]
        yield keys[best][1]
        item = next(heads[best], None)
        keys[best] = end if item is None else (0, item, best)
        play(best)


def merged_index(captures: DataFrame) -> DataFrame:
    """All captures with ``capture_rank``, their place by url_key, time and page id.

    Ranges are of key, time and id, so the captures of one URL may fill several. There are so
    many that a task holds about ``RANGE_ROWS`` captures, of 1 kB each as Python's rows; the
    driver sees one count per range.
    """
    spark = captures.sparkSession
    captures = saved(captures, "warc-captures")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // RANGE_ROWS))
    names = captures.columns
    order = ["url_key", "captured", "page_id"]
    ranged = captures.repartitionByRange(n, *order).sortWithinPartitions("run", *order)

    def merge(batches):
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                key = row[1].encode("utf-8", "surrogatepass"), row[2], row[3] is not None, row[3] or 0
                runs.setdefault(row[0], []).append((key, row[4:7], row[7] is not None, row[7] or 0, row))
        done = [item[-1] for item in loser_merge(list(runs.values()))]
        for a in range(0, len(done), 5000):
            part = done[a:a + 5000]
            arrays = [pa.array(c, t) for c, t in zip(zip(*part), types)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(range(a, a + len(part)), pa.int64())], names=[*names, "_at"])
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    done = saved(ranged.mapInArrow(merge, _CAPTURES + ", _at long").withColumn("_range", F.spark_partition_id()), "warc-index")
    counts = dict(done.groupBy("_range").count().collect())  # one row per range
    offsets, before = [], 1
    for i in range(max(counts, default=-1) + 1):
        offsets.append((i, before))
        before += counts.get(i, 0)
    offset = spark.createDataFrame(offsets, "_range int, _before long")
    return done.join(F.broadcast(offset), "_range").withColumn("capture_rank", F.col("_at") + F.col("_before")).select(*names, "capture_rank")


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, read them back, merge their index.

    Other columns are ignored; repeated rows are records of their own; an empty table
    gives no rows. Archives lie below ``folder``, else in a new shared one.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or shared_folder(spark, "warc")
    write_archives(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), folder)
    return merged_index(read_captures(spark, folder))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    done = archive_pages(spark.read.parquet(f"{folder}/pages.parquet"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "capture_rank")


SQL = rf"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, sha1(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
r AS (SELECT *, CASE WHEN payload_bytes >= {SMALLEST} THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS response,
  array_to_string(list_reverse(string_split(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.')), ',')
    || ')' || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS url_key FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to,
  row_number() OVER (ORDER BY url_key, page_id % {SPAN}, page_id) AS capture_rank FROM r
"""
