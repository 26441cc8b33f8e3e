"""WARC archives: writing captures, and transaction assembly of request, response and metadata records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, ship, small_side, text_key
from tidemark.sources.folders import file_system

#: Payloads below this are stored again rather than revisited.
MIN_REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD_SCHEMA = (
    "record_id string, type string, concurrent_to string, uri string, date string, refers_to string, "
    "payload_digest string, payload_bytes long, payload string, fields map<string,string>"
)
_ARROW = pa.schema(
    [
        *[(n, pa.string()) for n in ("record_id", "type", "concurrent_to", "uri", "date", "refers_to", "payload_digest")],
        ("payload_bytes", pa.int64()),
        ("payload", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())),
    ]
)
#: Bytes of payloads that Python hands over at once; most bytes of an archive, which is written and read as a whole.
PART_BYTES, ARCHIVE_BYTES = 8_000_000, 32_000_000


def _record_id(kind: str, key: Column, nth: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit(kind), key, nth.cast("string")))
    uuid = F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def _capture_key(page_id: Column, url: Column, digest: Column) -> Column:
    return F.md5(F.concat_ws("|", text_key(page_id), digest, text_key(url)))


def deduplicated(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """pages (page_id, url, html) with payload, payload_bytes, digest, capture_key, nth and, for revisits, refers_id.

    Of rows with equal payloads of at least min_bytes, the one with the largest page_id holds the payload; among rows that repeat that
    page_id it is the first by url. A null page_id counts as the smallest. Rows that repeat page_id, url and payload are told apart
    by nth. Who holds what is settled on ids and digests alone; payloads are shuffled only for rows that repeat all three.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1(F.col("payload").cast("binary"))})
    slim = checkpointed(rows.select("page_id", "url", "payload_bytes", "digest"))
    by_page = slim.where(F.col("payload_bytes") >= min_bytes).groupBy("digest", "page_id")
    by_page = by_page.agg(F.count("*").alias("n"), F.min(F.struct(F.col("url").isNotNull().alias("known"), "url"))["url"].alias("url"))
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "url")).alias("best")
    owners = by_page.groupBy("digest").agg(F.sum("n").alias("n"), best).where(F.col("n") > 1)
    owner_key = _capture_key(F.col("best.page_id"), F.col("best.url"), F.col("digest"))
    owners = small_side(owners.select(F.concat(F.lit("k"), "digest").alias("digest_key"), owner_key.alias("owner_key")))

    key = _capture_key(F.col("page_id"), F.col("url"), F.col("digest")).alias("capture_key")
    repeats = checkpointed(slim.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1).select("capture_key"))
    rows = rows.withColumn("capture_key", _capture_key(F.col("page_id"), F.col("url"), F.col("digest")))
    if repeats.limit(1).count():
        side = small_side(repeats)
        same = ("page_id", "url", "payload_bytes", "digest", "capture_key")
        again = rows.join(side, "capture_key", "left_semi").groupBy(*same).agg(F.first("payload").alias("payload"), F.count("*").alias("n"))
        again = again.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
        rows = rows.join(side, "capture_key", "left_anti").withColumn("nth", F.lit(1).cast("long")).unionByName(again)
    else:
        rows = rows.withColumn("nth", F.lit(1).cast("long"))
    rows = rows.withColumn("digest_key", F.when(F.col("payload_bytes") >= min_bytes, F.concat(F.lit("k"), "digest"))).join(owners, "digest_key", "left")
    holds = F.col("owner_key").isNull() | (F.col("owner_key") == F.col("capture_key")) & (F.col("nth") == 1)
    return rows.withColumn("refers_id", F.when(~holds, _record_id("response", F.col("owner_key"), F.lit(1)))).drop("digest_key", "owner_key")


def records(captures: DataFrame, date: str = DATE) -> DataFrame:
    """Request, response or revisit, and metadata record of each capture, as text without the two closing line ends."""
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def named(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    def record(kind: Column, record_id: Column, headers: list[Column], content_type: str, block: Column) -> Column:
        lines = [
            F.lit("WARC/1.1"),
            named("WARC-Type", kind),
            named("WARC-Record-ID", record_id),
            F.lit(f"WARC-Date: {date}"),
            named("WARC-Target-URI", uri),
            *headers,
            F.lit(f"Content-Type: {content_type}"),
            named("Content-Length", F.octet_length(block).cast("string")),
        ]
        return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)

    own = {kind: _record_id(kind, F.col("capture_key"), F.col("nth")) for kind in ("request", "response", "metadata")}
    target = F.coalesce(F.regexp_extract(uri, r"://[^/?#]*([^#]*)", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract(uri, r"://([^/?#]*)", 1), F.lit(""))
    request = F.concat(F.lit("GET "), F.when(target == "", F.lit("/")).otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("refers_id").isNotNull()
    concurrent = named("WARC-Concurrent-To", own["response"])
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    refers = [F.when(revisit, named("WARC-Refers-To", F.col("refers_id"))), F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}"))]
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    fields = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    kind = F.when(revisit, "revisit").otherwise("response")
    three = F.array(
        record(F.lit("request"), own["request"], [concurrent], "application/http;msgtype=request", request),
        record(kind, own["response"], [digest, *refers], "application/http;msgtype=response", block),
        record(F.lit("metadata"), own["metadata"], [concurrent], "application/warc-fields", fields),
    )
    return captures.select(F.explode(three).alias("value"))


def _info(first: bytes, date: str) -> bytes:
    """The record that opens an archive; its id comes from the record after it."""
    h = hashlib.md5(b"warcinfo:" + first).hexdigest()
    block = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    lines = (
        "WARC/1.1",
        "WARC-Type: warcinfo",
        f"WARC-Record-ID: <urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>",
        f"WARC-Date: {date}",
        "Content-Type: application/warc-fields",
        f"Content-Length: {len(block)}",
    )
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


#: The text sink ends each row with this byte, and so does a gzip member of less than 16 MB: the highest byte of its length.
LAST_BYTE = "\0"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)


def gzip_member(record: bytes) -> bytes:
    """The record and its two closing line ends as a gzip member that ends with a zero byte; longer ones get an empty member behind."""
    member = gzip.compress(record + b"\r\n\r\n", 6, mtime=0)
    return member if member[-1] == 0 else member + EMPTY_MEMBER


def _archives(batches: Iterator[pa.RecordBatch], max_records: int, max_bytes: int, date: str) -> Iterator[pa.RecordBatch]:
    """Whole archives, one a row, each without its last byte."""

    def archive(members: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"value": pa.array([b"".join(members)[:-1]], pa.binary())})

    members, held = [], 0
    for batch in batches:
        for value in batch.column("value").cast(pa.binary()):
            record = value.as_py()
            member = gzip_member(record)
            if len(members) >= max_records or len(members) > 1 and held + len(member) > max_bytes:
                yield archive(members)
                members, held = [], 0
            if not members:
                members.append(gzip_member(_info(record, date)))
                held = len(members[0])
            members.append(member)
            held += len(member)
    if members:
        yield archive(members)


def write_warc(pages: DataFrame, path: str, max_records: int = 30_000, max_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> None:
    """Archives of pages under path: WARC 1.1 files named .warc.gz, each of at most max_records (2 or more) records and max_bytes, the first record a
    warcinfo, and every record a gzip member of its own. Only an archive of a single record besides can be larger than max_bytes. Payloads are
    counted in UTF-8 bytes. What was under path goes; an empty table writes no archive.

    Spark's text sink writes the archives, so any store that Spark reaches will do; the driver renames the files when the job is done.
    """
    spark = pages.sparkSession
    ship(spark)
    archives = records(deduplicated(pages), date).mapInArrow(lambda b: _archives(b, max_records, max_bytes, date), "value binary")
    # a string of Spark's is bytes, and the sink writes them as they are, each row to a file of its own
    rows = archives.select(F.col("value").cast("string").alias("value")).write.mode("overwrite")
    rows.option("lineSep", LAST_BYTE).option("compression", "none").option("maxRecordsPerFile", 1).text(path)
    system, folder = file_system(spark, path)
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith("part-"):
            continue
        if status.getLen() == 0:
            system.delete(status.getPath(), False)
        elif not system.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + ".warc.gz")):
            raise OSError(f"{name} can't be renamed")


def _measured(headers: dict[str, str], head: bytes, body: bytes) -> str:
    """SHA-1 of a response's body. Fails if the declared payload length or digest is another one; chunked bodies and records that
    declare their truncation have no payload to hold them against."""
    sha1 = hashlib.sha1(body)
    names = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if b"transfer-encoding" not in names and "warc-truncated" not in headers:
        if int(names.get(b"content-length", len(body))) != len(body):
            raise ValueError(f"{headers.get('warc-record-id')}: {len(body)} bytes of payload, {int(names[b'content-length'])} declared")
        law, _, digest = headers.get("warc-payload-digest", "").partition(":")
        if law.lower() == "sha1" and digest.lower() != sha1.hexdigest() and digest.upper() != base64.b32encode(sha1.digest()).decode():
            raise ValueError(f"{headers.get('warc-record-id')}: payload of SHA-1 {sha1.hexdigest()}, {digest} declared")
    return f"sha1:{sha1.hexdigest()}"


def parse(stream) -> Iterator[dict]:
    """Records of an open WARC stream, by their declared lengths. payload_bytes and payload_digest (SHA-1) are those of a response's
    body as read, and for revisits the declared ones. A record that ends early or a payload unlike the declared one fails."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers.get("content-length", 0)))
        if not line or len(block) < int(headers.get("content-length", 0)):
            raise ValueError(f"{headers.get('warc-record-id')}: the archive ends within this record")
        kind, payload, size, digest, fields = headers.get("warc-type"), None, None, headers.get("warc-payload-digest"), {}
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            if kind == "response":
                size, digest, payload = len(body), _measured(headers, head, body), body.decode("utf-8", "replace")
            else:
                size = next((int(x[15:]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(body))
        elif kind == "metadata":
            fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").splitlines()) if k.strip()}
        yield {
            "record_id": headers.get("warc-record-id"), "type": kind, "concurrent_to": headers.get("warc-concurrent-to"), "uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"),
            "refers_to": headers.get("warc-refers-to"), "payload_digest": digest, "payload_bytes": size, "payload": payload, "fields": fields,
        }


def _parse_files(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            raw = io.BytesIO(memoryview(content.as_buffer()))
            stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw
            rows, held = [], 0
            for row in parse(stream):
                if not payloads:
                    row["payload"] = None
                row["fields"] = list(row["fields"].items())
                rows.append(row)
                held += len(row["payload"] or "")
                if len(rows) >= 5000 or held > PART_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives (.warc, .gz) under path. A file is read as a stream by one task. Without payloads they are
    measured and left out."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "{*.gz,*.warc}").load(path)
    return files.select("content").mapInArrow(lambda b: _parse_files(b, payloads), RECORD_SCHEMA)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: the request and metadata records meet the response or revisit that they are concurrent to.

    Columns: record_id, type, uri, date, payload_digest, payload_bytes, payload (null for revisits), refers_to (a record
    id), request (struct of record_id and uri), metadata (its fields). Captures without a request or metadata record have nulls there;
    records that belong to no capture are left out, of several requests or metadata records the one with the least id stays, and
    records that repeat an id count once. All records of a capture meet in one exchange, by its id.
    """
    main = F.col("type").isin("response", "revisit")
    own = found.withColumn("capture", F.when(main, F.col("record_id")).when(F.col("type").isin("request", "metadata"), F.col("concurrent_to")))
    own = own.where(F.col("capture").isNotNull())
    columns = ("type", "uri", "date", "payload_digest", "payload_bytes", "refers_to", "payload")
    one = own.groupBy(F.col("capture").alias("record_id")).agg(
        F.min(F.when(main, F.struct(*columns))).alias("main"),
        F.min(F.when(F.col("type") == "request", F.struct("record_id", "uri"))).alias("request"),
        F.min_by("fields", F.when(F.col("type") == "metadata", F.col("record_id"))).alias("metadata"),
    )
    return one.where(F.col("main").isNotNull()).select("record_id", "main.*", "request", "metadata")


def with_pages(captures: DataFrame) -> DataFrame:
    """captures with page_id and, for revisits, the page_id of the capture that they refer to. captures is computed once and kept
    in the checkpoint folder, so that the archives behind it are read once."""
    own = checkpointed(captures.withColumn("page_id", F.col("metadata")["page-id"].cast("long")))
    target = own.where(F.col("type") == "response").select(F.concat(F.lit("r"), "record_id").alias("refers_key"), F.col("page_id").alias("refers_page"))
    # a response looks itself up, so that no key of many rows stands for those that refer to nothing
    key = F.concat(F.lit("r"), F.coalesce("refers_to", "record_id"))
    found = own.withColumn("refers_key", key).join(target, "refers_key", "left").drop("refers_key")
    return found.withColumn("refers_page", F.when(F.col("refers_to").isNotNull(), F.col("refers_page")))
