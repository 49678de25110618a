"""Web archives of zstandard frames: one WARC record a frame, a dictionary in front.

An archive is written as a skippable frame that holds the dictionary (itself compressed), a
frame with the warcinfo record, and a frame for each further record. Spark's text sink writes
one archive a file: its line separator is an empty skippable frame, which readers pass over.
So archives are committed by Spark in any store that it can write, and a task that is run
again leaves no second copy. Reading takes archives of bounded size as binary files, walks
from frame to frame by the block headers and decodes and validates record by record: a frame
that cannot be decoded costs its own record only.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm.session import materialised

#: Fixed values of the zstandard format: magic numbers of a frame, of the skippable frame that
#: holds a dictionary, and (but for the last four bits) of any skippable frame.
FRAME, DICTIONARY, SKIPPABLE = 0xFD2FB528, 0x184D2A5D, 0x184D2A50
#: An empty skippable frame; its bytes are all ASCII.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
#: Records of an archive, before compression, end it beyond so many bytes.
ARCHIVE_BYTES = 32 << 20
#: Size of a dictionary, and bytes of an archive's records, evenly spread, that it is made from.
DICTIONARY_BYTES, SAMPLE_BYTES = 1 << 15, 1 << 21
LEVEL = 3
#: Fixed values of the WARC format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
DATE = "2000-01-01T00:00:00Z"

RECORDS = ("archive string, at long, record_id string, record_type string, page_id long, "
           "uri string, refers_to_id string, payload_bytes long, payload_digest string, "
           "payload binary, error string")
_RECORDS = pa.schema([
    ("archive", pa.string()), ("at", pa.int64()), ("record_id", pa.string()),
    ("record_type", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
    ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(row))}>"


def _uri(url: str | None, identity: str) -> str:
    """A value that stays on its line: blanks, controls and non-ASCII bytes are escaped."""
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}"
                   for b in (url or "").encode()) or identity[1:-1]


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    """A record: version, named fields that are not null, its length, and the block."""
    head = [VERSION] + [f"{k}: {v}" for k, v in fields.items() if v is not None]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(row: int, page_id: int | None, url: str | None, payload: bytes,
                target: int | None, date: str) -> bytes:
    """A page's response, or its revisit of the response that row ``target`` has."""
    identity = record_id(row)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if target is None else http
    return record({
        "WARC-Type": "response" if target is None else "revisit",
        "WARC-Record-ID": identity, "WARC-Date": date, "WARC-Target-URI": _uri(url, identity),
        "WARC-Profile": None if target is None else SAME_PAYLOAD,
        "WARC-Refers-To": None if target is None else record_id(target),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "X-Page-ID": None if page_id is None else str(page_id),
        "Content-Type": "application/http;msgtype=response"}, block)


def dictionary_of(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary made from records spread evenly over the archive; none where there are too
    few of them to make one."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records[::step])
    except zstandard.ZstdError:
        return None


def archive_of(records: list[bytes], date: str = DATE) -> bytes:
    """The bytes of an archive."""
    made = dictionary_of(records)
    head = b""
    if made:
        inner = zstandard.ZstdCompressor(level=LEVEL).compress(made.as_bytes())
        head = DICTIONARY.to_bytes(4, "little") + len(inner).to_bytes(4, "little") + inner
        made.precompute_compress(level=LEVEL)
    pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=True).compress
    identity = uuid.uuid5(uuid.NAMESPACE_OID, hashlib.sha256(b"".join(records)).hexdigest())
    info = record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{identity}>",
                   "WARC-Date": date, "Content-Type": "application/warc-fields"},
                  b"format: WARC File Format 1.1\r\n")
    return head + b"".join(map(pack, [info, *records]))


def _archives(date: str, archive_bytes: int):
    def write(batches):
        held, size = [], 0
        out = lambda: pa.record_batch([pa.array([archive_of(held, date)], pa.binary())],
                                      names=["archive"])
        for batch in batches:
            for i in range(len(batch)):
                row, page_id, url, payload, target = (
                    batch[c][i].as_py() for c in ("row", "page_id", "url", "payload", "target"))
                held.append(page_record(row, page_id, url, payload, target, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()
    return write


def revisits(rows: DataFrame, least: int = 0) -> DataFrame:
    """``rows`` (row, page_id, payload, ...) with ``target``: of rows with equal payloads of
    ``least`` bytes or more, the row with the largest page_id (null lowest, then the largest
    row) has null, others have that row; null for smaller payloads."""
    rows = rows.withColumn("same", F.unhex(F.sha2("payload", 256)))
    order = F.struct(F.col("page_id").isNotNull(), "page_id", "row")
    chosen = rows.filter(F.length("payload") >= least).groupBy("same").agg(
        F.max(order).alias("top"), F.count("*").alias("copies")).filter("copies > 1")
    out = rows.join(chosen.select("same", F.col("top.row").alias("target")), "same", "left")
    return out.withColumn("target", F.when(F.col("target") != F.col("row"), F.col("target"))).drop(
        "same")


def write_archives(rows: DataFrame, folder: str, least: int = 0, date: str = DATE,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for each of ``rows`` (row long, unique; page_id; url; html) to new
    archives in ``folder``. A null html is an empty payload, a null or empty url the record's
    own id; a null page_id has no field. No rows give no archive with records."""
    rows = rows.select("row", "page_id", "url",
                       F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    made = revisits(rows, least).mapInArrow(_archives(date, archive_bytes), "archive binary")
    made.select(F.col("archive").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1).option("lineSep", SEPARATOR).text(folder)


def frame_stop(data: bytes, at: int) -> int:
    """Where the frame at ``at`` stops, by its header and those of its blocks. ValueError where
    no frame begins or the data end before it does."""
    magic = int.from_bytes(data[at:at + 4], "little")
    if magic & ~15 == SKIPPABLE:
        stop = at + 8 + int.from_bytes(data[at + 4:at + 8], "little")
    elif magic == FRAME and at + 5 <= len(data):
        bits, stop, last = data[at + 4], at + 5, 0
        single, size = bits >> 5 & 1, bits >> 6
        stop += (not single) + (0, 1, 2, 4)[bits & 3] + ((2, 4, 8)[size - 1] if size else single)
        while not last and stop < len(data):
            block = int.from_bytes(data[stop:stop + 3], "little")
            last = block & 1
            stop += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        stop += 4 * (bits >> 2 & 1) if last else len(data)
    else:
        raise ValueError("no frame begins here")
    if stop > len(data):
        raise ValueError("the archive ends inside a frame")
    return stop


def dictionary_in(data: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading skippable frame, plain or compressed, and where frames go
    on; None where there is no such frame."""
    if int.from_bytes(data[:4], "little") != DICTIONARY:
        return None, 0
    stop = frame_stop(data, 0)
    inner = data[8:stop]
    if int.from_bytes(inner[:4], "little") == FRAME:
        inner = zstandard.ZstdDecompressor().decompressobj().decompress(inner)
    return zstandard.ZstdCompressionDict(inner), stop


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of a record that is whole and of the stated length, else
    ValueError."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "strict").split("\r\n")
    if not blank or not version.startswith("WARC/1."):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed field {line[:40]!r}")
        if fields.setdefault(name.lower(), value.strip()) != value.strip():
            raise ValueError(f"two values of {name}")
    missing = [k for k in REQUIRED if k.lower() not in fields]
    if missing:
        raise ValueError(f"without {', '.join(missing)}")
    size = fields["content-length"]
    if not (size.isascii() and size.isdigit()) or len(rest) != int(size) + 4:
        raise ValueError("Content-Length is not the block's length")
    if not rest.endswith(b"\r\n\r\n"):
        raise ValueError("no blank lines after the block")
    block = rest[:-4]
    if fields.get("warc-block-digest", "").startswith("sha1:"):
        if fields["warc-block-digest"][5:] != digest(block):
            raise ValueError("the block has another digest")
    return fields, block


def _page(fields: dict[str, str], block: bytes) -> dict:
    """What a response or revisit says of its page; ValueError where it contradicts itself."""
    page = fields.get("x-page-id")
    out = {"record_id": fields["warc-record-id"], "record_type": fields["warc-type"],
           "page_id": None if page is None else int(page), "uri": fields.get("warc-target-uri"),
           "refers_to_id": fields.get("warc-refers-to")}
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if fields["warc-type"] == "revisit":
        if fields.get("warc-profile") != SAME_PAYLOAD or not out["refers_to_id"]:
            raise ValueError("a revisit without its profile or response")
        return out | {"payload_digest": said}
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    for line in http.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.lower() == b"content-length" and value.strip() != str(len(payload)).encode():
            raise ValueError("the payload has another length")
    found = digest(payload)
    if said not in (None, found):
        raise ValueError("the payload has another digest")
    return out | {"payload_digest": found, "payload_bytes": len(payload), "payload": payload}


def records_in(data: bytes):
    """(offset, what the record says) for each response and revisit of an archive, with
    ``error`` for one that is not valid. What follows data that are no frame is not read."""
    at = 0
    try:
        made, at = dictionary_in(data)
        reader = zstandard.ZstdDecompressor(dict_data=made)
        while at < len(data):
            stop = frame_stop(data, at)
            if int.from_bytes(data[at:at + 4], "little") == FRAME:
                try:
                    raw = reader.decompressobj().decompress(data[at:stop])
                    fields, block = parsed(raw)
                    if fields["warc-type"] in ("response", "revisit"):
                        yield at, _page(fields, block)
                except (ValueError, zstandard.ZstdError) as wrong:
                    yield at, {"error": str(wrong)}
            at = stop
    except (ValueError, zstandard.ZstdError) as wrong:
        yield at, {"error": str(wrong)}


def _records(payloads: bool):
    def read(batches):
        names = _RECORDS.names
        for batch in batches:
            for i in range(len(batch)):
                rows, size = [], 0
                for at, found in records_in(batch["content"][i].as_py()):
                    found |= {"archive": batch["path"][i].as_py(), "at": at}
                    if not payloads:
                        found.pop("payload", None)
                    rows.append(found)
                    size += len(found.get("payload") or b"")
                    if len(rows) == 4096 or size > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(
                    [{k: r.get(k) for k in names} for r in rows], _RECORDS)
    return read


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row for each response and revisit of the archives in ``folder``: archive, at (offset of
    its frame), record_id, record_type, page_id, uri, refers_to_id, payload_bytes and
    payload_digest (of a revisit only the digest that it states), payload (null without
    ``payloads``), error (null for valid records, else all but the place may be null)."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(_records(payloads), RECORDS)


def with_responses(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (the page_id of the
    response that a revisit refers to). Fails where a record is not valid, or a revisit's
    response is not there or has another digest."""
    failed = lambda why: F.raise_error(F.concat(F.lit("record at "), F.col("at").cast("string"),
                                                F.lit(" of "), "archive", F.lit(": "), why))
    records = records.withColumn("record_type", F.when(
        F.col("error").isNotNull(), failed(F.col("error"))).otherwise(F.col("record_type")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = records.filter("record_type = 'response'")
    whole = responses.select(F.col("record_id").alias("refers_to_id"),
                             F.col("page_id").alias("refers_to"),
                             F.col("payload_bytes").alias("bytes"),
                             F.col("payload_digest").alias("found"))
    again = records.filter("record_type = 'revisit'").drop("payload_bytes").join(
        whole, "refers_to_id", "left").withColumn("payload_bytes", F.when(
            F.col("found").eqNullSafe(F.col("payload_digest")), F.col("bytes")).otherwise(
            failed(F.lit("no response with this digest")).cast("long")))
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        again.select(*columns, "refers_to"))


def round_trip(rows: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Archives of ``rows`` written to ``folder`` and read back: what ``with_responses`` says of
    each page. Repeated rows are records of their own; page_ids may be null or repeated, and
    ``refers_to`` is null where the response's page_id is."""
    write_archives(rows, folder, least)
    return with_responses(materialised(
        read_archives(rows.sparkSession, folder, payloads=False).drop("payload")))
