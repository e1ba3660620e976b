"""WARC archives in Zstandard frames: a dictionary in the leading skippable frame, one frame per record."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import chain, islice
from typing import BinaryIO

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchbook.llm.common import NO_ID, shared_dir

#: Magic number of the leading skippable frame that holds the dictionary.
DICT_MAGIC = 0x184D2A5D
#: Magic number of any skippable frame, but for its last four bits.
SKIPPABLE = 0x184D2A50
ZSTD_MAGIC = 0xFD2FB528
#: Records of an archive whose payloads its dictionary is trained on, and the dictionary's bytes.
TRAIN_RECORDS = 128
DICT_BYTES = 65_536
#: Bytes (compressed) after which an archive is closed and the next begins.
ARCHIVE_BYTES = 16_000_000
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PREFIX = "urn:page:"


class BadArchive(ValueError):
    """An archive, frame or record that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes | None, size: int, sha1: str, refers_to: int | None) -> bytes:
    """A response record with its payload, or a revisit record with the HTTP header only. Without page_id its id is a UUID."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    url = "".join(c for c in url if c >= " ")
    name = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {sha1}')}" if page_id is None else f"{PREFIX}{page_id}"
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>", f"WARC-Target-URI: {url}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{PREFIX}{refers_to}>"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _page(name: str | None) -> int | None:
    """The page id of a record id that this module wrote; null for any other."""
    number = (name or "").strip("<>").removeprefix(PREFIX)
    return int(number) if name and PREFIX in name and re.fullmatch(r"-?\d{1,19}", number) else None


def _sha1_is(said: str | None, data: bytes) -> bool:
    """Whether a digest field agrees; one that is absent or of another algorithm can't disagree."""
    return not (said or "").lower().startswith("sha1:") or said[5:].upper() == digest(data)


def parse(data: bytes) -> dict:
    """The fields NAMES of a whole record; BadArchive if it isn't valid.

    Of HTTP records the payload is what follows the HTTP header, of all others the block. A revisit has no payload;
    its length is the one that its HTTP header tells. Digests are checked where they are given, and told in any case.
    Records of all types are read; page_id and refers_to are null unless this module named the record.
    """
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise BadArchive("no WARC header")
    fields = _fields(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if not fields.get(name):
            raise BadArchive(f"{name} is missing")
    length, kind = fields["content-length"], fields["warc-type"].lower()
    if not re.fullmatch("[0-9]+", length) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive("the block's length is wrong")
    block = rest[:-4]
    if not _sha1_is(fields.get("warc-block-digest"), block):
        raise BadArchive("the block's digest is wrong")
    payload, size = block, len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, sep, payload = block.partition(b"\r\n\r\n")
        said = _fields(http.decode("utf-8", "replace").split("\r\n")[1:]).get("content-length", "")
        size = int(said) if re.fullmatch("[0-9]+", said) else len(payload)
        if kind == "response" and size != len(payload) and "warc-truncated" not in fields:
            raise BadArchive("the payload's length is wrong")
    if kind == "revisit":
        if not (fields.get("warc-refers-to") or fields.get("warc-refers-to-target-uri") or fields.get("warc-payload-digest")):
            raise BadArchive("a revisit refers to nothing")
        payload = None
    elif not _sha1_is(fields.get("warc-payload-digest"), payload):
        raise BadArchive("the payload's digest is wrong")
    told = fields.get("warc-payload-digest", "")
    own = told[5:] if told.lower().startswith("sha1:") else told or (digest(payload) if payload is not None else None)
    return {
        "record_id": fields["warc-record-id"].strip("<>"), "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri", "").strip("<>"), "record_type": kind, "payload": payload,
        "payload_bytes": size if payload is None else len(payload), "payload_digest": own, "refers_to": _page(fields.get("warc-refers-to")), "error": None,
    }


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the samples, or their raw start if they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICT_BYTES]


def archive(records: list[bytes], shared: bytes) -> bytes:
    """The leading skippable frame with the dictionary, then a frame per record."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared), write_content_size=True, write_checksum=True)
    return struct.pack("<II", DICT_MAGIC, len(shared)) + shared + b"".join(map(pack.compress, records))


def read(source: bytes | BinaryIO) -> Iterator[bytes]:
    """The records of an archive, each the content of exactly one frame.

    A dictionary in the leading skippable frame is loaded, unpacked if it is compressed itself; any other
    skippable frame is passed over. What is neither raises BadArchive. An archive is read in pieces.
    """
    import zstandard

    stream = io.BytesIO(source) if isinstance(source, bytes) else source
    pack, data, at, first = zstandard.ZstdDecompressor(), b"", 0, True

    def have(n: int) -> bool:
        nonlocal data, at
        while len(data) - at < n and (more := stream.read(max(n, 1 << 20))):
            data, at = data[at:] + more, 0
        return len(data) - at >= n

    while have(1):
        magic = struct.unpack_from("<I", data, at)[0] if have(4) else -1
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            size = struct.unpack_from("<I", data, at + 4)[0] if have(8) else 1 << 40
            if not have(8 + size):
                raise BadArchive("a skippable frame is cut off")
            if first and magic == DICT_MAGIC:
                shared = data[at + 8 : at + 8 + size]
                try:
                    if shared[:4] == struct.pack("<I", ZSTD_MAGIC):
                        shared = zstandard.ZstdDecompressor().decompress(shared)
                    pack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared) if shared else None)
                except zstandard.ZstdError as e:
                    raise BadArchive(f"the dictionary is damaged: {e}") from e
            at, first = at + 8 + size, False
            continue
        if magic != ZSTD_MAGIC:
            raise BadArchive("no frame")
        first, frame, parts = False, pack.decompressobj(), []
        while not frame.eof:
            if not have(1):
                raise BadArchive("a frame is cut off")
            chunk = data[at : at + (1 << 14)]
            try:
                parts.append(frame.decompress(chunk))
            except zstandard.ZstdError as e:
                raise BadArchive(f"a frame is damaged: {e}") from e
            at += len(chunk)
        at -= len(frame.unused_data)
        yield b"".join(parts)


#: Names that Hadoop's file systems have for stores which the Arrow library knows by another one.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs", "gcs": "gs"}


def shared_uri(uri: str) -> str:
    """A place in the cluster's shared storage as the Arrow library names it. Schemes that it knows stay as they are."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def _filesystem(uri: str):
    """File system and path of a place in the cluster's shared storage, as an executor reaches it: file, s3 (s3a, s3n), gs, abfs(s)
    and hdfs, which needs Hadoop's native client on the executors. Credentials are those of the executors' environment."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(shared_uri(uri))


WRITTEN = "archive string, records long, bytes long"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes response and revisit records of pages (page_id, url, html, refers_to) as archives in folder.

    Returns the manifest, a row per archive: its URI, records and bytes. An archive's name holds the
    attempt's number, so attempts of one task never write one file. What counts is the manifest that
    Spark commits: archives of attempts that failed or came second aren't in it. Each archive begins with
    a dictionary trained on its own first payloads. At most one archive is held in memory.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        context = TaskContext.get()
        place, path = _filesystem(folder)
        place.create_dir(path, recursive=True)
        number, rows = 0, []

        def flush(packed: list[bytes], shared: bytes) -> None:
            nonlocal number
            name = f"pages-{context.partitionId():06d}-{number:05d}-{context.taskAttemptId()}.warc.zst"
            with place.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(struct.pack("<II", DICT_MAGIC, len(shared)) + shared)
                for p in packed:
                    out.write(p)
            rows.append((f"{folder}/{name}", len(packed), sum(map(len, packed))))
            number += 1

        def records() -> Iterator[tuple[bytes, bytes]]:
            for batch in batches:
                for page, url, html, refers in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"], strict=True):
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    page, refers = (None if x == NO_ID else int(x) for x in (page, refers))
                    yield record(page, url or "", payload, len(payload), digest(payload), refers), payload if refers is None else b""

        source = records()
        while held := list(islice(source, TRAIN_RECORDS)):
            shared = dictionary([p for _, p in held if p])
            packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared), write_content_size=True, write_checksum=True)
            packed, size = [], 0
            for data, _ in chain(held, source):
                packed.append(packer.compress(data))
                size += len(packed[-1])
                if size >= ARCHIVE_BYTES and len(packed) >= len(held):
                    break
            flush(packed, shared)
        yield pd.DataFrame(rows, columns=["archive", "records", "bytes"])

    known = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_ID)).alias(c)
    return pages.select(known("page_id"), "url", "html", known("refers_to")).mapInPandas(run, WRITTEN)


RECORDS = "archive string, record_id string, page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, error string"
NAMES = [c.split()[0] for c in RECORDS.split(", ")]
DAMAGED = "damaged"


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """archive, bytes: all archives in a folder, listed by Spark. For folders that have no manifest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select(F.col("path").alias("archive"), F.col("length").alias("bytes"))


def records_of(archive: str, stream: BinaryIO, with_payload: bool = True) -> Iterator[tuple]:
    """A row NAMES per record. A record that isn't valid, or the rest of a damaged archive, is one row of type DAMAGED."""
    blank = dict.fromkeys(NAMES) | {"archive": archive, "record_type": DAMAGED}
    try:
        for content in read(stream):
            try:
                found = blank | parse(content)
            except BadArchive as e:
                found = blank | {"error": str(e)}
            yield tuple(None if k == "payload" and not with_payload else found[k] for k in NAMES)
    except BadArchive as e:
        yield tuple((blank | {"error": str(e)})[k] for k in NAMES)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives that a table names (archive: URI), as RECORDS; nothing else in their folder is looked at.

    The names are dealt to tasks; each task streams its archives, so it holds a record at a time and a batch of rows.
    A damaged record or archive gives a row of type `damaged` that names it and tells why.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = {"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"}
        for batch in batches:
            for archive in batch["archive"]:
                place, path = _filesystem(archive)
                with place.open_input_stream(path, compression=None) as stream:
                    rows = records_of(archive, stream, with_payload)
                    while some := list(islice(rows, 256)):
                        yield pd.DataFrame({n: pd.Series([r[i] for r in some], dtype=kinds.get(n, object)) for i, n in enumerate(NAMES)})

    spread = archives.select("archive").repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), "archive")
    return spread.mapInPandas(run, RECORDS)


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """pages with refers_to: of equal payloads of at least least_bytes bytes, the smallest page_id; null for itself and smaller ones.

    The smallest id per digest is aggregated with partial sums; pages join it by the digest, on which
    Spark can split a hot payload. A row without page_id revisits the smallest id of its payload, if there is one.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("key", F.unhex(F.sha2("html", 256)))
    first = keyed.where((F.octet_length("html") >= least_bytes) & F.col("page_id").isNotNull()).groupBy("key").agg(F.min("page_id").alias("first"))
    later = F.col("page_id").isNull() | (F.col("first") < F.col("page_id"))
    return keyed.join(first, "key", "left").select("page_id", "url", "html", F.when(later, F.col("first")).alias("refers_to"))


def round_trip(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes all pages as archives and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null or empty html: an empty payload. Null url: empty URI. Null page_id: a record of its own with a null
    page_id. Repeated rows of one page_id: a record each, all responses if they are the first of their
    payload. Empty table: no archives and no rows. An own archive that can't be read back raises an error.
    """
    spark = pages.sparkSession
    folder = folder or shared_dir(spark)
    write_archives(revisits(pages, least_bytes), f"{folder}/warc").write.parquet(f"{folder}/manifest")
    found = read_archives(spark.read.parquet(f"{folder}/manifest"), with_payload=False)
    whole = F.when(F.col("error").isNull(), True).otherwise(F.raise_error(F.concat_ws(": ", "archive", "error")).cast("boolean"))
    return found.where(whole).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
