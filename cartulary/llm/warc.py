"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame a record.

Writing: bundles of frames, of about ``BUNDLE_BYTES``, are rows of Spark's text
writer, whose line separator is an empty skippable frame (all ASCII, valid
Zstandard), so plain Spark writes the archives wherever Spark can write.  After
``BUNDLES`` of them a partition goes on in a new archive, so an archive stays at
about 64 MB however large the partitions are; each begins with the dictionary.
Payloads equal to that of a page with a smaller id become revisit records; pages
that surely aren't such are not shuffled.  Reading: each archive is read whole
by Spark's binary source, its frames are walked by their block headers, one is
decoded at a time, and every header, length and digest is checked.

Defined results: a null html is an empty payload; null ids are kept, as
responses; several payloads under one id are several pages; pages that share
the smallest id of a payload are all responses; a page of any size is one record
(an archive holds at least one); control characters in an address are percent-encoded, a null address
has no Target-URI; an empty table gives an archive folder without records;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.common import lookup_join, materialise, split_by_keys
from cartulary.llm.wordhash import spans

#: Fixed values of the Zstandard format and of its use for WARC.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"

#: The dictionary is trained on at most so many pages, of at most so many characters each; it changes sizes, never contents.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES, LEVEL = 256, 8192, 16384, 3

#: Bytes of frames in a row of the writer, and rows of an archive.
BUNDLE_BYTES, BUNDLES = 1 << 20, 64

RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample (empty if the sample is too small to train on)."""
    import zstandard

    h = F.xxhash64("page_id")
    picked = [r.h for r in pages.select(h.alias("h")).orderBy("h").limit(SAMPLE_PAGES).collect()]
    sample = pages.where(h.isin(picked)).select(F.substring("html", 1, SAMPLE_CHARS).alias("s")).where("s <> ''").limit(SAMPLE_PAGES)
    texts = sorted(r.s.encode() for r in sample.collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: the smallest page with an equal payload of ``least_bytes`` or more, null for that page itself."""
    told = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("key", F.unhex(F.sha2("html", 256)))
    keys = materialise(told.where(F.octet_length("html") >= least_bytes).select("page_id", "key"), "payload-keys")
    groups = materialise(keys.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "payload-groups")
    again = lookup_join(keys, groups, "key", "n", keys.count(), "inner").where("page_id <> first")
    again = materialise(again.select("page_id", "key", F.col("first").alias("refers_to")).distinct(), "revisits")
    may, first = split_by_keys(told, again, ["page_id", "key"])
    columns = ("page_id", "url", "html", "refers_to")
    return first.withColumn("refers_to", F.lit(None).cast("bigint")).select(*columns).unionByName(may.join(again.hint("shuffle_hash"), ["page_id", "key"], "left").select(*columns))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit has the response's HTTP head, with the full payload's length, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else "%%%02X" % ord(c) for c in url))
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:x-page:{refers_to}>")
    block = http if refers_to is not None else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write archives of bounded size of ``pages(page_id, url, html)`` below ``path``."""
    trained = train_dictionary(pages)

    def frames_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        dictionary = zstandard.ZstdCompressionDict(trained) if trained else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True, write_checksum=True)
        head = DICTIONARY_MAGIC + len(trained).to_bytes(4, "little") + trained
        bundles, frames, size = 0, [head], 0

        def bundle() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], names=["frame"])

        for batch in batches:
            for a, z in spans(batch.column(2)):
                part = batch.slice(a, z - a)
                for page_id, url, html, first in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    frames.append(packer.compress(record(page_id, url, html, first, date)))
                    size += len(frames[-1])
                    if size >= BUNDLE_BYTES:
                        yield bundle()
                        bundles += 1
                        frames, size = [head] if bundles % BUNDLES == 0 else [], 0
        if size:
            yield bundle()

    marked = mark_revisits(pages, least_bytes).select("page_id", "url", F.col("html").cast("binary"), "refers_to")
    bundled = marked.mapInArrow(frames_of, "frame binary").select(F.col("frame").cast("string").alias("value"))
    bundled.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", BUNDLES).text(path)


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its header and block headers; ValueError if it is cut short or malformed."""
    magic = bytes(data[at : at + 4])
    if len(magic) == 4 and magic[0] & 0xF0 == 0x50 and magic[1:] == b"\x2a\x4d\x18":
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
    elif magic == FRAME_MAGIC:
        described = data[at + 4]
        single, size_flag = described >> 5 & 1, described >> 6
        p = at + 5 + (not single) + (0, 1, 2, 4)[described & 3] + ((1 if single else 0), 2, 4, 8)[size_flag]
        last = 0
        while not last:
            if p + 3 > len(data):
                raise ValueError("a frame is cut short")
            block = int.from_bytes(data[p : p + 3], "little")
            last, kind, size = block & 1, block >> 1 & 3, block >> 3
            if kind == 3:
                raise ValueError("a frame has a reserved block")
            p += 3 + (1 if kind == 1 else size)
        end = p + 4 * (described >> 2 & 1)
    else:
        raise ValueError(f"no frame begins at byte {at}")
    if end > len(data):
        raise ValueError("a frame is cut short")
    return end


def read_records(data: bytes) -> Iterator[bytes]:
    """The records of one archive, decoded frame by frame with the dictionary that the archive brings."""
    import zstandard

    view = memoryview(data)
    if data[:4] != DICTIONARY_MAGIC:
        raise ValueError("the archive doesn't begin with a dictionary frame")
    at = frame_end(view, 0)
    trained = data[8:at]
    if trained[:4] == FRAME_MAGIC:
        trained = zstandard.ZstdDecompressor().decompress(trained)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained)) if trained else zstandard.ZstdDecompressor()
    while at < len(data):
        end = frame_end(view, at)
        if bytes(view[at : at + 4]) == FRAME_MAGIC:
            yield reader.decompress(view[at:end])
        at = end


def parse_record(raw: bytes) -> tuple:
    """The columns of ``RECORDS``; ValueError where a header, a length or a digest is wrong."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise ValueError("a record has no WARC header")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    for k in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"):
        if k not in fields:
            raise ValueError(f"a record lacks {k}")
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    lengths = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind, said = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if not gap or len(lengths) != 1 or kind not in ("response", "revisit"):
        raise ValueError("a record's HTTP head is wrong")
    if kind == "response" and (lengths[0] != len(payload) or payload_digest(payload) != said):
        raise ValueError("a payload differs from its length or digest")
    page = lambda k: int(x) if (x := fields[k].removeprefix("<urn:x-page:").removesuffix(">")) else None
    refers = page("warc-refers-to") if kind == "revisit" else None
    return page("warc-record-id"), lengths[0], said, kind, refers, fields.get("warc-target-uri"), payload if kind == "response" else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives below ``path`` (columns of ``RECORDS``; without ``payloads`` the last is left out)."""
    names = [k.split()[0] for k in RECORDS.split(", ")][: 7 if payloads else 6]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()][: len(names)]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(some: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for value in batch.column(0):
                some, size = [], 0
                for raw in read_records(value.as_py()):
                    some.append(parse_record(raw)[: len(names)])
                    size += len(raw)
                    if size > 4_000_000:
                        yield rows(some)
                        some, size = [], 0
                if some:
                    yield rows(some)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(decode, ", ".join(RECORDS.split(", ")[: len(names)]))
