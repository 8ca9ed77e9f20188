"""Web archives with a two-level capture index.

``write_archives`` stores pages as WARC 1.1 records, each compressed on its own, so that a
record can be read by its offset and length. Of equal payloads one is stored; the others become
revisit records that refer to it. ``build_index`` reads archives back and sorts their captures
by reversed-host key (``org,example,www)/path``) across the cluster; runs of captures are
compressed into blocks, and a sparse directory keeps the first key of each block. ``lookup``
finds the block of a key by binary search in the directory, then the captures by binary search
in the block; ``fetch`` reads the wanted records by offset and length, and checks each against the
index. Archives are read as streams, so their size is no matter to a task. Only where no client
can seek in the file system (see ``rawfiles``) are whole archives handed over and cut in memory.

The directory has at most ``MAX_BLOCKS`` entries, whatever the number of captures (blocks grow
instead), and an entry holds no more of a key than tells the blocks apart, so that sending it
to all executors is safe.

Null html is an empty payload, a null url an empty key. Rows with equal ids are captures of
their own; an empty table gives an archive without records.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm.common import map_batches
from millwright.llm.rawfiles import can_seek, list_files, open_file, read_raw, write_raw
from millwright.sources.staging import stage

# Payloads shorter than this are stored every time.
LEAST_SHARED_BYTES = 100
BLOCK_LINES = 3000
MAX_BLOCKS = 65_536
RECORDS_PER_FILE = 20_000
COMPRESSION_LEVEL = 4
# Records that follow each other are read together up to so many bytes.
RANGE_BYTES = 4_000_000
# A task's share of an archive, and the payload bytes of a batch.
STRETCH_BYTES = 64_000_000
BATCH_BYTES = 16_000_000
CAPTURE_DATE = "1970-01-01T00:00:00Z"

# Fixed values of the archive format.
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_EMPTY_MEMBER = gzip.compress(b"", mtime=0)

CAPTURE_SCHEMA = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, path string, offset bigint, length bigint"
)


def reversed_host_key(url: str | None) -> str:
    """Sort key of a url: host labels from the right, then path and query; no scheme or fragment."""
    url = (url or "").strip()
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    if not url:
        return ""
    labels = ",".join(reversed(host.rstrip(".").split(".")))
    if port and port not in (80, 443):
        labels += f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}){parts.path or '/'}{query}"


# --- writing --------------------------------------------------------------------------------


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_RECORD_IDS, f'page/{page_id}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as gzip members; the last byte is zero, as it ends in the high byte of a size."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers)
    data = head.encode("utf-8", "surrogatepass")
    data += f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packed = gzip.compress(data, COMPRESSION_LEVEL, mtime=0)
    return packed if packed[-1] == 0 else packed + _EMPTY_MEMBER


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """The compressed record of a capture; a revisit has no payload of its own."""
    uri = quote(url or "", safe=":/?#[]@!$&'()*+,;=%~-._")
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", CAPTURE_DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Page-Url", json.dumps(url)),
        ("X-Payload-Bytes", str(len(payload))),
    ]
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n"
    block = http.encode()
    if refers_to is None:
        block += payload
    else:
        headers += [
            ("WARC-Profile", _REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(refers_to)),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    return _member(headers, block)


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to``; the latter is null for responses."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    read = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "payload_digest", F.sha2("payload", 256)
    )
    shared = (
        read.filter(F.length("payload") >= LEAST_SHARED_BYTES)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .drop("_copies")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return read.join(shared, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest", refers.alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write the records of ``pages`` (page_id, url, html) as files of gzip members."""

    def records(batches):
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for low in range(0, batch.num_rows, 500):
                own = [record(*row) for row in zip(*[c[low : low + 500] for c in columns])]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], ["record"])

    columns = ["page_id", "url", "payload", "payload_digest", "refers_to"]
    made = map_batches(with_revisits(pages), columns, records, "record binary")
    write_raw(made, "record", folder, per_file=RECORDS_PER_FILE)


# --- reading --------------------------------------------------------------------------------


def members(source) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and data of the gzip members of a file that is open for reading."""
    offset, held = 0, b""
    while held := held or source.read(65_536):
        unpack = zlib.decompressobj(31)
        parts, fed = [], 0
        while not unpack.eof:
            if not held:
                raise ValueError("a record is cut off at the end of the file")
            parts.append(unpack.decompress(held))
            fed += len(held)
            held = unpack.unused_data if unpack.eof else source.read(65_536)
        length = fed - len(held)
        yield offset, length, b"".join(parts)
        offset += length


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of an uncompressed record; raises if it is not whole."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not re.fullmatch(r"WARC/1\.\d", lines[0]):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    length = int(headers["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length does not match its content")
    return headers, rest[:length].partition(b"\r\n\r\n")[2]


def _capture(headers: dict[str, str], payload: bytes) -> tuple:
    """Index fields of a record; a response's digest and size come from its own payload."""
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(headers["X-Payload-Bytes"])
    if headers["WARC-Type"] == "response":
        if (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    page_id, refers = headers["X-Page-Id"], headers.get("X-Refers-To-Page-Id")
    return (
        int(page_id) if page_id else None,
        size,
        digest,
        headers["WARC-Type"],
        int(refers) if refers else None,
    )


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


_CAPTURES = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)


_LOCATED = pa.schema([("block", pa.int64()), ("key", pa.string()), ("page_id", pa.int64())])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All captures of a folder of archives: ``key`` and the index fields, checked on the way."""
    schema = _CAPTURES.insert(0, pa.field("key", pa.string()))

    def indexed(name: str, source) -> Iterator[pa.RecordBatch]:
        rows = []
        for offset, length, data in members(source):
            if not data:  # the empty member that ends a very large record
                last = rows.pop()
                rows.append((*last[:-1], last[-1] + length))
                continue
            if len(rows) > 2000:  # the last one may go on
                yield _rows(rows[:-1], schema)
                del rows[:-1]
            headers, payload = parse_record(data)
            key = reversed_host_key(json.loads(headers["X-Page-Url"]))
            rows.append((key, *_capture(headers, payload), name, offset, length))
        yield _rows(rows, schema)

    def streamed(batches):
        for batch in batches:
            for name in batch.column("path").to_pylist():
                with open_file(name) as source:
                    yield from indexed(name, source)

    def whole(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                yield from indexed(path.as_py(), io.BytesIO(content.as_buffer()))

    fields = "key string, " + CAPTURE_SCHEMA
    if can_seek(folder):
        return map_batches(list_files(spark, folder), ["path"], streamed, fields)
    return map_batches(read_raw(spark, folder), ["path", "content"], whole, fields)


def build_index(captures: DataFrame) -> DataFrame:
    """Blocks of captures in key order: ``block, first_key, first_id, entry, lines``; staged.

    ``lines`` are the compressed captures. ``entry`` is the directory's key: as much of the
    first key as sets it above the last key of the block before.
    """
    captures = stage(captures)
    lines_per_block = max(BLOCK_LINES, -(-captures.count() // MAX_BLOCKS))
    # The place in the archives parts even captures of one url and id.
    order = ["key", "page_id", "path", "offset"]
    ordered = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def blocks(batches):
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        held, before, number = [], None, 0

        def closed():
            nonlocal before, number
            first, last = held[0], held[-1]
            shared = 0
            if before is not None:
                while shared < min(len(before), len(first[0])) and before[shared] == first[0][shared]:
                    shared += 1
            # The first block of a task keeps its whole key: the one before it is unknown here.
            entry = first[0] if before is None else first[0][: shared + 1]
            row = (base + number, entry, first[1], zlib.compress(json.dumps(held).encode()))
            before, number = last[0], number + 1
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in row[:1]]
                + [pa.array([row[1]], pa.string()), pa.array([row[2]], pa.int64())]
                + [pa.array([row[3]], pa.binary())],
                ["block", "entry", "first_id", "lines"],
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.append(row)
                if len(held) == lines_per_block:
                    yield closed()
        if held:
            yield closed()

    schema = "block bigint, entry string, first_id bigint, lines binary"
    return stage(map_batches(ordered, captures.columns, blocks, schema))


def _least(page_id) -> int:
    return -(1 << 63) if page_id is None else page_id  # nulls are sorted first


def lookup(index: DataFrame, requests: DataFrame) -> DataFrame:
    """The captures of the requested ``(page_id, url)`` rows; each request is answered once."""
    spark = index.sparkSession
    directory = index.select("entry", "first_id", "block").collect()  # at most MAX_BLOCKS
    # Blocks are in key order; the order by entry and id is the same, block by block.
    directory.sort(key=lambda row: row.block)
    entries = [(row.entry, _least(row.first_id)) for row in directory]
    shared = spark.sparkContext.broadcast((entries, [row.block for row in directory]))

    def located(batches):
        entries, numbers = shared.value
        for batch in batches:
            keys = [reversed_host_key(u) for u in batch.column("url").to_pylist()]
            ids = batch.column("page_id").to_pylist()
            found = []
            for key, page_id in zip(keys, ids, strict=True):
                own = (key, _least(page_id))
                # Equal captures may fill the end of one block and the start of the next ones.
                low = max(0, bisect.bisect_left(entries, own) - 1)
                for k in range(low, bisect.bisect_right(entries, own)):
                    found.append((numbers[k], key, page_id))
            yield _rows(found, _LOCATED)

    schema = "block bigint, key string, page_id bigint"
    asked = map_batches(requests, ["page_id", "url"], located, schema).distinct()
    # Distinct requests of a block are at most its lines, as each finds another capture there
    # (or none: such requests are spread over the blocks they would lie in).
    by_block = asked.groupBy("block").agg(
        F.collect_list(F.struct("key", "page_id")).alias("wanted")
    )

    def answered(batches):
        for batch in batches:
            columns = (batch.column("lines").to_pylist(), batch.column("wanted").to_pylist())
            for packed, wanted in zip(*columns, strict=True):
                lines = json.loads(zlib.decompress(packed))
                order = [(line[0], _least(line[1])) for line in lines]
                rows = []
                for request in wanted:
                    own = (request["key"], _least(request["page_id"]))
                    for k in range(bisect.bisect_left(order, own), len(order)):
                        if order[k] != own:
                            break
                        rows.append(tuple(lines[k][1:]))
                yield _rows(rows, _CAPTURES)

    joined = index.select("block", "lines").join(by_block, "block")
    return map_batches(joined, ["lines", "wanted"], answered, CAPTURE_SCHEMA)


Located = tuple[str, int, int, str]  # path, offset, length, payload digest


def read_ranges(
    wanted: Iterable[Located], opener: Callable = open_file
) -> Iterator[tuple[tuple, bytes]]:
    """Index fields and payload of each wanted record, given in order of path and offset.

    Records that follow each other are read at once; nothing else of a file is read.
    """
    opened, source = None, None
    run: list[Located] = []

    def records():
        nonlocal opened, source
        path, start = run[0][0], run[0][1]
        if path != opened:
            if source is not None:
                source.close()
            opened, source = path, opener(path)
        source.seek(start)
        data = source.read(run[-1][1] + run[-1][2] - start)
        for _, offset, length, digest in run:
            own = data[offset - start : offset - start + length]
            headers, payload = parse_record(gzip.decompress(own))
            fields = _capture(headers, payload)
            if fields[2] != digest:
                raise ValueError(f"{path} holds another record at byte {offset}")
            yield fields, payload
        run.clear()

    for row in wanted:
        if run:
            path, offset, length, _ = run[-1]
            follows = row[0] == path and row[1] == offset + length
            if not follows or row[1] + row[2] - run[0][1] > RANGE_BYTES:
                yield from records()
        run.append(row)
    if run:
        yield from records()
    if source is not None:
        source.close()


def fetch(
    spark: SparkSession, folder: str, captures: DataFrame, *, with_payload: bool = True
) -> DataFrame:
    """The captures as their records say: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to`` and, with ``with_payload``, ``payload`` (of revisits an empty one).

    ``captures`` are distinct rows of :func:`lookup`. Every record is read by its offset and
    length; a response's digest is taken from its payload, and must be that of the index.
    Stretches of an archive are dealt out, so that a large one is read by many tasks.
    """
    fields = list(_CAPTURES)[:5] + [pa.field("payload", pa.binary())] * with_payload
    schema = pa.schema(fields)

    def listed(records):
        rows, held = [], 0
        for record_fields, payload in records:
            rows.append((*record_fields, payload)[: len(schema)])
            held += len(payload) if with_payload else 0
            if held > BATCH_BYTES or len(rows) == 5000:
                yield _rows(rows, schema)
                rows, held = [], 0
        yield _rows(rows, schema)

    def located(batches):
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in places], strict=True)

    def ranged(batches):
        yield from listed(read_ranges(located(batches)))

    def cut(batches):
        for batch in batches:
            wanted = batch.column("ranges").to_pylist()
            for content, ranges in zip(batch.column("content"), wanted, strict=True):
                own = sorted(tuple(r[c] for c in places) for r in ranges)
                source = io.BytesIO(content.as_buffer())
                yield from listed(read_ranges(own, lambda _: source))

    places = ["path", "offset", "length", "payload_digest"]
    out = CAPTURE_SCHEMA.partition(", path")[0] + ", payload binary" * with_payload
    own = captures.select(*places)
    if can_seek(folder):
        stretch = F.expr(f"offset div {STRETCH_BYTES}")
        dealt = own.repartition("path", stretch).sortWithinPartitions("path", "offset")
        return map_batches(dealt, places, ranged, out)
    # At most as many ranges as an archive has records.
    by_file = own.groupBy("path").agg(F.collect_list(F.struct(*places)).alias("ranges"))
    files = read_raw(spark, folder).join(by_file, "path")
    return map_batches(files, ["content", "ranges"], cut, out)


def read_captures(spark: SparkSession, folder: str, captures: DataFrame) -> DataFrame:
    """Payloads of captures: ``page_id, payload``; revisits have an empty one."""
    return fetch(spark, folder, captures).select("page_id", "payload")
