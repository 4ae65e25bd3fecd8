"""Deterministic WARC archives of pages, written in shards, and their reader.

Records are ordered by page id and dealt to shards by ranges of ids; the bounds of the
ranges come from a fixed hash sample, so the same pages always give the same files. A task
writes its shard as files of gzip members, one for each record, and begins a new file when
the compressed size is reached. Headers, record ids and digests are made anew from the payload.
Files are written under temporary names and moved into place; the manifest, written last,
names the files that count, with their sizes and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared_files import committed, located
from .tables import python_tasks, saved

ROLL_BYTES = 64 << 20
SHARD_ROWS = 2000
SAMPLE = 20_000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-records")


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member; ``refers_to`` makes it a revisit without payload."""
    uri = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "")
    sha = digest(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    kind = "revisit" if refers_to is not None else "response"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {uri} {sha}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri or 'urn:page:' + str(page_id)}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _bounds(ids: DataFrame) -> list[int]:
    """First ids of the shards after the first, from at most about ``SAMPLE`` sampled ids.

    Rows are chosen by a hash of the id, so the choice depends on the table alone.
    """
    total = ids.count()
    keep = min(1.0, SAMPLE / max(1, total))
    chosen = ids.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) < F.lit(round(keep * (1 << 20))))
    found = sorted(r.page_id for r in chosen.limit(2 * SAMPLE).collect()) if total else []
    shards = min(-(-total // SHARD_ROWS), SAMPLE // 5, max(1, len(found)))
    return sorted({found[k * len(found) // shards] for k in range(1, shards)})


def _shard(page_id: Column, bounds: list[int]) -> Column:
    """Number of bounds up to the id, searched in groups of about the root of their number."""
    if not bounds:
        return F.lit(0)
    step = int(len(bounds) ** 0.5) + 1
    groups = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    listed = [F.array(*[F.lit(b).cast("bigint") for b in g]) for g in groups]
    if len(groups) == 1:
        return F.coalesce(F.size(F.filter(listed[0], lambda b: b <= page_id)), F.lit(0))
    heads = F.array(*[F.lit(g[0]).cast("bigint") for g in groups[1:]])
    group = F.size(F.filter(heads, lambda b: b <= page_id))
    within = F.size(F.filter(F.get(F.array(*listed), group), lambda b: b <= page_id))
    return F.coalesce(F.when(page_id.isNotNull(), group * step + within), F.lit(0))


def first_pages(sums: DataFrame, min_bytes: int) -> DataFrame:
    """``(page_id, sha, refers_to)`` of all pages whose payload an earlier page has.

    ``sums`` has ``page_id``, ``sha`` and ``size``. Groups of equal payloads are reduced
    before the shuffle, and only groups of two or more are joined.
    """
    groups = (
        sums.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("sha", "size")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    return sums.join(groups, ["sha", "size"]).where(F.col("page_id") > F.col("refers_to")).select("page_id", "sha", "refers_to")


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Writes archives under ``folder``; returns the manifest ``(file, n_records, bytes, sha)``.

    Of pages with equal payloads of at least ``min_bytes`` bytes, that with the
    smallest id becomes a response and the others revisits of it. A null html is an empty payload; a null
    id is written first and never a revisit; rows with equal ids are each a record.
    An empty table gives no file; other columns are not written. Pages are shuffled once;
    revisit decisions travel to the same shards as rows without payload.
    """
    spark = pages.sparkSession
    python_tasks(spark, 200)
    chosen = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    )
    sums = saved(
        chosen.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size")), "page-sums"
    )
    bounds = _bounds(sums.select("page_id").where(F.col("page_id").isNotNull()))
    rows = (
        chosen.withColumns({"sha": F.sha1("payload"), "refers_to": F.lit(None).cast("bigint")})
        .unionByName(first_pages(sums, min_bytes), allowMissingColumns=True)
        .withColumn("shard", _shard(F.col("page_id"), bounds))
    )
    dealt = rows.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "page_id", "sha", F.desc_nulls_last("refers_to"), "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _rolled(_decided(batches), folder, roll_bytes)
        for name, n, size, sha in files:
            yield pa.record_batch({"file": [name], "n_records": [n], "bytes": [size], "sha": [sha]})

    manifest = dealt.mapInArrow(write, "file string, n_records bigint, bytes bigint, sha string")
    return saved(manifest, "warc-manifest")


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """Shard and record of each page; a decision row comes right before the pages it is about."""
    known = None
    for batch in batches:
        columns = [batch[c] for c in ("shard", "page_id", "url", "payload", "sha", "refers_to")]
        for k in range(batch.num_rows):
            shard, page_id, url, payload, sha, refers_to = (c[k].as_py() for c in columns)
            if payload is None:
                known = page_id, sha, refers_to
            else:
                decided = known is not None and known[:2] == (page_id, sha)
                yield shard, record(page_id, url, payload, known[2] if decided else None)


def _rolled(records: Iterator[tuple[int, bytes]], folder: str, roll_bytes: int) -> Iterator[tuple[str, int, int, str]]:
    """Writes records to files that end with their shard or when they are full."""
    after = next(records, None)
    shard, part = None, 0
    while after:
        part = part + 1 if after[0] == shard else 0
        shard = after[0]
        path, n, size, sha = f"{folder}/pages-{shard:05d}-{part:05d}.warc.gz", 0, 0, hashlib.sha1()
        with committed(path) as sink:
            while after and after[0] == shard and (not n or size + len(after[1]) <= roll_bytes):
                sink.write(after[1])
                sha.update(after[1])
                n, size = n + 1, size + len(after[1])
                after = next(records, None)
        yield path, n, size, sha.hexdigest()


def _members(path: str) -> Iterator[bytes]:
    """The uncompressed records of a file, one at a time."""
    system, place = located(path)
    with system.open_input_stream(place, compression=None) as source:
        data = b""
        while data or (data := source.read(1 << 20)):
            unpacker, parts = zlib.decompressobj(31), []
            while not unpacker.eof:
                parts.append(unpacker.decompress(data))
                data = unpacker.unused_data if unpacker.eof else source.read(1 << 20)
                if not unpacker.eof and not data:
                    raise ValueError(f"{path} ends within a record")
            yield b"".join(parts)


def parse(data: bytes) -> dict:
    """Headers and payload of a record; its block digest is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError("not a record, or a damaged one")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response" and (len(payload) != size or fields["WARC-Payload-Digest"] != f"sha1:{digest(payload)}"):
        raise ValueError("damaged payload")
    return fields | {"payload": payload, "payload_bytes": size}


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """A row for each record of the files in ``manifest``; a damaged record is an error.

    Without ``payloads`` they are checked but not returned.
    """
    spark = manifest.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["file"].to_pylist():
                held = []
                for data in _members(path):
                    r = parse(data)
                    page, refers = r.get("X-Page-Id"), r.get("X-Refers-To-Page-Id")
                    held.append(
                        {
                            "page_id": int(page) if page else None,
                            "url": r["WARC-Target-URI"],
                            "record_type": r["WARC-Type"],
                            "payload_bytes": r["payload_bytes"],
                            "payload_digest": r["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "refers_to": int(refers) if refers else None,
                            "payload": r["payload"] if payloads else b"",
                        }
                    )
                    if sum(len(x["payload"]) for x in held[-100:]) > 1 << 22 or len(held) == 100:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )
    python_tasks(spark)
    files = manifest.select("file").repartition(spark.sparkContext.defaultParallelism * 4, "file")
    return files.mapInArrow(
        read,
        "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
        "refers_to bigint, payload binary",
    )
