"""A deterministic sharded WARC writer and its reader.

Pages are range-sorted by id and digest. Each range is a shard, written as one or more files that roll by compressed
size; every record is a gzip member of its own. The bounds of the shards are counted over all pages, not sampled, and
headers, record ids and digests depend on the page alone, so a rerun writes the same files. A task writes under temporary names and reports its files; what Spark kept of the reports is the manifest, and
only files in it get their names.

Equal payloads are found on digests. The decision that a page is a revisit is a narrow row that is sorted in before the
page it speaks of, so page bodies cross the network once.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import commit_file, open_shared, staged, text_of
from tidewater.operators.skew import hot_join
from tidewater.session import new_dir

#: Fixed values of the format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

#: Bytes of a record beside its payload, for sizing, and shards at most: their bounds go to every task.
HEAD_BYTES, SHARDS = 500, 20_000

MANIFEST = "shard int, part int, records long, bytes long, crc32 long, temporary string, file string"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{sha1}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP head only."""
    sha1 = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or f"urn:page:{page_id}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, sha1.hexdigest())}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1.digest()).decode()}",
        f"WARC-Block-Digest: {_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"Page-Id: {'' if page_id is None else page_id}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, sha1.hexdigest())}", f"Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def file_head(name: str) -> bytes:
    body = b"software: tidewater\r\nformat: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>\r\nWARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member without a time, so that equal data give equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """``page_id, sha256, refers_to`` of every page that repeats the payload of a page with a larger id."""
    narrow = staged(pages.sparkSession, pages.filter(F.col("bytes") >= least).select("page_id", "sha256"), "warc-digests")
    groups = narrow.groupBy(F.col("sha256").alias("group")).agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    groups = groups.filter((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n")
    later = F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to"))
    return hot_join(narrow, groups, {"sha256": "group"}).filter(later).select("page_id", "sha256", "refers_to").distinct()


def shard_bounds(pages: DataFrame, shard_bytes: int) -> list[tuple]:
    """The first ``(page_id, sha256)`` of every shard, from the bytes of all pages in order.

    A key that fills shards of its own stands there several times. The bytes before a page are those of the files before
    and of the rows before in its file of a range sort, so the bounds follow from the pages alone and not from a sample.
    """
    spark = pages.sparkSession
    order = [F.col("page_id").asc_nulls_first(), F.col("sha256")]
    dealt = pages.select("page_id", "sha256", (F.col("bytes") + HEAD_BYTES).alias("bytes"))
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    path = new_dir(spark, "warc-order")
    dealt.write.option("maxRecordsPerFile", 0).parquet(path)
    files = spark.read.schema(dealt.schema).parquet(path).withColumn("at", F.col("_metadata.row_index"))
    parts = files.groupBy(F.col("part").alias("of_part")).agg(F.sum("bytes").alias("n"))  # one row per file
    before = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("of_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("inner", F.coalesce(F.sum("bytes").over(within), F.lit(0))).join(offsets, F.col("part") == F.col("of_part"))
    size = F.greatest(F.lit(shard_bytes), F.ceil(F.col("total") / SHARDS))
    shard = F.floor((F.col("offset") + F.col("inner")) / size)
    first = placed.groupBy(shard.alias("shard")).agg(F.min_by(F.struct("page_id", "sha256"), F.struct("part", "at")).alias("key"))
    return [_rank(r.key.page_id, r.key.sha256) for r in first.orderBy("shard").select("key").collect()]


def _rank(page_id: int | None, sha256: str) -> tuple:
    return (page_id is not None, page_id or 0, sha256)


def _dealt(rows: DataFrame, bounds: list[tuple]) -> DataFrame:
    """Rows sorted in their shards; rows of a key that has several shards are spread over them, its mark goes to all."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            at, shard = [], []
            for i, (page_id, sha256, kind) in enumerate(zip(*[batch[c].to_pylist() for c in ("page_id", "sha256", "kind")])):
                key = _rank(page_id, sha256)
                high = max(0, bisect_right(bounds, key) - 1)
                low = min(high, bisect_left(bounds, key))
                mine = range(low, high + 1) if kind == 0 else (low + turn % (high - low + 1),)
                turn += 1
                for n in mine:
                    at.append(i)
                    shard.append(n)
            yield batch.take(pa.array(at, pa.int64())).append_column("shard", pa.array(shard, pa.int32()))

    marked = rows.mapInArrow(deal, ", ".join(f"{n} {t}" for n, t in kinds.items()) + ", shard int")
    return marked.repartitionById(max(1, len(bounds)), F.col("shard")).drop("shard").sortWithinPartitions(F.col("page_id").asc_nulls_first(), "sha256", "kind", "url")


def write_warc(
    df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", file_bytes: int = 64 << 20, least: int = 1000, shard_bytes: int = 16 << 20
) -> DataFrame:
    """Write the archives into ``folder`` and give their manifest, one row per file.

    Shards of about ``shard_bytes``, more where that would be over ``SHARDS`` of them, follow from the pages alone, so the
    same files come out of every run.
    """
    html = text_of(html_col)
    pages = df.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        html.cast("binary").alias("payload"),
        F.sha2(html, 256).alias("sha256"),
        F.octet_length(html).cast("long").alias("bytes"),
    )
    marks = revisits(pages, least)
    rows = pages.select("page_id", "sha256", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("refers_to"))
    rows = rows.unionByName(marks.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        fs, base = open_shared(folder)
        out, files, mark = None, [], None
        for batch in batches:
            columns = [batch[c] for c in ("page_id", "sha256", "kind", "url", "payload", "refers_to")]
            for at in range(batch.num_rows):
                page_id, sha256, kind, url, payload, refers_to = (c[at].as_py() for c in columns)
                if kind == 0:
                    mark = (page_id, sha256, refers_to)
                    continue
                revisit = mark is not None and mark[:2] == (page_id, sha256)
                member = gzip_member(make_record(page_id, url, payload, mark[2] if revisit else None, revisit))
                if out is not None and files[-1]["bytes"] + len(member) > file_bytes:
                    out.close()
                    out = None
                if out is None:
                    name = f"pages-{shard:06d}-{len(files):04d}.warc.gz"
                    temporary = f"{base}/_temporary/{name}.{uuid.uuid4().hex}"
                    fs.create_dir(f"{base}/_temporary", recursive=True)
                    out = fs.open_output_stream(temporary, compression=None)
                    files.append({"shard": shard, "part": len(files), "records": 0, "bytes": 0, "crc32": 0, "temporary": temporary, "file": f"{base}/{name}"})
                    member = gzip_member(file_head(name)) + member
                out.write(member)
                last = files[-1]
                last["records"] += 1
                last["bytes"] += len(member)
                last["crc32"] = zlib.crc32(member, last["crc32"])
        if out is not None:
            out.close()
        if files:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in files], k) for n, k in zip(names, kinds)], names)

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_shared(folder)
        for batch in batches:
            for temporary, final in zip(batch["temporary"].to_pylist(), batch["file"].to_pylist()):
                commit_file(fs, temporary, final)
            yield batch

    spark = df.sparkSession
    dealt = _dealt(rows, shard_bounds(pages, shard_bytes))
    report = staged(spark, dealt.mapInArrow(work, MANIFEST), "warc-report")
    report.mapInArrow(commit, report.schema).drop("temporary").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], stream.read(1 << 20)
    while data:
        parts.append(unpack.decompress(data))
        data = unpack.unused_data if unpack.eof else b""
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
        data = data or stream.read(1 << 20)
    if parts and any(parts):
        raise ValueError("cut archive")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("record length")
    return fields, rest[:length]


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page record: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``.

    Block digests, and payload digests of responses, are checked; the payload of a revisit is null.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_shared(folder)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

        def flush(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path in batch["file"].to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for data in members(stream):
                        fields, block = parse_record(data)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        if _digest(block) != fields["WARC-Block-Digest"]:
                            raise ValueError(f"block digest in {path}")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        revisit = fields["WARC-Type"] == "revisit"
                        if not revisit and (len(payload) != size or _digest(payload) != fields["WARC-Payload-Digest"]):
                            raise ValueError(f"payload digest in {path}")
                        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        page_id, refers_to = fields["Page-Id"], fields.get("Refers-To-Page-Id")
                        rows.append((int(page_id) if page_id else None, fields["WARC-Target-URI"], size, digest, fields["WARC-Type"], int(refers_to) if refers_to else None, None if revisit else payload))
                        held += len(payload)
                        if held > 8 << 20:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)

    manifest = spark.read.parquet(f"{folder}/manifest").select("file")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    # a manifest is small, so its bytes say nothing about the work: the number of tasks follows the files
    return manifest.repartition(max(1, manifest.count()), "file").mapInArrow(work, schema)


def archive(df: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write pages as WARC files and read them back.

    Of records with equal payloads of at least ``least`` bytes, that with the largest id is the response and the others
    revisit it. Null html is an empty payload; a null url becomes a name made of the id; a null id comes first, and
    revisits any page with an id. Rows that repeat the largest id of a group are all responses. An empty table gives an
    empty result; other columns are ignored.
    """
    spark = df.sparkSession
    folder = folder or new_dir(spark, "warc")
    write_warc(df, folder, **options)
    return read_warc(spark, folder)
