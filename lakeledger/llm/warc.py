"""WARC archives: writing, normalising whole-file gzip streams to one member per record, reading by index."""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.session import cut_lineage, scratch_table

LEAST_REVISIT = 1000  # bytes; smaller payloads are always stored
ARCHIVE_BYTES = 64 << 20  # payload bytes after which a writer begins its next file
READ = 1 << 20
TASK_BYTES = 8 << 20  # compressed bytes that one task reads back, about
MOST_TASKS = 20_000
LEVEL = 1
INDEX = "path string, page_id long, record_type string, offset long, length long"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark resolves it by; a bare path is one of the default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _open(folder: str):
    """File system and path of a qualified folder, which driver and executors share: ``file:/x``, ``file:///x`` or another scheme."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")) if folder.startswith("file:") else fs.FileSystem.from_uri(folder)


def record(page_id: int, url: str | None, kind: str, refers_to: int | None, digest: str, payload: bytes) -> bytes:
    """One WARC 1.1 record; a revisit carries headers only."""
    body = b"" if kind == "revisit" else payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z",
            "WARC-Target-URI: " + " ".join((url or "").split()), f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(x.split(": ", 1) for x in lines[1:] if x)


def number(urn: str | None) -> int | None:
    return None if urn is None else int(urn.removeprefix("<urn:page:").removesuffix(">"))


def inflated(source) -> Iterator[bytes]:
    """The uncompressed bytes of a gzip file, which may have one member or many, read once from start to end."""
    engine = zlib.decompressobj(31)
    while data := source.read(READ):
        while data:
            yield engine.decompress(data)
            data = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(31)


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Cut a stream of bytes into records, holding no more than the current record and a chunk."""
    held = bytearray()
    head, need = None, 0
    for chunk in chunks:
        held += chunk
        while True:
            if head is None:
                if (end := held.find(b"\r\n\r\n")) < 0:
                    break
                head = headers(bytes(held[:end]))
                need = end + 4 + int(head["Content-Length"]) + 4
            if len(held) < need:
                break
            yield head, bytes(held[:need])
            del held[:need]
            head = None
    if held:
        raise ValueError("the archive ends inside a record")


def normalise(source, target) -> Iterator[tuple[int, str, int, int]]:
    """Inflate ``source`` once and write every record to ``target`` as its own gzip member; gives page id, record
    type, offset and length of each member."""
    offset = 0
    for head, data in records(inflated(source)):
        member = gzip.compress(data, LEVEL, mtime=0)
        target.write(member)
        yield number(head["WARC-Record-ID"]), head["WARC-Type"], offset, len(member)
        offset += len(member)


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to`` of every page.

    Equal payloads of at least ``LEAST_REVISIT`` bytes: the one with the largest page_id is the response and the
    others revisit it. A null html is an empty payload; rows without a page_id cannot be named and are left out.
    Rows that repeat a page_id are a record each; a revisit's target is found by page_id and digest.
    """
    rows = (pages.where(F.col("page_id").isNotNull())
            .select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
            .withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload")))
    firsts = (rows.where(F.col("size") >= LEAST_REVISIT).groupBy("digest", "size")
              .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = rows.join(firsts, ["digest", "size"], "left")
    other = F.col("holder") != F.col("page_id")
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(other, "revisit").otherwise("response").alias("record_type"),
                         F.when(other, F.col("holder")).alias("refers_to"))


def write_archives(plan: DataFrame, folder: str) -> DataFrame:
    """Write the records as monolithic archives (one gzip stream a file) below ``folder``; gives their paths.

    A task writes its rows in the order it reads them, a file at a time, and begins a new file after
    ``ARCHIVE_BYTES``. File names are new in each attempt: files of lost attempts are not in the result.
    """
    folder = qualified(plan.sparkSession, folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        name, sink, engine, size = None, None, None, 0
        try:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    if sink is None:
                        name, engine, size = f"{uuid.uuid4().hex}.warc.gz", zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                        sink = fs.open_output_stream(f"{base}/{name}", compression=None)
                    refers = None if pd.isna(row.refers_to) else int(row.refers_to)
                    sink.write(engine.compress(record(row.page_id, row.url, row.record_type, refers, row.digest, row.payload)))
                    size += len(row.payload)
                    if size >= ARCHIVE_BYTES:
                        sink.write(engine.flush())
                        sink.close()
                        sink = None
                        yield pd.DataFrame({"path": [f"{folder}/{name}"]})
            if sink is not None:
                sink.write(engine.flush())
                sink.close()
                sink = None
                yield pd.DataFrame({"path": [f"{folder}/{name}"]})
        finally:
            if sink is not None:
                sink.close()

    return plan.select("page_id", "url", "payload", "digest", "record_type", "refers_to").mapInPandas(write, "path string")


def tasks(wanted: int) -> int:
    """A number of partitions to ask for; each of more than ``MOST_TASKS`` holds several files."""
    return max(1, min(wanted, MOST_TASKS))


def normalise_archives(paths: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive below ``folder`` with one gzip member a record, next to a sidecar ``.idx`` file of tab
    separated page id, type, offset and length; gives the same index as rows (``INDEX``)."""
    folder = qualified(paths.sparkSession, folder)

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, base = _open(folder)
        out.create_dir(base, recursive=True)
        for batch in batches:
            for path in batch["path"]:
                fs, at = _open(path)
                name = f"{uuid.uuid4().hex}.warc.gz"
                with fs.open_input_stream(at, compression=None) as source, \
                        out.open_output_stream(f"{base}/{name}", compression=None) as target, \
                        out.open_output_stream(f"{base}/{name}.idx") as sidecar:
                    held = []
                    for row in normalise(source, target):
                        sidecar.write(("\t".join(map(str, row)) + "\n").encode())
                        held.append((f"{folder}/{name}", *row))
                        if len(held) == 10_000:
                            yield pd.DataFrame(held, columns=["path", "page_id", "record_type", "offset", "length"])
                            held = []
                    if held:
                        yield pd.DataFrame(held, columns=["path", "page_id", "record_type", "offset", "length"])

    # A range of one path each, by number: rows are tiny, so that by their size all of them would go to one task.
    return paths.repartitionByRange(tasks(paths.count()), "path").mapInPandas(rewrite, INDEX)


def read_records(index: DataFrame) -> DataFrame:
    """Read single records by their index rows: ``page_id, record_type, refers_to, digest`` as its headers say, the
    ``payload`` (null for a revisit) and its SHA-1 as read."""
    schema = "page_id long, record_type string, refers_to long, digest string, payload binary, payload_digest string"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, source = None, None
        try:
            for batch in batches:
                out, held = [], 0
                for row in batch.itertuples(index=False):
                    if row.path != path:
                        if source is not None:
                            source.close()
                        fs, at = _open(row.path)
                        path, source = row.path, fs.open_input_file(at)
                    source.seek(row.offset)
                    data = zlib.decompress(source.read(row.length), 31)
                    end = data.index(b"\r\n\r\n")
                    head = headers(data[:end])
                    kind, body = head["WARC-Type"], data[end + 4:end + 4 + int(head["Content-Length"])]
                    out.append((number(head["WARC-Record-ID"]), kind, number(head.get("WARC-Refers-To")),
                                head["WARC-Payload-Digest"].removeprefix("sha1:"), None if kind == "revisit" else body,
                                None if kind == "revisit" else hashlib.sha1(body).hexdigest()))
                    held += len(body)
                    if held > 8 << 20:
                        yield frame(out)
                        out, held = [], 0
                yield frame(out)
        finally:
            if source is not None:
                source.close()

    def frame(rows):
        df = pd.DataFrame(rows, columns=["page_id", "record_type", "refers_to", "digest", "payload", "payload_digest"])
        return df.astype({"refers_to": "Int64"})

    size = index.agg(F.sum("length")).first()[0] or 0
    return (index.select("path", "offset", "length").repartitionByRange(tasks(-(-size // TASK_BYTES)), "path", "offset")
            .sortWithinPartitions("path", "offset").mapInPandas(read, schema))


def archive(pages: DataFrame) -> DataFrame:
    """Write, normalise and index the pages below the shared folder; gives the index rows."""
    spark = pages.sparkSession
    root = scratch_table(spark, "warc")
    written = cut_lineage(write_archives(plan_records(pages), f"{root}/monolithic"))
    return cut_lineage(normalise_archives(written, f"{root}/normal"))


def read_back(index: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` as the archives say.

    A revisit's length and digest are those of the response it refers to. Fails if a stored payload does not have
    the digest in its header, or if a revisit's differs from its response's.
    """
    rows = cut_lineage(read_records(index).select(
        "page_id", "record_type", "refers_to", "digest", F.length("payload").cast("long").alias("n"), "payload_digest"))
    wanted = rows.where("record_type = 'revisit'").select("refers_to", "digest").distinct()
    stored = (rows.where("record_type = 'response'")
              .select(F.col("page_id").alias("refers_to"), "digest", F.col("n").alias("there"), F.col("payload_digest").alias("digest_there"))
              .join(wanted, ["refers_to", "digest"], "left_semi").distinct())
    joined = rows.join(stored, ["refers_to", "digest"], "left")
    found = F.coalesce("payload_digest", "digest_there")
    checked = F.when(found == F.col("digest"), found).otherwise(F.raise_error(F.concat(F.lit("payload digest differs in page "), F.col("page_id").cast("string"))))
    return joined.select("page_id", F.coalesce("n", "there").alias("payload_bytes"), checked.alias("payload_digest"), "record_type", "refers_to")
