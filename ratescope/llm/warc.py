"""Deterministic sharded WARC archives, written and read back by Spark tasks.

Every record gets a 64-bit key from its page; equal ranges of that key are the shards, so shards are even whatever ids
and addresses look like, and a page always lands in the same one. A shard's records are sorted by key and rolled into
gzip files (one member per record) of about ``roll_bytes`` compressed. A file is written under a temporary name in the
target folder and renamed when it is complete; its name and bytes depend on the records alone, so a task that runs
twice replaces a file by the same file. The manifest, a Parquet table that Spark commits last, says which files count.

Of records with equal payloads of at least ``revisit_from`` bytes, the one with the smallest page_id is the response and
the others are revisits that name it. Null html is an empty payload. Rows that repeat the smallest page_id are all
responses. A null page_id is larger than any other; if a payload has no other, its records are responses. Null
addresses are written empty. A table without rows gives an empty manifest and no records. Columns other than page_id,
url and html are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescope.llm.common import few_rows, utf8, write_stage

SHARD_BYTES = 16 << 20
ROLL_BYTES = 4 << 20
#: Archives hold no clock time, or a second run would differ.
RECORD_DATE = "2000-01-01T00:00:00Z"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:ratescope:warc")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_MANIFEST = "file string, shard bigint, part int, n_records bigint, n_bytes bigint, sha256 string"
_RECORDS = (
    "page_id bigint, url string, record_type string, record_id string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(page_id, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{payload_digest}')}>"


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1"] + [f"{k}: {v}" for k, v in fields if v is not None]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n"


def _member(block: bytes) -> bytes:
    """One gzip member; the format's time field stays 0."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(block) + pack.flush()


def _one_line(text) -> str:
    return quote(text, safe="!#$%&'()*+,/:;=?@[]~-._") if isinstance(text, str) else ""


def build_record(page_id, url, payload: bytes | None, n_bytes: int, payload_digest: str, first) -> bytes:
    """A response with its payload, or a revisit (``payload`` None) of page ``first``."""
    http = _HTTP % n_bytes
    block = http + (payload or b"")
    fields = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", _record_id(page_id, payload_digest)),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Payload-Length", n_bytes),
        ("Page-ID", page_id),
    ]
    if payload is None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(first, payload_digest)),
            ("Refers-To-Page-ID", first),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return _member(_header(fields) + block + b"\r\n\r\n")


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


class _Roll:
    """Collects members and commits them as one file of the shard."""

    def __init__(self, folder: str, shard: int, part: int):
        self.name, self.shard, self.part = f"shard-{shard:06d}-{part:05d}.warc.gz", shard, part
        self.folder, self.members, self.size = folder, [], 0

    def add(self, member: bytes) -> None:
        self.members.append(member)
        self.size += len(member)

    def commit(self) -> tuple:
        content = b"".join(self.members)
        store, root = _store(self.folder)
        store.create_dir(f"{root}/_temporary-warc", recursive=True)
        unfinished = f"{root}/_temporary-warc/{self.name}.{uuid.uuid4().hex}"
        with store.open_output_stream(unfinished, compression=None) as out:
            out.write(content)
        store.move(unfinished, f"{root}/{self.name}")
        return self.name, self.shard, self.part, len(self.members), len(content), hashlib.sha256(content).hexdigest()


def _write_shards(folder: str, roll_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll, done = None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                shard = int(row.shard)
                if roll is not None and (roll.shard != shard or roll.size >= roll_bytes):
                    done.append(roll.commit())
                    roll = _Roll(folder, shard, roll.part + 1 if roll.shard == shard else 0)
                if roll is None:
                    roll = _Roll(folder, shard, 0)
                page = None if pd.isna(row.page_id) else int(row.page_id)
                first = None if pd.isna(row.first) else int(row.first)
                roll.add(build_record(page, row.url, None if row.revisit else utf8(row.html), int(row.n_bytes),
                                      base64.b32encode(bytes.fromhex(row.sha1)).decode("ascii"), first))
        if roll is not None:
            done.append(roll.commit())
        yield pd.DataFrame(done, columns=["file", "shard", "part", "n_records", "n_bytes", "sha256"])

    return run


def records(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Pages with payload size, digest, the page they repeat and their sort key; revisits no longer carry html."""
    html = F.coalesce(F.col("html"), F.lit(""))
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha1"), F.sha2(html, 256).alias("sha2"), F.octet_length(html).cast("long").alias("n_bytes"),
    )
    first = named.where(F.col("n_bytes") >= revisit_from).groupBy("sha2").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = write_stage(first.where(F.col("n") > 1).select(F.col("sha2").alias("_sha2"), "first"), "warc-repeated")
    joined = named.join(few_rows(repeated), F.col("sha2") == F.col("_sha2"), "left")
    revisit = F.coalesce(F.col("first") != F.col("page_id"), F.col("first").isNotNull() & F.col("page_id").isNull())
    return joined.withColumn("revisit", revisit).select(
        "page_id", "url", F.when(~F.col("revisit"), F.col("html")).alias("html"), "sha1", "n_bytes", "revisit",
        F.when(F.col("revisit"), F.col("first")).alias("first"), F.xxhash64("page_id", "url", "sha2").alias("key"),
    )


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, revisit_from: int = 0) -> DataFrame:
    """Write the archives of ``pages`` into ``folder`` and return the committed manifest."""
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    # The key's upper 52 bits as a share of the whole range, in doubles, exact and the same everywhere.
    place = (F.shiftright("key", 12) + F.lit(1 << 51)).cast("double") / float(1 << 52)
    dealt = (
        records(pages, revisit_from).withColumn("shard", F.floor(place * shards))
        .repartition(shards, "shard").sortWithinPartitions("shard", "key", "page_id", "url")
    )
    target = f"{folder}/manifest"
    dealt.mapInPandas(_write_shards(folder, roll_bytes), _MANIFEST).write.mode("overwrite").parquet(target)
    return pages.sparkSession.read.schema(_MANIFEST).parquet(target)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and HTTP payload of every record of an archive; digests are checked."""
    rest = content
    while rest:
        unpack = zlib.decompressobj(31)
        raw = unpack.decompress(rest) + unpack.flush()
        rest = unpack.unused_data
        head, _, body = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
        block = body[: int(fields["Content-Length"])]
        if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        payload = block.partition(b"\r\n\r\n")[2]
        if fields["WARC-Type"] == "response" and f"sha1:{digest(payload)}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        yield fields, payload


def _read_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    number = lambda text: None if text is None else int(text)
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for fields, payload in parse_records(bytes(content)):
                kind = fields["WARC-Type"]
                rows.append((
                    number(fields.get("Page-ID")), fields["WARC-Target-URI"], kind, fields["WARC-Record-ID"],
                    int(fields["Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                    number(fields.get("Refers-To-Page-ID")), payload if kind == "response" else None,
                ))
            out = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "record_id", "payload_bytes", "payload_digest", "refers_to", "payload"])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the files that the manifest in ``folder`` names; files are small enough to be read whole."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").select(F.col("file").alias("_file"), "n_bytes")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    named = found.withColumn("_name", F.element_at(F.split("path", "/"), -1))
    listed = named.join(manifest, F.col("_name") == F.col("_file"))
    return listed.select("content").mapInPandas(_read_files, _RECORDS)
