"""WARC archives: a deterministic sharded writer, and a reader of what it wrote.

Records are sorted by page and digest and dealt to shards of about equal bytes, by
ranges that depend on the data alone. A task writes one shard: records as
gzip members of their own, a new file as soon as the compressed size reaches the
limit. Files are written under a name of the attempt and renamed to the name of their
content, so a second attempt replaces a file with the same bytes. The manifest, written
last, names the files that count.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.scratch import materialize, scratch_path

FILE_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
CUT_ROWS = 64  # rows of a hash sample for each shard, from which the shards' bounds are taken
HEADER_BYTES = 400  # of a record, about
CONTROL = re.compile("[\\x00-\\x1f\\x7f]")
FIXED_DATE = "2025-01-01T00:00:00Z"  # a real date would make every run's bytes differ


class Manifest(NamedTuple):
    folder: str
    files: DataFrame  # file, records, bytes, sha1


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if re.match(r"\w+:", folder) else (fs.LocalFileSystem(), folder)


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def encode_record(page_id, url, payload: bytes, n_bytes: int, digest: str, refers_to) -> bytes:
    """One record: header lines, an empty line, the payload of a response, two line ends."""
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    head += [f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {FIXED_DATE}"]
    if url is not None:  # what could end a header line is escaped
        head.append("WARC-Target-URI: " + CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Bytes: {n_bytes}"]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if revisit else len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + (b"" if revisit else payload) + b"\r\n\r\n"


def decode_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *fields = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    header = dict(line.split(": ", 1) for line in fields)
    length = int(header["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record {header.get('WARC-Record-ID')} has a wrong length")
    return header, rest[:length]


def read_members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    rest = stream.read(size)
    while rest:
        member, out = zlib.decompressobj(31), []
        while not member.eof:
            if not rest and not (rest := stream.read(size)):
                raise ValueError("an archive ends within a record")
            out.append(member.decompress(rest))
            rest = member.unused_data if member.eof else b""
        yield b"".join(out)
        rest = rest or stream.read(size)


def linked(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, n_bytes, digest and refers_to (null for responses) of every row.

    Of equal payloads the largest page id stays a response. The digests are aggregated
    before they meet the pages, so a payload that many pages share is one row there.
    """
    rows = pages.select("page_id", _n_bytes().alias("n_bytes"), _digest().alias("digest"))
    first = (
        rows.filter(F.col("n_bytes") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("kept_id")), F.col("kept_id"))
    return rows.join(first, "digest", "left").select("page_id", "n_bytes", "digest", refers_to.alias("refers_to"))


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def _n_bytes() -> Column:
    return F.octet_length(_payload()).cast("long")


def _digest() -> Column:
    return F.unhex(F.sha1(_payload()))


def shard_bounds(links: DataFrame, shard_bytes: int) -> list[tuple]:
    """The first (page_id, digest) of every shard but the first, in order; a null id stands first.

    Cut by running bytes over a sample of rows, drawn by a hash of both, and all rows that are
    large beside a shard. The driver holds some CUT_ROWS rows for each shard.
    """
    size = F.when(F.col("refers_to").isNull(), F.col("n_bytes")).otherwise(0) + HEADER_BYTES
    sized = links.select("page_id", "digest", size.alias("size"))
    n, total = sized.agg(F.count("*"), F.sum("size")).first()
    n_shards = -(-(total or 0) // shard_bytes)
    if n_shards < 2:
        return []
    every = max(1, n // (CUT_ROWS * n_shards))
    large = F.col("size") * 16 > shard_bytes
    drawn = F.pmod(F.xxhash64("page_id", "digest"), F.lit(every)) == 0
    weight = F.when(large, F.col("size")).otherwise(F.col("size") * every)
    rows = sized.filter(large | drawn).select("page_id", "digest", weight.alias("weight")).collect()
    rows = sorted((_order(r["page_id"], bytes(r["digest"])), r["weight"]) for r in rows)
    each = sum(weight for _, weight in rows) / n_shards
    bounds, filled = [], 0
    for key, weight in rows:
        if filled + weight / 2 > each * (len(bounds) + 1) and (not bounds or key > bounds[-1]):
            bounds.append(key)
        filled += weight
    return bounds


def _order(page_id, digest: bytes) -> tuple:
    return (page_id is not None, page_id or 0, digest)


def shard_of(bounds: list[tuple]):
    """A function of columns page_id and digest: the number of the shard."""
    firsts = np.array([b[1] for b in bounds if b[0]], np.int64)
    before = len(bounds) - len(firsts)  # bounds among rows without an id

    @F.pandas_udf("int")
    def find(ids: pd.Series, digests: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        number = np.array([int(i) if k else 0 for i, k in zip(ids, known, strict=True)], np.int64)
        low, high = np.searchsorted(firsts, number, "left"), np.searchsorted(firsts, number, "right")
        out = before + low
        # Only among equal ids the digest decides.
        for i in np.flatnonzero((low < high) | ~known):
            out[i] = bisect.bisect_right(bounds, _order(int(number[i]) if known[i] else None, bytes(digests.iloc[i])))
        return pd.Series(out.astype(np.int32))

    return find


def write_warc(
    pages: DataFrame,
    folder: str | None = None,
    file_bytes: int = FILE_BYTES,
    shard_bytes: int = SHARD_BYTES,
    min_revisit_bytes: int = 0,
) -> Manifest:
    """Write a record for every row of ``pages`` (page_id, url, html) and the manifest.

    ``folder`` must be a place that every executor can write to (a path or URI that
    pyarrow's file systems open); by default a new one in the cluster's shared folder.
    A null html is an empty payload, a null url has no target header, a null page_id sorts
    first and has no id header. Rows that repeat a page id and its payload are each a
    response if that id is the payload's largest. Ids are whole numbers of 64 bits. An empty
    table has an empty manifest.
    Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    pages = pages.select("page_id", "url", "html")
    links = materialize(linked(pages, min_revisit_bytes), "warc-links")
    bounds = shard_bounds(links, shard_bytes)
    columns = ["page_id", "url", "html", "n_bytes", "digest", "refers_to"]
    none = F.lit(None).cast("string")
    whole = pages.withColumns(
        {"n_bytes": _n_bytes(), "digest": _digest(), "refers_to": F.lit(None).cast(dict(links.dtypes)["refers_to"])}
    )
    # The marks of the revisits travel with the pages and stand before the pages they are about,
    # so that the payloads are shuffled once.
    marks = links.filter("refers_to IS NOT NULL").distinct().withColumns({"url": none, "html": none})
    both = whole.select(*columns, F.lit(1).alias("kind")).union(marks.select(*columns, F.lit(0)))
    # Ids travel as text: pandas would turn a column of whole numbers with nulls into floats.
    sorted_rows = (
        both.withColumn("shard", shard_of(bounds)(F.col("page_id").cast("string"), "digest"))
        .repartitionById(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
        .select("kind", "shard", "url", "html", "n_bytes", "digest", *(F.col(c).cast("string") for c in ("page_id", "refers_to")))
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        attempt = uuid.uuid4().hex
        done: list[tuple] = []
        stream, shard, name, records, size, sha = None, None, "", 0, 0, hashlib.sha1()
        seq, mark, refers_to = 0, None, None

        def close():
            stream.close()
            final = f"part-{shard:06d}-{seq:05d}-{sha.hexdigest()[:16]}.warc.gz"
            store.move(name, f"{root}/{final}")
            done.append((final, records, size, sha.hexdigest()))

        for frame in batches:
            for row in frame.itertuples(index=False):
                if row.kind == 0:
                    mark, refers_to = (row.page_id, row.digest), row.refers_to
                    continue
                if stream is not None and (row.shard != shard or size >= file_bytes):
                    close()
                    stream = None
                    seq = seq + 1 if row.shard == shard else 0
                if stream is None:
                    shard, records, size, sha = row.shard, 0, 0, hashlib.sha1()
                    name = f"{root}/.{attempt}-{shard}-{seq}.tmp"
                    stream = store.open_output_stream(name, compression=None)
                payload = b"" if row.html is None else row.html.encode()
                about = refers_to if mark == (row.page_id, row.digest) else None
                record = encode_record(row.page_id, row.url, payload, row.n_bytes, base32(row.digest), about)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = packer.compress(record) + packer.flush()
                stream.write(packed)
                sha.update(packed)
                records, size = records + 1, size + len(packed)
        if stream is not None:
            close()
        yield pd.DataFrame(done, columns=["file", "records", "bytes", "sha1"])

    files = sorted_rows.mapInPandas(write, "file string, records long, bytes long, sha1 string")
    return Manifest(folder, materialize(files, "warc-manifest", f"{folder}/manifest.parquet"))


def open_manifest(spark: SparkSession, folder: str) -> Manifest:
    return Manifest(folder, spark.read.parquet(f"{folder}/manifest.parquet"))


def read_warc(manifest: Manifest) -> DataFrame:
    """The records of the files in the manifest.

    page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type,
    refers_to. A file whose digest is not the manifest's, a response whose payload does
    not match its headers and a broken record end the read with an error.
    """
    folder = manifest.folder

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for frame in batches:
            for item in frame.itertuples(index=False):
                out, held = [], 0
                with store.open_input_stream(f"{root}/{item.file}", compression=None) as plain:
                    stream = _Digesting(plain)
                    for raw in read_members(stream):
                        out.append(_row(*decode_record(raw)))
                        held += len(raw)
                        if held > 8 << 20:
                            yield pd.DataFrame(out, columns=columns)
                            out, held = [], 0
                if stream.sha.hexdigest() != item.sha1:
                    raise ValueError(f"{item.file} differs from the manifest")
                if out:
                    yield pd.DataFrame(out, columns=columns)

    files = manifest.files.select("file", "sha1")
    spread = files.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism), "file")
    return spread.mapInPandas(
        read,
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long",
    )


class _Digesting:
    def __init__(self, stream):
        self.stream, self.sha = stream, hashlib.sha1()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.sha.update(data)
        return data


def _row(header: dict[str, str], payload: bytes) -> tuple:
    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
    response = header["WARC-Type"] == "response"
    n_bytes = int(header["X-Payload-Bytes"])
    if response and (base32(hashlib.sha1(payload).digest()) != digest or len(payload) != n_bytes):
        raise ValueError(f"payload of {header['WARC-Record-ID']} differs from its headers")
    page_id, refers_to = header.get("X-Page-ID"), header.get("X-Refers-To-Page-ID")
    return (
        page_id and int(page_id),
        header.get("WARC-Target-URI"),
        payload if response else None,
        n_bytes,
        digest,
        header["WARC-Type"],
        refers_to and int(refers_to),
    )
