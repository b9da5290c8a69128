"""WARC archives: a deterministic sharded writer, and a reader.

Records are dealt into shards by ranges of (url, page_id). The bounds come
from a hashed sample of the keys, in proportion to the number of shards, so they depend on the rows alone and not on
the cluster. Spark picks them from the sorted sample, one row per shard reaches the driver, and tasks find a
record's shard by bisection. A shard is a partition of its own, sorted and written by one task, which rolls to
the next file at ``ROLL_BYTES`` of compressed size. Headers are generated
anew: record ids, dates, lengths and digests follow from page and payload.

A task writes each file under a temporary name, with the attempt in it, and
renames it when complete; a retried or lost task writes the same bytes
under the same final name. Its last row reports the files; the driver's
manifest, written through Spark after all tasks are done, lists what counts, and
the reader takes files from the manifest alone.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one
with the largest page_id (then the largest url) is written in full, the others as revisits
that name it and keep its length and digest in their headers.

Files are reached through pyarrow's filesystem of the folder's URI (shared
folders, HDFS, object stores).

Defined results: null html is an empty payload, null url an empty target. Null
page_ids are written with an empty id and read back as null; they count as the smallest.
Of fully equal rows one is the response. An empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import zlib
from base64 import b32encode
from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import small_side, stage, with_workers
from hebdo.sources.files import scratch_path

ROLL_BYTES = 64_000_000
REVISIT_BYTES = 1000
MIN_SHARDS, SHARD_BYTES = 48, 512_000_000
#: Keys a shard in the sample that gives the bounds.
SAMPLE = 64
#: Fixed date of generated records: the writer regenerates headers and has no crawl time.
DATE = "2024-01-01T00:00:00Z"


def _fs(folder: str):
    from pyarrow import fs
    scheme, _, path = folder.rpartition(":")
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri(folder)


def record(page_id: str, url: str, payload: bytes, digest: str, refers: str | None, length: int) -> bytes:
    """One WARC/1.1 record, response or revisit, as its own gzip member."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {length}\r\n\r\n").encode()
    block = http if refers is not None else http + payload
    kind = "response" if refers is None else "revisit"
    target = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A").replace(" ", "%20")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}:{digest}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{b32encode(bytes.fromhex(digest)).decode()}",
            f"WARC-Block-Digest: sha1:{b32encode(hashlib.sha1(block).digest()).decode()}", f"Content-Length: {len(block)}"]
    if refers is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers}:{digest}>"]
    data = ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def responses(pages: DataFrame) -> DataFrame:
    """(digest, first): for payloads that occur more than once, the (page_id, url) of the response; staged."""
    key = F.struct(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return stage(pages.select(F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("n"), key.alias("key"))
                 .filter(F.col("n") >= REVISIT_BYTES).groupBy("digest")
                 .agg(F.max("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                 .select("digest", "first"), "warc-responses")


def shard_bounds(pages: DataFrame, shards: int, sample: int = SAMPLE) -> list[tuple[str, int]]:
    """Ascending distinct (url, page_id) at which a shard begins (but the first), at most ``shards`` - 1.

    The hashed sample holds about ``sample`` keys a shard, all keys where there are fewer; it is sorted and numbered
    by Spark, range by range.
    """
    grain = 1 << 40
    keys = pages.select(F.coalesce("url", F.lit("")).alias("url"), F.coalesce(F.col("page_id").cast("long"), F.lit(-1)).alias("p"))
    n = keys.count()
    share = min(grain, max(1, grain * sample * shards // max(n, 1)))
    # ranges of the sample by its first characters, each with the number of keys before it
    picked = stage(keys.filter(F.pmod(F.xxhash64("url", "p"), F.lit(grain)) < F.lit(share)).repartitionByRange("url", "p")
                   .sortWithinPartitions("url", "p").select("url", "p", F.spark_partition_id().alias("part"),
                                                            F.monotonically_increasing_id().alias("at")), "warc-sample")
    sizes = sorted((r["part"], r["n"], r["least"]) for r in picked.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("least")).collect())
    total, before, starts = sum(k for _, k, _ in sizes), 0, []
    for part, k, least in sizes:
        starts.append((part, before - least))
        before += k
    if not total or shards < 2:
        return []
    shift = picked.sparkSession.createDataFrame(starts, "part int, shift long")
    rank = picked.join(F.broadcast(shift), "part").select("url", "p", (F.col("at") + F.col("shift")).alias("rank"))
    # rank r begins shard k where r is total * k // shards
    k = F.floor((F.col("rank") * shards + shards - 1) / total).cast("long")
    edge = (k > 0) & (k < shards) & (F.floor(k * total / F.lit(shards)).cast("long") == F.col("rank"))
    return sorted({(r["url"], r["p"]) for r in rank.filter(edge).select("url", "p").collect()})


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shards: int | None = None) -> DataFrame:
    """Write the archives under ``folder``; returns the manifest (file, records, bytes, sha1), staged in it."""
    spark = with_workers(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    if shards is None:
        total = pages.agg(F.coalesce(F.sum(F.length("html")), F.lit(0))).first()[0]
        shards = max(MIN_SHARDS, int(total // SHARD_BYTES) + 1)
    bounds = spark.sparkContext.broadcast(shard_bounds(pages, shards))

    @F.pandas_udf("int")
    def shard_of(url: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds.value, key) for key in zip(url, p)], dtype="int32")

    first = responses(pages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    rows = rows.join(small_side(first), "digest", "left")
    rows = rows.withColumn("shard", shard_of(F.col("url"), F.coalesce("page_id", F.lit(-1))))
    rows = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "url", F.col("page_id").asc_nulls_first(), "digest")

    fields = ("page_id", "url", "html", "digest", "copied", "top_id", "top_url", "shard")

    def run(batches):
        from pyspark import TaskContext
        fs, base = _fs(folder)
        fs.create_dir(base, recursive=True)
        ctx = TaskContext.get()
        tag = f"{ctx.stageId()}-{ctx.taskAttemptId()}"
        state = {"shard": None, "roll": 0, "out": None, "size": 0, "n": 0, "sha": None}
        done, previous = [], None

        def close():
            if state["out"] is not None:
                state["out"].close()
                fs.move(f"{base}/{name()}.{tag}.tmp", f"{base}/{name()}")
                done.append((name(), state["n"], state["size"], state["sha"].hexdigest()))
                state.update(out=None, roll=state["roll"] + 1)

        def name():
            return f"pages-{state['shard']:06d}-{state['roll']:05d}.warc.gz"

        for pdf in batches:
            for pid, url, text, digest, copied, top_id, top_url, shard in zip(*(pdf[c] for c in fields)):
                if shard != state["shard"] or state["size"] >= roll_bytes:
                    close()
                    if shard != state["shard"]:
                        state.update(shard=shard, roll=0)
                    state.update(size=0)
                if state["out"] is None:
                    state.update(out=fs.open_output_stream(f"{base}/{name()}.{tag}.tmp", compression=None), size=0, n=0, sha=hashlib.sha1())
                # equal rows stand side by side: the first of those equal to the response is the response
                response = not copied or (pid, url) == (top_id, top_url) and previous != (pid, url, digest)
                previous = (pid, url, digest)
                payload = text.encode("utf-8", "surrogatepass")
                data = record(pid, url, payload, digest, None if response else top_id, len(payload))
                state["out"].write(data)
                state["sha"].update(data)
                state["size"] += len(data)
                state["n"] += 1
        close()
        yield pd.DataFrame(done, columns=["file", "records", "bytes", "sha1"])

    name_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    made = rows.select(name_of("page_id").alias("page_id"), "url", "html", "digest", F.col("first").isNotNull().alias("copied"),
                       name_of("first.page_id").alias("top_id"), name_of("first.url").alias("top_url"), "shard").mapInPandas(
        run, "file string, records long, bytes long, sha1 string")
    manifest = f"{folder.rstrip('/')}/_manifest"
    made.write.parquet(manifest)
    return spark.read.schema("file string, records long, bytes long, sha1 string").parquet(manifest)


def records(stream, chunk: int = 1 << 16):
    """(headers, block) of each gzip member of a stream, one at a time."""
    z, data = zlib.decompressobj(31), bytearray()
    while True:
        raw = stream.read(chunk)
        if not raw:
            return
        while raw:
            data += z.decompress(raw)
            raw = z.unused_data
            if z.eof:
                head, _, rest = bytes(data).partition(b"\r\n\r\n")
                fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                yield fields, rest[:int(fields["Content-Length"])]
                z, data = zlib.decompressobj(31), bytearray()


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of all records in listed files.

    Block and payload digests are checked; a mismatch fails the read.
    """
    with_workers(manifest.sparkSession)

    def run(batches):
        from urllib.parse import unquote
        from base64 import b32decode
        fs, base = _fs(folder)
        for pdf in batches:
            for file in pdf["file"]:
                rows, size = [], 0
                with fs.open_input_stream(f"{base}/{file}", compression=None) as stream:
                    for h, block in records(stream):
                        if b32encode(hashlib.sha1(block).digest()).decode() != h["WARC-Block-Digest"][5:]:
                            raise ValueError(f"{file}: block digest of {h['WARC-Record-ID']}")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        full = h["WARC-Type"] == "response"
                        digest = b32decode(h["WARC-Payload-Digest"][5:]).hex()
                        if full and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{file}: payload digest of {h['WARC-Record-ID']}")
                        length = len(payload) if full else int(http.rsplit(b"Content-Length: ", 1)[1])
                        ident = lambda k: int(v) if (v := h[k].split(":")[2]) else None
                        rows.append((ident("WARC-Record-ID"), unquote(h.get("WARC-Target-URI", "")),
                                     payload if full else None, length, digest, h["WARC-Type"],
                                     None if full else ident("WARC-Refers-To")))
                        size += len(payload)
                        if size > 16_000_000:
                            yield frame(rows)
                            rows, size = [], 0
                yield frame(rows)

    def frame(rows):
        out = pd.DataFrame(rows, columns=["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    files = manifest.select("file").repartition(max(1, min(10_000, manifest.count())), "file")
    return files.mapInPandas(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                                  "record_type string, refers_to long")


def archive(pages: DataFrame) -> tuple[DataFrame, str]:
    """Write ``pages`` into a new folder of the shared checkpoint folder: (manifest, folder)."""
    folder = scratch_path(pages.sparkSession, "warc")
    return write(pages, folder), folder
