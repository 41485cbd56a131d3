"""Deterministic sharded WARC writer and reader (operator 2).

Order and shards come from the data alone: records are put in the order of page
id, digest and url, exact running sums of their bytes cut it into shards of
about ``shard_bytes``, whatever the ids (far apart, repeated or missing), and a
shard rolls to a new file when the compressed size passes ``file_bytes``.  Every record is a gzip member with no
time stamp, a fixed date and an id made from its content, so the same table
gives the same bytes.

Commit: a task writes under ``_temporary/<attempt>/`` and returns a manifest row
per file; the rows are written by Spark, whose committer keeps one attempt of
each task.  Then the files of those rows move to their final names (moving twice
is harmless), the manifest is written, and last ``_SUCCESS``.  Readers go by the manifest only, so files of
lost attempts are never read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.session import scratch_path, settings, written
from sensorloom.sources.tables import table

MIN_REVISIT = 100
MAX_TASKS = 20_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str):
    """(Arrow file system, path) of a folder's URI; a bare path is a mounted folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# -- records ---------------------------------------------------------------

def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{copy}')}>"


def _header_text(value: str | None) -> str:
    """A header's value on one line: line ends as blanks."""
    return " ".join((value or "").replace("\r", "\n").split("\n"))


def record(page_id, url, payload: bytes, digest: str, refers_to, copy: int) -> bytes:
    """One record, headers and digests made anew.  A revisit has no block and names the response's page."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest, copy)), ("WARC-Date", DATE),
            ("WARC-Target-URI", _header_text(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0)), ("X-Refers-To-Page", str(refers_to))]
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member without time or name."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed stream; a broken record raises."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line[:-2].partition(b": ")
            head[k.decode("utf-8")] = v.decode("utf-8")
        block = stream.read(size := int(head["Content-Length"]))
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head.get('WARC-Record-ID')} is cut")
        yield head, block


# -- writing ---------------------------------------------------------------

def resolved(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, html, digest, bytes, refers_to`` per row of ``pages``.

    Of equal payloads of ``min_revisit`` bytes or more the row with the smallest
    page id is the response; a null id is larger than any.  Rows that share that
    smallest id are all responses.  Only payloads that occur twice are looked at again."""
    body = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html"))
    rows = rows.select("*", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("bytes"))
    few = rows.select("page_id", "digest", "bytes")
    first = few.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = written(first.where("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("d"), "first"), "repeated")
    rows = rows.join(first, F.col("digest") == F.col("d"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "html", "digest", "bytes", F.when(revisit, F.col("first")).alias("refers_to"))


def running_bytes(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``before``: the sum of ``size`` over all rows that come earlier in ``order`` (unique, nulls last).

    Rows are sorted by range and written with their range's number; a range adds up its own, and a table of one row
    per range says where each starts, so no task sees more than a range."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(c).asc_nulls_last() for c in order]
    parts = written(rows.repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id()), name)
    ahead = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per range
    starts = parts.groupBy("part").agg(F.sum("size").alias("size"))
    starts = starts.select(F.col("part").alias("of"), ahead(Window.orderBy("part")).alias("start"))
    own = parts.withColumn("own", ahead(Window.partitionBy("part").orderBy(*keys)))
    return own.join(F.broadcast(starts), F.col("part") == F.col("of")).select(*rows.columns, (F.col("own") + F.col("start")).alias("before"))


def with_shards(rows: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """``rows`` with ``shard`` and ``copy``, and the number of shards: stretches of about ``shard_bytes`` of payload in the
    order page id (nulls last), digest, url.

    A row's shard is the sum of the bytes before it over ``shard_bytes``.  For most rows the bytes before their id decide,
    looked up among the first ids of the shards (8 bytes on the driver for each ``shard_bytes`` of payload).  An id, or no
    id, with more than ``shard_bytes`` of its own is cut inside: its different records are counted and sorted too, and
    equal ones are laid out as often as they occur, so ``copy`` (null elsewhere) numbers them across shards."""
    cost = F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(0) + 512
    ids = written(rows.groupBy("page_id").agg(F.sum(cost).alias("size")), "id-bytes")
    laid = written(running_bytes(ids, ["page_id"], "id-ranges"), "id-starts")
    laid = laid.withColumn("shard", F.floor(F.col("before") / F.lit(shard_bytes)).cast("long"))
    firsts = sorted((r.shard, r.page_id) for r in laid.groupBy("shard").agg(F.min("page_id").alias("page_id")).collect() if r.page_id is not None)
    total = laid.agg(F.max(F.col("before") + F.col("size"))).first()[0] or 0
    n_shards = -(-total // shard_bytes)
    shards, starts = (np.array([x[k] for x in firsts], dtype=np.int64) for k in (0, 1))
    no_id = laid.where("page_id IS NULL").select("shard").first()

    @F.pandas_udf("long")
    def shard_of(page_id: pd.Series) -> pd.Series:
        return pd.Series(shards[np.searchsorted(starts, page_id.to_numpy(np.int64), "right") - 1])

    shard = F.lit(no_id.shard if no_id else 0).cast("long")
    if len(shards):
        # every id looks itself up; rows without one ask for the first id and do not use the answer
        shard = F.when(F.col("page_id").isNull(), shard).otherwise(shard_of(F.coalesce(F.col("page_id"), F.lit(int(starts[0])))))
    large = laid.where(F.col("size") > shard_bytes).select(F.col("page_id").alias("large_id"), F.col("before").alias("id_before"))
    # at most one for each shard_bytes of payload
    if large.isEmpty():
        return rows.select("*", shard.alias("shard"), F.lit(None).cast("long").alias("copy")), n_shards
    large = written(large, "large-ids")
    is_large = F.col("page_id").eqNullSafe(F.col("large_id"))
    rest = rows.join(F.broadcast(large), is_large, "left_anti").select("*", shard.alias("shard"), F.lit(None).cast("long").alias("copy"))
    inside = rows.join(F.broadcast(large), is_large)
    key = ["page_id", "digest", "url"]
    once = inside.groupBy(*key).agg(F.first("html").alias("html"), F.first("bytes").alias("bytes"), F.first("refers_to").alias("refers_to"),
                                    F.first("id_before").alias("id_before"), F.count("*").alias("n"))
    once = written(once.withColumn("each", cost), "large-records")
    sizes = once.select(*key, "n", "each", "id_before", (F.col("n") * F.col("each")).alias("size"))
    run = written(running_bytes(sizes, key, "large-ranges").withColumnRenamed("before", "at"), "large-starts")
    run = written(running_bytes(run.drop("size").withColumn("size", F.col("n")), key, "large-counts").drop("size"), "large-numbers")
    # bytes before the record inside its id, and records before it with the same id and payload
    by_id = run.groupBy(F.col("page_id").alias("i")).agg(F.min("at").alias("first_at"))
    by_payload = run.groupBy(F.col("page_id").alias("p"), F.col("digest").alias("d")).agg(F.min("before").alias("first_record"))
    run = run.join(F.broadcast(by_id), F.col("page_id").eqNullSafe(F.col("i")))
    run = run.join(by_payload, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")))
    run = run.select(F.col("page_id").alias("i"), F.col("digest").alias("d"), F.col("url").alias("u"),
                     (F.col("id_before") + F.col("at") - F.col("first_at")).alias("at"), (F.col("before") - F.col("first_record")).alias("number"))
    same = F.col("page_id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")) & F.col("url").eqNullSafe(F.col("u"))
    cut = once.join(run, same).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"))
    cut = cut.withColumns({"shard": F.floor((F.col("at") + F.col("k") * F.col("each")) / F.lit(shard_bytes)).cast("long"),
                           "copy": F.col("number") + F.col("k")})
    return rest.unionByName(cut.select(rest.columns)), n_shards


MANIFEST = "shard long, seq long, name string, temporary string, records long, bytes long, sha256 string, first_page long, last_page long"


def write_archives(pages: DataFrame, folder: str, file_bytes: int = 64 << 20, shard_bytes: int = 256 << 20,
                   level: int = 6, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC files under ``folder`` (a URI Arrow can open); returns the committed manifest.

    Null html is an empty payload, a null url an empty header; a record larger
    than ``file_bytes`` has a file of its own.  An empty table commits an empty
    manifest.  Rows without an id come last; repeated rows are records of their own.  Other columns are not read."""
    spark = pages.sparkSession
    rows, n_shards = with_shards(resolved(pages, min_revisit), shard_bytes)
    order = ["shard", F.col("page_id").asc_nulls_last(), "digest", F.col("url").asc_nulls_last(), "copy"]
    # a task has whole shards, and neighbouring ones: one each up to MAX_TASKS
    tasks = min(max(1, n_shards), MAX_TASKS)
    task = F.floor(F.col("shard") * F.lit(tasks) / F.lit(max(1, n_shards))).cast("int")
    rows = rows.repartitionById(tasks, task).sortWithinPartitions(*order)
    # ids travel as text: pandas would turn a column with nulls into floats
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to", "copy")})

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(folder)
        place = f"_temporary/{uuid.uuid4().hex}"
        out, facts, last = None, None, None

        def close() -> pd.DataFrame:
            out.close()
            facts["sha256"] = facts["sha256"].hexdigest()
            return _frame([facts.values()], list(facts), ["first_page", "last_page"])

        for pdf in batches:
            for page, url, html, digest, ref, shard, copy in zip(pdf.page_id, pdf.url, pdf.html, pdf.digest, pdf.refers_to, pdf.shard, pdf["copy"]):
                page, ref, copy = (None if x is None else int(x) for x in (page, ref, copy))
                if copy is None:
                    copy = last[2] + 1 if last and last[:2] == (page, digest) else 0
                last = (page, digest, copy)
                data = member(record(page, url, bytes(html), digest, ref, copy), level)
                if out is not None and (facts["shard"] != shard or facts["bytes"] + len(data) > file_bytes):
                    yield close()
                    seq = facts["seq"] + 1 if facts["shard"] == shard else 0
                    out = None
                elif out is None:
                    seq = 0
                if out is None:
                    name = f"shard-{int(shard):06d}-{seq:05d}.warc.gz"
                    fs.create_dir(f"{root}/{place}", recursive=True)
                    out = fs.open_output_stream(f"{root}/{place}/{name}", compression=None)
                    facts = dict(shard=int(shard), seq=seq, name=name, temporary=f"{place}/{name}", records=0, bytes=0,
                                 sha256=hashlib.sha256(), first_page=page, last_page=page)
                out.write(data)
                facts["sha256"].update(data)
                facts["records"] += 1
                facts["bytes"] += len(data)
                facts["last_page"] = page
        if out is not None:
            yield close()

    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="256"):
        manifest = written(rows.mapInPandas(write, MANIFEST), "attempts")

    def commit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileType

        fs, root = filesystem(folder)
        for pdf in batches:
            for name, temporary, size in zip(pdf.name, pdf.temporary, pdf.bytes):
                there = fs.get_file_info(f"{root}/{name}")
                if there.type == FileType.NotFound or there.size != size:
                    fs.move(f"{root}/{temporary}", f"{root}/{name}")
            yield pdf

    done = manifest.mapInPandas(commit, manifest.schema).select("shard", "seq", "name", "records", "bytes", "sha256", "first_page", "last_page")
    done.write.mode("errorifexists").parquet(f"{folder}/_manifest")
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/_SUCCESS", compression=None) as f:
        f.write(b"")
    return spark.read.schema(done.schema).parquet(f"{folder}/_manifest")


# -- reading ---------------------------------------------------------------

RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html binary"


def read_archives(spark: SparkSession, folder: str, payloads: bool = False, min_files_a_task: int = 1) -> DataFrame:
    """The records of the files that the folder's manifest lists, read as streams, one file at a time in a task.

    Response payloads are digested again; a record whose digest, length or file
    does not agree with its headers or the manifest raises.  A revisit's length
    and digest are those of the payload it refers to."""
    fs, root = filesystem(folder)
    if fs.get_file_info(f"{root}/_SUCCESS").type.name == "NotFound":
        raise FileNotFoundError(f"{folder} has no committed archives")
    files = spark.read.parquet(f"{folder}/_manifest").select("name", "records")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = [f for f in T._parse_datatype_string(RECORDS).fields if payloads or f.name != "html"]

    names = [f.name for f in fields]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(folder)
        for pdf in batches:
            for name, records in zip(pdf.name, pdf.records):
                out, held, seen = [], 0, 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 20)) as z:
                    for head, block in read_records(io.BufferedReader(z, 1 << 20)):
                        out.append(_row(head, block) + ((block,) if payloads else ()))
                        seen, held = seen + 1, held + len(block) * payloads
                        if len(out) >= 2000 or held > 16 << 20:
                            yield _frame(out, names, ["page_id", "refers_to"])
                            out, held = [], 0
                if seen != records:
                    raise ValueError(f"{name} holds {seen} records; the manifest says {records}")
                yield _frame(out, names, ["page_id", "refers_to"])

    return files.repartition(n, "name").mapInPandas(read, T.StructType(fields))


def _frame(rows: list, names: list[str], whole: list[str]) -> pd.DataFrame:
    """Rows as a frame whose ``whole`` columns are integers with gaps."""
    columns = list(zip(*rows)) or [()] * len(names)
    return pd.DataFrame({n: pd.array(c, "Int64") if n in whole else pd.Series(c, dtype=None if c else "object") for n, c in zip(names, columns)})


def _row(head: dict[str, str], block: bytes) -> tuple:
    digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["X-Payload-Length"])
    kind = head["WARC-Type"]
    own = hashlib.sha256(block).hexdigest()
    if head["WARC-Block-Digest"] != f"sha256:{own}" or kind == "response" and (own, len(block)) != (digest, size):
        raise ValueError(f"record {head['WARC-Record-ID']} has another payload than its headers say")
    number = lambda k: int(head[k]) if k in head else None
    return number("X-Page-Id"), head["WARC-Target-URI"], size, digest, kind, number("X-Refers-To-Page")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: pages written as archives into the shared folder and read back."""
    folder = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder).drop("url")


SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d WHERE n >= {MIN_REVISIT} GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR first = page_id THEN NULL ELSE first END AS refers_to
FROM d LEFT JOIN f USING (h)
"""
