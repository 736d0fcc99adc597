"""WARC archives written and read with Spark.

Writing: one record per page; of records with equal payloads of some size, one
is the response and the others are revisits that refer to it. Spark's text
writer joins the records with the blank lines that end a WARC record, so each
output file is an archive.

Reading trusts no magic: a payload may hold text that looks like a record. The
files are read as lines in splits of any size; line lengths give every line's
file offset (split sizes are summed first). Tasks emit, for each line that could
begin a record, the offset where its successor would begin. Starting from
offset 0 of each file, pointer jumping (doubling the links every round) keeps
the reachable records only. Each split then starts at its first such record and
hashes the payloads that end inside it; only the pieces of records that cross a
split's border move, to be put together in order.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgeframe.llm.common import as_batch, prepare, scratch_path, stage, table
from lodgeframe.session import own_session

VERSION = "WARC/1.1"
NEWLINE = "\r\n"
#: equal payloads are stored once from this size
REVISIT_BYTES = 1000
# fixed value: the profile of revisits by equal payload digest
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: byte ranges (splits) of one read at most; a row of numbers for each reaches every task
MAX_SPLITS = 100_000
#: revisits (about 100 bytes each) that may be broadcast to the pages
BROADCAST_REVISITS = 200_000


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
          least: int = REVISIT_BYTES, date: str = DATE) -> None:
    """Write ``pages`` as archives below ``path``.

    The payload is the text in UTF-8 (null: empty). Of equal payloads of at least
    ``least`` bytes, the rows with the largest page id are responses and the
    others revisit it. Rows without an id are responses. Repeated rows give a
    record each; control characters of a url are percent-encoded, a null url is
    left out; an empty table writes archives without records. Extra columns
    are ignored.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("n", F.octet_length("payload")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    plan = stage(rows.select("page_id", "digest", "n"), "warc-plan")
    copies = (plan.where((F.col("n") >= least) & F.col("page_id").isNotNull()).groupBy("digest", "n")
              .agg(F.max("page_id").alias("response"), F.count("*").alias("m")).where("m > 1").drop("m"))
    revisits = (plan.join(copies, ["digest", "n"]).where("page_id <> response").select("page_id", "digest", "response").distinct())
    revisits = stage(revisits, "warc-revisits")
    if revisits.count() <= BROADCAST_REVISITS:       # else payloads are shuffled to meet them
        revisits = F.broadcast(revisits)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(NEWLINE))
    ref = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    is_revisit = F.col("response").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{NEWLINE}Content-Type: text/html; charset=utf-8{NEWLINE}Content-Length: "),
                    F.col("n").cast("string"), F.lit(NEWLINE * 2))
    block = F.concat(http, F.when(is_revisit, "").otherwise(F.col("payload")))
    safe_url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x1F]", "%00")
    header = F.concat(
        F.lit(VERSION + NEWLINE), line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", ref("page_id")), F.coalesce(line("WARC-Target-URI", safe_url), F.lit("")), line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(is_revisit, F.concat(line("WARC-Refers-To", ref("response")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit(NEWLINE))
    (rows.join(revisits, ["page_id", "digest"], "left")
     .withColumn("block", block).select(F.concat(header, "block").alias("record"))
     .write.option("lineSep", NEWLINE * 2).text(path))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, value): the archives' lines, as bytes without the final \\n."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.col("value").cast("binary").alias("value")))


def runs(batch: pa.RecordBatch):
    """(file, split, values) of neighbouring lines of one split in a batch."""
    file, split = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    code = file.indices.to_numpy()
    cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(split) != 0)) + 1
    for a, z in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
        if z > a:
            yield file.dictionary[int(code[a])].as_py(), int(split[a]), batch.column(2).slice(a, z - a)


def line_ends(values: pa.Array) -> np.ndarray:
    """Offsets after each line (its \\n included), from the first one's begin."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    return offsets[1:] - offsets[0] + np.arange(1, len(values) + 1)


def located(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, value, within) of the lines that matter to a record's header
    (``interesting``); ``within`` is the size of the split's lines before."""

    def run(batches):
        at: dict[tuple, int] = {}
        for batch in batches:
            for f, s, values in runs(batch):
                ends = line_ends(values) + at.get((f, s), 0)
                begins = np.concatenate([[at.get((f, s), 0)], ends[:-1]])
                at[f, s] = int(ends[-1])
                pick = [i for i, v in enumerate(values.to_pylist()) if interesting(v)]
                yield as_batch({"file": [f] * len(pick), "split": [s] * len(pick), "value": values.take(pa.array(pick, pa.int64())),
                                "within": begins[pick]}, schema)

    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("value", pa.binary()), ("within", pa.int64())])
    return lines(spark, path).mapInArrow(run, "file string, split long, value binary, within long")


def split_bases(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, size, base): bytes of each split's lines, and the file offset of its first one."""
    sizes = lines(spark, path).groupBy("file", "split").agg(F.sum(F.octet_length("value") + 1).alias("size"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("file", "split", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))


def interesting(value: bytes) -> bool:
    """Lines that can begin, belong to or end a record's header."""
    return value == b"\r" or value[:7] == b"WARC/1." or value[:5] == b"WARC-" or value[:15].lower() == b"content-length:"


def candidates(spark: SparkSession, path: str, bases: DataFrame) -> DataFrame:
    """(file, offset, body, length, next, ..): every place that reads like a
    record header, with the offset of the record that would follow."""
    found = (located(spark, path).join(bases.select("file", "split", "base"), ["file", "split"])
             .withColumn("offset", F.col("base") + F.col("within")).withColumn("text", F.col("value").cast("string")))
    starts = F.when(F.col("text").startswith("WARC/1.") & F.col("text").endswith("\r"), F.col("offset"))
    in_file = Window.partitionBy("file").orderBy("offset")
    grouped = (found.withColumn("start", F.last(starts, ignorenulls=True).over(in_file)).where("start is not null")
               .groupBy("file", F.col("start").alias("offset"))
               .agg(F.min(F.when(F.col("text") == "\r", F.col("offset"))).alias("blank"),
                    F.array_sort(F.collect_list(F.struct(F.col("offset").alias("at"), "text", "split", "within"))).alias("lines"))
               .where("blank is not null"))
    pairs = F.transform(F.filter("lines", lambda x: (x["at"] > F.col("offset")) & (x["at"] < F.col("blank"))),
                        lambda x: F.struct(F.lower(F.trim(F.substring_index(x["text"], ":", 1))).alias("name"),
                                           F.trim(F.regexp_replace(x["text"], r"^[^:]*:|\r$", "")).alias("value")))
    get = lambda name: F.try_element_at(F.filter("pairs", lambda p: p["name"] == name), F.lit(1))["value"]
    out = grouped.withColumn("pairs", pairs).withColumn("length", get("content-length").try_cast("long"))
    return (out.where("length >= 0")
            .select("file", "offset", F.col("lines")[0]["split"].alias("split"), F.col("lines")[0]["within"].alias("within"),
                    (F.col("blank") + 2).alias("body"), "length",
                    (F.col("blank") + 2 + F.col("length") + len(NEWLINE) * 2).alias("next"),
                    get("warc-type").alias("type"), get("warc-record-id").alias("id"), get("warc-refers-to").alias("refers_to"),
                    F.regexp_replace(get("warc-payload-digest"), "^sha1:", "").alias("digest")))


def reachable(found: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain from each file's first byte."""
    links = found.select("file", "offset", "next")
    jump = stage(links.join(found.select("file", F.col("offset").alias("next")), ["file", "next"]).select("file", "offset", "next"), "warc-jump")
    seen = stage(found.where("offset = 0").select("file", "offset"), "warc-seen")
    while not jump.isEmpty():
        seen = stage(seen.union(seen.join(jump, ["file", "offset"]).select("file", F.col("next").alias("offset"))), "warc-seen")
        far = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("end"))
        jump = stage(jump.join(far, ["file", "next"]).select("file", "offset", F.col("end").alias("next")), "warc-jump")
    return seen


class Payload:
    """The payload of one record: what follows the HTTP header of its block."""

    def __init__(self):
        self.head, self.n, self.sha1 = b"", 0, hashlib.sha1()

    def feed(self, data: bytes) -> None:
        if self.head is not None:
            self.head += data
            blank = _BLANK.search(self.head)          # the HTTP header ends with an empty line
            if blank is None:
                return
            data, self.head = self.head[blank.end():], None
        self.n += len(data)
        self.sha1.update(data)


_BLANK = re.compile(rb"(?:\A|\n)\r\n")


class SplitCutter:
    """Follows the chain of records through one split's lines.

    ``entry`` is the split's first record, ``open`` the record begun before it.
    Records that end inside the split are hashed; of others, pieces go out.
    """

    def __init__(self, file: str, base: int, size: int, entry: int | None, open_record: int | None, out: dict):
        self.file, self.at, self.end, self.next, self.out = file, base, base + size, entry, out
        self.record, self.body_end, self.payload, self.length = open_record, None, None, None
        self.where = "before"                          # before the entry, header, block, or over (chain broken)

    def piece(self, begin: int, data: bytes) -> None:
        for name, value in zip(PIECE, (self.file, self.record, begin, data, None, None)):
            self.out[name].append(value)

    def finish(self) -> None:
        for name, value in zip(PIECE, (self.file, self.record, None, None, self.payload.n, self.payload.sha1.hexdigest())):
            self.out[name].append(value)
        self.where, self.next = "before", self.body_end + len(NEWLINE) * 2
        self.record = None

    def feed(self, values: pa.Array) -> None:
        ends = line_ends(values) + self.at
        begins = np.concatenate([[self.at], ends[:-1]])
        i, n = 0, len(values)
        join = lambda a, z: b"".join(v + b"\n" for v in values.slice(a, z - a).to_pylist())
        while i < n:
            if self.where == "before":
                stop = n if self.next is None else int(np.searchsorted(begins, self.next))
                if self.record is not None and stop > i:
                    self.piece(int(begins[i]), join(i, stop))
                i = stop
                if i < n:
                    self.record, self.length = int(begins[i]), None
                    first = values[i].as_py()
                    fits = self.record == self.next and first.startswith(b"WARC/1.") and first.endswith(b"\r")
                    self.where, i = ("header", i + 1) if fits else ("over", n)
            elif self.where == "header":
                line = values[i].as_py()
                i += 1
                if line == b"\r":
                    self.body_end = int(ends[i - 1]) + (self.length if self.length is not None and self.length >= 0 else 0)
                    self.payload, self.where = Payload(), "block"
                    if self.body_end <= self.end and self.body_end == int(ends[i - 1]):
                        self.finish()
                elif self.length is None and line[:15].lower() == b"content-length:":
                    text = line[15:].strip()
                    self.length = int(text) if text.isdigit() else -1
            elif self.where == "block":
                stop = int(np.searchsorted(begins, self.body_end))
                data = join(i, stop)[:self.body_end - int(begins[i])]
                if self.body_end > self.end:
                    self.piece(int(begins[i]), data)
                else:
                    self.payload.feed(data)
                i = stop
                if self.body_end <= self.end and int(ends[i - 1]) >= self.body_end:
                    self.finish()
            else:
                i = n
        self.at = int(ends[-1])


PIECE = ("file", "offset", "at", "data", "payload_bytes", "payload_digest")
PIECE_SCHEMA = "file string, offset long, at long, data binary, payload_bytes long, payload_digest string"


def cut_splits(spark: SparkSession, path: str, splits) -> DataFrame:
    """``PIECE_SCHEMA`` rows: a digest for each record that lies in one split, the
    pieces (with their file offsets) of the others."""

    def run(batches):
        cutter, key = None, None
        for batch in batches:
            out = {name: [] for name in PIECE}
            for f, s, values in runs(batch):
                if (f, s) != key:
                    key, cutter = (f, s), SplitCutter(f, *splits.value[f, s], out)
                cutter.out = out
                cutter.feed(values)
            yield as_batch(out, schema)

    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("at", pa.int64()), ("data", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    return lines(spark, path).mapInArrow(run, PIECE_SCHEMA)


def join_pieces(batches):
    """Streams the pieces of each record in order, after a row (at -1) with its
    body's begin and end."""
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    key, payload, span = None, None, None
    for batch in batches:
        out = {c: [] for c in schema.names}
        for f, o, at, data, body, end in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if at < 0:
                if key is not None:
                    add(out, key, payload)
                key, payload, span = (f, o), Payload(), (body, end)
            elif (f, o) == key:
                payload.feed(data[max(0, span[0] - at):max(0, span[1] - at)])
        yield as_batch(out, schema)
    if key is not None:
        out = {c: [] for c in schema.names}
        add(out, key, payload)
        yield as_batch(out, schema)


def add(out: dict, key: tuple, payload: Payload) -> None:
    for name, value in zip(out, (*key, payload.n, payload.sha1.hexdigest())):
        out[name].append(value)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``: file, offset, page_id,
    record_type, refers_to (page id, null for responses), payload_bytes and
    payload_digest of the full payload (a revisit's is its response's).

    Only records on the chain of boundaries from a file's first byte count; what
    follows a broken boundary in a file is not read. Files without records give
    no rows.
    """
    prepare(spark)
    own = own_session(spark)                          # every pass sees the same splits
    total = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.sum("length")).first()[0] or 0
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max(size, -(-total // MAX_SPLITS))))
    bases = stage(split_bases(own, path), "warc-splits")
    found = stage(candidates(own, path, bases), "warc-candidates")
    records = stage(found.join(reachable(found), ["file", "offset"], "left_semi"), "warc-reachable")
    inside = records.groupBy("file", "split").agg(F.min("offset").alias("entry"), F.max(F.struct("offset", (F.col("body") + F.col("length")).alias("end"))).alias("last"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    rows = (bases.join(inside, ["file", "split"], "left")
            .withColumn("open", F.last("last", ignorenulls=True).over(earlier))
            .withColumn("open", F.when(F.col("open.end") > F.col("base"), F.col("open.offset"))).collect())   # at most MAX_SPLITS, and one per file
    splits = spark.sparkContext.broadcast({(r.file, r.split): (r.base, r.size, r.entry, r.open) for r in rows})
    cut = stage(cut_splits(own, path, splits), "warc-cut")
    pieces = cut.where("data is not null").select("file", "offset", "at", "data", F.lit(None).cast("long").alias("body"), F.lit(None).cast("long").alias("end"))
    heads = (records.join(pieces.select("file", "offset").distinct(), ["file", "offset"], "left_semi")
             .select("file", "offset", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("binary").alias("data"), "body",
                     (F.col("body") + F.col("length")).alias("end")))
    joined = (heads.union(pieces).repartition("file", "offset").sortWithinPartitions("file", "offset", "at")
              .mapInArrow(join_pieces, "file string, offset long, payload_bytes long, payload_digest string"))
    hashed = cut.where("data is null").select("file", "offset", "payload_bytes", "payload_digest").union(joined)
    cut = stage(records.withColumnRenamed("digest", "declared").join(hashed, ["file", "offset"], "left").select(
        "file", "offset", "type", "id", "refers_to", F.col("declared").alias("digest"), F.coalesce("payload_bytes", F.lit(0)).cast("long").alias("payload_bytes"),
        F.coalesce("payload_digest", F.sha1(F.lit(b""))).alias("payload_digest")), "warc-records")
    number = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).try_cast("long")
    cut = cut.withColumn("page_id", number("id")).withColumn("refers_to", F.when(F.col("type") == "revisit", number("refers_to")))
    full = (cut.where("type = 'response'").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest"))
            .agg(F.max("payload_bytes").alias("full_bytes")))
    responses = cut.where("refers_to is null").select("file", "offset", "page_id", F.col("type").alias("record_type"), "refers_to",
                                                      "payload_bytes", "payload_digest")
    revisits = (cut.where("refers_to is not null").join(full, ["refers_to", "digest"], "left")
                .select("file", "offset", "page_id", F.col("type").alias("record_type"), "refers_to",
                        F.col("full_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest")))
    return responses.union(revisits)


def op4_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-warc")
    write(table(spark, sf_dir, "pages"), path)
    return read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
