"""WARC archives of web pages: written as records, read back in blocks with the chain of record boundaries verified."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraloom.session import checkpointed, shared_dir
from terraloom.sinks.publish import remove

#: Fixed values of the format: what ends a record, and what begins one.
END, MAGIC = "\r\n\r\n", "WARC/1."
#: Where files are cut: no header line begins like this, so a header is never cut. It has no border (no beginning that is an end
#: of it too): with END in it, Hadoop's reader loses a row where a split ends inside a run of line ends.
BETWEEN = END[-1] + MAGIC
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
#: Payloads shorter than this are always stored.
LEAST_BYTES = 100
#: Rows of repeated payloads that are broadcast at most; beyond, pages are joined with them by digest and salt.
BROADCAST_ROWS = 500_000
SPREAD = 64


def first_holders(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(digest, first): of each payload of at least `least` bytes that occurs again, the smallest page_id."""
    given = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).where(F.octet_length("html") >= least)
    found = given.groupBy(F.sha2("html", 256).alias("digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return found.where("n > 1 AND first IS NOT NULL").drop("n")


def with_holders(pages: DataFrame, holders: DataFrame) -> DataFrame:
    """`pages` (with digest) and `first`. Holders are broadcast behind a check of their number, so no page moves; else pages are
    salted, as a digest may have a third of them."""
    kept = checkpointed(holders)
    if kept.count() <= BROADCAST_ROWS:
        return pages.join(F.broadcast(kept), "digest", "left")
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SPREAD)))
    copies = kept.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    return salted.join(copies, ["digest", "salt"], "left").drop("salt")


def records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", least: int = LEAST_BYTES) -> DataFrame:
    """(record): the text of one WARC record a page, without the blank lines that end it.

    Of equal payloads of `least` bytes or more, the smallest page_id's is a response, others are revisits that refer to it
    and hold the HTTP header alone. Rows that share the smallest page_id are responses all; a null page_id is never the
    smallest, and if there is no other, all are responses. Null html: an empty payload. A null url: no target address;
    line ends in a url are escaped.
    """
    given = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    given = with_holders(given, first_holders(pages, least))
    long_enough = F.octet_length("html") >= least
    revisit = F.col("first").isNotNull() & long_enough & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    lines = F.concat_ws(
        "\r\n",
        F.lit(f"{MAGIC}1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), named(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {IDENTICAL}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), named(F.col("first")))),
        F.lit(f"Content-Type: {HTTP_TYPE}"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, 0).otherwise(F.octet_length("html"))).cast("string")),
    )
    return given.select(F.concat(lines, F.lit(END), http, F.when(revisit, "").otherwise(F.col("html"))).alias("record"))


def write_archive(pages: DataFrame, path: str) -> None:
    """Archives of `pages` in the folder `path`, one or more files a task, written by Spark and so whole or not there."""
    records(pages).write.option("lineSep", END).text(path)


def stretches(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): what stands between two places where a record may begin. Blocks are Spark's splits of the files."""
    rows = spark.read.option("lineSep", BETWEEN).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _field(head: Column, name: str, what: str = r"([^\r\n]*?)") -> Column:
    """The value of a header line; null if there is none."""
    found = F.regexp_extract(head, rf"(?i)(?:^|\n){name}:[ \t]*{what}[ \t]*(?:\r|\n|$)", 1)
    return F.when(found != "", found)


def record_fields(value: Column, head: Column, head_bytes: Column, content: Column, whole: Column) -> list[Column]:
    """The columns of a record whose text is `value`. Those of the payload are null where it isn't whole. A revisit has its
    payload's length and digest from its headers, other records from the bytes that were read."""
    kind = F.lower(_field(head, "WARC-Type"))
    block = F.substring(value.cast("binary"), head_bytes.cast("int") + 1, content.cast("int"))
    is_http = F.coalesce(_field(head, "Content-Type"), F.lit("")).startswith("application/http")
    http_head = F.when(is_http, F.substring_index(block.cast("string"), END, 1))
    payload = F.when(is_http, F.substring(block, F.octet_length(http_head) + len(END) + 1, content.cast("int"))).otherwise(block)
    page = lambda name: _field(head, name, r"<urn:page:([^>\r\n]*)>").try_cast("long")
    revisit = kind == "revisit"
    length = F.when(revisit, _field(http_head, "Content-Length", r"(\d{1,18})").try_cast("long")).otherwise(F.octet_length(payload).cast("long"))
    digest = F.when(revisit, _field(head, "WARC-Payload-Digest", "sha256:([0-9a-f]{64})")).otherwise(F.sha2(payload, 256))
    return [
        page("WARC-Record-ID").alias("page_id"),
        _field(head, "WARC-Target-URI").alias("url"),
        kind.alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        F.when(whole, length).alias("payload_bytes"),
        F.when(whole, digest).alias("payload_digest"),
    ]


def parsed(rows: DataFrame) -> DataFrame:
    """`rows` with head_bytes and content (bytes; null where no record begins) and the record's fields. The JVM alone sees the
    content. A row is `whole` if all its content is in it, and nothing besides but what ends the record."""
    named = rows.withColumn("head", F.when((F.locate(END, F.col("value")) > 0) & F.col("value").rlike(r"^(?:WARC/1\.)?[01]\r\n"), F.substring_index("value", END, 1)))
    content = _field(F.col("head"), "Content-Length", r"(\d{1,18})").try_cast("long")
    measured = named.withColumns({"size": F.octet_length("value").cast("long"), "head_bytes": F.octet_length("head").cast("long") + len(END), "content": content})
    rest = F.col("size") - F.col("head_bytes") - F.col("content")
    ended = (rest == len(END) - 1) & F.col("value").endswith(END[:-1]) | (rest == len(END)) & F.col("value").endswith(END)
    measured = measured.withColumn("whole", F.coalesce(ended, F.lit(False)))
    others = [c for c in rows.columns if c != "value"]
    return measured.select(*others, "size", F.col("value").startswith(MAGIC).alias("magic"), "head_bytes", "content", "whole", *record_fields(*map(F.col, ("value", "head", "head_bytes", "content", "whole"))))


def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with `at`: where each row begins in its block, counted from where the block's first row begins. The rows
    of a block follow each other in one task, in the order of the file."""
    now, at = None, 0
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        sizes = batch.column("size").to_pylist()
        out = np.empty(batch.num_rows, np.int64)
        for i, key in enumerate(zip(files, blocks, strict=True)):
            if key != now:
                now, at = key, 0
            out[i] = at
            at += sizes[i] + len(BETWEEN)
        yield batch.append_column("at", pa.array(out))


def exits_of(at: np.ndarray, after: np.ndarray, total: int) -> np.ndarray:
    """Of each candidate in a block: where the chain that begins with it leaves the block, or -1 if it breaks off
    inside. `after` has each one's successor, -1 if none; candidates that end later are done first."""
    out = np.full(len(at), -1, np.int64)
    to = np.searchsorted(at, after)
    for i in range(len(at) - 1, -1, -1):
        if after[i] >= total:
            out[i] = after[i]
        elif after[i] > at[i] and to[i] < len(at) and at[to[i]] == after[i]:
            out[i] = out[to[i]]
    return out


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place of the archives where a record may begin: (file, block, at, after, leaves, total, whole, the record's fields).
    `after` is the successor that its length names; `leaves` is where its chain leaves the block."""
    rows = parsed(stretches(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def done() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            at, size, head, content = (np.array(table[c].fill_null(-1)) for c in ("at", "size", "head_bytes", "content"))
            first = (at == 0) & (now[1] == 0)
            real = (head >= 0) & (content >= 0) & (np.array(table["magic"].fill_null(False)) == first)
            after = np.where(real, at + head + content + len(END) + len(MAGIC), -1)
            total = int(at[-1] + size[-1] + len(BETWEEN))
            new = {"after": after, "leaves": exits_of(at, after, total), "total": np.full(len(at), total)}
            kept = table.drop_columns(["size", "magic", "head_bytes", "content"])
            for name, values in new.items():
                kept = kept.append_column(name, pa.array(values))
            return kept.to_batches()[0]

        for batch in placed(batches):
            keys = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and keys[a] != now:
                    yield done()
                    held = []
                now = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield done()

    kinds = dict(rows.dtypes)
    kept = ", ".join(f"{c} {kinds[c]}" for c in rows.columns if c not in ("size", "magic", "head_bytes", "content"))
    return rows.mapInArrow(run, f"{kept}, at long, after long, leaves long, total long")


def entries(found: DataFrame) -> DataFrame:
    """(file, at): where the chain from the start of each file enters its blocks; `at` and `leaves` of `found` are counted from the
    start of the file here.

    Only chains' exits are linked, a few a block. Pointers are jumped: each round joins the reached places with the
    pointers and the pointers with themselves, so a file of n blocks takes log2(n) rounds and no task walks a file."""
    starts = found.where("at = 0").select("file", "at").distinct()
    exits = found.where("leaves >= 0").select("file", F.col("leaves").alias("at")).distinct()
    pointers = found.where("leaves >= 0").select("file", "at", "leaves")
    jump = checkpointed(exits.join(pointers, ["file", "at"]).unionByName(pointers.where("at = 0")).distinct())
    reached = starts
    while not jump.isEmpty():
        further = reached.join(jump, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        reached = checkpointed(reached.union(further).distinct())
        onward = jump.select("file", F.col("at").alias("from"), F.col("leaves").alias("at")).join(jump, ["file", "at"])
        jump = checkpointed(onward.select("file", F.col("from").alias("at"), "leaves"))
    return reached


def verified(found: DataFrame) -> DataFrame:
    """All candidates with places from the start of the file, `reached` (they are on the chain from the start of their file) and
    `owner`: the place of the record that a candidate is or lies in. Bounded groups: what a task takes up at once is a block."""
    blocks = found.groupBy("file", "block").agg(F.max("total").alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    moved = lambda c: F.when(F.col(c) >= 0, F.col(c) + F.col("base")).otherwise(-1).alias(c)
    others = [c for c in found.columns if c not in ("at", "after", "leaves", "total")]
    absolute = found.join(bases, ["file", "block"]).select(*others, *map(moved, ("at", "after", "leaves")))
    entered = entries(absolute).withColumn("entry", F.lit(True))
    marked = absolute.join(entered, ["file", "at"], "left")

    def follow(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        at, after = np.array(table["at"]), np.array(table["after"])
        to = np.searchsorted(at, after)
        reached = np.array(table["entry"].fill_null(False))
        for i in np.flatnonzero(reached).tolist():
            while to[i] < len(at) and after[i] > at[i] and at[to[i]] == after[i] and not reached[to[i]]:
                i = to[i]
                reached[i] = True
        last = np.maximum.accumulate(np.where(reached, np.arange(len(at)), -1))
        owner = pa.array(at[np.maximum(last, 0)], mask=last < 0)
        return table.drop_columns(["entry"]).append_column("reached", pa.array(reached)).append_column("owner", owner)

    kinds = dict(absolute.dtypes)
    order = [c for c in marked.columns if c != "entry"]
    schema = ", ".join(f"{c} {kinds[c]}" for c in order)
    done = marked.groupBy("file", "block").applyInArrow(follow, f"{schema}, reached boolean, owner long")
    carried = done.groupBy("file", "block").agg(F.max("owner").alias("last")).select("file", "block", F.max("last").over(before).alias("carried"))
    return done.join(carried, ["file", "block"]).withColumn("owner", F.coalesce("owner", "carried")).drop("carried")


def contents(spark: SparkSession, path: str, chosen: DataFrame, checked: DataFrame) -> DataFrame:
    """(file, owner, value): the text of the chosen records, put together again where their payload looks like the begin of
    others. The archives are read once more; only rows of chosen records are shuffled."""
    need = checked.join(chosen.select("file", F.col("at").alias("owner")), ["file", "owner"]).select("file", "block", "at", "owner")
    base = checked.groupBy("file", "block").agg(F.min("at").alias("base"))
    rows = stretches(spark, path).join(need.select("file", "block").distinct(), ["file", "block"], "left_semi").withColumn("size", F.octet_length("value").cast("long"))
    there = rows.select("file", "block", "value", "size").mapInArrow(placed, "file string, block long, value string, size long, at long")
    parts = there.join(base, ["file", "block"]).withColumn("at", F.col("at") + F.col("base")).join(need, ["file", "block", "at"])
    together = parts.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
    return together.select("file", "owner", F.array_join("parts.value", BETWEEN).alias("value"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, page_id, url, record_type, refers_to, payload_bytes, payload_digest) of every record of the archives in `path`.

    A task sees a block of a file and emits each place where a record may begin with the successor that its length names.
    A record counts if the chain from the start of its file reaches it, so what looks like a record inside a payload is
    none. A chain that breaks off (a damaged file) ends there; a last record that is cut off is left out. Empty archives:
    no rows. Archives are read uncompressed. A record is one value and must fit a task, as its page did.
    """
    checked = checkpointed(verified(checkpointed(candidates(spark, path))))
    columns = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    records = checked.where("reached AND after >= 0")
    whole, broken = records.where("whole").select("file", "at", *columns), checkpointed(records.where("NOT whole").select("file", "at"))
    if broken.isEmpty():
        return whole
    stitched = parsed(contents(spark, path, broken, checked).withColumnRenamed("owner", "at"))
    return whole.unionByName(stitched.where("whole").select("file", "at", *columns))


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every page, read back from archives of them.

    Archives are written to a folder of their own in the shared one, and removed once the result stands. Nulls and
    repeated rows as in `records`; extra columns are not read. An empty table: no rows.
    """
    spark = pages.sparkSession
    path = f"{folder or shared_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    write_archive(pages, path)
    read = checkpointed(read_archive(spark, path).select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    remove(spark, path)
    return read
