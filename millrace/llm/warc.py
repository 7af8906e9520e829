"""WARC archives: written with revisit records, read back by boundary chains.

Writing: each page becomes a record of HTTP headers and, unless another page has
the same payload, the payload. Of pages with equal payloads (SHA-1 and length)
the one with the largest id is the response and the others revisit it; pages
below ``min_bytes`` are all responses. Spark's text writer puts the records into
files, with the two line ends that close a record as its separator.

Reading: the text reader cuts files at the magic ``WARC/1.0`` and so finds
candidates, some of which are inside payloads. A task adds up the sizes of the
pieces of a file block, which gives each candidate's offset and, with the length
it states, that of its successor. Only what can be reached from the start of the
file is a record. Reachability comes from pointer jumping: within a block from
each candidate to the first successor behind the block, then over the blocks
of a file by joins whose number grows with the logarithm of the blocks. Pieces
between two records belong to the record before them. A file whose start holds
no record has none.

NULL html counts as empty, and empty pages are copies of each other. A NULL id
is smaller than others; it is named ``none``. Rows that repeat the largest id
are all responses. Control characters and blanks in a URL become ``%20``; a NULL
URL is empty. An empty table writes and reads no record.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import clean_text, materialize, shared_dir, slices, text_bytes

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
FILE_RECORDS = 4000
HEAVY_SHARE = 1000
_NAME = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d{1,18})[ \t]*\r?$")


def base32_sha1(value):
    """Upper-case base32 of the SHA-1 of a binary column: five hexadecimal digits make four."""
    digits = F.sha1(value)
    parts = [
        F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def planned(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with payload digest, size, record type and the page they refer to.

    Groups with more than one in ``HEAVY_SHARE`` pages are fewer than that and
    go to every task, so that such a group's pages stay where they are.
    """
    html = clean_text("html")
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        base32_sha1(F.encode(html, "UTF-8")).alias("payload_digest"),
    )
    on = ["payload_digest", "payload_bytes"]
    keys = materialize(pages.select("page_id", *on), "page-keys")
    rows = keys.count()
    least = max(rows // HEAVY_SHARE, 1)
    groups = (
        keys.where(F.col("payload_bytes") >= min_bytes)
        .groupBy(*on)
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    groups = materialize(groups, "page-groups")
    heavy = groups.where(F.col("n") > least).select(*on, F.col("largest").alias("heavy"))
    light = groups.where(F.col("n") <= least).select(*on, F.col("largest").alias("light"))
    # A page of a heavy group meets no light one: its key is its own.
    mark = F.when(F.col("is_heavy"), F.concat(F.lit("-"), F.uuid())).otherwise(F.col("payload_digest"))
    found = (
        pages.join(F.broadcast(heavy.withColumn("is_heavy", F.lit(True))), on, "left")
        .withColumn("mark", mark)
        .join(light.withColumnsRenamed({on[0]: "mark", on[1]: "light_bytes"}), "mark", "left")
        .withColumn("largest", F.coalesce("heavy", "light"))
    )
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return found.select(
        "page_id",
        "url",
        "html",
        *on,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("largest")).alias("refers_to"),
    )


def _uri(page):
    return F.concat(F.lit(f"<{_NAME}"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def record_text(date: str):
    """A record of a planned page, without the two line ends that close it."""
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    response = F.col("record_type") == "response"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(response, F.col("html")).otherwise(F.lit("")))
    refers = F.concat(
        F.lit("\r\nWARC-Refers-To: "),
        _uri(F.col("refers_to")),
        F.lit(f"\r\nWARC-Profile: {_PROFILE}"),
    )
    return F.concat(
        F.lit(f"{MAGIC}WARC-Type: "),
        F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "),
        _uri(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "),
        url,
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(response, F.lit("")).otherwise(refers),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Write one record for each page to files of at most ``FILE_RECORDS`` records."""
    records = planned(pages, min_bytes).select(record_text(date).alias("value"))
    writer = records.write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("compression", "none").text(path)


_PIECE = "file string, block long, at long, size long, next long"


def _cut(with_content: bool):
    """Offsets of pieces within their block; pieces of a block come in order."""

    def run(batches):
        place, at = None, 0
        for batch in batches:
            for part in slices([batch], "content"):
                files, blocks = part.column("file").to_pylist(), part.column("block").to_pylist()
                starts, sizes, following = [], [], []
                for i, own in enumerate(zip(files, blocks, strict=True)):
                    if own != place:
                        place, at = own, 0
                    content = text_bytes(part.column("content")[i])
                    starts.append(at)
                    sizes.append(len(content) + len(MAGIC))
                    end = content.find(END.encode())
                    stated = _LENGTH.search(content, 0, end) if end >= 0 else None
                    following.append(at + end + 8 + int(stated[1]) if stated else None)
                    at += sizes[-1]
                arrays = [
                    part.column("file"),
                    part.column("block"),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(following, pa.int64()),
                ]
                names = ["file", "block", "at", "size", "next"]
                if with_content:
                    arrays.append(part.column("content"))
                    names.append("content")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def pieces(spark: SparkSession, path: str, with_content: bool) -> DataFrame:
    """What lies between two magics of an archive, with its offset within the block."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("content"),
    )
    schema = _PIECE + (", content binary" if with_content else "")
    return lines.mapInArrow(_cut(with_content), schema)


def _successors(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Index of each candidate's successor within the same block, or its own index."""
    own = np.arange(len(at))
    slot = np.minimum(np.searchsorted(at, following), len(at) - 1)
    return np.where(at[slot] == following, slot, own)


def _exits(frame: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a block, the first offset its chain reaches behind the block."""
    frame = frame.sort_values("at")
    at, following = frame["at"].to_numpy(), frame["next"].to_numpy()
    jump = _successors(at, following)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    return pd.DataFrame({"file": frame["file"].iloc[0], "at": at, "next": following[jump]})


def _reached(frame: pd.DataFrame) -> pd.DataFrame:
    """Candidates of a block on the chain from its entry."""
    frame = frame.sort_values("at")
    at = frame["at"].to_numpy()
    jump = _successors(at, frame["next"].to_numpy())
    reached = frame["entry"].to_numpy(dtype=bool).copy()
    while True:
        more = reached.copy()
        more[jump[reached]] = True
        if (more == reached).all():
            break
        reached, jump = more, jump[jump]
    return pd.DataFrame({"file": frame["file"].iloc[0], "at": at[reached]})


def _entries(exits: DataFrame) -> DataFrame:
    """Where chains from the start of a file enter blocks: pointer jumping by joins.

    Offsets count from the end of the magic, so the first record is at its length.
    """
    reached = exits.where(F.col("at") == len(MAGIC)).select("file", "at")
    jump = exits.join(
        exits.select("file", F.col("at").alias("next")), ["file", "next"], "left_semi"
    ).select("file", "at", "next")
    while True:
        jump = materialize(jump, "chain-jumps")
        if jump.isEmpty():
            return reached
        new = reached.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = materialize(reached.unionByName(new).distinct(), "chain-reached")
        behind = jump.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        jump = jump.join(behind, ["file", "next"]).select("file", "at", F.col("after").alias("next"))


def boundaries(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Offset of each block in its file, and the pieces that are not a record by themselves.

    Those have the record they belong to, or none. They are few where payloads
    do not imitate records, and then the content of the others need not move.
    """
    sizes = found.groupBy("file", "block").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(
        sizes.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")),
        "block-bases",
    )
    placed = found.join(bases, ["file", "block"]).select(
        "file",
        "block",
        (F.col("at") + F.col("base")).alias("at"),
        (F.col("next") + F.col("base") + len(MAGIC)).alias("next"),
    )
    # The piece at 0 lies before the first magic and is no candidate.
    chain = placed.where(F.col("next").isNotNull() & (F.col("at") > 0))
    exits = materialize(
        chain.groupBy("file", "block").applyInPandas(_exits, "file string, at long, next long"),
        "chain-exits",
    )
    entries = _entries(exits).withColumn("entry", F.lit(True))
    marked = chain.join(entries, ["file", "at"], "left").withColumn(
        "entry", F.coalesce("entry", F.lit(False))
    )
    records = marked.groupBy("file", "block").applyInPandas(_reached, "file string, at long")
    owned = placed.join(records.withColumn("record", F.col("at")), ["file", "at"], "left")
    last = Window.partitionBy("file").orderBy("at")
    owned = owned.withColumn("record", F.last("record", ignorenulls=True).over(last))
    pieces_of = owned.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"))
    several = pieces_of.where(F.col("record").isNull() | (F.col("n") > 1)).select("file", "record")
    same = F.col("o.record").eqNullSafe(F.col("s.record")) & (F.col("o.file") == F.col("s.file"))
    special = owned.alias("o").join(several.alias("s"), same, "left_semi")
    return bases, materialize(special.select("o.file", "o.at", "o.record"), "split-records")


_RECORD = (
    "record_type string, page_id long, url string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _header(lines: bytes) -> dict[str, str]:
    pairs = (x.partition(b":") for x in lines.split(b"\r\n"))
    return {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def _page(uri: str | None) -> int | None:
    named = (uri or "").strip("<>").removeprefix(_NAME)
    return int(named) if re.fullmatch(r"-?\d+", named) else None


def _parsed(batches):
    """Fields and payload of records; a revisit's size and digest are those it states."""
    for batch in batches:
        for part in slices([batch], "content"):
            rows = []
            for value in part.column("content"):
                head, _, rest = text_bytes(value).partition(END.encode())
                fields = _header(head)
                block = rest[: int(fields["content-length"])]
                http, _, payload = block.partition(END.encode())
                kind = fields.get("warc-type")
                stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                if kind == "revisit":
                    size, digest, payload = int(_header(http).get("content-length", 0)), stated, None
                else:
                    size = len(payload)
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                rows.append(
                    (
                        kind,
                        _page(fields.get("warc-record-id")),
                        fields.get("warc-target-uri"),
                        _page(fields.get("warc-refers-to")),
                        size,
                        digest,
                        payload,
                    )
                )
            if not rows:
                continue
            names = [c.split()[0] for c in _RECORD.split(", ")]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of archives: type, page, URL, page referred to, size, digest and payload.

    The archives are scanned twice. Should the second scan cut files into other blocks
    than the first, as after a change of the cluster's size, it fails; run it again.
    """
    found = materialize(pieces(spark, path, False), "archive-pieces")
    bases, special = boundaries(found)
    unknown = F.raise_error(F.lit("an archive was cut into other blocks than before")).cast("long")
    content = pieces(spark, path, True).join(bases, ["file", "block"], "left").select(
        "file", (F.col("at") + F.coalesce("base", unknown)).alias("at"), "content"
    )
    single = content.join(special, ["file", "at"], "left_anti").select("content")
    ordered = F.array_sort(F.collect_list(F.struct("at", "content")))
    magic = F.lit(MAGIC).cast("binary")
    several = (
        content.join(special.where(F.col("record").isNotNull()), ["file", "at"])
        .groupBy("file", "record")
        .agg(ordered.alias("parts"))
        .select(
            F.aggregate(
                F.slice("parts", 2, F.size("parts")),
                F.col("parts")[0]["content"],
                lambda done, part: F.concat(done, magic, part["content"]),
            ).alias("content")
        )
    )
    return single.unionByName(several).mapInArrow(_parsed, _RECORD)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)


def reported(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
