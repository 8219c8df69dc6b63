"""WARC archives written and read by Spark, with an index merged from sorted runs.

Writing: equal payloads of at least `least` bytes are found by digest; the row with the largest page_id is the response,
the others are revisits that name it. Each row becomes one record as text (header, blank line, payload), and the text
writer with a blank line as its line end puts the records one after the other: a valid WARC file, on any file
system Spark writes to.

Reading: whole files of bounded size, cut at Content-Length. Each file gives a run of index rows sorted by URL key,
time and page. Key ranges of all runs meet in the merge tasks, where a loser tree of the runs yields them in order,
so the parts of the result, one after the other, are the capture histories in global order.

Defined results: a null payload is empty; a null url is the empty key. Equal payloads with equal page_ids (repeated rows)
are each a response. Rows with a null page_id are written as responses or revisits of the largest id and read
back with a null id. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.llm.common import let, scratch_path, ship

LEAST_BYTES = 1000
#: A reader holds one file at a time.
RECORDS_PER_FILE = 2000
END = "\r\n"
#: Of the index; page_id and what it refers to keep the type of the table.
INDEX = "url_key string, captured string, file string, at long, length long, payload_bytes long, payload_digest string, record_type string"


def records(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """url, page_id, record: one WARC record, as text, for each row of `pages` (page_id, url, html)."""
    rows = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")
    ).select("page_id", "url", "html", F.octet_length("html").alias("n"), F.sha1("html").alias("digest"))
    # Ids and digests only; the payloads stay where they are.
    winners = (
        rows.where(F.col("n") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("winner"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select(F.col("digest").alias("_digest"), "winner")
    )
    joined = rows.join(winners, (F.col("digest") == F.col("_digest")) & (F.col("n") >= least), "left")
    revisit = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    captured = F.date_format(F.timestamp_seconds(F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(2**32))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        ("WARC-Target-URI", safe_uri(F.col("url"))),
        ("WARC-Date", captured),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Payload-Length", F.col("n").cast("string")),
        ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("winner").cast("string"), F.lit(">")))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.when(revisit, "0").otherwise(F.col("n").cast("string"))),
    ]
    # concat_ws leaves out the fields that are null
    head = F.concat_ws(END, F.lit("WARC/1.1"), *[F.concat(F.lit(f"{k}: "), v) for k, v in fields])
    body = F.when(revisit, "").otherwise(F.col("html"))
    return joined.select("page_id", "url", F.concat(head, F.lit(END + END), body).alias("record"))


def safe_uri(url: Column) -> Column:
    """Line ends and the escape sign escaped, so that a header field stays one line and comes back as it was."""
    out = F.replace(url, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write the records of `pages` as compressed WARC files under `path`."""
    out = records(pages, least).select("record").write.option("lineSep", END + END)
    out.option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path)


def parsed(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Place, length, header fields and payload of each record of a file."""
    at = 0
    while at < len(content):
        blank = content.index(b"\r\n\r\n", at)
        lines = content[at:blank].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start = blank + 4
        end = start + int(head["Content-Length"])
        if content[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end after its length")
        yield at, end - at, head, content[start:end]
        at = end + 4


def url_key(url: str) -> str:
    """Host labels reversed, then port, path and query, lower-case host: captures of a site sort together."""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return quote(url, safe=":/?&=%,;@+~#")
    return f"{host}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def page_of(field: str | None) -> int | None:
    digits = field[len("<urn:page:") : -1] if field else ""
    return int(digits) if digits else None


def index(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """One row for each record of the files under `path`, in a sorted run for each file. Payloads are digested anew."""
    ship(spark)
    schema = f"{INDEX}, page_id {kind}, refers_to {kind}"
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                for at, length, head, payload in parsed(gzip.decompress(content)):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(head["WARC-Payload-Length"])
                    if head["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{file}: the payload at byte {at} does not have its digest")
                    url = unquote(head["WARC-Target-URI"], errors="strict") if "%" in head["WARC-Target-URI"] else head["WARC-Target-URI"]
                    rows.append(
                        (url_key(url), head["WARC-Date"], file, at, length, size, digest, head["WARC-Type"],
                         page_of(head["WARC-Record-ID"]), page_of(head.get("WARC-Refers-To")))
                    )
                rows.sort(key=lambda r: (r[0], r[1], r[8] is not None, r[8]))
                out = pd.DataFrame(rows, columns=names)
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, schema)


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of their match, so a new head replays one path only."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, max(len(runs), 1)
        self.heads = [next(run, None) for run in runs] + [None] * (self.k - len(runs))
        self.tree = [-1] * self.k
        for i in range(self.k):
            self.replay(i)

    def beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) < (y, b)

    def replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            held = self.tree[node]
            if held < 0:  # while the tree is built: wait for the other side
                self.tree[node] = winner
                return
            if self.beats(held, winner):
                self.tree[node], winner = winner, held
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[self.tree[0]]) is not None:
            winner = self.tree[0]
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self.replay(winner)


def merge(runs: DataFrame, parts: int | None = None) -> DataFrame:
    """The rows of all sorted runs in one order: by url_key, captured, page_id over the parts of the result.

    A part holds a range of keys; captures of one URL may be spread over several parts, as time and page are in the key.
    """
    ship(runs.sparkSession)
    key = ["url_key", "captured", "page_id"]
    parts = parts or int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.repartitionByRange(parts, *key).sortWithinPartitions("file", *key)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        pages = rows["page_id"].astype("Int64")
        keys = zip(rows["url_key"], rows["captured"], pages.notna(), pages.fillna(0), rows.index, strict=True)
        cuts = rows["file"].ne(rows["file"].shift()).to_numpy().nonzero()[0].tolist() + [len(rows)]
        flat = list(keys)
        order = [k[-1] for k in LoserTree([iter(flat[a:b]) for a, b in zip(cuts, cuts[1:])])]
        yield rows.iloc[order].astype({"page_id": "Int64", "refers_to": "Int64"})

    return dealt.mapInPandas(merged, dealt.schema)


def round_trip(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write `pages` as archives into the shared folder, read them back and return the merged index."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, least)
    kind = dict(pages.dtypes)["page_id"]
    return merge(index(spark, path, kind))
