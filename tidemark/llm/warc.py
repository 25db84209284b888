"""Operator 4: WARC archives and the merge of their capture indexes.

Each page becomes a record: the first page (smallest page_id) of those with equal
payloads of at least 100 bytes is a response, the others revisit it. Records are
written as compressed WARC files by Spark's text writer, whose record separator is
the two line ends that close a WARC record, and read back by their content lengths.
Every file gives a capture run sorted by URL key, time and record; the runs' parts
that fall into a range of keys are merged there by a loser tree, and with the ranges'
sizes each capture gets its place in the global order.

Null html is an empty payload, a null url an empty key. Repeated rows of a page_id are
records of their own; of equal page_ids all are responses. Null page_ids rank last and
are never referred to. Other columns of the input are not read.
"""

from __future__ import annotations

import gzip
import hashlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ORACLE, QUERIES, shared_folder, table, written

LEAST = 100
PER_FILE = 5000
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CAPTURES = "page_id long, url string, urlkey string, captured string, record_type string, refers_to long, payload_bytes long, payload_digest string, run string, offset long, length long"


class LoserTree:
    """Merges k sorted runs; each step replays one path from a leaf to the root."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.heads = [(key(r[0]), i) if r else None for i, r in enumerate(runs)]
        self.loser = [-1] * max(self.k, 1)
        self.winner = self._play(1) if self.k > 1 else 0

    def _play(self, node: int) -> int:
        """The winner below a node; its loser stays at the node."""
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        a, b = (a, b) if self._before(a, b) else (b, a)
        self.loser[node] = b
        return a

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and x < y

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            w = self.winner
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.heads[w] = (self.key(self.runs[w][self.at[w]]), w) if self.at[w] < len(self.runs[w]) else None
            node = (w + self.k) // 2
            while node >= 1 and self.k > 1:
                if self._before(self.loser[node], w):
                    w, self.loser[node] = self.loser[node], w
                node //= 2
            self.winner = w


def url_key(url: str | None) -> str:
    """Host from its last part on, then path and sorted query, in lower case."""
    try:
        parts = urlsplit((url or "").strip())
        host = ",".join(reversed((parts.hostname or "").removeprefix("www.").split(".")))
        query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
        return f"{host}){parts.path.rstrip('/') or '/'}{query}".lower() if url else ""
    except ValueError:
        return (url or "").lower()


def records(pages: DataFrame) -> DataFrame:
    """record: one WARC record as text, without the two line ends that close it."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    own = own.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    first = own.where(f"bytes >= {LEAST}").groupBy(F.col("digest").alias("digest_")).agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # Only ids and digests meet; the payloads then join by the few ids that revisit.
    who = own.where(f"bytes >= {LEAST}").select("page_id", "digest").join(first, F.col("digest") == F.col("digest_")).where("page_id <> first").select(F.col("page_id").alias("page_id_"), "first").distinct()
    own = own.join(who, F.col("page_id") == F.col("page_id_"), "left")
    revisit = F.col("first").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    date = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce(F.pmod("page_id", F.lit(86400 * 365)), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    content = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", "")),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("first")), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(content).cast("string")),
    )
    return own.select(F.concat(head, F.lit("\r\n\r\n"), content).alias("record"))


def archived(pages: DataFrame) -> str:
    """Writes the pages' records as .gz archives; returns their folder."""
    path = shared_folder(pages.sparkSession, "warc")
    records(pages).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", PER_FILE).text(path)
    return path


def parsed(raw: bytes):
    """(headers, content, offset, length) of each record of an archive."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in raw[at:end].decode().split("\r\n")[1:])
        start, size = end + 4, int(head["Content-Length"])
        yield head, raw[start : start + size], at, start + size - at
        at = start + size + 4


def captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives; a response's payload is measured and held against its digest."""

    def page(urn: str | None) -> int | None:
        return int(x) if (x := (urn or "")[10:-1]) else None

    def read(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0), batch.column(1), strict=True):
                out: list[tuple] = []
                for head, content, offset, length in parsed(gzip.decompress(raw.as_py())):
                    size, digest = int(head["WARC-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if head["WARC-Type"] == "response":
                        payload = content[content.index(b"\r\n\r\n") + 4 :]
                        if (size, digest) != (len(payload), got := hashlib.sha256(payload).hexdigest()):
                            raise ValueError(f"record at {offset} of {name}: payload {got} is not {digest}")
                    url = head["WARC-Target-URI"]
                    out.append((page(head["WARC-Record-ID"]), url, url_key(url), head["WARC-Date"], head["WARC-Type"], page(head.get("WARC-Refers-To")), size, digest, name.as_py().rsplit("/", 1)[-1], offset, length))
                out.sort(key=_order)
                yield pa.RecordBatch.from_pylist([dict(zip(_names, r, strict=True)) for r in out], schema=_schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(read, CAPTURES)


_names = [f.split()[0] for f in CAPTURES.split(", ")]
_schema = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in CAPTURES.split(", ")])


def _order(row) -> tuple:
    return row[2], row[3], -1 if row[0] is None else row[0], row[8], row[9]


def merged(runs: DataFrame) -> DataFrame:
    """Captures with range and rank_in_range: the runs' parts of each range of keys merged by a loser tree."""

    def merge(batches):
        import itertools

        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]  # one range
        if rows:
            parts = [list(g) for _, g in itertools.groupby(rows, key=lambda r: r[8])]
            got = list(LoserTree(parts, _order))
            schema = pa.schema([*_schema, ("range", pa.int32()), ("rank_in_range", pa.int64())])
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*r[:11], r[11], k), strict=True)) for k, r in enumerate(got)], schema=schema)

    dealt = runs.repartitionByRange("urlkey", "captured", "page_id").withColumn("range", F.spark_partition_id())
    dealt = dealt.sortWithinPartitions("run", "urlkey", "captured", F.coalesce("page_id", F.lit(-1)), "offset")
    return dealt.mapInArrow(merge, f"{CAPTURES}, range int, rank_in_range long")


def capture_history(pages: DataFrame) -> DataFrame:
    """Every capture with its place in the global order by URL key and time."""
    spark = pages.sparkSession
    rows = written(merged(written(captures(spark, archived(pages)), "runs")), "merged")
    sizes = rows.groupBy("range").count().select("range", "count").collect()  # one row per range
    before, total = {}, 0
    for r in sorted(sizes):
        before[r[0]], total = total, total + r[1]
    start = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("range")) if before else F.lit(0)
    return rows.withColumn("place", (start + F.col("rank_in_range")).cast("long")).drop("range", "rank_in_range")


def op4_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_history(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def capture_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_history(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "urlkey", "captured", "place")


QUERIES["op4_warc_index_merge"] = op4_warc_index_merge
QUERIES["capture_places"] = capture_places
ORACLE["op4_warc_index_merge"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (SELECT page_id, sha256(payload) AS payload_digest, CAST(strlen(payload) AS BIGINT) AS payload_bytes FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM r
"""
