"""Web archives: records written and read back, and an index merged from sorted runs.

Writing: payloads are digested with SHA-1; of equal payloads of at least ``LEAST_BYTES``
the one with the largest page_id is a response, the others are revisits that name it.
Records are WARC/1.1, laid end to end in archive files. Spark's text sink writes them:
a record ends in two line ends, the second of which is the sink's separator. Archives are gzip files; places count unpacked bytes.

Reading: each archive is parsed by its length fields, payloads are digested again, and
the archive's captures leave as one run, sorted by (URL key, timestamp, page). The runs
are dealt by range over all three, so a host or page that holds a third of the captures
is spread; each task merges the runs' parts of its range with a loser tree. The result
is in global order, and captures of a URL key are numbered through.

Defined results: a null html is an empty payload; a null url has an empty URL key; a
null page_id stays null and cannot be referred to; rows that repeat the largest page_id
of their payload are all responses. Archives are about ``ARCHIVE_BYTES`` long.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.session import run_folder, staged

LEAST_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
MERGE_ROWS = 100_000
#: Capture time of page 0; pages follow by the second, as the table has no times.
FIRST_CAPTURE = "2024-01-01 00:00:00"
END = "\r\n"


def digested(pages: DataFrame) -> DataFrame:
    """page_id, size and digest of every payload, and its record type."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = staged(
        pages.select("page_id", F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("digest")), "warc-digests"
    )
    # Copies shrink to one row per task and payload before the shuffle.
    latest = (
        rows.where(F.col("bytes") >= LEAST_BYTES)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.max("page_id").alias("latest"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    joined = rows.join(latest, (F.col("digest") == F.col("_digest")) & (F.col("bytes") >= LEAST_BYTES), "left")
    other = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return joined.select("page_id", "bytes", "digest", F.when(other, F.col("latest")).alias("refers_to"))


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(END))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, types: DataFrame) -> DataFrame:
    """One string per page: its record without the last line end."""
    # Rows that repeat a page_id must not multiply, so equal facts of a page are taken once.
    facts = types.distinct().select(*[F.col(c).alias(f"_{c}") for c in types.columns])
    html = F.coalesce("html", F.lit(""))
    payload = F.encode(html, "UTF-8")
    mine = F.col("page_id").eqNullSafe(F.col("_page_id")) & (F.sha1(payload) == F.col("_digest"))
    joined = pages.select("page_id", "url", "html").join(facts, mine, "left")
    revisit = F.col("_refers_to").isNotNull()
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "")
    taken = F.timestamp_add("SECOND", F.coalesce(F.col("page_id"), F.lit(0)), F.lit(FIRST_CAPTURE).cast("timestamp"))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}"),
        _line("Content-Type", "text/html; charset=utf-8"),
        _line("Content-Length", F.col("_bytes").cast("string")),
        F.lit(END),
    )
    block = F.concat(head, F.when(revisit, F.lit("")).otherwise(html))
    lines = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.date_format(taken, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                _line("WARC-Refers-To", _record_id(F.col("_refers_to"))),
            ),
        ).otherwise(F.lit("")),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
    )
    return joined.select(F.concat(lines, block, F.lit(END)).alias("value"))


def write_archives(pages: DataFrame, path: str) -> str:
    types = staged(digested(pages), "warc-types")
    size = types.agg(F.avg("bytes").alias("mean")).first()["mean"] or 0
    per_file = max(1, int(ARCHIVE_BYTES / (size + 600)))
    writer = records(pages, types).write.option("lineSep", END).option("maxRecordsPerFile", per_file).option("compression", "gzip")
    writer.text(path)
    return path


def url_key(url: str) -> str:
    """Sort-friendly key: host reversed by its parts, then path and query; no scheme, user, port or fragment."""
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)", url)
    if not found:
        return url
    host = re.sub(r"^www\.", "", found[1].lower())
    return ",".join(reversed(host.split("."))) + ")" + (found[2] or "/")


def parse(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header and block of every record of an archive."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        first, *lines = content[at:end].decode("utf-8", "surrogatepass").split(END)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        block = content[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at {at} is cut off")
        yield at, end + 4 + size + 4 - at, fields, block
        at = end + 4 + size + 4


def _page(record_id: str | None) -> int | None:
    number = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


CAPTURES = (
    "url_key string, captured string, page_id long, archive string, place long, length long, run string, run_no long, "
    "record_type string, payload_bytes long, payload_digest string, refers_to long"
)
NAMES = [part.split()[0] for part in CAPTURES.split(", ")]


def _order(row: dict) -> tuple:
    page = row["page_id"]
    return row["url_key"], row["captured"], page is not None, page or 0, row["archive"], row["place"]


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """Every archive's captures as a sorted run."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches):
        for batch in batches:
            for name, content in zip(batch[0].to_pylist(), batch[1]):
                rows = []
                for place, length, fields, block in parse(gzip.decompress(content.as_py())):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    kind, stated = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(re.search(rb"Content-Length: ([0-9]+)", head)[1])
                    if kind == "response" and (hashlib.sha1(payload).hexdigest() != stated or len(payload) != size):
                        raise ValueError(f"payload at {place} of {name} does not agree with its digest")
                    rows.append(
                        {
                            "url_key": url_key(fields["WARC-Target-URI"]),
                            "captured": fields["WARC-Date"],
                            "page_id": _page(fields["WARC-Record-ID"]),
                            "archive": name,
                            "place": place,
                            "length": length,
                            "run": name,
                            "run_no": 0,
                            "record_type": kind,
                            "payload_bytes": size,
                            "payload_digest": stated,
                            "refers_to": _page(fields.get("WARC-Refers-To")),
                        }
                    )
                rows.sort(key=_order)
                for number, row in enumerate(rows):
                    row["run_no"] = number
                schema = pa.schema([(n, pa.int64() if k == "long" else pa.string()) for n, k in (p.split() for p in CAPTURES.split(", "))])
                yield from pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=10_000)

    return files.mapInArrow(read, CAPTURES)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the root the winner.

    Taking a row replays one path, log2(runs) comparisons.
    """

    def __init__(self, runs: list[list[dict]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = len(runs)
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf)

    def _key(self, run: int):
        at = self.at[run]
        return _order(self.runs[run][at]) if at < len(self.runs[run]) else None

    def _before(self, a: int, b: int) -> bool:
        """Whether run ``a`` wins; an exhausted run loses, equal rows keep the order of runs."""
        x, y = self._key(a), self._key(b)
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1:  # no opponent yet: wait here
                self.losers[node] = run
                return
            if self._before(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[dict]:
        if not self.k:
            return
        while True:
            run = self.losers[0]
            if self.at[run] >= len(self.runs[run]):
                return
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self._play(run)


def merge_runs(captures: DataFrame, rows: int) -> DataFrame:
    """All runs in one global order, with ``part`` (tasks follow the order) and ``seen`` (number within key and part)."""
    parts = max(1, -(-rows // MERGE_ROWS))
    dealt = captures.repartitionByRange(parts, "url_key", "captured", "page_id", "archive", "place")
    schema = f"{CAPTURES}, part int, seen long"

    def merge(batches):
        runs: dict[str, list[dict]] = {}
        kind = None
        for batch in batches:
            kind = batch.schema
            for row in batch.to_pylist():
                runs.setdefault(row["run"], []).append(row)
        if kind is None:
            return
        for run in runs.values():
            run.sort(key=lambda row: row["run_no"])  # rows of a run may arrive in several blocks
        part = TaskContext.get().partitionId()
        out = kind.append(pa.field("part", pa.int32())).append(pa.field("seen", pa.int64()))
        held, last, seen = [], None, 0
        for row in LoserTree([runs[name] for name in sorted(runs)]):
            seen = seen + 1 if row["url_key"] == last else 1
            last = row["url_key"]
            held.append({**row, "part": part, "seen": seen})
            if len(held) == 5_000:
                yield pa.RecordBatch.from_pylist(held, schema=out)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=out)

    return dealt.mapInArrow(merge, schema)


def capture_histories(spark: SparkSession, path: str) -> DataFrame:
    """The merged index of archives; ``capture_no`` numbers the captures of a URL key."""
    captures = staged(capture_runs(spark, path), "warc-captures")
    merged = staged(merge_runs(captures, captures.count()), "warc-index")
    # A key can run on over parts: one row per part and key that it ends or begins there.
    counts = merged.groupBy(F.col("url_key").alias("_key"), F.col("part").alias("_part")).agg(F.max("seen").alias("held"))
    split_keys = counts.groupBy("_key").agg(F.min("_part").alias("low"), F.max("_part").alias("high")).where("low < high")
    spread = counts.join(split_keys.select("_key"), "_key", "left_semi")
    earlier = spread.alias("a").join(spread.alias("b"), (F.col("a._key") == F.col("b._key")) & (F.col("b._part") < F.col("a._part")))
    shifts = earlier.groupBy(F.col("a._key").alias("_key"), F.col("a._part").alias("_part")).agg(F.sum("b.held").alias("before"))
    joined = merged.join(shifts, (F.col("url_key") == F.col("_key")) & (F.col("part") == F.col("_part")), "left")
    number = F.col("seen") + F.coalesce("before", F.lit(0))
    return joined.select(*[c for c in NAMES if c not in ("run", "run_no")], number.alias("capture_no"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages as archives, read them back, and merge their index."""
    path = write_archives(pages, run_folder(pages.sparkSession, "warc"))
    return capture_histories(pages.sparkSession, path)
