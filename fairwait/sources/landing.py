"""Landing a window from a paged service so that a repeated job fetches only what is missing.

Slices are fetched in waves, which double in length up to a number of records, so that a large job is not
very many small waves. What a wave completes is written beside the last landing and noted in a ledger: bounds,
number of records and checksum per slice. When the ledger covers the window, one commit makes its slices the
window's state; until then readers see the last landing. A job that is repeated goes on with the ledger
of the one before, as far as the service still counts the same.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwait.sources import snapshots
from fairwait.sources.pages import AT_ONCE, PAGE_SIZE, SLICE_PAGES, Count, Fetch, Slice, planned, read_slices, registered
from fairwait.sources.snapshots import PREFIX, Folder

LEDGER = "_ledger"
ROWS_IN_TURN = 500_000  # records that a task of a wave fetches, sorts and writes, in one slice or several


class LandingIncomplete(RuntimeError):
    """Slices that could not be fetched; the others are in the ledger."""


@dataclass(frozen=True)
class Entry:
    """A slice that is written: its records, the sum of their crc32, and the folder with them."""

    low: str
    high: str
    offset: int
    rows: int
    checksum: int
    path: str


def read_ledger(folder: Folder, name: str) -> list[Entry]:
    """What the complete files of the ledger of snapshot ``name`` note."""
    files = sorted(n for n in folder.names(f"{name}/{LEDGER}") if n.endswith(".json"))
    texts = [folder.get(f"{name}/{LEDGER}/{file}") for file in files]
    return [Entry(**entry) for text in texts if text is not None for entry in json.loads(text)]


def gaps(start: str, end: str, known: Sequence[Entry]) -> list[tuple[str, str]]:
    """The spans of the window that no known slice covers."""
    found, at = [], start
    for low, high in sorted({(e.low, e.high) for e in known}, key=lambda span: datetime.fromisoformat(span[0])):
        if datetime.fromisoformat(low) > datetime.fromisoformat(at):
            found.append((at, low))
        at = max(at, high, key=datetime.fromisoformat)
    return found + ([(at, end)] if datetime.fromisoformat(at) < datetime.fromisoformat(end) else [])


def still_true(entries: Sequence[Entry], count: Count | None, on: str, at_once: int) -> list[Entry]:
    """Slices of which the service still counts what was fetched. An instant dealt by offset counts as a whole."""
    if count is None:
        return list(entries)
    spans: dict[tuple[str, str], list[Entry]] = {}
    for entry in entries:
        spans.setdefault((entry.low, entry.high), []).append(entry)
    with ThreadPoolExecutor(at_once) as pool:
        counts = pool.map(lambda span: count(Slice(*span).condition(on)), spans)
        return [e for span, n in zip(spans.values(), counts) if sum(x.rows for x in span) == n for e in span]


def attempts(spark: SparkSession) -> int:
    """How often Spark tries a task."""
    master = spark.sparkContext.master
    if master.startswith("local["):
        found = re.search(r",(\d+)\]", master)
        return int(found[1]) if found else 1
    return int(spark.sparkContext.getConf().get("spark.task.maxFailures", "4"))


def land_slices(
    spark: SparkSession,
    fetch: Fetch,
    start: str,
    end: str,
    target: str,
    on: str = "created_date",
    slice_hours: float = 24,
    size: int = PAGE_SIZE,
    at_once: int = AT_ONCE,
    count: Count | None = None,
) -> int:
    """Land ``start <= on < end`` as the new state of ``target``; returns the number of records.

    A wave is ``at_once`` tasks, so no more calls than that reach the service together. A task of the first wave fetches one
    slice, and where the service counts, tasks of each further wave twice as many, up to ``ROWS_IN_TURN``. A slice that fails does
    not undo the others of its wave; ``LandingIncomplete`` is raised after it, and ``target`` stays as it was.
    """
    folder = Folder(spark, target)
    number, name = snapshots.begin(spark, target)
    begun = [n for n in folder.names() if n.startswith(f"{PREFIX}{number:08d}-") and folder.names(f"{n}/{LEDGER}")]
    name = min(begun, default=name)
    entries = still_true(read_ledger(folder, name), count, on, at_once)
    slices = [s for low, high in gaps(start, end, entries) for s in planned(low, high, on, slice_hours, size, count, at_once)]
    source, tries = registered(spark, fetch, count), attempts(spark)
    first, in_turn = 0, 1
    most = 1 if count is None else max(1, ROWS_IN_TURN // (size * SLICE_PAGES))
    while first < len(slices):
        wave = f"wave-{uuid.uuid4().hex[:12]}"
        asked = slices[first : first + at_once * in_turn]
        fetched = read_slices(spark, source, asked, on, size, report=tries, tasks=at_once)
        fetched.write.partitionBy("slice", "kind").text(folder.at(f"{name}/{wave}"))
        told = spark.read.text(folder.at(f"{name}/{wave}")).where("kind <> 'data'").collect()
        said = {row["slice"]: json.loads(row["value"]) for row in told if row["kind"] == "done"}
        written = [
            Entry(asked[k].low, asked[k].high, asked[k].offset, s["rows"], s["checksum"], f"{wave}/slice={k}/kind=data")
            for k, s in sorted(said.items())
        ]
        if written:
            noted = json.dumps([asdict(entry) for entry in written])
            folder.put_new(f"{name}/{LEDGER}/{len(folder.names(f'{name}/{LEDGER}')):06d}.json", noted)
        entries += written
        failed = [json.loads(row["value"]) for row in told if row["kind"] == "failed"]
        if failed:
            left = len(slices) - first - len(asked) + len(failed)
            raise LandingIncomplete(f"{left} of {len(slices)} slices left to fetch: {failed[0]}")
        first, in_turn = first + len(asked), min(2 * in_turn, most)
    rows = sum(entry.rows for entry in entries)
    notes = [[f"{name}/{e.path}", e.rows, e.checksum] for e in entries if e.rows]
    snapshots.commit(spark, target, number, [path for path, _, _ in notes], rows=rows, slices=notes)
    snapshots.expire(spark, target)
    return rows


def damaged(spark: SparkSession, target: str) -> DataFrame:
    """(path, rows, checksum, found_rows, found_checksum) of slices whose files no longer hold what was fetched."""
    notes = snapshots.commits(spark, target, 1)[0].facts.get("slices", [])
    noted = spark.createDataFrame([tuple(n) for n in notes], "path string, rows long, checksum long")
    folder = Folder(spark, target)
    there = [folder.at(path) for path, _, _ in notes if folder.names(path)]
    if not there:
        return noted.select("*", F.lit(0).cast("long").alias("found_rows"), F.lit(0).cast("long").alias("found_checksum"))
    lines = spark.read.option("recursiveFileLookup", "true").text(there)
    path = F.regexp_extract(F.col("_metadata.file_path"), f"/({PREFIX}[^/]+/.*)/[^/]+$", 1)
    found = lines.groupBy(F.url_decode(path).alias("path")).agg(
        F.count(F.lit(1)).alias("found_rows"), F.sum(F.crc32("value")).alias("found_checksum")
    )
    both = noted.join(found, "path", "left").na.fill(0, ["found_rows", "found_checksum"])
    return both.where("rows <> found_rows or checksum <> found_checksum")
