"""Jobs whose tasks fail once: run in a process of its own, as local sessions do not retry by default."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
from pathlib import Path

root, out = sys.argv[1:]
sys.path[:0] = [root, root + "/tests"]
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

spark = (
    SparkSession.builder.master("local[4,3]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

from fairwait.operators.ranks import with_tile
from fairwait.plans.jobs import build_silver, land_pages, land_window
from fairwait.schemas import BRONZE
from fairwait.sources.scans import scan_json
from fixtures import SIX, bronze, request


def fetch(condition, offset, size):
    low, high = condition.split("'")[1::2]
    found = [r for r in RECORDS if low <= r["created_date"] < high]
    page = found[offset : offset + size]
    if offset and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
    return page


RECORDS = [{"sr_number": f"A{i}", "created_date": f"2024-01-0{1 + i % 4}T08:00:00.000"} for i in range(40)]
assert land_pages(spark, fetch, "2024-01-01", "2024-01-05", out + "/pages", size=3) == 40
assert scan_json(spark, out + "/pages").select("sr_number").distinct().count() == 40


def fail_once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")


records = [*SIX, *[request(f"B{i}") for i in range(100)]]
flaky = bronze(spark, records).repartition(4).mapInPandas(fail_once, BRONZE)
assert land_window(flaky, "2024-01-01", "2024-02-01", out + "/bronze") == 106
assert build_silver(spark, out + "/bronze", out + "/silver")["silver_rows"] == 105

numbers = spark.range(100).repartition(4).mapInPandas(fail_once, "id long")
tiles = with_tile(numbers, 4, ["id"], "tile", max_rows=10)
sizes = tiles.groupBy("tile").agg(F.count("*").alias("n")).collect()
assert sorted(map(tuple, sizes)) == [(1, 25), (2, 25), (3, 25), (4, 25)]
assert tiles.where("tile != floor(id / 25) + 1").count() == 0
print("all held")
"""


def test_results_hold_when_tasks_are_repeated(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, root, str(tmp_path)], capture_output=True, text=True, timeout=300
    )
    assert run.stdout.strip().endswith("all held"), run.stderr[-3000:]
