"""Landing delimited lines: no task holds the rows it writes, whatever the folders they go to."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sievework import sources
from workload import modelling

REPO = Path(__file__).resolve().parents[1]

#: Runs a query over many orders in a session of its own, whose event log tells the memory of the tasks.  A sort of
#: more than 10,000 rows spills there, which also shows the one that a writer begins when it has too many open files.
RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from sievework.session import build_session
at, n = sys.argv[2], int(sys.argv[3])
spark = build_session("landing", "local[2]", 4, {
    "spark.ui.enabled": "false", "spark.log.level": "ERROR", "spark.checkpoint.dir": f"{at}/scratch",
    "spark.shuffle.spill.numElementsForceSpillThreshold": "10000",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{at}/events", "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
})
spark.range(n).selectExpr("id o_orderkey", "substr('FOP', cast(id % 3 + 1 as int), 1) o_orderstatus").write.parquet(f"{at}/orders.parquet")
from workload import modelling
modelling.quarantined(spark, at).write.parquet(f"{at}/result")
spark.stop()
"""


def test_no_task_holds_what_it_writes(spark, tmp_path):
    (tmp_path / "events").mkdir()
    subprocess.run([sys.executable, "-c", RUN, str(REPO), str(tmp_path), "300000"], check=True, timeout=300, capture_output=True)
    events = [json.loads(line) for file in (tmp_path / "events").iterdir() if file.is_file() for line in file.open()]
    tasks = [e["Task Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    assert tasks and not any(t["Disk Bytes Spilled"] for t in tasks)
    # The pages of small hash tables take 34 MB.
    assert max(t["Peak Execution Memory"] for t in tasks) < 45e6
    got = spark.read.parquet(f"{tmp_path}/result")
    assert got.filter("reason = 'too many fields'").count() == len(range(0, 300_000, 11))
    accepted = {s: sum(1 for i in range(j, 300_000, 3) if i % 11) for j, s in enumerate("FOP")}
    assert {(r.reason, r.text) for r in got.filter("reason like 'accepted%'").collect()} == {(f"accepted {n}", f"status\n{s}") for s, n in accepted.items()}


@pytest.mark.parametrize("files", [1, 3])
def test_header_stands_first_whatever_the_keys(spark, rows, tmp_path, files):
    """Keys below the smallest usual one, missing and repeated ones; a header is never taken for a row."""
    orders = [(None, "F"), (-22, "F"), (-5, "O"), (-5, "O"), (0, "P"), (3, None), (4, "O"), (11, "O"), (12, "F")]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderstatus string").repartition(files).write.parquet(f"{tmp_path}/orders.parquet")
    bad = [("too many fields", f'{k},"status\n{s}",x,y') for k, s in ((-22, "F"), (0, "P"), (11, "O"))]
    assert rows(modelling.quarantined(spark, str(tmp_path))) == sorted([*bad, ("accepted 3", "status\nO"), ("accepted 1", "status\nF")], key=repr)


def test_no_orders_no_lines(spark, tmp_path):
    spark.createDataFrame([], "o_orderkey bigint, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    assert modelling.quarantined(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("set_before", [None, "0", "7"])
def test_more_folders_than_open_files(spark, tmp_path, set_before):
    """All rows land, in the folder they belong to, and the session's setting is as it was."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    if set_before:
        spark.conf.set(name, set_before)
    try:
        df = spark.range(1000, numPartitions=3).withColumn("k", F.col("id") % 5)
        path = sources.land_raw(df, f"{tmp_path}/raw", "v1", "2026-01-01", ["k"])
        assert spark.conf.get(name, None) == set_before
    finally:
        spark.conf.unset(name)
    assert sorted(p.name for p in Path(path).glob("k=*")) == [f"k={k}" for k in range(5)]
    got = spark.read.parquet(path)
    assert sorted((r.id, r.k) for r in got.collect()) == [(i, i % 5) for i in range(1000)]
