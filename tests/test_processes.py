"""Stored state outlives the process: each step here is a Python process of its own."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
START = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, sys.argv[1])
from forecourt import sinks
from forecourt.plans import jobs
root = sys.argv[2]
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.sql.warehouse.dir", root + "/warehouse").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
"""
UPSERT = START + """
ids = sys.argv[3].split(",")
sinks.upsert_table(spark.createDataFrame([(i, 1) for i in ids], "id string, v int"), "t", root + "/t")
print("GOT", ",".join(sorted(r.id for r in spark.table("t").collect())), flush=True)
spark.stop()
"""
JOB = START + """
lake = jobs.Lake(root + "/lake")
report = getattr(jobs, sys.argv[3])(spark, root + "/raw.csv", lake)
print("GOT", report.rows["silver"], spark.table(lake.mart("mart_listings_summary")).count(), flush=True)
spark.stop()
"""


def run(code, *args) -> str:
    done = subprocess.run(
        [sys.executable, "-c", code, str(ROOT), *args], capture_output=True, text=True, timeout=300
    )
    assert "GOT " in done.stdout, done.stderr[-2000:]
    return done.stdout.rpartition("GOT ")[2].strip()


def test_upsert_keeps_rows_of_an_earlier_process(tmp_path):
    assert run(UPSERT, str(tmp_path), "1,2") == "1,2"
    assert run(UPSERT, str(tmp_path), "2,3") == "1,2,3"


def test_jobs_run_again_in_a_new_process(tmp_path):
    lines = ["id,manufacturer,model,year,price,odometer,state,condition"]
    lines += [f"{i},ford,f,2010,{9000 + i},50000,ca,good" for i in range(60)]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    for job in ("run_batch", "run_stream"):
        assert run(JOB, str(tmp_path), job) == "60 1"
        assert run(JOB, str(tmp_path), job) == "60 1"
