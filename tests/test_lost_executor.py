"""An executor dies while the ledgers are read; its map tasks run again, and the control totals still agree."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
JOB = """
import os, signal, sys
from datetime import date, timedelta
from pyspark.sql import SparkSession

folder = sys.argv[1]
spark = (
    SparkSession.builder.master("local-cluster[2,1,1024]")
    .config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
    .config("spark.sql.shuffle.partitions", "4").config("spark.executor.memory", "1g")
    .config("spark.sql.adaptive.coalescePartitions.enabled", "false").config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .config("spark.checkpoint.dir", f"file://{folder}/staging").config("spark.sql.warehouse.dir", f"{folder}/warehouse")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
from shelfledger import ExportParams
from shelfledger.operators import ledgers
from shelfledger.plans import gates
from shelfledger.plans.daily_export import DailyExport
from shelfledger.sources.staging import Staging
from tests.store import LAST, Store

store = Store()
for code in range(1, 31):
    store.product(code)
    for day in range(5):
        store.line(code, LAST - timedelta(day), 1, 10)
once = f"{folder}/killed"


def kill_once(batches):
    # The JVM of this task's executor, two processes up: its map outputs are lost with it.
    from pyspark import TaskContext
    for batch in batches:
        if TaskContext.get().partitionId() == 2 and not os.path.exists(once):
            open(once, "w").close()
            daemon = os.getppid()
            with open(f"/proc/{daemon}/stat") as file:
                os.kill(int(file.read().rsplit(")", 1)[1].split()[1]), signal.SIGKILL)
        yield batch


sound = ledgers.with_pos_header
ledgers.with_pos_header = lambda *tables: (lambda df: df.mapInArrow(kill_once, df.schema))(sound(*tables))
run = DailyExport(spark, store.sources(spark), ExportParams(run_date=date(2024, 3, 10)), Staging(spark))
lines = run.pos_ledger.agg({"line_count": "sum"}).first()[0]
print("KILLED", os.path.exists(once), "LINES", lines, "GATES", gates.failures(run.ledger_gates()))
spark.stop()
"""


def test_totals_stay_sound_when_map_tasks_run_again(tmp_path):
    environment = {**os.environ, "PYTHONPATH": str(REPO)}
    done = subprocess.run([sys.executable, "-c", JOB, str(tmp_path)], cwd=REPO, env=environment, capture_output=True, text=True, timeout=300)
    assert "KILLED True LINES 150 GATES []" in done.stdout, done.stdout[-2000:] + done.stderr[-2000:]
