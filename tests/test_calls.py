"""The limit of calls by slots, on executors that have some."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

from phrasegrove.operators import calls
from phrasegrove.operators.calls import call_profile, dealt


def test_two_jobs_at_once_stay_within_the_slots():
    """Two jobs over two executors with a slot each, in an application of its own."""
    app = Path(__file__).with_name("slots_app.py")
    ran = subprocess.run([sys.executable, str(app)], capture_output=True, text=True, timeout=300)
    found = re.search(r"rows \[600, 600\] calls (\d+) at once (\d+)", ran.stdout)
    assert found, ran.stderr[-2000:]
    assert int(found[1]) >= 8 and int(found[2]) == 2


def test_without_slots_partitions_are_the_limit(spark):
    assert call_profile(False) is None
    assert dealt(spark.range(50), 3, False).rdd.getNumPartitions() == 3
    assert "calls" in call_profile(True).taskResources


@pytest.mark.parametrize("wanted", [True, False])
def test_a_scan_of_many_files_is_not_shuffled(spark, tmp_path, monkeypatch, wanted):
    path = str(tmp_path / "rows")
    spark.range(0, 800, 1, 8).write.parquet(path)
    parts = spark.read.parquet(path).rdd.getNumPartitions()
    monkeypatch.setattr(calls, "SCANS_PER_CALL", parts // 4 if wanted else parts)
    dealt = calls.dealt_scan(spark.read.parquet(path), 4, False)
    assert ("Exchange" not in dealt._jdf.queryExecution().executedPlan().toString()) == wanted
    assert dealt.rdd.getNumPartitions() == 4 and dealt.count() == 800
