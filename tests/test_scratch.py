"""Scratch stage folders are deleted when the driver process exits."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from lendgrade.session import local_session, fresh_dir
spark = local_session(2, shuffle_partitions=2, app="scratch-test")
scratch = fresh_dir(spark, "stages")
kept = fresh_dir(spark, "outputs", keep=True)
spark.range(100).write.parquet(scratch + "/keyed")
spark.range(100).write.parquet(kept + "/table")
assert spark.read.parquet(scratch + "/keyed").count() == 100
print(scratch)
print(kept)
"""


def test_scratch_removed_at_exit():
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)],
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    scratch, kept = (p.removeprefix("file:") for p in out.stdout.strip().splitlines()[-2:])
    assert os.path.isdir(os.path.dirname(scratch))
    assert not os.path.exists(scratch)
    assert os.path.exists(os.path.join(kept, "table"))
