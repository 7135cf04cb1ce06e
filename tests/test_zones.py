"""Results must not depend on the driver's local time zone."""
import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = ["device_popularity", "visits_dense_15m", "sessions_dense_8h", "top_products", "latest_visitors", "relative_time",
         "visitor_age", "snapshot_changed", "merge_partials", "stream_bucket_counts"]

SCRIPT = f"""
import sys
sys.path[:0] = [{REPO!r}, {REPO + '/tools'!r}]
from oracle_check import check
from clickweave.session import build_session
spark = build_session("local[2]", 4)
bad = {{k: v for k, v in check(spark, "/root/testdata/sf0.001", {NAMES!r}, verbose=False).items() if v[0] != "match"}}
from clickweave.sources import testbed as TB
from clickweave.sources.testbed import stage_time_slices
from clickweave.session import shared_path
clicks, path = TB.clicks(spark, "/root/testdata/sf0.001"), shared_path(spark, "staged")
stage_time_slices(clicks, path, 4, 2)
assert spark.read.parquet(path).count() == clicks.count()
assert not bad, bad
print("ZONE OK")
"""


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_queries_in_another_zone(zone):
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=os.environ | {"TZ": zone}, capture_output=True, text=True, timeout=900)
    assert "ZONE OK" in out.stdout, out.stdout[-1500:] + out.stderr[-1500:]
