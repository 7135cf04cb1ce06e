"""The driver imports the entry module from another working directory and
hands it its own session: Python workers must not need to import the package."""
import os
import subprocess
import sys
import tempfile
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "Asia/Tokyo").config("spark.ui.enabled", "false").getOrCreate())
import __spark_entry__ as E
print("ENTRY", E.entry(spark).count())
print("REFRESH", E.queries()["drop_refreshes"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_from_foreign_cwd_and_session():
    cwd = tempfile.mkdtemp(prefix="cw-foreign-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ENTRY" in out.stdout, out.stderr[-2000:]
    lines = dict(line.split() for line in out.stdout.splitlines() if line.startswith(("ENTRY", "REFRESH")))
    assert int(lines["ENTRY"]) >= 1 and int(lines["REFRESH"]) > 0


def test_context_checkpoint_folder_is_enough(tmp_path):
    """A session whose only setting is sc.setCheckpointDir runs the entry."""
    code = textwrap.dedent(f"""
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        assert not spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir({str(tmp_path / 'shared')!r})
        import sys
        sys.path.insert(0, {REPO!r})
        import __spark_entry__ as E
        assert E.entry(spark).count() >= 0
        import os
        assert any(os.scandir({str(tmp_path / 'shared')!r}))
    """)
    conf = tmp_path / "conf"
    conf.mkdir()
    env = {k: v for k, v in os.environ.items()} | {"SPARK_CONF_DIR": str(conf)}
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-3000:]
