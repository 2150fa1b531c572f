import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
import __spark_entry__
from marquee.llm.queries import QUERIES
for name in [*QUERIES, "pipeline"]:
    print(name, __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, flush=True)
"""


def test_every_operator_runs_without_the_package_on_the_workers(tmp_path, monkeypatch):
    """Started from an empty folder, workers find no package; all that they need is sent to them by value."""
    monkeypatch.delenv("PYTHONPATH", raising=False)
    repo = str(Path(__file__).resolve().parents[2])
    (tmp_path / "empty").mkdir()
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, shared=str(tmp_path / "shared"))], cwd=tmp_path / "empty", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count(" True") == 14, done.stdout
