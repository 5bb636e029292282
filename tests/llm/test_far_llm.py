"""Every corpus query on workers that cannot import the package from their own path."""

import os
import subprocess
import sys
from pathlib import Path

from conftest import SF

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import importlib
from parley.session import build_session
entry = importlib.import_module("__spark_entry__")
spark = build_session("local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": sys.argv[3]})
spark.range(1).rdd.map(lambda _: __import__("importlib.util").util.find_spec("parley") is None).collect()[0] or sys.exit("the workers see the package")
for name, build in entry.queries().items():
    if name == "pipeline" or name.startswith("op"):
        print("rows", name, build(spark, sys.argv[2]).count(), flush=True)
"""


def test_queries_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(REPO), SF, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1500, check=False)
    rows = {line.split()[1]: int(line.split()[2]) for line in done.stdout.splitlines() if line.startswith("rows ")}
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(rows) == 14 and min(rows.values()) > 0
