import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
TESTDATA = Path(os.environ.get("CALLSIEVE_TESTDATA", "/root/testdata"))

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("driver_contract", sys.argv[1])
driver = importlib.util.module_from_spec(spec)
sys.modules["driver_contract"] = driver
spec.loader.exec_module(driver)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("py_grouped_score", "py_module_udf", "py_ndarray_reshape", "ml_end_to_end"):
    print(name, driver.queries()[name](spark, sys.argv[2]).count())
"""


def test_python_operators_work_from_any_folder(tmp_path):
    """Executors start in another folder, without the package on their path."""
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT / "__spark_entry__.py"), str(TESTDATA / "sf0.001")],
        cwd=tmp_path, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert dict(line.split() for line in done.stdout.splitlines()) == {
        "py_grouped_score": "15", "py_module_udf": "1000", "py_ndarray_reshape": "32000", "ml_end_to_end": "1",
    }
