import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
q = e.queries()
assert 'trailing_window' in q and not [n for n in q if n.startswith('op') or n == 'pipeline'] and set(e.oracle_sql()) <= set(q)
s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()
assert q['keep_last_per_key'](s, '/root/testdata/sf0.001').count() > 0
"""


@pytest.mark.parametrize("pipeline", [False, True])
def test_the_rest_works_without_the_llm_folders(tmp_path, pipeline):
    shutil.copytree(ROOT / "marketpipe", tmp_path / "marketpipe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline:
        if not (ROOT / "corpus_pipeline.py").exists():
            pytest.skip("corpus_pipeline.py is not here")
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    code = CODE if Path("/root/testdata/sf0.001").exists() else CODE.rpartition("s = Spark")[0]
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True, timeout=300)


def test_a_missing_library_is_not_taken_for_missing_folders(tmp_path):
    if not (ROOT / "marketpipe" / "llm").exists():
        pytest.skip("the folders are not here")
    shutil.copytree(ROOT / "marketpipe", tmp_path / "marketpipe", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path)
    code = "import sys; sys.modules['tiktoken'] = None; import __spark_entry__"
    got = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert got.returncode and "tiktoken" in got.stderr
