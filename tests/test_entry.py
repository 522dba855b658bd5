import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_runs(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.count() > 0 and "coverage_pct" in out.columns
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "slotwise"):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        copy(f"{ROOT}/{name}", tmp_path / name)
    shutil.rmtree(tmp_path / "slotwise/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 150 and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True)
