"""The driver's entry, with the optional modules and without them or what they need."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(at, before=""):
    code = f"{before}\nimport __spark_entry__ as e\nprint(*sorted(e.queries()))\nassert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=at, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(at)}, timeout=300)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


def test_entry_without_optional_modules(tmp_path):
    at = tmp_path / "copy"
    shutil.copytree(ROOT / "tidemark", at / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", at)
    alone = names(at)
    assert alone and not any(x.startswith("op") and "_" in x and x[2:3].isdigit() for x in alone) and "pipeline" not in alone
    # a module that the optional ones need is missing
    assert names(ROOT, "import sys\nsys.modules['numpy'] = None") >= alone


def test_entry(spark):
    import __spark_entry__ as e

    if os.path.isdir("/root/testdata/sf0.001"):
        assert e.entry(spark).count() > 0
