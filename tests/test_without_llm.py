"""The rest of the library stands without the training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_llm(tmp_path):
    shutil.copytree(ROOT / "meridian", tmp_path / "meridian", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and set(e.oracle_sql()) <= set(q) and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
