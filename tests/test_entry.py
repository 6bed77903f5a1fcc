from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SAID = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def test_the_rest_stands_without_the_training_text_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__"))
    for gone in ([], ["corpus_pipeline.py"]):
        for name in gone:
            (copy / name).unlink()
        env = os.environ | {"PYTHONPATH": str(copy)}
        said = subprocess.run([sys.executable, "-c", SAID], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
        assert said.returncode == 0, said.stderr
        queries, oracles = (set(line.split()) for line in said.stdout.strip().splitlines())
        assert len(queries) > 200 and oracles <= queries
        assert not [q for q in queries if q.startswith("op") or q == "pipeline"]
