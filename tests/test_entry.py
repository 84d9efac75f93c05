"""The entry works with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), len(s), set(s) <= set(q), 'pipeline' in q, 'training_samples' in q)"


@pytest.mark.parametrize("gone", [["segue/llm", "tests/llm"], ["segue/llm", "tests/llm", "corpus_pipeline.py"]])
def test_the_rest_lives_without_training_data(tmp_path, gone):
    copy = tmp_path / "repo"
    skip = {REPO / name for name in [*gone, ".git"]}
    shutil.copytree(REPO, copy, ignore=lambda folder, names: [n for n in names if Path(folder, n) in skip or n in ("__pycache__", ".pytest_cache")])
    said = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    queries, sql, paired, pipeline, flagship = said.stdout.split()
    assert int(queries) >= int(sql) > 100 and paired == flagship == "True" and pipeline == "False"
    listed = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=copy, capture_output=True, text=True)
    assert listed.returncode == 0, listed.stdout[-2000:]
