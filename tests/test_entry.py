"""The entry without the subpackage on training data, and without a library that only it needs."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), 'pipeline' in q, any(n.startswith('op1_') for n in q))"


@pytest.mark.parametrize("gone", ["folder", "library", "nothing"])
def test_entry(tmp_path, gone):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "terrafold"):
        if (REPO / name).is_dir():
            shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *(["llm"] if gone == "folder" else [])))
        elif (REPO / name).exists() and not (gone == "folder" and name.startswith("corpus")):
            shutil.copy(REPO / name, tmp_path / name)
    block = "import sys; sys.modules['public_tokenizers'] = None\n" if gone == "library" else ""
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", block + COUNT], cwd=tmp_path, capture_output=True, text=True, timeout=120, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    n, sql, pipeline, first = done.stdout.split()
    assert int(n) > 100 and int(sql) > 90
    if gone != "nothing" or not (REPO / "terrafold" / "llm").exists():
        assert (pipeline, first) == ("False", "False")
    else:
        assert (pipeline, first) == ("True", "True")
