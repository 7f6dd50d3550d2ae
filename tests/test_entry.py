"""The entry file works with and without the operators for training data."""

import json
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT
from workload import ORACLES, QUERIES

LIST = """
import json, sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
print(json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql()), "fundmart.llm" in sys.modules]))
"""


@pytest.mark.parametrize("left_out", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_entry_without_training_data_operators(tmp_path, left_out):
    names = ["fundmart", "workload", "__spark_entry__.py", "corpus_pipeline.py"]
    ignored = shutil.ignore_patterns("__pycache__", *left_out)
    for name in names:
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, tmp_path / name, ignore=ignored)
        elif (ROOT / name).exists() and name not in left_out:
            shutil.copy(ROOT / name, tmp_path / name)
    # A folder that is left empty is not a package either.
    (tmp_path / "fundmart" / "llm" / "__pycache__").mkdir(parents=True)
    run = [sys.executable, "-c", LIST, str(tmp_path)]
    done = subprocess.run(run, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    found, oracles, has_llm = json.loads(done.stdout)
    assert found == sorted(QUERIES) and oracles == sorted(ORACLES) and not has_llm
