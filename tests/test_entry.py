"""The entry keeps the queries on counts when the optional operators cannot be imported."""

import os
import shutil
import subprocess
import sys

import pytest

from loopcount.plans import queries as count_queries

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = """
import sys
{block}
import __spark_entry__ as e
names = set(e.queries())
print(len(names), len(e.oracle_sql()), any(n.startswith("op") or n == "pipeline" for n in names), "observations" in names and "dow_profile" in names)
"""


def loaded(folder, block=""):
    done = subprocess.run([sys.executable, "-c", COUNT.format(block=block)], cwd=folder, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": folder})
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split()


def only_counts(out):
    return [int(out[0]), int(out[1])] == [len(count_queries.QUERIES)] * 2 and out[2:] == ["False", "True"]


@pytest.fixture
def copy(tmp_path):
    for name in ("__spark_entry__.py", "loopcount", "corpus_pipeline.py"):
        source = os.path.join(TOP, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif os.path.exists(source):
            shutil.copy(source, tmp_path / name)
    return tmp_path


@pytest.mark.parametrize("package", ["tiktoken", "ahocorasick", "public_tokenizers"])
def test_without_a_package_of_the_operators(copy, package):
    if not (copy / "loopcount" / "llm" / "queries.py").exists():
        pytest.skip("the operators are not there")
    assert only_counts(loaded(str(copy), f"sys.modules[{package!r}] = None"))


def test_without_the_operators(copy):
    if (copy / "loopcount" / "llm").exists():
        shutil.rmtree(copy / "loopcount" / "llm")
    if (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
    assert only_counts(loaded(str(copy)))


def test_with_an_emptied_folder(copy):
    if (copy / "loopcount" / "llm").exists():
        shutil.rmtree(copy / "loopcount" / "llm")
    (copy / "loopcount" / "llm" / "__pycache__").mkdir(parents=True)
    assert only_counts(loaded(str(copy)))
