"""The driver's entry point with and without its optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

from editscope.plans import catalog, oracle

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"


def listed(root):
    done = subprocess.run([sys.executable, "-c", LIST], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, _, sql = done.stdout.partition("|")
    return queries.split(), sql.split()


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_optional_subpackage(tmp_path, pipeline):
    shutil.copytree(f"{ROOT}/editscope", tmp_path / "editscope", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * pipeline:
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    assert listed(tmp_path) == (sorted(catalog.QUERIES), sorted(oracle.ORACLE))


def test_a_broken_part_is_an_error(tmp_path):
    shutil.copytree(f"{ROOT}/editscope", tmp_path / "editscope", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "no_such_module" in done.stderr


def test_whole():
    queries, sql = listed(ROOT)
    assert set(catalog.QUERIES) <= set(queries) and set(oracle.ORACLE) <= set(sql) <= set(queries)
