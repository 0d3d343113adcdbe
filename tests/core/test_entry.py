import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("leftover", [False, True])
def test_entry_works_without_the_training_data_subpackage(tmp_path, leftover):
    shutil.copytree(f"{ROOT}/quireflow", tmp_path / "quireflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if leftover:
        os.makedirs(tmp_path / "quireflow/llm/__pycache__")
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q)); assert 'tag_prf' in q and not any(k.startswith('op') for k in q) and e.oracle_sql().keys() <= q.keys()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry_works_where_the_subpackage_cannot_be_imported(tmp_path):
    (tmp_path / "quireflow/llm").mkdir(parents=True)
    shutil.copytree(f"{ROOT}/quireflow", tmp_path / "quireflow", ignore=shutil.ignore_patterns("llm", "__pycache__"), dirs_exist_ok=True)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "quireflow/llm/__init__.py").write_text("")
    (tmp_path / "quireflow/llm/queries.py").write_text("import a_library_that_is_not_there")
    code = "import __spark_entry__ as e; assert 'tag_prf' in e.queries() and not any(k.startswith('op') for k in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0 and "a_library_that_is_not_there" in done.stderr, done.stderr


def test_flagship(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["grp", "tp", "fp", "fn", "precision", "recall", "f1"]


def test_nothing_else_imports_the_subpackage():
    for top, _, names in os.walk(f"{ROOT}/quireflow"):
        if "llm" not in top:
            for n in names:
                if n.endswith(".py"):
                    assert "quireflow.llm" not in open(f"{top}/{n}").read()
