"""The driver's entry with the text operators taken away, wholly or by halves."""

import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

SHOW = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.oracle_sql()))"


def copied(tmp_path):
    for name in ("basketry", "__spark_entry__.py", "corpus_pipeline.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif source.exists():
            shutil.copy(source, tmp_path / name)
    return tmp_path


def show(folder):
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True,
                          env={"PYTHONPATH": str(folder), "PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr
    return done.stdout.strip().splitlines()[-1].split()


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "compiled files", "the pipeline"])
def test_the_rest_stays(tmp_path, left):
    from basketry.plans import queries

    folder = copied(tmp_path)
    shutil.rmtree(folder / "basketry" / "llm", ignore_errors=True)
    if left != "the pipeline":
        (folder / "corpus_pipeline.py").unlink(missing_ok=True)
    if left in ("an empty folder", "compiled files"):
        (folder / "basketry" / "llm" / "__pycache__").mkdir(parents=True)
    assert show(folder)[:2] == [str(len(queries.queries())), "False"]


def test_a_fault_is_not_an_absence(tmp_path):
    folder = copied(tmp_path)
    text = folder / "basketry" / "llm" / "queries.py"
    if not text.exists():
        pytest.skip("the text operators are absent")
    text.write_text("import a_module_that_nobody_has\n")
    with pytest.raises(AssertionError, match="a_module_that_nobody_has"):
        show(folder)
