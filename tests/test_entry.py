"""The entry point in a copy of the repository without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); assert set(s) <= set(q); print(len(q), len(s), 'pipeline' in q, any(n.startswith('op') for n in q))"


def listed(root):
    out = subprocess.run([sys.executable, "-c", LIST], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    left_over = copy / "lectern" / "llm" / "__pycache__"
    left_over.mkdir(parents=True)
    with_pipeline = listed(copy)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert listed(copy) == with_pipeline
    assert with_pipeline[2:] == ["False", "False"] and int(with_pipeline[0]) > 150


def test_nothing_else_imports_them():
    for folder, _, names in os.walk(os.path.join(ROOT, "lectern")):
        if os.path.basename(folder) != "llm":
            for name in (n for n in names if n.endswith(".py")):
                with open(os.path.join(folder, name)) as f:
                    assert "lectern.llm" not in f.read(), name
