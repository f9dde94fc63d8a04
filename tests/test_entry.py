"""The driver's entry module, with and without the optional part."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(root):
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q), set(s) - set(q); print(len(q)); "
            "print(*[n for n in q if n.startswith('op') and n[2].isdigit() or n == 'pipeline'])")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": root})
    assert done.returncode == 0, done.stderr
    return done.stdout.splitlines()[-2:]


def copy(tmp_path, without):
    shutil.copytree(ROOT, tmp_path / "r", ignore=lambda folder, found: [f for f in found if f in (".git", "__pycache__", "tests", *without)])
    return str(tmp_path / "r")


def test_the_rest_stands_without_the_optional_part(tmp_path):
    n, own = names(copy(tmp_path, ("llm", "corpus_pipeline.py")))
    assert int(n) > 70 and own == ""


def test_a_broken_optional_part_is_an_error(tmp_path):
    root = copy(tmp_path, ())
    if not os.path.isdir(f"{root}/cvlens/llm"):
        return
    with open(f"{root}/cvlens/llm/queries.py", "a") as f:
        f.write("\nimport no_such_module\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=root, capture_output=True, text=True, timeout=300,
                          env=os.environ | {"PYTHONPATH": root})
    assert done.returncode != 0 and "no_such_module" in done.stderr
