"""The entry file without the training-data parts, and the package on executors that have no copy of it."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

WITHOUT = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{gone!r}] = None
import __spark_entry__ as entry
from checks.queries import all_queries
assert set(entry.queries()) == set(all_queries()) == set(entry.oracle_sql())
"""

ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from pulsetide.session import build_session
spark = build_session("elsewhere", "local[2]")
spark.sparkContext.setLogLevel("ERROR")

def names(rows):
    import pulsetide.schemas
    for batch in rows:
        yield batch

sys.path.remove({root!r})
assert spark.range(3).mapInArrow(names, "id long").count() == 3
spark.stop()
"""


def run(code, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_other_queries_stand_without_a_library(tmp_path):
    for gone in ("tokenizers", "corpus_pipeline", "pulsetide.llm"):
        if gone == "tokenizers":
            # Imported where it is used only; the vocabularies' package is imported at once.
            gone = "public_tokenizers"
        run(WITHOUT.format(root=str(ROOT), gone=gone), tmp_path)


def test_the_package_travels_to_the_executors(tmp_path):
    run(ELSEWHERE.format(root=str(ROOT)), tmp_path)
