"""The entry module with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(folder) -> list[str]:
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); e.oracle_sql()"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


def test_core_without_training_data_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    alone = names(tmp_path / "repo")
    from dialogue_etl import registry

    assert alone == sorted(registry.queries())
    # The pipeline file alone, without the operators that it calls, doesn't hide the core either.
    (tmp_path / "repo/corpus_pipeline.py").write_text("from dialogue_etl.llm import mixing\n")
    assert names(tmp_path / "repo") == alone


def test_broken_operators_are_no_missing_ones(tmp_path):
    """Where the operators are there but can't be imported, the queries don't vanish without a word."""
    for name in ("__spark_entry__.py", "dialogue_etl"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name, **({"ignore": shutil.ignore_patterns("__pycache__", "llm")} if (ROOT / name).is_dir() else {}))
    (tmp_path / "dialogue_etl/llm").mkdir()
    (tmp_path / "dialogue_etl/llm/registry.py").write_text("from dialogue_etl.llm import nowhere\n")
    (tmp_path / "corpus_pipeline.py").write_text("")
    broken = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=tmp_path, capture_output=True, text=True)
    assert broken.returncode and "nowhere" in broken.stderr
