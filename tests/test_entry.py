"""The driver contract holds without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SAYS = (
    "import __spark_entry__ as e; from modelweave.plans.queries import registered; from modelweave.plans.oracle import oracle;"
    "assert set(registered()) <= set(e.queries()) and set(oracle()) <= set(e.oracle_sql());"
    "print(sorted(set(e.queries()) - set(registered())))"
)


def _copy(to: Path, *left_out: str) -> Path:
    hidden = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", "*.json")
    skipped = {ROOT / x for x in left_out}

    def ignored(folder, names):
        return hidden(folder, names) | {n for n in names if Path(folder) / n in skipped}

    return Path(shutil.copytree(ROOT, to, ignore=ignored))


def _extra(folder: Path) -> str:
    run = subprocess.run([sys.executable, "-c", SAYS], cwd=folder, capture_output=True, text=True, check=False)
    assert run.returncode == 0, run.stderr
    return run.stdout.strip()


def test_entry_with_any_part_missing(tmp_path):
    folders = ("modelweave/llm", "tests/llm")
    assert _extra(_copy(tmp_path / "none", *folders, "corpus_pipeline.py")) == "[]"
    assert _extra(_copy(tmp_path / "pipeline_only", *folders)) == "[]"
    if (ROOT / "modelweave/llm").is_dir():
        whole = _extra(_copy(tmp_path / "no_pipeline", "corpus_pipeline.py"))
        assert "op1_" in whole and "pipeline" not in whole
