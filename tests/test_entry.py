"""The entry stands without the text operators."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["ahocorasick", "tokenizers", "hourgrid.llm", "corpus_pipeline"])
def test_entry_without(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), sum(n[:2] == 'op' for n in e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True)
    n, text = map(int, run.stdout.split())
    assert n > 200 and text == 0 and "no text operators" in run.stderr, run.stderr
