"""The entry file stands without the corpus operators, whatever keeps them from being imported."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["xxhash", "silkgrain.llm", "corpus_pipeline", "ahocorasick"])
def test_entry_without(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), sum(n.startswith('op') for n in q), len(s))"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) > 150 and int(out[2]) > 130
    if missing != "ahocorasick":  # a package that they may do without
        assert out[1] == "0"
