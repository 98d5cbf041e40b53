from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent
DATA = Path("/root/testdata/sf0.001")


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_need_the_llm_subpackage():
    code = "import sys; sys.modules['docforge.llm'] = None; import __spark_entry__ as e; assert 'doc_token_stats' in e.queries(); assert not any(m.startswith('docforge.llm.') for m in sys.modules)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


@pytest.mark.skipif(not DATA.exists(), reason="no test data here")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
