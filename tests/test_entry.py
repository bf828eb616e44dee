"""The driver contract holds, with and without the optional folders."""

import os
import subprocess
import sys
import textwrap

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_names_and_oracles():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_imports_without_the_training_data_folder(tmp_path):
    code = f"""
    import importlib.util, sys
    sys.path.insert(0, {ROOT!r})
    real = importlib.util.find_spec
    importlib.util.find_spec = lambda n, *a: None if n in ("localpulse.llm", "corpus_pipeline") else real(n, *a)
    import __spark_entry__ as e
    import re
    assert e.queries() and not [n for n in e.queries() if re.match(r"op\\d|pipeline", n)], "left over"
    assert not [m for m in sys.modules if m.startswith("localpulse.llm")]
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=tmp_path)
