import subprocess
import sys

import __spark_entry__ as entry

WITHOUT = """
import sys
sys.modules["corpus_pipeline"] = None
import __spark_entry__ as e
assert e.llm is None and "region_quarter_summary" in e.queries() and not any(n.startswith("op1_") or n == "pipeline" for n in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "order_count" in df.columns


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_corpus_operators():
    subprocess.run([sys.executable, "-c", WITHOUT], check=True, timeout=60)
