"""The entry point with and without what the operators for training text need."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), len(set(e.queries()) - set(e.oracle_sql()) - {"charset_detect", "raster_steps"}), len([n for n in e.queries() if n.startswith("op") and n[2].isdigit() or n == "pipeline"]))
"""


def counts(*blocked):
    out = subprocess.run([sys.executable, "-c", CODE, *blocked], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True).stdout
    return [int(x) for x in out.split()]


def test_engine_queries_need_no_other_library():
    for blocked in ("zstandard", "public_tokenizers", "folio.llm"):
        n, sql, plain, ops = counts(blocked)
        assert n == sql + 2 > 80 and plain == ops == 0, blocked  # the two are compared with plain versions
