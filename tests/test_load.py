"""queries() and oracle_sql() load without opening files, archives or a JVM."""
import subprocess
import sys

from tests.conftest import ROOT

CODE = """
import glob, zipfile
def refuse(*a, **k):
    raise AssertionError("file lookup while loading queries")
glob.glob = glob.iglob = refuse
class NoZip:
    def __init__(self, *a, **k):
        refuse()
zipfile.ZipFile = NoZip
import __spark_entry__ as E
assert len(E.queries()) >= 100 and len(E.oracle_sql()) >= 100
from pyspark import SparkContext
assert SparkContext._active_spark_context is None
"""


def test_queries_load_without_files_or_jvm():
    r = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
