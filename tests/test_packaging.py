"""Executors get the package wherever the driver runs."""

import os
import subprocess
import sys
import zipfile

from conftest import ROOT, SMALL

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from creditlens.session import local_session
spark = local_session(2, "2g", "packaging")
print("ROWS", entry.queries()["boost_stump"](spark, {folder!r}).count())
spark.stop()
"""


def test_a_query_runs_from_another_folder(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT, folder=SMALL)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "ROWS 7" in run.stdout, run.stderr[-2000:]


def test_the_archive_holds_the_package(spark):
    from creditlens import session

    session.ship(spark)
    files = [f for f in spark.sparkContext._python_includes if f == "creditlens.zip"]
    assert files and spark.sparkContext.applicationId in session.SHIPPED
    path = next(p for p in sys.path if p.endswith("creditlens.zip"))
    names = zipfile.ZipFile(path).namelist()
    assert "creditlens/session.py" in names and "creditlens/operators/boosting.py" in names
