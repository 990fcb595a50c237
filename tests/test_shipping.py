"""The package reaches Python workers that cannot find it themselves."""

import os
import subprocess
import sys
import zipfile

from clickpath.shipping import package_zip

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys; sys.path.insert(0, {REPO!r})
from clickpath.session import build_spark
from clickpath.shipping import ship_package
from clickpath.functions.redaction import redact_json
from pyspark.sql import functions as F
spark = build_spark(master="local[1]", shuffle_partitions=1)
ship_package(spark); ship_package(spark)
print("got", spark.createDataFrame([('{{"a_token":"x"}}',)], "t string").select(redact_json(F.col("t"))).first()[0])
"""


def test_zip_holds_the_package(scratch):
    names = zipfile.ZipFile(package_zip(scratch)).namelist()
    assert "clickpath/functions/redaction.py" in names and not any("__pycache__" in n for n in names)


def test_udf_runs_from_another_folder(scratch):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=scratch, env=env, capture_output=True, text=True, timeout=200)
    assert 'got {"a_token":"<REDACTED>"}' in out.stdout, out.stderr[-2000:]
