from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

CODE = """
from pyspark.sql import SparkSession
from docforge import io
s = SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", "file://{0}").config("spark.ui.enabled", "false").getOrCreate()
x = io.materialise(s.range(5), "t")
assert x.count() == 5 and all("{0}" in f for f in x.inputFiles()), x.inputFiles()
io.clean(s)
"""


def test_tables_go_to_the_folder_that_the_session_names(tmp_path):
    root = Path(__file__).parent.parent
    subprocess.run([sys.executable, "-c", CODE.format(tmp_path)], cwd=root, check=True, env=os.environ | {"PYTHONPATH": str(root)})
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("docforge-")]
