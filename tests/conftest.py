import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cohesion.session import DEFAULTS, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("cohesion-tests")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "4").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
