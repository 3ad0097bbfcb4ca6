import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("bookmart-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bookmart-test-ckpt-"))
    yield s


def rows(df, *cols):
    """Sorted list of tuples (None sorts first)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))
