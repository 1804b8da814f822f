import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from eventide.session import configure, ship_package  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]").appName("eventide-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    ship_package(s)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventide-test-ckpt-"))
    yield s


def events_df(spark, rows, extra_cols=()):
    """Canonical events from literal tuples:
    (id, event_time, user_id, event_type, properties, created_at, *extra)."""
    cols = ["id long", "event_time timestamp_ntz", "user_id string", "event_type string",
            "properties string", "created_at timestamp_ntz", *extra_cols]
    return spark.createDataFrame(rows, ", ".join(cols))
