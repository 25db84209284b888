import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    own = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='spark-')}").getOrCreate()
    own.sparkContext.setLogLevel("ERROR")
    return own
