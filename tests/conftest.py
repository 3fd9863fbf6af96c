import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (str(ROOT), os.environ.get("PYTHONPATH", "")) if x)
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "3g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def same_rows(a, b):
    """Whether two pandas frames hold the same rows, whatever their order and number types."""
    import pandas as pd

    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    text = lambda v: "None" if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)) else f"{float(v):.12g}" if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)
    rows = lambda d: sorted(tuple(map(text, r)) for r in d[cols].itertuples(index=False))
    assert rows(a) == rows(b)
