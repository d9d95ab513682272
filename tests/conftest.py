import contextlib
import io
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", f"file://{folder}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


HIT = "event_id long, dev long, fp long, det long, geo long, ch long, value long, edge long"
MAP = "cat string, id long, dev long, fp long, det long, geo long, ch long"
MAPPED = "event_id long, cat string, id long, value long, edge long"
PULSE = "event_id long, cat string, id long, charge double, timing double"


def explained(df) -> str:
    """The formatted physical plan, with the details of each step."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def plan_tree(df) -> str:
    """The tree of physical steps, last step first."""
    return explained(df).split("\n\n")[0]


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
