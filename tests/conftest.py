import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

DATA = Path("/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    path = DATA / "sf0.01"
    if not path.exists():
        pytest.skip("no test data")
    return str(path)


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


def rows_of(frame) -> list[tuple]:
    """Rows with columns by name, floats rounded, in a fixed order."""
    cols = sorted(frame.columns)
    plain = lambda v: None if v is None or v != v else round(float(v), 6) if isinstance(v, float) else v
    found = [tuple(plain(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))
