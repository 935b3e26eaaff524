import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from compare import session
    return session(8)


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column expression over a list of values, in order."""
    from pyspark.sql import functions as F

    def run(expr, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(expr(F.col("v")).alias("r")).collect()]
    return run
