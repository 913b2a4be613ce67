import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortix.operators import clean  # noqa: E402
from cohortix.session import build_session  # noqa: E402
from cohortix.sources.subscribers import subscribers  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", "tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
           "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def raw(spark, sf_dir):
    return subscribers(spark, sf_dir).cache()


@pytest.fixture(scope="session")
def cleaned(raw):
    return clean.run(raw)
