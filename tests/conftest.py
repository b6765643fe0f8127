import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clinloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "local[4]", 4,
        **{
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": f"file://{folder}/warehouse",
            "spark.checkpoint.dir": f"file://{folder}/checkpoint",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def store(spark):
    from clinloom.staging import StageStore

    return StageStore(spark)
