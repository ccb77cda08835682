import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rosterline.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        4,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture(scope="session")
def department(spark):
    names = ["Computer Science", "Electronics", "Mechanical", "Electrical Engineering"]
    rows = [(i + 1, name, f"Head {i + 1}") for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "department_id int, department_name string, department_head string")
