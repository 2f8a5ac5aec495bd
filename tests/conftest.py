import pathlib
import sys

import pytest

sys.path[:0] = [str(pathlib.Path(__file__).resolve().parents[1]), str(pathlib.Path(__file__).resolve().parent)]

from marquee.session import local_session


@pytest.fixture(scope="session")
def spark():
    # Tiny inputs: compiling stages would take longer than running them.
    settings = {"spark.sql.shuffle.partitions": "3", "spark.sql.codegen.wholeStage": "false", "spark.ui.showConsoleProgress": "false"}
    session = local_session(8, "tests", **settings)
    yield session
    session.stop()
