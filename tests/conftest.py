import os
import tempfile

import pytest

from tidemark.session import local_session

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    folders = {
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-wh-"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-ck-"),
    }
    session = local_session(8, app="tidemark-tests", memory="6g", **folders)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
