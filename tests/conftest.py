import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from authlytics.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Folders of its own: tests that write leave nothing in the repository.
    folders = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("working")),
    }
    session = local_session("8", "4g", folders)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
