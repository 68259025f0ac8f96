import pytest

from corvid.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, "4g", 4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('shared')}")
    s.sparkContext.setLogLevel("ERROR")
    return s
