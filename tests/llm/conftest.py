import pytest

from corvid.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, "4g", 4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('shared')}")
    s.sparkContext.setLogLevel("ERROR")
    return s


def frame(spark, rows, extra=()):
    """documents-like rows (doc_id, text, lang, source) with clashing extra columns."""
    schema = "doc_id long, text string, lang string, source string, length long, rank string, salt int, n long"
    return spark.createDataFrame([(*r, *[None] * (4 - len(r)), 7, "x", 3, None) for r in rows], schema)
