import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from prosemill.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "prosemill-tests")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as tuples, in the order given by the frame."""
    chosen = df.select(*columns) if columns else df
    return [tuple(row) for row in chosen.collect()]
