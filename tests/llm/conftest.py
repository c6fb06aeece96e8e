import pytest

from encore.session import build_session, checkpoint_dir


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(app="llm-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_dir(session, fallback=str(tmp_path_factory.mktemp("shared")))
    return session
