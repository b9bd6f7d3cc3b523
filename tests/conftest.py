import pytest

from keyflow.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = local_session(4, memory="4g", shuffle_partitions=4, conf=shared)
    yield session
    session.stop()
