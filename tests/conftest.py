import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from small import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tablewise.session import build_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": ckpt})
    yield s


@pytest.fixture(scope="session")
def duck():
    from oracle_check import duck as make
    return make(SF_SMALL)
