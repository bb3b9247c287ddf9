import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ladle.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="ladle-test-ckpt-")
    s = build_session("local[4]", app="ladle-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s


def csv_rows(text: str) -> list[str]:
    """Golden CSV text (header first) -> the data rows."""
    return [line.strip() for line in text.strip().splitlines()[1:]]
