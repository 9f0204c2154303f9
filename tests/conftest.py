import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trawl.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def write_files(folder, files: dict[str, str]) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, body in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as fh:
            fh.write(body)
    return str(folder)
