import os
import sys
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalogflow import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame."""

    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted(map(tuple, picked.collect()), key=repr)

    return collect


@pytest.fixture(autouse=True)
def rising_times(monkeypatch):
    """Files written one after another differ in time: Spark's file source orders by milliseconds."""
    write, last = Path.write_text, [0]

    def stepped(path, *args, **kwargs):
        size = write(path, *args, **kwargs)
        last[0] = max(time.time_ns() // 10**6, last[0] + 1)
        os.utime(path, ns=(last[0] * 10**6, last[0] * 10**6))
        return size

    monkeypatch.setattr(Path, "write_text", stepped)
