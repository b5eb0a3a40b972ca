import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from tillmark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(tmp_path):
    """Writes raw CSV drops: raw(table, stamp, text) -> raw directory."""

    def write(table: str, stamp: str, text: str) -> str:
        folder = tmp_path / "raw" / table
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{table}_{stamp}.csv").write_bytes(text.encode())
        return str(tmp_path / "raw")

    write.dir = str(tmp_path / "raw")
    return write


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")
