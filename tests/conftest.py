from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from samples import GOLDEN  # noqa: E402

from cartlens.session import builder  # noqa: E402
from cartlens.sources.files import read_event_csv  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        builder("tests")
        .master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "2020-Apr.csv").write_text(GOLDEN)
    return str(folder)


@pytest.fixture(scope="session")
def golden(spark, raw_folder):
    return read_event_csv(spark, f"{raw_folder}/2020-Apr.csv")
