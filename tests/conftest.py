import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from keyfold.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, memory="4g", app="keyfold-tests")


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def measurements(spark):
    """Build ``chunk, station, temp`` from tuples."""

    def build(rows):
        return spark.createDataFrame(rows, "chunk BIGINT, station STRING, temp DOUBLE")

    return build


@pytest.fixture
def text_file(tmp_path):
    """Write a file of the given content and return its path."""

    def write(content, name="measurements.txt"):
        path = tmp_path / name
        path.write_bytes(content.encode())
        return str(path)

    return write
