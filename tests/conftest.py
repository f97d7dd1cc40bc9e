import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests import fixtures as FX  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from blotter.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="blotter-test-")


def _write(path, lines, mtime=None):
    with open(path, "w") as f:
        f.write("\n".join(lines))
    if mtime is not None:
        os.utime(path, (mtime, mtime))


@pytest.fixture()
def incident_dir(tmp_dir):
    """The two sample files, file 1 older than file 2."""
    d = os.path.join(tmp_dir, "incidents")
    os.makedirs(d)
    _write(os.path.join(d, "part-0001.csv"), [FX.HEADER] + FX.FILE_1, 1_700_000_000)
    _write(os.path.join(d, "part-0002.csv"), [FX.HEADER] + FX.FILE_2, 1_700_000_100)
    return d


@pytest.fixture()
def code_file(tmp_dir):
    p = os.path.join(tmp_dir, "codes-small.csv")
    _write(p, [FX.CODE_HEADER] + FX.CODES_SMALL)
    return p


def records_df(spark, lines):
    """Keyed records (key = text before the first comma) from raw lines."""
    from blotter.sources.records import keyed_lines
    return keyed_lines(spark.createDataFrame([(v,) for v in lines], "value string"))
