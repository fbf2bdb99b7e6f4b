import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from levain.session import get_session
    extra = {"spark.ui.showConsoleProgress": "false"}
    s = get_session("local[4]", app_name="levain-tests", shuffle_partitions=8, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):  # only tests set their own shared folder
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="levain-tests-"))
    yield s


@pytest.fixture()
def workdir(spark):
    from levain.session import shared_dir
    return shared_dir(spark, "tests", unique=True)


def rows(df, *cols):
    """Sorted list of tuples (NULL-safe ordering)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
