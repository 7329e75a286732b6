import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_SUBMIT_ARGS",
                      "--conf spark.ui.showConsoleProgress=false pyspark-shell")


@pytest.fixture(scope="session")
def spark():
    from foodgrid.session import build_session
    # Tests run locally, so a scratch folder is an acceptable checkpoint dir;
    # build_session applies it only where the session has none.
    ckpt = tempfile.mkdtemp(prefix="foodgrid-test-ckpt-", dir="/tmp")
    os.environ["PYSPARK_SUBMIT_ARGS"] = (
        "--conf spark.ui.showConsoleProgress=false "
        f"--conf spark.sql.warehouse.dir={ckpt}/warehouse pyspark-shell")
    s = build_session("tests", master="local[4]", shuffle_partitions=4, checkpoint_dir=ckpt)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
