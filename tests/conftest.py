import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from tidepool.session import checkpoint_dir, get_spark
    warehouse = tempfile.mkdtemp(prefix="tidepool-warehouse-")
    s = get_spark("local[*]", 8, app="tidepool-tests",
                  extra={"spark.sql.warehouse.dir": warehouse,
                         "spark.driver.extraJavaOptions": f"-Dderby.system.home={warehouse}"})
    checkpoint_dir(s)          # unset in tests: a scratch folder is made once
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
