import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pulsekit.session import ensure_checkpoint_dir, get_spark
    session = get_spark("local[4]", app_name="pulsekit-tests", shuffle_partitions=8,
                        conf={"spark.driver.memory": "4g"})
    ensure_checkpoint_dir(session, fallback=tempfile.mkdtemp(prefix="pulsekit-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="pulsekit-test-out-")


ACTIVITY_SCHEMA = "row_id long, Steps long, Heart_Rate_avg double, Calories_Burned double, Workout_Type string"


@pytest.fixture()
def make(spark):
    def _make(rows, schema=ACTIVITY_SCHEMA):
        return spark.createDataFrame(rows, schema)
    return _make
