import pytest

from costflow.scratch import scratch_dir
from costflow.session import DEFAULTS


class FakeSession:
    def __init__(self, **conf):
        self._conf = conf
        self.conf = self

    def get(self, key, default=None):
        return self._conf.get(key.replace(".", "_"), default)


def test_named_folder_is_used():
    spark = FakeSession(spark_checkpoint_dir="hdfs://shared/base/", spark_master="yarn")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith("hdfs://shared/base/costflow/x-") and first != second


def test_the_warehouse_is_next_and_no_local_folder_after_it():
    warehouse = FakeSession(spark_sql_warehouse_dir="hdfs://shared/wh")
    assert scratch_dir(warehouse, "x").startswith("hdfs://shared/wh/costflow/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession(spark_master="local[4]"), "x")


def test_session_defaults():
    assert DEFAULTS["spark.sql.session.timeZone"] == "UTC"
    assert DEFAULTS["spark.sql.adaptive.enabled"] == "true"
