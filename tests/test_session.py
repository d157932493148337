import os
import subprocess
import sys

import pytest

from tallywood import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class Session:
    def __init__(self, master, **conf):
        self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})
        self.sparkContext = type("Context", (), {"master": master, "getConf": lambda _: Conf({})})()


def test_the_named_folder_is_used():
    named = Session("spark://host", spark__checkpoint__dir="hdfs://shared/x/")
    assert session.fresh_dir(named, "a").startswith("hdfs://shared/x/a-")


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_a_folder_has_to_be_named(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(master))


SCRIPT = """
import sys
from tallywood import session
shared = sys.argv[1] if len(sys.argv) > 1 else None
spark = session.build_session("own", "local[1]", shared=shared, spark__ui__enabled="false")
print("ROWS", session.materialize(spark.range(3)).count())
"""


def test_a_real_session_without_other_settings(tmp_path):
    """A session of its own process, which finds no configuration of this machine."""
    (tmp_path / "conf").mkdir()
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": ROOT}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    named = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path / "shared")], env=env, capture_output=True, text=True, timeout=120)
    assert "ROWS 3" in named.stdout, named.stderr[-2000:]
    unnamed = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=120)
    assert "ROWS" not in unnamed.stdout and "spark.checkpoint.dir" in unnamed.stderr


def test_materialised_rows_are_the_same(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS DECIMAL(18,4)) AS x")
    again = session.materialize(df)
    assert again.dtypes == df.dtypes and sorted(again.collect()) == sorted(df.collect())
