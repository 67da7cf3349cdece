"""The session takes master, partitions and folders from the submit command."""

import os
import subprocess
import sys

import pytest

from reachset.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SUBMITTED = """
from reachset.session import build_session
s = build_session()
print("GOT", s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"),
      s.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor"))
s.stop()
"""


def test_submitted_master_and_partitions_win():
    env = os.environ | {
        "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=37 "
        "--conf spark.ui.enabled=false pyspark-shell",
        "PYTHONPATH": ROOT,
    }
    out = subprocess.run(
        [sys.executable, "-c", SUBMITTED], env=env, capture_output=True, text=True, timeout=120
    ).stdout
    assert "GOT local[2] 37 4" in out


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, path):
        raise AssertionError("a folder of one machine")


class _Session:
    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    def __init__(self, master):
        self.sparkContext = _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://x", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_raises(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(master))
