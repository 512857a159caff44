import pytest

from cohortlens.session import ensure_checkpoint_dir


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return _Conf()


class _Session:
    sparkContext, conf = _Context(), _Conf()


def test_a_cluster_needs_a_shared_checkpoint_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session())


def test_local_mode_has_one(spark):
    assert ensure_checkpoint_dir(spark)
