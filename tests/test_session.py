import pytest

from tierflow import session


class _Conf:
    def __init__(self, **kv):
        self.kv = kv

    def get(self, key, default=None):
        return self.kv.get(key, default)


class _Spark:
    def __init__(self, master):
        self.conf = _Conf(**{"spark.master": master})

    @property
    def sparkContext(self):
        raise RuntimeError("not in this test")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]", ""])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Spark(master))
