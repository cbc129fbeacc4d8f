import os

import pytest

from zonecast import session as S


class _Conf:
    def get(self, key, default=None):
        return default


class _ConnectLikeSession:
    """No spark.checkpoint.dir and no SparkContext (as under Spark Connect)."""

    conf = _Conf()

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext")


def test_checkpoint_folder_fallback_is_stable_per_session(tmp_dir):
    fake = _ConnectLikeSession()
    first = S.ensure_checkpoint_dir(fake, fallback=os.path.join(tmp_dir, "ck"))
    assert first == os.path.join(tmp_dir, "ck") and os.path.isdir(first)
    assert S.ensure_checkpoint_dir(fake) == first


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_ConnectLikeSession())

    class Cluster(_ConnectLikeSession):
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return _Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(Cluster())


def test_session_setting_wins(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert S.ensure_checkpoint_dir(spark, fallback="/nonexistent/never") == (configured or S._FALLBACK_DIRS[id(spark)])
