import pytest

from trailmark.session import checkpoint_root, remove_scratch, scratch_dir


def test_scratch_goes_below_the_configured_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root.rstrip("/")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(f"{root.rstrip('/')}/trailmark/run-") and "/x-" in a and a != b
    assert a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]


def test_scratch_is_gone_after_a_query_when_asked(spark):
    import os

    from trailmark.plans.contract import queries

    folder = os.path.dirname(scratch_dir(spark, "x"))
    assert queries()["jsonl_source"](spark, "/root/testdata/sf0.001").count() > 0 and os.listdir(folder)
    remove_scratch(spark)
    assert not os.path.exists(folder)
    assert os.path.dirname(scratch_dir(spark, "x")) != folder


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)
