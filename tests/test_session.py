import pytest

from millrace.session import workspace


class Elsewhere:
    """A session on a cluster, as far as `workspace` looks at it."""

    class sparkContext:
        master = "spark://somewhere:7077"

        @staticmethod
        def getConf():
            return {}

    class conf:
        @staticmethod
        def get(name, default=None):
            return default


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(Elsewhere, "x")


def test_folders_are_fresh_and_below_the_shared_one(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first != second
    assert shared is None or all(p.startswith(f"{shared.rstrip('/')}/millrace/x-") for p in (first, second))
