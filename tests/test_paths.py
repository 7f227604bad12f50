from types import SimpleNamespace

import pytest

from tokenloom.session import checkpoint_dir, scratch_path
from tokenloom.sources.tokenbin import shared_path


class Context:
    """A cluster's context: Spark keeps the folder with its file system, below it one of its own."""

    master, folder = "spark://host:7077", None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/2f1c"


def test_a_plain_checkpoint_folder_is_shared_by_executors():
    cluster = SimpleNamespace(sparkContext=Context(), conf={"spark.checkpoint.dir": "/mnt/shared"})
    path = scratch_path(cluster, "tokens")
    assert path.startswith("file:/mnt/shared/tokens-")
    assert shared_path(cluster, path) == path
    assert checkpoint_dir(cluster) == "file:/mnt/shared"
    with pytest.raises(ValueError, match="names no file system"):
        shared_path(cluster, "/mnt/shared/tokens")


def test_the_folder_stays_the_same(spark):
    assert checkpoint_dir(spark) == checkpoint_dir(spark)
    assert scratch_path(spark, "x").startswith("file:/")
