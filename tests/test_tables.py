import gc
import os
import time

import pytest
from pyspark.sql import functions as F

from gridloom import queries, tables

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are missing")
@pytest.mark.parametrize("name", ["duplicate_suppression", "detections_per_region"])
def test_frames_made_from_a_result(spark, name):
    made = lambda: queries.QUERIES[name](spark, SF)
    n, first = made().count(), made().columns[0]
    for derive in (lambda df: df.select(first), lambda df: df.where(F.lit(True)), lambda df: df.groupBy(*df.columns).count()):
        derived = derive(made())
        tables.free(spark)
        tables._tables(spark).sweep()
        assert derived.count() == n


def test_a_table_goes_with_its_last_frame(spark):
    scope = tables.Scope(spark)
    kept = scope.write(spark.range(5), "numbers").where("id > 1")
    path = scope.paths[0].removeprefix("file://")
    tables.free(spark)
    tables._tables(spark).sweep()
    assert kept.count() == 3
    assert os.path.exists(path)
    del kept
    gc.collect()
    for _ in range(20):  # the driver's listeners let go of a query a little later
        tables.free(spark)
        tables._tables(spark).sweep()
        if not os.path.exists(path):
            return
        time.sleep(0.2)
    raise AssertionError(path)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda name, default: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_dir(Session())
