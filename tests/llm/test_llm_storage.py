import os

import pytest
from llm_cases import frame, rows

from flightlake.llm import simhash
from flightlake.llm.storage import landed, scratch


def test_tables_of_a_block_go_with_it(spark, tmp_path):
    kept = landed(spark.range(3), "kept")
    with scratch(spark) as outer:
        first = landed(spark.range(5), "first")
        with scratch(spark) as inner:
            simhash.keep_one(frame(spark, rows())).write.parquet(f"{tmp_path}/done")
            assert len(inner) > 3 and all(os.path.isdir(p) for p in inner)
        assert not any(os.path.exists(p) for p in inner)
        assert len(outer) == 1 and first.count() == 5
    assert not os.path.exists(outer[0])
    assert kept.count() == 3 and spark.read.parquet(f"{tmp_path}/done").count() > 0


def test_a_block_that_fails_leaves_nothing(spark):
    with pytest.raises(RuntimeError), scratch(spark) as paths:
        landed(spark.range(2), "lost")
        raise RuntimeError
    assert paths and not os.path.exists(paths[0])
