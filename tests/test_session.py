import os

import pytest

from rareclass.session import discard, materialize, scratch, shared_dir


def folder(df):
    return "/" + os.path.dirname(df.inputFiles()[0]).removeprefix("file:").lstrip("/")


def test_scratch_tables_go_when_their_work_is_done(spark):
    outside = folder(materialize(spark.range(3), "outside"))
    kept = shared_dir(spark, "kept")
    with scratch(spark, keep=(kept,)):
        inner = folder(materialize(spark.range(5), "inner"))
        with scratch(spark):
            nested = folder(materialize(spark.range(7), "nested"))
        assert os.path.exists(inner) and not os.path.exists(nested)
        spark.range(2).write.parquet(kept)
    assert os.path.exists(outside) and os.path.exists(kept) and not os.path.exists(inner)
    with pytest.raises(RuntimeError, match="lost"), scratch(spark):
        inner = folder(materialize(spark.range(5), "inner"))
        raise RuntimeError("lost")
    assert not os.path.exists(inner)
    discard(spark, kept, outside, "/tmp/never-made-by-anyone")
    assert not os.path.exists(outside)
