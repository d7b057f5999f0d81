"""What queries put into the shared folder goes with the scratch around them."""

import pathlib

import pytest

from curate.llm.queries import QUERIES
from curate.session import scratch, shared_dir
from tests.llm.conftest import SF_DIR


@pytest.mark.parametrize("name", ["op5_id_planes", "op10_stream_dedup", "op12_two_stage_suffixes", "op13_pointer_sort"])
def test_nothing_stays_of_a_query_whose_result_is_written(spark, tmp_path, name):
    folder = pathlib.Path(shared_dir(spark)) / "curate"
    before = set(folder.glob("*"))
    with scratch(spark):
        QUERIES[name](spark, SF_DIR).write.parquet(str(tmp_path / name))
        assert set(folder.glob("*")) > before
    assert set(folder.glob("*")) == before
    assert spark.read.parquet(str(tmp_path / name)).count() > 0
