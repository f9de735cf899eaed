"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare
from checks.oracles import all_oracles
from checks.queries import all_queries


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, data, name):
    ok, note = compare(spark, data, all_queries()[name], all_oracles()[name])
    assert ok, note


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["source", "lang", "n_examples", "n_chars", "longest"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", ["stream_prepare", "stream_rejected"])
def test_a_stream_reads_a_table_of_several_files(spark, data, name, tmp_path):
    folder = tmp_path / "tables"
    spark.read.parquet(f"{data}/documents.parquet").repartition(3).write.parquet(f"{folder}/documents.parquet")
    one, several = (queries()[name](spark, where) for where in (data, str(folder)))
    assert one.count() == several.count() > 0
    assert one.exceptAll(several).count() == 0
