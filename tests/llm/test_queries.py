import pytest

from shoalframe.llm import queries
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, connect(SF), SF, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", ["op1_harmonic_packing", "op5_mpeg_audio", "op7_pfair_mixing"])
def test_every_document_is_there(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert out.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
