"""The registered text queries over the smallest tables: they run whole and keep their columns."""

import pytest
from conftest import SMALL

from quirework.llm import queries
from quirework.session import read_table

COLUMNS = {
    "p5_found": ["page_id", "line_no", "noise"], "p6_found": ["page_id", "line_no", "term_id"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "start_pos", "end_pos"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    assert df.count() > 0
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
        assert df.count() == df.distinct().count()


def test_every_document_has_ids(spark):
    docs = read_table(spark, SMALL, "documents")
    assert queries.p7_ids(spark, SMALL).count() == docs.count()
    assert queries.p7_round_trip(spark, SMALL).where("NOT same").count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_product_of_tables(spark, name):
    text = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, con, name):
    import compare

    assert compare.differences(spark, con, queries.QUERIES[name], queries.SQL[name], SMALL) == ""
