"""Every catalog query against its SQL in DuckDB."""

import pytest
from conftest import rows_of

from matchloom.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, small, duck, name):
    mine, theirs = catalog.QUERIES[name](spark, small).toPandas(), duck.execute(catalog.SQL[name]).fetchdf()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows_of(mine) == rows_of(theirs)


def test_features_are_complete(spark, small):
    rows = catalog.QUERIES["pair_features"](spark, small).toPandas()
    assert len(rows) and not rows.isna().any().any()
    assert rows.drop(columns=["source1_entity_id", "candidate_entity_id"]).stack().between(0, 1).all()


def test_training_and_scoring(spark, small):
    rows = catalog.QUERIES["train_and_score"](spark, small).toPandas()
    assert len(rows) and rows.calibrated_score.between(0, 1).all()
    assert rows.calibrated_score.nunique() > 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
