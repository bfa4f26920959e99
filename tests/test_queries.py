"""Every registered query against its SQL, on the smallest test tables."""

import pytest

import oracle_check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF)


OWN = oracle_check.spark_entry.QUERIES


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql(spark, con, name):
    ok, text = oracle_check.compare(spark, con, name, SF)
    assert ok, text


def test_every_query_has_sql():
    assert set(OWN) == set(oracle_check.spark_entry.SQL)


def test_either_key_match_in_its_or_form(spark, con):
    """The split fact's SQL spells the OR condition out as two matches; compare it with the OR itself."""
    from workload import oracle

    def ids(sql):
        return sorted(con.execute(oracle.compose(sql)).fetchall(), key=repr)

    literal = ids(
        """select t.id, s.id from int_unique_transaction t left join unique_subtransaction s
           on s.super_id = t.id or s.super_id = t.matched_transaction_id"""
    )
    assert literal == ids(
        """select t.id, m.id from int_unique_transaction t left join part_owner m on m.owner = t.id"""
    )


def test_entry_has_rows(spark):
    assert oracle_check.spark_entry.entry(spark).count() > 0
