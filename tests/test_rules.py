"""What the planner decides about types, schemas, changes and definitions, against listed rows."""

import duckdb
import pytest

from deltaloom.plans import catalogue
from deltaloom.plans.catalogue_rules import RULES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(RULES))
def test_rule(spark, name):
    made, sql = RULES[name]
    want = duckdb.sql(sql)
    got = made(spark, FOLDER)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_rules_are_no_queries():
    assert len(RULES) == 28 and not set(RULES) & set(catalogue.queries())
