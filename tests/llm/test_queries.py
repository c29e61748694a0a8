"""Every query of the subpackage with SQL against it, and the register's completeness."""

import re

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from noticeloom.llm.queries import ORACLES, QUERIES

from ..compare import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == ""


def test_one_query_per_operator():
    numbers = [int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14))
    assert entry_module.queries()["pipeline"] is corpus_pipeline.run
    assert set(QUERIES) <= set(entry_module.queries())
