"""Queries of the operators against their SQL twins."""

import pytest

from check_oracle import compare, connect
from deskflow.llm.oracle import ORACLE
from deskflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None
