import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohortframe.session import tune
    from tests.oracle import session

    return tune(session())


@pytest.fixture(scope="session")
def frame(spark):
    """``frame("a int, b double", [(1, 2.0)])``"""
    from cohortframe.session import literal_table

    return lambda schema, rows: literal_table(spark, rows, schema)
