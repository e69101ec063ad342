import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def ready(spark):
    from tallyline.llm.common import ready as prepare
    return prepare(spark)
