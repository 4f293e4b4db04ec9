import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pagelake.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="pagelake-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def shred_one(spark):
    """Shred literal HTML strings: returns the collected node dicts per page."""
    from pagelake.operators.shred import shred_html

    def run(*htmls):
        df = spark.createDataFrame([(str(i), h) for i, h in enumerate(htmls)], "page_key string, body string")
        rows = shred_html(df, keep_html=False, partitions=1).orderBy("page_key").collect()
        return [[n.asDict(recursive=True) for n in r.nodes] for r in rows]

    return run
