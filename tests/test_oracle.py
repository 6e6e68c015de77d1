"""Every registered query against its SQL on the smallest folder."""

import math
from pathlib import Path

import duckdb
import pytest

import factweave.plans.flow  # noqa: F401
import factweave.plans.more  # noqa: F401
import factweave.plans.reasoning  # noqa: F401
import factweave.plans.resolution  # noqa: F401
import factweave.plans.surfaces  # noqa: F401
import factweave.plans.queries  # noqa: F401
import factweave.plans.writes  # noqa: F401
from factweave.plans.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return int(value) if value.is_integer() else round(value, 6)
    return value if isinstance(value, (bool, int, str)) else str(value)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    rows = [tuple(_plain(r[c]) for c in columns) for r in found.collect()]
    if name not in ORACLE:
        assert found.columns
        return
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    wanted = [tuple(_plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert sorted(map(repr, rows)) == sorted(map(repr, wanted))
