"""Every query beside its SQL on the smallest tables."""

import os

import pytest

from quillspark.plans import collected, queries, registry  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def canonical(rows, columns):
    def show(v):
        if isinstance(v, float):
            return "None" if v != v else f"{v:.6f}"
        return str(list(v)) if hasattr(v, "tolist") else str(v)

    return sorted(tuple(show(r[c]) for c in sorted(columns)) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    got = registry.QUERIES[name](spark, SF)
    rows = [r.asDict() for r in got.collect()]
    if name not in registry.SQL:
        return
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    want = c.execute(registry.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(rows, columns) == canonical([dict(zip(columns, r, strict=True)) for r in want.fetchall()], columns)
