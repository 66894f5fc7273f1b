import duckdb
import pytest

import __spark_entry__
from quarrylane.oracle import ORACLE_SQL
from quarrylane.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def text(rows):
    return sorted(repr([None if v is None or v != v else int(v) if isinstance(v, float) and v.is_integer() else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, name):
    out = QUERIES[name](spark, SF)
    columns = sorted(out.columns)
    rows = [tuple(r) for r in out.select(*columns).collect()]
    if name not in ORACLE_SQL:
        assert rows
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    con.execute(f"CREATE TABLE found AS {ORACLE_SQL[name]}")
    assert sorted(c[0] for c in con.execute("DESCRIBE found").fetchall()) == columns
    want = con.execute(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM found").fetchall()
    assert text(rows) == text(want)


def test_entry(spark):
    out = __spark_entry__.entry(spark)
    assert len(out.columns) == 10 and out.count() == 1000
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE_SQL) <= set(QUERIES)


def test_verify_edges_parses_bounds_once(spark):
    """Resolving and proving read the stored bounds: no text is parsed in the plan that follows."""
    out = QUERIES["verify_edges"](spark, SF)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "start" in plan and not any(f in plan for f in ("RLIKE", "regexp_replace", "from_value"))
