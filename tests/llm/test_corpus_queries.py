import duckdb
import pytest

from quarrylane.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_for_each_of_the_table(spark, name):
    table, key = {"op5": ("pages", "page_id"), "op6": ("pages", "page_id"), "op13": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    want = [r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()]
    out = QUERIES[name](spark, SF)
    rows = out.collect()
    assert sorted(r[key] for r in rows) == sorted(want)
    if name not in ORACLE_SQL:
        return
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(out.columns)
    assert sorted(found.fetchall(), key=repr) == sorted((tuple(r[c] for c in columns) for r in rows), key=repr)
