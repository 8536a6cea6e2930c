"""Each query of the evidence operators against its SQL on the smallest tables."""

import duckdb
import pytest

from claimweft.plans import catalog as registry
from conftest import SMALL

TABLES = "documents embeddings pages benchmark labels conversations region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, tmp_path, name):
    path = str(tmp_path / "out")
    registry.queries()[name](spark, SMALL).write.parquet(path)
    duck.execute(f"create or replace table want as {registry.oracle_sql()[name]}")
    duck.execute(f"create or replace table got as select * from '{path}/*.parquet'")
    columns = ", ".join(f'"{r[0]}"' for r in duck.execute("describe want").fetchall())
    assert duck.execute("select count(*) from want").fetchone() == duck.execute("select count(*) from got").fetchone()
    assert not duck.execute(f"select {columns} from want except all select {columns} from got").fetchall()
