import duckdb
import pytest


@pytest.fixture
def duck():
    """Runs SQL over pandas frames or Parquet folders given by name."""

    def run(sql, **tables):
        con = duckdb.connect()
        for name, t in tables.items():
            if isinstance(t, str):
                con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{t}'")
            else:
                con.register(name, t)
        return con.sql(sql).df()

    return run
