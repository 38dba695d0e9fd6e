"""Comparison of a DataFrame with SQL."""
import duckdb
import pandas as pd


def same(got, sql, key="doc_id", **tables):
    """Rows of a DataFrame equal those of the SQL over pandas or Parquet tables."""
    con = duckdb.connect()
    for name, table in tables.items():
        if isinstance(table, str):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{table}'")
        else:
            con.register(name, table)
    exp = con.sql(sql).df()
    cols = sorted(exp.columns)
    norm = lambda df: sorted((tuple("" if pd.isna(x) else x for x in r) for r in df[cols].astype(object).itertuples(index=False)), key=repr)
    assert sorted(got.columns) == cols
    assert norm(got.toPandas()) == norm(exp)
