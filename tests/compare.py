"""Comparing a query with its SQL."""

import pandas as pd


def ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def same_as_sql(spark, duck, query, sql, sf_dir="/root/testdata/sf0.001"):
    a, b = query(spark, sf_dir).toPandas(), duck.sql(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    pd.testing.assert_frame_equal(ordered(a), ordered(b), check_dtype=False, check_exact=True)
    return a
