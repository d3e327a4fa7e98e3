"""Order-free comparison of a Spark result with a DuckDB result."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        tuple(("~",) if r[i] is None else (str(type(r[i]).__name__), str(r[i])) for i in order)
        for r in rows
    )


def difference(df, con, sql):
    """None if equal, else what differs."""
    rel = con.sql(sql)
    want_columns, want = rel.columns, rel.fetchall()
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got_columns, got), canonical(want_columns, want)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
