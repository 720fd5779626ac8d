"""Compare a Spark result with its DuckDB counterpart: columns, types, values."""

from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def mismatch(df, con, sql):
    """None if both sides agree, else a short description."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    names = sorted(types)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    ours = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if ours != types:
        return f"types {[(n, ours[n], types[n]) for n in names if ours[n] != types[n]]}"
    order = [list(types).index(n) for n in names]
    theirs = Counter(tuple(r[i] for i in order) for r in rows)
    mine = Counter(tuple(r) for r in df.select(*names).collect())
    if mine != theirs:
        return (
            f"{sum(mine.values())} vs {sum(theirs.values())} rows, "
            f"only Spark {list((mine - theirs).items())[:2]}, only SQL {list((theirs - mine).items())[:2]}"
        )
    return None
