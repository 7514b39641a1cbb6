"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def open_oracle(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, list):
        return tuple(_value(x) for x in v)
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return _bag(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return _bag(names, cursor.fetchall())


def difference(left, right) -> str:
    """Empty when equal, else a short description."""
    if left[0] != right[0]:
        return f"columns {sorted(set(left[0]) ^ set(right[0]))}"
    if left[1] != right[1]:
        only_left, only_right = left[1] - right[1], right[1] - left[1]
        a, b = sorted(only_left, key=str)[:1], sorted(only_right, key=str)[:1]
        return (f"rows {sum(left[1].values())}/{sum(right[1].values())}, unequal {sum(only_left.values())}"
                f"/{sum(only_right.values())}\n   spark {a}\n   sql   {b}")
    return ""


def main(argv):
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from parcelwing.session import build_session

    folder, wanted = argv[0], argv[1:]
    spark = build_session("compare", "8", memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = open_oracle(folder), entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not wanted or any(n.startswith(w) for w in wanted)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = spark_rows(queries[name](spark, folder))
            middle = time.time()
            problem = difference(got, oracle_rows(con, oracle[name])) if name in oracle else ""
            kind = "" if name in oracle else " (rows only)"
            size = sum(got[1].values())
            empty = "  EMPTY" if size == 0 else ""
            state = f"{size} rows {middle - start:.2f}s sql {time.time() - middle:.2f}s{kind}{empty}"
        except Exception as error:  # report and go on with the next query
            problem, state = f"{type(error).__name__}: {str(error)[:600]}", "error"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '}{name}: {state} {problem}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
