"""Side-by-side check of the registered queries and their SQL: python tests/compare.py [names]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(round(v, 6)))
    return (1, str(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_key(r[i]) for i in order) for r in rows))


def same(spark_df, con, sql):
    got = spark_df.collect()
    cur = con.execute(sql)
    want = cur.fetchall()
    a = canonical(spark_df.columns, got)
    b = canonical([d[0] for d in cur.description], want)
    if a[0] != b[0]:
        return False, f"columns {a[0]} != {b[0]}"
    if a[1] != b[1]:
        extra = [r for r in a[1] if r not in set(b[1])][:2]
        lack = [r for r in b[1] if r not in set(a[1])][:2]
        return False, f"rows {len(got)} vs {len(want)}\n   spark {str(extra)[:700]}\n   sql   {str(lack)[:700]}"
    types = {d[0]: str(d[1]) for d in cur.description}
    odd = [
        f"{f.name}:{f.dataType.simpleString()}/{types[f.name]}"
        for f in spark_df.schema
        if (f.dataType.simpleString(), types[f.name].lower()) not in KNOWN
    ]
    return True, f"{len(got)} rows" + (f" types? {odd}" if odd else "")


KNOWN = {
    ("bigint", "bigint"), ("string", "varchar"), ("double", "double"), ("int", "integer"),
    ("boolean", "boolean"), ("timestamp_ntz", "timestamp"), ("date", "date"),
    ("float", "float"), ("timestamp", "timestamp with time zone"),
}


def main():
    import __spark_entry__ as entry
    from corvane.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__enabled="false", spark__driver__extraJavaOptions="-Xss8m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[1:]
    bad = []
    for name, run in queries.items():
        if wanted and not any(name == w or name.startswith(w + "_") for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf)
            if name in oracles:
                ok, note = same(df, duck(sf), oracles[name])
            else:
                ok, note = True, f"{len(df.collect())} rows, no SQL"
        except Exception as e:
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        if not ok:
            bad.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
