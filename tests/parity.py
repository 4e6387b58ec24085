"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

    python tests/parity.py [scale factor] [name...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
FORBIDDEN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython")
SPARK_FAMILY = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    return (1, str(v))


def compare(spark, con, run, sql, folder) -> list[str]:
    """Problems found: schema, row count, values. Empty if equal."""
    df = run(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    names = sorted(df.columns)
    spark_types = {f.name: SPARK_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rows = [tuple(_cell(r[c]) for c in names) for r in df.collect()]
    cur = con.execute(sql)
    duck_names = [d[0] for d in cur.description]
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    other = cur.fetchall()
    if sorted(duck_names) != names:
        return [f"columns {names} != {sorted(duck_names)}"]
    at = [duck_names.index(c) for c in names]
    expected = [tuple(_cell(r[i]) for i in at) for r in other]
    out = [f"plan has {node}" for node in FORBIDDEN_NODES if node in plan]
    out += [f"type of {c}: {spark_types[c]} != {duck_types[c]}" for c in names if spark_types[c] != duck_types[c]]
    if len(rows) != len(expected):
        out.append(f"{len(rows)} rows != {len(expected)}")
    rows.sort()
    expected.sort()
    bad = [(a, b) for a, b in zip(rows, expected) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x[1], y[1]) for c, x, y in zip(names, a, b) if x != y]
        out.append(f"{len(bad)} differing rows, first: {diff}")
    if not rows:
        out.append("no rows")
    return out


def main() -> None:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from tests.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:]
    spark = build_session("parity")
    con = duck(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problems = compare(spark, con, run, sqls[name], folder)
            else:
                problems = [] if run(spark, folder).count() > 0 else ["no rows"]
        except Exception as e:  # noqa: BLE001 - report and go on
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {time.time() - start:6.2f}s {name}{'' if name in sqls else ' (no SQL)'}", flush=True)
        for p in problems:
            print("       ", p, flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
