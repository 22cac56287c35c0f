"""Run registered queries next to their SQL: python tests/compare.py <sf dir> [name part ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return db


def shown(value):
    if value is None or value is pd.NA or value != value:
        return "<null>"
    return repr(value) if isinstance(value, float) else str(value)


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        rows.append(tuple(shown(v) for v in row))
    return list(frame.columns), sorted(rows)


def difference(spark_frame, sql_frame):
    """None if both hold the same rows, else a short description."""
    for side in (spark_frame, sql_frame):
        for column in side.columns:
            if str(side[column].dtype).startswith("float"):
                whole = side[column].dropna()
                if len(whole) and (whole == whole.round()).all():
                    side[column] = pd.Series([None if v != v else int(v) for v in side[column]], dtype=object)
    left, right = canonical(spark_frame), canonical(sql_frame)
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"row {str(a)[:300]} / {str(b)[:300]}"
    return None


def kinds(spark_frame, sql_types):
    spark = {f.name: f.dataType.simpleString() for f in spark_frame.schema}
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    return [f"{n}: {t}/{sql_types[n]}" for n, t in spark.items() if same.get(t) != sql_types.get(n)]


def main(sf, parts):
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    db, bad, sql = connect(sf), 0, e.oracle_sql()
    for name, query in e.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.time()
        try:
            frame = query(spark, sf)
            rows = frame.toPandas()
            took = time.time() - started
            if name in sql:
                started = time.time()
                result = db.execute(sql[name])
                types = {d[0]: str(d[1]) for d in result.description}
                expected = result.df()
                verdict = difference(rows, expected) or "ok"
                verdict += f" sql {time.time() - started:.1f}s " + " ".join(kinds(frame, types))
            else:
                verdict = "ok (no sql)"
        except Exception as error:
            took, verdict = time.time() - started, f"ERROR {str(error)[:600]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += not verdict.startswith("ok")
        print(f"{name:36s} {took:6.1f}s {len(rows) if 'rows' in dir() else 0:7d} {verdict}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], [p for p in sys.argv[2:] if p != "-v"])
