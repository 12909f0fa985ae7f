"""Compare every query with its SQL: names, types, row count and values regardless of order."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# Spark type names as the SQL engine writes them.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def sql_connection(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def type_name(data_type) -> str:
    text = data_type.simpleString()
    return TYPE_NAMES.get(text, text.upper())


def differences(df, connection, sql: str) -> list[str]:
    """What differs, empty when nothing does."""
    cursor = connection.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    spark_types = {f.name: type_name(f.dataType) for f in df.schema.fields}
    problems = []
    if sql_types.keys() != spark_types.keys():
        return [f"columns {sorted(spark_types)} / {sorted(sql_types)}"]
    for column, kind in spark_types.items():
        if sql_types[column].replace(" ", "") != kind:
            problems.append(f"type of {column}: {kind} / {sql_types[column]}")
    order = sorted(spark_types)
    places = [list(sql_types).index(c) for c in order]
    expected = Counter(tuple(row[i] for i in places) for row in cursor.fetchall())
    found = Counter(tuple(row[c] for c in order) for row in df.collect())
    if found != expected:
        problems.append(
            f"rows {found.total()} / {expected.total()}; only Spark {list((found - expected).items())[:3]}; "
            f"only SQL {list((expected - found).items())[:3]}"
        )
    return problems


def main(folder: str, names: list[str]) -> int:
    from quire.session import build_session
    from quire.trial.catalogue import QUERIES
    from quire.trial.oracle import ORACLE

    spark = build_session("local[8]", "quire-compare", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "10g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = sql_connection(folder)
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            if name not in ORACLE:
                outcome = f"no SQL, {QUERIES[name](spark, folder).count()} rows"
            else:
                problems = differences(QUERIES[name](spark, folder), connection, ORACLE[name])
                bad += bool(problems)
                outcome = "DIFFERENT " + "; ".join(problems)[:1500] if problems else "equal"
        except Exception as error:  # report and go on with the other queries
            bad += 1
            outcome = f"ERROR {str(error)[:800]}"
        print(f"\nCMP {name}: {outcome} ({time.time() - started:.1f} s)", flush=True)
    print(f"\nCMP {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
