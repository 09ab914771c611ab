"""Spark rows against DuckDB rows: names, types, values, whatever the order."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

SAME_TYPE = {
    "string": {"VARCHAR"},
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "timestamp": {"TIMESTAMP"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def duck(connection, sql):
    result = connection.sql(sql)
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return {result.columns[i]: str(result.types[i]) for i in order}, sorted(rows, key=repr)


def spark_rows(df):
    names = sorted(df.columns)
    df = df.select(*names)
    return dict(df.dtypes), sorted((tuple(row) for row in df.collect()), key=repr)


def differences(df, connection, sql):
    """What differs, as text; empty where nothing does."""
    types, rows = spark_rows(df)
    expected_types, expected = duck(connection, sql)
    found = []
    if set(types) != set(expected_types):
        return [f"columns {sorted(types)} / {sorted(expected_types)}"]
    for name, kind in types.items():
        if expected_types[name] not in SAME_TYPE[kind]:
            found.append(f"type of {name}: {kind} / {expected_types[name]}")
    if len(rows) != len(expected):
        found.append(f"rows {len(rows)} / {len(expected)}")
    else:
        wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
        if wrong:
            found.append(f"{len(wrong)} of {len(rows)} rows differ, first {str(wrong[0][0])[:500]} / {str(wrong[0][1])[:500]}")
    return found
