"""Builders of small tables and comparison of results."""

import math

from odmeter.schemas import KEY, PAIR

POINT = (-46.6, -23.5, -46.7, -23.6)


def od_rows(spark, rows):
    """Rows of (key, month, file, row index[, pair]) with file columns; files are in time order by name."""
    full = [
        (key, month, name, f"{month}/{name}", f"{month}-01T0{i % 10}:00:00+00:00", index, *(pair[0] if pair else POINT))
        for i, (key, month, name, index, *pair) in enumerate(rows)
    ]
    columns = (
        f"{KEY} string, partition_month string, source_file string, file_path string, file_time_text string,"
        " row_index bigint, " + ", ".join(f"{c} double" for c in PAIR)
    )
    frame = spark.createDataFrame(full, columns)
    return frame.selectExpr("*", "to_timestamp('2025-01-01') + make_interval(0,0,0,0,0,0,0) AS file_time").drop("file_time_text")


def values(df, *names):
    """Result as a sorted list of tuples."""
    names = names or df.columns
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=repr)


def comparable(columns, rows):
    """Column order and row order do not matter; doubles to six decimals."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)

    return sorted(columns), sorted(tuple(text(row[i]) for i in order) for row in rows)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
