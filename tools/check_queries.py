"""Run queries and their SQL side by side: python tools/check_queries.py SF_DIR [name …]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pathloom.catalog.queries import ORACLES, QUERIES  # noqa: E402


def cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def table(rows, names) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def open_tables(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def compare(spark, con, name: str, folder: str) -> str:
    """An empty text if both agree, else what differs."""
    found = QUERIES[name](spark, folder)
    got = table(found.collect(), found.columns)
    if name not in ORACLES:
        return "" if got else "no rows"
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = table(cursor.fetchall(), columns)
    if sorted(columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)} / {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows, first {wrong[0]}" if wrong else ""


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = open_tables(folder)
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem}", flush=True)


if __name__ == "__main__":
    main()
