"""Run registered queries and their oracles side by side.

    python -m verification.compare [folder of tables] [query ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from verification.oracles import ORACLES
from verification.queries import QUERIES


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _counted(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(folder: str):
    base = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        base.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return base


def differences(spark: SparkSession, base, folder: str, name: str) -> str | None:
    """None where both sides agree, else what differs."""
    frame = QUERIES[name](spark, folder)
    got = _counted(frame.columns, frame.collect())
    cursor = base.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = _counted(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    if got != want:
        extra, missing = list((got - want).items()), list((want - got).items())
        return f"{len(extra)} extra {extra[:3]}, {len(missing)} missing {missing[:3]}"
    return None if want else "no rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base, failed = connect(folder), 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found = differences(spark, base, folder, name)
        except Exception as problem:  # report every query, then fail
            found = f"{type(problem).__name__}: {str(problem)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
