"""The daily snapshot over every day of the fact against DuckDB, row by row, on the smallest scale."""

import duckdb
from pyspark.sql import functions as F

from starloom.plans.bind_marts import _SCALED, DAILY_SQL, DIGEST, _natural_ids, daily_runs, program_daily_snapshot_whole
from starloom.plans.mart1 import daily_snapshot_rows
from starloom.sources.tables import TABLES
from tests.conftest import SF_SMALL

DEFINITION = DAILY_SQL + f""", days AS (SELECT unnest(generate_series(min(day_from), max(day_to), INTERVAL 30 DAY)) AS day FROM spans)
SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, count(*), {", ".join(f"CAST(sum(coalesce({_SCALED.format(e)}, 0)) AS BIGINT)" for e in DIGEST.values())}
FROM (SELECT day, p.child_id, p.center_id, p.teacher_id, max(day_key) AS day_key FROM days, states p
      WHERE day_key <= CAST(strftime(day, '%Y%m%d') AS INTEGER) GROUP BY ALL) JOIN states USING (child_id, center_id, teacher_id, day_key)
GROUP BY 1 ORDER BY 1"""


def test_expanded_rows_and_digests_agree(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = {r[0]: r for r in con.execute(DEFINITION).fetchall()}
    state, _, out = daily_runs(spark, SF_SMALL)
    digests = {r[0]: tuple(r) for r in program_daily_snapshot_whole(spark, SF_SMALL).select("date_key", "n_rows", *DIGEST).collect()}
    assert len(digests) > 2_400 and len(want) > 80
    assert {k: digests[k] for k in want} == want
    rows = _natural_ids(daily_snapshot_rows(state, out), out)
    expanded = rows.groupBy("date_key").agg(F.count(F.lit(1)), *[F.sum(F.coalesce(F.expr(_SCALED.format(e)), F.lit(0))) for e in DIGEST.values()])
    got = {r[0]: tuple(r) for r in expanded.collect()}
    assert got == digests and sum(r[1] for r in got.values()) > 4_000_000
