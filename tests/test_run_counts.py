"""What a run tells about itself."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_operators import sources_full
from vacancy_lake.operators import silver
from vacancy_lake.plans import medallion

def as_of():
    return F.lit(dt.datetime(2026, 1, 5))


def test_counts_are_taken_as_silver_is_written(spark, tmp_path):
    done = medallion.run(*sources_full(spark), str(tmp_path), as_of=as_of(), stop_on_error=False)
    assert done.counts["rows"] == 3 and done.counts["good"] == done.silver.count() == 2 and done.counts["rejected"] == 1
    assert done.counts["rejected_by"] == {silver.BAD_SALARY: 1}
    blank = {c: done.silver.filter(F.coalesce(F.trim(c), F.lit("")) == "").count() for c in medallion.COUNTED_BLANKS}
    assert done.counts["blanks"] == blank
    row = medallion.runs(spark, str(tmp_path)).first()
    assert (row.status, row.error, row.rows, row.good, row.rejected_by) == ("success", None, 3, 2, {silver.BAD_SALARY: 1})
    assert row.seconds > 0 and row.exit_code == done.exit_code


def test_stopped_and_failed_runs_leave_a_row(spark, tmp_path):
    out = str(tmp_path)
    stopped = medallion.run(*sources_full(spark), out, as_of=as_of())
    assert stopped.gold is None and stopped.exit_code == 1
    listed, detail, text = sources_full(spark)
    bad = listed.filter("ord = 2")  # its salary cannot be read
    with pytest.raises(ValueError):
        medallion.run(bad, detail.filter("false"), text.filter("false"), out, as_of=as_of())
    found = {r.status: r for r in medallion.runs(spark, out).collect()}
    assert set(found) == {"stopped", "failed"} and found["failed"].error == "ValueError: no good record"
    assert (found["failed"].rows, found["failed"].good, found["failed"].rejected) == (1, 0, 1)
