"""Thresholds of single checks, and drift that raises like any other check."""

import pytest

from tidepool.operators import quality as Q


def test_drift_raises_by_its_own_threshold(spark):
    docs = [("b1", '{"id": "1", "v": "2"}'), ("b1", '{"id": "x", "v": "2", "more": "1"}'), ("b1", '{"id": "3"}'), ("b1", '{"id": "4", "v": "1"}'),
            ("b2", '{"id": "1", "v": "2"}'), ("b2", "{broken")]
    raw = spark.createDataFrame([(f"2024-01-0{b[1]}", j) for b, j in docs], "day string, json string")
    m = Q.drift_metrics(Q.schema_drift(raw, "json", "day", {"id": "int", "v": "int"}), "t").cache()
    got = {(str(r.run_timestamp)[:10], r.check_name): (r.severity, r.total_rows, r.pass_count, r.fail_count, float(r.fail_pct)) for r in m.collect()}
    assert got["2024-01-01", "cast_failure:id"] == ("ERROR", 4, 3, 1, 25.0)
    assert got["2024-01-01", "missing:v"] == ("ERROR", 4, 3, 1, 25.0)
    assert got["2024-01-01", "extra:more"] == ("WARNING", 4, 3, 1, 25.0)
    assert got["2024-01-02", "missing:id"] == ("ERROR", 2, 1, 1, 50.0)
    own = {"cast_failure:id": 30.0, "missing:v": 60.0, "missing:id": 60.0}
    assert Q.threshold_breaches(m, 5.0, per_check=own).count() == 0
    assert Q.threshold_breaches(m, 5.0, ("ERROR", "WARNING"), own).count() == 1
    Q.assert_thresholds(m, 5.0, per_check=own)
    with pytest.raises(Q.DataQualityError, match="1 checks"):
        Q.assert_thresholds(m, 5.0, per_check=own | {"cast_failure:id": 20.0})
