from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kodeks.operators.history import act_change_history

SCHEMA = "change_row_id long, eli string, eli_annotation string, type_of_change string, date_of_change_annotation string, snapshot_date string, loaded_at timestamp, key_ string, n_ int"
SNAPS = ["2023-01-31", "2023-02-28", "2023-03-31", "2023-04-30"]


def make(spark, rows):
    full = [(i, *r, "clash", 1) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def found(df):
    return sorted((r.eli, r.eli_annotation, r.valid_from, r.valid_to) for r in act_change_history(df).collect())


def t(day, hour=0):
    return datetime(2023, 5, day, hour)


def test_versions(spark):
    a, b = "DU/2010/15", "DU/2011/7"
    rows = [
        (a, b, "Akty zmieniające", "2010-01-02", SNAPS[0], t(1)),
        (" du / 2010 / 015", b, "AKTY zmieniające ", "2.01.2010", SNAPS[1], t(2)),  # spelling
        (a, b, "-", "b.d.", SNAPS[2], t(3)),  # missing keeps the value
        (a, b, "Akty uchylające", "2 stycznia 2010 r.", SNAPS[3], t(4)),  # change
        (a, b, "Akty uchylające", "2 stycznia 2010 r.", SNAPS[3], t(4)),  # repeated row
    ]
    assert found(make(spark, rows)) == [(a, b, SNAPS[0], SNAPS[3]), (a, b, SNAPS[3], "")]


def test_return_and_correction(spark):
    a, b = "DU/2010/15", "DU/2011/7"
    x = ("DU/1/1", "DU/2/2")
    rows = [(*x, "k", None, s, t(1)) for s in SNAPS]
    rows += [(a, b, "old", "2010-01-01", SNAPS[0], t(1)), (a, b, "new", "2010-01-01", SNAPS[0], t(9)), (a, b, "new", "2010-01-01", SNAPS[2], t(2))]
    assert found(make(spark, rows)) == [("DU/1/1", "DU/2/2", SNAPS[0], ""), (a, b, SNAPS[0], SNAPS[1]), (a, b, SNAPS[2], SNAPS[3])]


def test_nulls_and_empty(spark):
    rows = [(None, "DU/1/1", "a", "2010-01-01", SNAPS[0], t(1)), ("DU/1/1", "", "a", None, SNAPS[0], t(1)), ("DU/1/1", "DU/1/2", None, None, None, t(1)), ("DU/1/1", "DU/1/2", None, None, SNAPS[0], None), ("DU/1/1", "DU/1/3", "x" * 100_000, "0000-00-00", SNAPS[0], t(1))]
    assert found(make(spark, rows)) == [("DU/1/1", "DU/1/2", SNAPS[0], ""), ("DU/1/1", "DU/1/3", SNAPS[0], "")]
    assert found(make(spark, [])) == []


def brute(rows):
    last = {}
    for i, (e, a, kind, date, snap, at) in enumerate(rows):
        k = (e, a, snap)
        if k not in last or (at, i) > last[k][0]:
            last[k] = ((at, i), kind, date)
    snaps, out = sorted({k[2] for k in last}), []
    for e, a in sorted({k[:2] for k in last}):
        held, begun = None, None
        value = [None, None]
        for i, s in enumerate(snaps):
            if (e, a, s) not in last:
                if begun is not None:
                    out.append((e, a, begun, s))
                held, begun = None, None
                continue
            _, kind, date = last[(e, a, s)]
            value = [kind if kind != "-" else value[0], date or value[1]]
            if begun is None or value != held:
                if begun is not None:
                    out.append((e, a, begun, s))
                begun, held = s, list(value)
        if begun is not None:
            out.append((e, a, begun, ""))
    return sorted(out)


ROW = st.tuples(st.sampled_from(["DU/1/1", "DU/2/2"]), st.sampled_from(["DU/3/3", "DU/4/4"]), st.sampled_from(["a", "b", "-"]), st.sampled_from(["2010-01-01", "2011-01-01", None]), st.sampled_from(SNAPS), st.sampled_from([t(1), t(2), t(3)]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=30))
def test_against_fold(spark, rows):
    assert found(make(spark, rows)) == brute(rows)


def test_batches_carry_over(spark):
    rows = [("DU/1/1", f"DU/2/{i}", "ab"[(i + j) % 2 if i % 3 else 0], "2010-01-01", s, t(1)) for i in range(60) for j, s in enumerate(SNAPS)]
    df = make(spark, rows)
    want = found(df)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(df) == want == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")


@pytest.mark.parametrize("name", ["p4_found"])
def test_registered(name):
    import __spark_entry__ as entry

    assert name in entry.queries()
