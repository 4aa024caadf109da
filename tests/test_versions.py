"""Versioned tables and the history kept by change: crash-safe commits, daily runs equal one run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tally.plans import bronze, text
from tally.plans.history import PeriodHistory
from tally.sinks import versions
from tally.sinks.versions import ConcurrentCommit, VersionedTable

D = dt.date
DAYS = "v long, metric_date date"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def table(spark, tmp_path):
    return VersionedTable(spark, f"file://{tmp_path}/t")


def test_a_job_that_stops_before_its_commit_changes_nothing(spark, df, table, monkeypatch):
    table.replace_window(df([(1, D(2024, 1, 20)), (2, D(2024, 1, 21)), (3, D(2024, 1, 22)), (9, None)], DAYS), "metric_date", "2024-01-01")
    assert _rows(table.read()) == sorted([(1, D(2024, 1, 20)), (2, D(2024, 1, 21)), (3, D(2024, 1, 22))], key=str)
    before = _rows(table.read())
    new = df([(20, D(2024, 1, 21))], DAYS)

    def stop(*a):
        raise KeyboardInterrupt("stopped after the data is written, before the manifest")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            table.replace_window(new, "metric_date", "2024-01-21")
    assert _rows(table.read()) == before
    # a manifest left half written is no commit either, and the next one goes past it
    out = table._fs.create(table._hadoop_path(f"{table.path}/manifests/{2:012d}.json"), False)
    out.write(bytearray(b'{"version": 2, "par'))
    out.close()
    assert _rows(table.read()) == before
    for _ in range(2):
        table.replace_window(new, "metric_date", "2024-01-21")
        assert _rows(table.read()) == [(1, D(2024, 1, 20)), (20, D(2024, 1, 21))]
    assert _rows(table.read(1)) == before


def test_rows_without_a_date_stay(spark, df, table):
    table.replace(df([(9, None)], DAYS))
    kept = VersionedTable(spark, table.path + "2")
    kept.replace_window(df([], DAYS), "metric_date", "2024-01-01")
    assert kept.read().count() == 0 and kept.read().columns == ["v", "metric_date"]


def test_two_writers_cannot_commit_one_version(spark, df, table, monkeypatch):
    table.replace(df([(1, None)], DAYS))
    names = table._names
    other = VersionedTable(spark, table.path)
    seen = names("manifests")
    other.append(df([(2, None)], DAYS))
    monkeypatch.setattr(table, "_names", lambda folder: seen if folder == "manifests" else names(folder))
    with pytest.raises(ConcurrentCommit):
        table.replace(df([(3, None)], DAYS))
    assert _rows(other.read()) == [(1, None), (2, None)]


def test_vacuum_keeps_the_newest_versions(spark, df, table):
    for i in range(4):
        table.replace(df([(i, None)], DAYS))
    table.vacuum(keep=2)
    assert _rows(table.read()) == [(3, None)] and _rows(table.read(3)) == [(2, None)]
    assert len(table._names("data")) == 2 and table.manifest(1) is None


EVENTS = "event_id long, user_id long, event_type string, event_source string, event_ts timestamp_ntz"
BILLS = "user_id long, reference_event_id long, plan_id long, amount_cents long, currency string, transaction_status string"
NOW = "2024-02-01 00:00:00"


def _staging(events, bills):
    return _rows(bronze.subscription_staging(events, bills, NOW))


def test_history_follows_new_late_corrected_and_withdrawn_rows(spark, df, tmp_path):
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    kinds = ["subscription_created", "subscription_upgraded", "subscription_renewed", "subscription_cancelled"]
    base = [(u * 10 + k, u, kinds[k], "user", t(1 + k * 3 + u % 3)) for u in range(1, 9) for k in range(3)]
    bills = [(u, e, e % 5, 100 + e, "USD", "completed") for e, u, *_ in base]
    h = PeriodHistory(spark, f"file://{tmp_path}/h")
    assert h.update(df(base, EVENTS), df(bills, BILLS)) == 8
    assert _rows(h.staging(NOW)) == _staging(df(base, EVENTS), df(bills, BILLS))
    files = set(h.table._names("data"))
    assert h.update(df(base, EVENTS), df(bills, BILLS)) == 0 and set(h.table._names("data")) == files

    base.append((99, 1, "subscription_cancelled", "user", t(20)))            # new
    base.append((98, 2, "subscription_upgraded", "api", t(2, 5)))             # late, between stored ones
    bills += [(1, 99, 3, 5, "USD", "completed"), (2, 98, 4, 6, "EUR", "completed")]
    bills[6] = (*bills[6][:3], 777, *bills[6][4:])                            # a corrected amount of user 3
    base = [r for r in base if r[1] != 4]                                     # withdrawn
    assert {r.user_id for r in h.changed(df(base, EVENTS), df(bills, BILLS)).collect()} == {1, 2, 3, 4}
    assert h.update(df(base, EVENTS), df(bills, BILLS)) == 4
    assert _rows(h.staging(NOW)) == _staging(df(base, EVENTS), df(bills, BILLS))
    assert files < set(h.table._names("data"))                                # earlier files are as they were
    new = h.table.read(segments=True).filter(~F.col(versions.SEGMENT).isin([f.split("=")[1] for f in files]))
    assert {r.user_id for r in new.select("user_id").distinct().collect()} == {1, 2, 3, 4}
    h.compact()
    assert _rows(h.staging(NOW)) == _staging(df(base, EVENTS), df(bills, BILLS))
    # a user who comes back, after all segments became one
    base.append((97, 4, "subscription_created", "user", t(25)))
    bills.append((4, 97, 1, 1, "USD", "completed"))
    assert h.update(df(base, EVENTS), df(bills, BILLS)) == 1
    assert _rows(h.staging(NOW)) == _staging(df(base, EVENTS), df(bills, BILLS))


def test_categories_are_appended_or_replaced_by_delete_flag(spark, df, table):
    dic = [("fruit", ["apple", "pear"])]
    first = [(1, "an apple"), (2, "nothing"), (3, "12"), (None, "pear"), (4, None)]
    got = text.categorize_into(table, df(first, "id long, title string"), dic, "t", delete_flag=False)
    assert _rows(got.select("id", "category")) == sorted([(1, "fruit"), (2, "uncategorized"), (None, "fruit")], key=str)
    files = set(table._names("data"))
    second = [*first, (5, "pear tree"), (1, "an apple, changed")]
    got = text.categorize_into(table, df(second, "id long, title string"), dic, "t", delete_flag=False)
    assert got.count() == 5 and files < set(table._names("data"))
    added = table.read(segments=True).filter(~F.col(versions.SEGMENT).isin([f.split("=")[1] for f in files]))
    assert sorted(r.title for r in added.collect()) == ["an apple, changed", "pear tree"]
    got = text.categorize_into(table, df(second[:1], "id long, title string"), dic, "t", delete_flag=True)
    assert [tuple(r)[:2] for r in got.collect()] == [(1, "an apple")]
