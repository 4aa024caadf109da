"""Quality rules, text, cohorts, window replace, sinks, sheet load, plan shape."""

import datetime as dt
import json

import pytest

from tally.operators.replace import replace_window
from tally.plans import cohorts, quality, text
from tally.sinks.tables import replace_window_table, write_table
from tally.sources.dictionaries import load_dictionaries
from tally.sources.sheets import load_sheet_csv
from tally.operators.periods import explode_days

T = dt.datetime
D = dt.date
NOW = T(2024, 1, 31)


# --- V1-V7 -------------------------------------------------------------------

def _res(df, rules):
    return [(r["rule"], r["passed"], r["detail"]) for r in
            quality.check(df, "t", rules, NOW).collect()]


def test_rules_on_empty_table(df):
    e = df([], "a long, ts timestamp_ntz")
    res = _res(e, [{"type": "not_empty"}, {"type": "row_count_range"},
                   {"type": "freshness", "column": "ts"}])
    assert res[0] == ("not_empty", False, "row_count=0")
    assert res[1] == ("row_count_range", True, "row_count=0 expected=[0, inf]")
    assert res[2][1] is False and res[2][2].startswith("latest=NULL")


def test_unique_counts_null_rows_and_bounds(df):
    d = df([(1, None), (2, None), (3, 3)], "a long, b long")
    res = _res(d, [{"type": "unique", "column": "b"}, {"type": "unique", "column": "a"},
                   {"type": "no_nulls", "column": "b"},
                   {"type": "row_count_range", "min": 3, "max": 3},
                   {"type": "unique_key", "columns": ["b"]}])
    assert res[0] == ("unique", False, "duplicates(b)=2")   # 3 rows - 1 distinct non-NULL
    assert res[1][1] is True
    assert res[2] == ("no_nulls", False, "null_count(b)=2")
    assert res[3][1] is True                                # bounds inclusive
    assert res[4] == ("unique_key", False, "duplicate_keys(b)=1")   # NULLs group together


def test_freshness_exactly_at_cutoff(df):
    d = df([(T(2024, 1, 29),)], "ts timestamp_ntz")
    assert _res(d, [{"type": "freshness", "column": "ts"}])[0][1] is True
    d2 = df([(T(2024, 1, 28, 23, 59, 59),)], "ts timestamp_ntz")
    assert _res(d2, [{"type": "freshness", "column": "ts"}])[0][1] is False


def test_validate_order_of_errors(df):
    d = df([(1,)], "a long")
    with pytest.raises(ValueError):
        quality.validate(d, "t", [{"type": "not_empty"}, {"type": "bogus"}], NOW)
    with pytest.raises(quality.DataQualityError):
        quality.validate(d, "t", [{"type": "row_count_range", "min": 5}, {"type": "bogus"}], NOW)
    ok = quality.validate(d, "t", [{"type": "not_empty"},
                                   {"type": "expression", "condition": "a < 0"}], NOW)
    assert [r["rule"] for r in ok] == ["not_empty", "expression"]


def test_check_is_one_aggregation(df):
    d = df([(1, 2)], "a long, b long")
    res = quality.check(d, "t", [{"type": "not_empty"}, {"type": "no_nulls", "column": "a"},
                                 {"type": "unique", "column": "b"}], NOW)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 or plan.count("Scan") == 1


# --- T1-T3, J11 --------------------------------------------------------------

DICT = [("motion", ["from", "with"]), ("quality", ["tion"]), ("people", ["ther"])]


def test_categorize_edges(df):
    d = df([(1, None), (2, ""), (3, "123 4 5"), (4, "a b From with from"),
            (5, "ther tion x"), (6, "nothing here")], "id long, title string")
    out = {r["id"]: r for r in text.categorize_text(d, DICT, "review").collect()}
    assert set(out) == {4, 5, 6}                     # NULL, empty, digits only dropped
    assert out[4]["nouns"] == "from,with,from"        # order and repeats kept, 1-letter out
    assert out[4]["category"] == "motion"
    assert out[5]["category"] == "quality,people"     # dictionary order
    assert out[6]["category"] == "uncategorized"
    plan = text.categorize_text(d, DICT, "review")._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "Exchange" not in plan


def test_large_dictionary_equal_and_null_ids(df):
    many = [(f"c{i}", [f"word{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100]}"]) for i in range(700)]
    d = df([(1, "from here"), (1, "ther there"), (None, "FROM x")], "id long, title string")
    rows = text.categorize_text(d, many + [("motion", ["From"]), ("people", ["ther"])], "x").collect()
    assert {(r["id"], r["title"], r["category"]) for r in rows} == {
        (1, "from here", "motion"), (1, "ther there", "people"), (None, "FROM x", "motion")}


def test_broken_dictionary_fails(spark, tmp_path):
    p = tmp_path / "cut.json"
    p.write_text('{"a": ["x"')
    with pytest.raises(Exception):
        load_dictionaries(spark, [str(p)])


def test_sheet_quotes_and_line_breaks(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text('plan_id,plan_name\n1,"The ""Pro"" plan"\n2,"two\nlines"\n')
    rows = {r["plan_id"]: r["plan_name"] for r in load_sheet_csv(spark, str(p), "plan_id long, plan_name string").collect()}
    assert rows == {1: 'The "Pro" plan', 2: "two\nlines"}


def test_reversed_periods(df):
    per = df([(1, dt.date(2024, 1, 10), dt.date(2024, 1, 5))], "k int, s date, e date")
    assert explode_days(per, "s", "e", "2024-01-01", "2024-01-31").count() == 0


def test_dictionary_merge(spark, tmp_path):
    p1, p2 = tmp_path / "a.json", tmp_path / "b.json"
    p1.write_text(json.dumps({"x": ["a"], "y": ["b"]}))
    p2.write_text(json.dumps({"z": ["c"], "x": ["d", "e"]}))
    merged = load_dictionaries(spark, [str(p1), str(p2)])
    assert merged == [("x", ["d", "e"]), ("y", ["b"]), ("z", ["c"])]


# --- N4, N6 ------------------------------------------------------------------

OP = "user_id long, plan_id long, period_start timestamp_ntz, period_end timestamp_ntz, mrr_cents long"


def test_merged_periods(df):
    rows = [(1, 1, T(2024, 1, 1), T(2024, 1, 31), 5),     # contains the next one
            (1, 1, T(2024, 1, 5), T(2024, 1, 10), 5),
            (1, 1, T(2024, 1, 31), T(2024, 2, 10), 5),    # touching -> merged
            (1, 1, T(2024, 1, 31), T(2024, 2, 10), 5),    # exact duplicate
            (1, 1, T(2024, 3, 1), T(2024, 3, 2), 5),      # disjoint
            (1, 2, T(2024, 1, 1), T(2024, 1, 2), 5)]
    out = sorted(tuple(r) for r in cohorts.merged_periods(df(rows, OP)).collect())
    assert out == [(1, 1, 1, T(2024, 1, 1), T(2024, 2, 10), 3),
                   (1, 1, 2, T(2024, 3, 1), T(2024, 3, 2), 1),
                   (1, 2, 1, T(2024, 1, 1), T(2024, 1, 2), 1)]


def test_retention_year_end_and_single_month(df):
    per = df([(1, 1, T(2023, 12, 20), T(2024, 1, 19), 10),
              (2, 1, T(2023, 12, 1), T(2023, 12, 31), 0)], OP)
    coh = cohorts.cohort_base(per)
    out = sorted(tuple(r) for r in cohorts.retention_matrix(per, coh).collect())
    assert out == [(D(2023, 12, 1), 0, 2, 2, 1.0), (D(2023, 12, 1), 1, 1, 2, 0.5)]
    rev = sorted(tuple(r) for r in cohorts.revenue_by_cohort(per, coh).collect())
    assert rev == [(D(2023, 12, 1), D(2023, 12, 1), 0, 10, 1)]


# --- R16, sinks, J12 ---------------------------------------------------------

MET = "metric_date date, v long"


def test_replace_window_idempotent(df):
    old = df([(D(2024, 1, 1), 1), (D(2024, 1, 20), 2), (D(2024, 1, 21), 3), (None, 9)], MET)
    new = df([(D(2024, 1, 21), 30), (D(2024, 1, 22), 40)], MET)
    once = replace_window(old, new, "metric_date", "2024-01-21")
    twice = replace_window(once, new, "metric_date", "2024-01-21")
    expect = [(None, 9), (D(2024, 1, 1), 1), (D(2024, 1, 20), 2), (D(2024, 1, 21), 30),
              (D(2024, 1, 22), 40)]
    key = lambda r: (r[0] is not None, r[0] or D(1, 1, 1))
    assert sorted(map(tuple, once.collect()), key=key) == expect
    assert sorted(map(tuple, twice.collect()), key=key) == expect
    empty = replace_window(old, df([], MET), "metric_date", "2024-01-21")
    assert sorted(map(tuple, empty.collect()), key=key) == expect[:3]


def test_replace_window_table_clears_stale_partitions(spark, df):
    name = "tally_test_window"
    replace_window_table(spark, name, df([(1, D(2024, 1, 20)), (2, D(2024, 1, 21)),
                                          (3, D(2024, 1, 22))], "v long, metric_date date"),
                         "metric_date", "2024-01-01")
    new = df([(20, D(2024, 1, 21))], "v long, metric_date date")
    for _ in range(2):
        table = replace_window_table(spark, name, new, "metric_date", "2024-01-21")
        got = sorted((r["metric_date"], r["v"]) for r in table.read().collect())
        assert got == [(D(2024, 1, 20), 1), (D(2024, 1, 21), 20)]


def test_write_table_modes(spark, df):
    name = "tally_test_modes"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert write_table(df([], "a long"), name, "append") is False     # empty: no-op
    assert not spark.catalog.tableExists(name)
    assert write_table(df([(1,)], "a long"), name, "append")
    write_table(df([(2,)], "a long"), name, "append")
    assert spark.table(name).count() == 2
    write_table(df([(3,)], "a long"), name, "replace")
    assert [r[0] for r in spark.table(name).collect()] == [3]
    with pytest.raises(Exception):
        write_table(df([(4,)], "a long"), name, "fail")
    with pytest.raises(ValueError):
        write_table(df([(4,)], "a long"), name, "upsert")


def test_load_sheet_csv(spark, tmp_path):
    p = tmp_path / "plan_master.csv"
    p.write_text("plan_id,plan_name,max_seats,extra\n1,Basic,3,x\n2,Pro,,y\n")
    out = load_sheet_csv(spark, str(p), "plan_id long, plan_name string, max_seats int, "
                                        "plan_tier string")
    assert [tuple(r) for r in out.orderBy("plan_id").collect()] == \
        [(1, "Basic", 3, None), (2, "Pro", None, None)]


def test_event_log_lookback_reaches_scan(spark):
    from tally.catalog import Pipeline
    p = Pipeline(spark, "/root/testdata/sf0.001")
    plan = p.event_log._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "DataFilters" in plan
    assert "unix_timestamp" in plan


def test_tokenizer_hook_pandas_udf(df):
    import pandas as pd
    from pyspark.sql import functions as F

    @F.pandas_udf("array<string>")
    def words(s: pd.Series) -> pd.Series:
        return s.str.lower().str.split()

    d = df([(1, "From here"), (2, "x y")], "id long, title string")
    out = {r["id"]: r for r in text.categorize_text(d, DICT, "t", tokenizer=words).collect()}
    assert set(out) == {1}                                  # one-letter tokens filtered out
    assert (out[1]["nouns"], out[1]["category"]) == ("from,here", "motion")
