"""Conversion pipeline on hand-made rows (FIXTURES.md edge rows)."""

from tabflow.operators.checks import run_checks, unique
from tabflow.plans import conversion as C

EV = "user_session string, user_id long, event_type string"
US = "user_id long, customer_segment string"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_session_conversion_edges(spark):
    events = spark.createDataFrame(
        [
            (None, 1, "purchase"),  # null session: dropped
            ("a", 1, None),  # null event type: 0
            ("b", 1, "view"),
            ("b", 2, "purchase"),  # two users: max id, converted
        ],
        EV,
    )
    got = sorted(rows(C.session_conversion(events)))
    assert got == [("a", 1, 0), ("b", 2, 1)]
    assert C.session_conversion(events).schema["converted"].dataType.simpleString() == "int"


def test_conversion_by_segment_drops_unknown_and_null(spark):
    sessions = spark.createDataFrame(
        [("s1", 1, 1), ("s2", 1, 0), ("s3", 2, 0), ("s4", 3, 1), ("s5", None, 1)],
        "user_session string, user_id long, converted int",
    )
    users = spark.createDataFrame([(1, "high"), (2, None), (4, "low")], US)
    got = rows(C.conversion_by_segment(sessions, users))
    assert got == [("high", 2, 1, 0.5)]


def test_duplicate_user_matches_row_level_join(spark):
    # a repeated user id multiplies rows in SQL; the per-user pre-aggregation
    # must give the same counts, and the uniqueness check must flag it
    sessions = spark.createDataFrame(
        [("s1", 1, 1), ("s2", 1, 0), ("s3", 2, 1)], "user_session string, user_id long, converted int"
    )
    users = spark.createDataFrame([(1, "high"), (1, "low"), (2, "high")], US)
    got = {r[0]: r[1:] for r in rows(C.conversion_by_segment(sessions, users))}
    sessions.createOrReplaceTempView("s")
    users.createOrReplaceTempView("u")
    sql = spark.sql(
        "SELECT u.customer_segment, COUNT(*) AS t, SUM(s.converted) AS c FROM s JOIN u ON s.user_id = u.user_id"
        " WHERE u.customer_segment IS NOT NULL GROUP BY u.customer_segment"
    )
    want = {r[0]: (r[1], r[2]) for r in sql.collect()}
    assert {k: v[:2] for k, v in got.items()} == want
    check = run_checks(users, [unique("user_id")]).collect()[0]
    assert check["violations"] == 1 and not check["passed"]


def test_rounding_tie_in_rate(spark):
    sessions = spark.createDataFrame(
        [(f"s{i}", 1, 1 if i < 57 else 0) for i in range(800)],
        "user_session string, user_id long, converted int",
    )
    users = spark.createDataFrame([(1, "high")], US)
    assert rows(C.conversion_by_segment(sessions, users))[0][3] == 0.0712


def _by_segment(spark, data):
    return spark.createDataFrame(
        data, "customer_segment string, total_sessions long, converting_sessions long, conversion_rate double"
    )


def test_kpis_and_best_segment_tie(spark):
    seg = _by_segment(spark, [("low", 10, 5, 0.5), ("high", 4, 2, 0.5), ("medium", 10, 1, 0.1)])
    k = C.conversion_kpis(seg).collect()[0]
    assert (k["total_sessions"], k["converting_sessions"]) == (24, 8)
    assert k["overall_rate"] == 8 / 24
    assert k["best_segment"] == "high"  # T8: tie goes to the earlier segment
    assert C.best_segment(seg).collect()[0]["customer_segment"] == "high"


def test_zero_sessions(spark):
    empty = _by_segment(spark, [])
    k = C.conversion_kpis(empty).collect()[0]
    assert (k["total_sessions"], k["converting_sessions"], k["overall_rate"]) == (0, 0, 0.0)
    res = {(r["check"], r["column"]): r["passed"] for r in run_checks(empty, C.conversion_checks()).collect()}
    assert res.pop(("not_empty", "")) is False
    assert all(res.values())


def test_checks_catch_bad_rows(spark):
    bad = _by_segment(
        spark,
        [("high", 1, 2, 2.0), ("vip", 3, 1, float("nan")), ("low", 3, 1, None), (None, 2, 1, 0.5)],
    )
    res = {(r["check"], r["column"]): r["violations"] for r in run_checks(bad, C.conversion_checks()).collect()}
    assert res[("counts_valid", "total_sessions,converting_sessions")] == 1  # conversions above totals
    assert res[("in_range", "conversion_rate")] == 2  # 2.0 and NaN; null is not a violation
    assert res[("no_nulls", "conversion_rate")] == 1
    assert res[("accepted_values", "customer_segment")] == 1  # vip; null is ignored here
    assert res[("no_nulls", "customer_segment")] == 1


def test_segment_report_order_and_text(spark):
    seg = _by_segment(
        spark, [("low", 1200, 30, 0.025), ("gold", 5, 1, 0.2), ("high", 1337, 509, 0.3807), ("medium", 9, 3, 0.3333)]
    )
    rep = C.segment_report(seg).collect()
    assert [r["customer_segment"] for r in rep] == ["high", "medium", "low", "gold"]
    assert (rep[0]["sessions_text"], rep[0]["conversion_rate_text"]) == ("1,337", "38.07%")
    shown = C.display_names(C.segment_report(seg))
    assert shown.columns == ["Segment", "Sessions", "Conversions", "Conv. rate"]


def test_sessions_grouped_once_per_key(spark):
    # the plan aggregates partially before each shuffle
    events = spark.createDataFrame([("a", 1, "view")], EV)
    sessions = C.session_conversion(events)
    users = spark.createDataFrame([(1, "high")], US)
    plan = C.conversion_by_segment(sessions, users)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 4
