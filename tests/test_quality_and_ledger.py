from datetime import datetime

import pytest
from pyspark.sql import functions as F

from medallion.operators import quality as Q
from medallion.operators.integrity import (
    cascade_delete, missing_rows, orphans, restricting_children, set_null_delete,
)
from medallion.operators.ledger import (
    backfill_state, last_success_cursors, latest_run_state, start_cursors, state_cursors,
    upsert_cursors,
)
from medallion.operators.selection import SelectionError, check_request, resume_point, select_reviews
from medallion.plans.suites import SUITES
from medallion.schemas import CURSOR_SCHEMA, LEDGER_SCHEMA, VALIDITY, silver_schema, PLAYER_ROW, REVIEW_ROW

NOW = datetime(2026, 6, 1)


def at(hour, minute=0):
    return datetime(2026, 1, 1, hour, minute)


def test_declared_counts(spark):
    sizes = {name: len(suite(NOW)) for name, suite in SUITES.items()}
    assert sizes == {"reviews_scd1": 53, "reviews_scd2": 59, "players_scd1": 30,
                     "players_scd2": 36}


def test_suites_run_on_empty_tables(spark):
    reviews = spark.createDataFrame([], silver_schema([*REVIEW_ROW, *VALIDITY]))
    players = spark.createDataFrame([], silver_schema([*PLAYER_ROW, *VALIDITY]))
    for name, rows in (("reviews_scd2", reviews), ("players_scd2", players)):
        report = Q.run_suite(name, rows, SUITES[name](NOW), {"reviews_scd2": reviews})
        found = report.collect()
        assert len(found) == len(SUITES[name](NOW))
        assert {r["status"] for r in found} == {"pass"}


def test_starter_model_fails_as_intended(spark):
    rows = spark.createDataFrame([(1,), (None,)], "id int")
    report = Q.run_suite("starter", rows, [Q.UniqueTest("id"), Q.t_not_null("id")])
    assert {(r["test_name"], r["failures"]) for r in report.collect()} == {
        ("unique", 0), ("not_null", 1)}


def test_bad_reactions_and_count_in_the_suite_agree(spark):
    texts = ['[]', '[{"count":2,"reaction_type":31}]', '[{"count":"x","reaction_type":1}]',
             '[{"count":1}]', '[1,null]', '{"a":1}', 'oops', None, '[{"count":"2.5","reaction_type":"3"}]']
    rows = spark.createDataFrame([(t,) for t in texts], "reactions string")
    assert Q.bad_reactions(rows, "reactions").count() == 4
    report = Q.run_suite("t", rows, [Q.t_reactions("reactions")]).first()
    assert report["failures"] == 4


def test_joined_test_counts_pairs_without_making_them(spark):
    players = spark.createDataFrame(
        [("r1", datetime(2010, 1, 1))] * 3 + [("r1", datetime(2020, 1, 1)), ("r2", None)],
        "review_id string, played timestamp_ntz")
    reviews = spark.createDataFrame([("r1", "730")] * 4 + [("r1", "x"), ("r2", "730")],
                                    "review_id string, app_id string")
    failed = Q.joined_date_before(players, reviews, "review_id", "app_id", 730, "played",
                                  F.lit(datetime(2012, 8, 21)).cast("timestamp_ntz"))
    assert failed.agg(F.sum("n_matches")).first()[0] == 12 and failed.count() == 3


@pytest.mark.parametrize("age,status", [(59, "pass"), (61, "warn"), (179, "warn"), (181, "error")])
def test_freshness(spark, age, status):
    rows = spark.createDataFrame([(at(3),)], "loaded timestamp_ntz")
    now = F.lit(at(3)).cast("timestamp_ntz") + F.expr(f"interval {age} minutes")
    assert Q.freshness(rows, "loaded", now).first()["status"] == status
    assert Q.freshness(rows.where("false"), "loaded", now).first()["status"] == "error"


def test_run_ledger(spark):
    events = spark.createDataFrame([
        ("a", 7, "start", "c0", None, at(0), None, None),
        ("a", 7, "progress", "c1", 10, at(0, 1), None, None),
        ("a", 7, "progress", "c2", 5, at(0, 2), None, None),
        ("a", 7, "success", "c2", None, at(0, 3), None, None),
        ("b", 7, "start", "c2", None, at(1), None, None),
        ("b", 7, "failed", None, None, at(1, 1), "STEAM_HTTP", "down"),
        ("c", 8, "start", "*", None, at(1), None, None),
        ("c", 8, "skipped", "*", 0, at(1, 1), None, None),
        ("d", 9, "start", "*", None, at(1), None, None),
    ], LEDGER_SCHEMA)
    runs = {r["run_id"]: r for r in latest_run_state(events).collect()}
    assert runs["a"]["status"] == "success" and runs["a"]["rows_fetched"] == 15
    assert runs["a"]["last_success_cursor"] == "c2" and runs["a"]["finished_at"] == at(0, 3)
    assert (runs["b"]["status"], runs["b"]["error_type"]) == ("failed", "STEAM_HTTP")
    assert runs["b"]["end_cursor"] is None
    assert runs["c"]["status"] == "skipped_no_reviews" and runs["c"]["end_cursor"] == "*"
    assert runs["c"]["last_success_cursor"] is None
    assert runs["d"]["status"] == "running" and runs["d"]["finished_at"] is None
    state = latest_run_state(events)
    apps = spark.createDataFrame([(7,), (8,), (9,)], "app_id bigint")
    def cursors(now):
        return {r["app_id"]: r["start_cursor"] for r in start_cursors(apps, state, now).collect()}
    assert cursors("2026-01-01 01:03:00") == {7: "c2", 8: "*", 9: "*"}
    assert cursors("2026-01-01 01:03:01") == {7: "*", 8: "*", 9: "*"}
    assert last_success_cursors(state).count() == 1
    bronze = spark.createDataFrame([("7", "1767225600"), ("7", "1767225500")],
                                   "app_id string, timestamp_created string")
    filled = {r["app_id"]: r for r in backfill_state(state, bronze, events).collect()}
    assert (filled[7]["status"], filled[7]["consecutive_failures"]) == ("failed", 1)
    assert (filled[7]["pages_completed"], filled[7]["last_cursor"]) == (2, "c2")
    assert filled[8]["status"] == "complete" and filled[9]["status"] == "not_started"


def test_cursor_state(spark):
    empty = spark.createDataFrame([], CURSOR_SCHEMA)
    one = spark.createDataFrame([(7, "c1", at(0), "SUCCESS"), (7, "c2", at(1), "SUCCESS")],
                                CURSOR_SCHEMA)
    state = upsert_cursors(empty, one)
    assert state.collect()[0]["last_cursor"] == "c2"
    apps = spark.createDataFrame([(7,), (8,)], "app_id bigint")
    assert {r["app_id"]: r["start_cursor"] for r in state_cursors(apps, state).collect()} == {
        7: "c2", 8: "*"}


def test_referential_actions(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    children = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", 9)], "c string, p int")
    pair, gone = {"p": "id"}, spark.createDataFrame([(1,)], "id int")
    assert [r["c"] for r in orphans(children, parents, pair).collect()] == ["d"]
    assert sorted(r["c"] for r in cascade_delete(children, gone, pair).collect()) == ["b", "c", "d"]
    assert restricting_children(children, gone, pair).first()["n_children"] == 1
    nulled = {r["c"]: r["p"] for r in set_null_delete(children, gone, pair).collect()}
    assert nulled == {"a": None, "b": 2, "c": None, "d": 9}
    assert missing_rows(spark.createDataFrame([(1,), (5,)], "id int"), parents, ["id"]).collect()[0][0] == 5


def test_options_outside_their_domain_are_refused(spark):
    rows = spark.createDataFrame([], "language string, voted_up string, steam_purchase string")
    with pytest.raises(SelectionError):
        select_reviews(rows, language="klingon")
    with pytest.raises(SelectionError):
        check_request(730, 101)
    check_request(730, 100)


def test_resume_point(spark):
    rows = spark.createDataFrame([(1,), (4,), (9,)], "raw_id bigint")
    state = spark.createDataFrame([("mid", 3), ("done", 9)],
                                  "pipeline_name string, last_raw_id_processed bigint")
    found = [resume_point(rows, state, "raw_id", p).first()["resume_id"]
             for p in ("mid", "done", "new")]
    assert found == [4, -1, 1]
