from datetime import datetime

from pyspark.sql import functions as F

from medallion.functions.casts import (
    canonical_json, content_hash, to_bigint, to_boolean, to_double, to_number, to_timestamp_ntz,
)
from medallion.operators.flatten import (
    accepted_pages, flag_reviews, flatten_reviews, page_errors, record_dump, rejected_pages,
    rejected_records, split_page_elements, valid_records, validate_records,
)
from medallion.operators.ledger import page_stop_states
from medallion.operators.quarantine import (
    clean_player_rows, clean_review_rows, player_quarantine, review_quarantine,
)
from medallion.sources.pages import to_landing
from tests.fixture_pages import page, review, rule_pages

NOW = "2026-03-01 00:00:00"


def landing(spark, pages):
    return to_landing(spark.createDataFrame([(p,) for p in pages], "raw_data string"), NOW)


def test_each_rule_alone(spark):
    pages = rule_pages()
    rows = [(reason, text) for reason, text in pages.items()]
    assert len(rows) == 28
    for_page = spark.createDataFrame(rows, "expected string, raw_data string")
    at = F.lit(NOW).cast("timestamp_ntz")
    flagged = flag_reviews(flatten_reviews(for_page.select("raw_data", at.alias("ingested_at"))))
    reasons = flagged.select(F.concat(
        "review_failure_reasons", "review_player_failure_reasons").alias("reasons"))
    found = sorted(",".join(r["reasons"]) for r in reasons.collect())
    assert found == sorted(pages)
    assert clean_review_rows(flagged).count() == 9
    assert review_quarantine(flagged).count() == 19
    assert clean_player_rows(flagged).count() == 20
    assert player_quarantine(flagged).count() == 8


def test_row_broken_in_both_grains_is_in_both_quarantines(spark):
    both = page([review(voted_up="maybe", author={"last_played": "yesterday"})])
    flagged = flag_reviews(flatten_reviews(landing(spark, [both])))
    assert review_quarantine(flagged).first()["voted_positive"] == "maybe"
    assert player_quarantine(flagged).first()["author_last_played"] == "yesterday"


def test_missing_update_time_breaks_no_rule(spark):
    flagged = flag_reviews(flatten_reviews(landing(spark, [page([review(timestamp_updated=...)])])))
    row = flagged.first()
    assert row["timestamp_updated"] is None and row["review_failure_reasons"] == []


def test_flatten_defaults_and_shapes(spark):
    rows = flatten_reviews(landing(spark, [page([review(), review(review="é漢")]), page([])])).collect()
    assert len(rows) == 2
    assert {r["review"] for r in rows} == {"solid", "é漢"}
    assert {r["author_deck_playtime_at_review"] for r in rows} == {"0"}
    assert {r["app_id"] for r in rows} == {"730"}
    assert {r["votes_up"] for r in rows} == {"4"}


def cast_all(spark, cast, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in rows.select("i", cast(F.col("t")).alias("v")).orderBy("i").collect()]


def test_number_text(spark):
    texts = ["12", "12.7", "-12.5", "1e3", " 7 ", "+5", "", "abc", "12abc", None,
             "99999999999999999999"]
    assert cast_all(spark, to_bigint, texts) == [12, 13, -13, 1000, 7, 5, None, None, None, None,
                                                 None]
    assert [str(v) for v in cast_all(spark, to_number, ["2", "1.5", "x"])] == ["2", "2", "None"]


def test_double_text(spark):
    values = cast_all(spark, to_double, ["0.52", "1e-3", "1d", "2f", "0x1p3", "inf", "nan", "x", ""])
    assert values[:6] == [0.52, 0.001, None, None, None, float("inf")]
    assert values[6] != values[6] and values[7:] == [None, None]


def test_boolean_text(spark):
    true, false = ["true", "T", "yes", "Y", "on", "1"], ["false", "F", "no", "N", "OFF", "0"]
    assert cast_all(spark, to_boolean, true) == [True] * 6
    assert cast_all(spark, to_boolean, false) == [False] * 6
    assert cast_all(spark, to_boolean, ["maybe", "", "2", None]) == [None] * 4


def test_timestamp_text(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["1700000000", "1700000000000", "1700000000000000", "1700000000000000000",
                 "2023-11-14 22:13:20", "2023-11-14T22:13:20", "2023-11-14", "yesterday", "", "12:30",
                 "-99999999999999999", "-1"]
        at = datetime(2023, 11, 14, 22, 13, 20)
        values = cast_all(spark, to_timestamp_ntz, texts)
        assert values[:6] == [at] * 6
        assert values[6] == datetime(2023, 11, 14)
        assert values[7:11] == [None] * 4
        assert values[11] == datetime(1969, 12, 31, 23, 59, 59)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_canonical_json(spark):
    same = ['{"a":1,"b":[2.50]}', '{"b": [2.5], "a": 1}']
    assert len(set(cast_all(spark, canonical_json, same))) == 1
    assert len(set(cast_all(spark, content_hash, same))) == 1
    assert cast_all(spark, canonical_json, ["[bad", "", None]) == [None] * 3


def test_pages_are_rejected_whole(spark):
    pages = [page([review()]), page([review(), review(votes_up="many")], cursor="c2"),
             page([review()], app_id=None), page([], cursor="c4"), "{broken"]
    checked = page_errors(landing(spark, pages))
    assert accepted_pages(checked).count() == 2
    errors = sorted(",".join(r["page_errors"]) for r in rejected_pages(checked).collect())
    assert errors == ["app_id", "reviews", "success,num_reviews,cursor,app_id,reviews"]


def test_record_validation(spark):
    rows = [review(), review(votes_up="4"), review(votes_up=4.5), review(reactions="x"),
            review(author={"steamid": ...})]
    checked = validate_records(split_page_elements(landing(spark, [page(rows)])))
    assert valid_records(checked).count() == 2
    errors = sorted(r["record_errors"][0] for r in rejected_records(checked).collect())
    assert errors == ["author.steamid", "reactions", "votes_up"]


def test_dump_has_equality_classes(spark):
    """Key order, number text and unknown fields do not make another dump; play time does."""
    base = review()
    turned = dict(reversed(list(review(votes_up="4", unknown="x").items())))
    played = review(author={"playtime_forever": 601})
    checked = validate_records(split_page_elements(landing(spark, [page([base, turned, played])])))
    dumps = [r["d"] for r in valid_records(checked).select(
        record_dump(F.col("record")).alias("d")).collect()]
    assert dumps[0] == dumps[1] != dumps[2]
    assert "developer_response" not in dumps[0]


def test_stop_states(spark):
    pages = [page([], total_reviews=0), page([], total_reviews=10), page([]),
             page([review()], total_reviews=10)]
    states = [r["state"] for r in page_stop_states(landing(spark, pages)).collect()]
    assert states == ["skipped_no_reviews", "empty_page", "skipped_no_reviews", "success"]
    strict = page_stop_states(landing(spark, pages), total_missing_is_zero=False).collect()
    assert strict[2]["state"] == "empty_page"
