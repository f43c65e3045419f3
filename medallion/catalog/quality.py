"""Quality tests: each alone on the given tables, and the declared suites on the dimensions."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.catalog import Query, table
from medallion.catalog.dims import QUERIES as DIM_QUERIES, dimension, flagged_table
from medallion.catalog.feed import FLAGGED_CTES, bronze_feed
from medallion.catalog.sqltext import ctes
from medallion.operators import quality as Q
from medallion.operators.flatten import type_reviews
from medallion.plans.suites import (
    AUDIT_FROM, CONTENT_FROM, COUNTS, FLAGS, LAUNCH_DATE, LAUNCHED_APP, PLAYER_MINIMA, SUITES,
)
from medallion.schemas import LANGUAGES
from medallion.session import scratch_folder
from medallion.sources.layout import newest_day, write_by_day

NOW = datetime(2026, 6, 1)
LAUNCH = "1996-01-01 00:00:00"


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.not_null(bronze_feed(spark, sf_dir), "language").select("app_id", "review_id")


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_keys(bronze_feed(spark, sf_dir), "review_id")


def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.unaccepted_values(bronze_feed(spark, sf_dir), "language", LANGUAGES)


def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose source is blank; German ones are given a blank source first."""
    rows = table(spark, sf_dir, "documents").withColumn(
        "source", F.when(F.col("lang") == "de", F.lit("  ")).otherwise(F.col("source")))
    return Q.not_empty_string(rows, "source").select("doc_id", "lang")


def dq_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types, dates and keys of the line items; three expectations are wrong on purpose."""
    lines = table(spark, sf_dir, "lineitem")
    tests = [Q.TypeTest("l_orderkey", "number"), Q.TypeTest("l_discount", "float"),
             Q.TypeTest("l_shipdate", "timestamp_ntz"), Q.TypeTest("l_returnflag", "number"),
             Q.TypeTest("l_tax", "boolean"), Q.t_not_null("l_shipdate"), Q.UniqueTest("l_orderkey")]
    return Q.run_suite("lineitem", lines, tests)


def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.outside_between(table(spark, sf_dir, "customer"), "c_acctbal", low=0).select(
        "c_custkey", "c_acctbal")


def dq_within_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.outside_range(table(spark, sf_dir, "orders"), "o_orderdate",
                           _ntz("1996-01-01 00:00:00"), _ntz("1998-12-31 00:00:00")).select(
        "o_orderkey", "o_orderdate")


def dq_no_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped before they were ordered."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return Q.later_than(rows, "o_orderdate", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")


def dq_date_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze_feed(spark, sf_dir)
    return Q.app_date_before(rows, "app_id", LAUNCHED_APP, "ingested_at", _ntz(LAUNCH)).select(
        "app_id", "review_id", "ingested_at")


def dq_cross_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from before the launch, with the number of lines of part 730 they meet."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    lines = table(spark, sf_dir, "lineitem").withColumn("app_id", F.col("l_partkey").cast("string"))
    return Q.joined_date_before(
        orders, lines, "l_orderkey", "app_id", LAUNCHED_APP, "o_orderdate",
        _ntz("1999-01-01 00:00:00")).select("l_orderkey", "o_orderdate", "n_matches")


def dq_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = type_reviews(bronze_feed(spark, sf_dir))
    return Q.bad_reactions(rows, "reactions", ["review_id", "app_id"])


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same newest load seen from three moments."""
    events = table(spark, sf_dir, "events")
    newest = events.agg(F.max("ts").alias("ts"))
    parts = []
    for name, hours in (("soon", "30 minutes"), ("later", "2 hours"), ("late", "4 hours")):
        moved = events.select((F.col("ts") - F.expr(f"interval {hours}")).alias("ts"))
        seen = Q.freshness(moved, "ts", newest.scalar())
        parts.append(seen.select(F.lit(name).alias("seen"), "status"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def freshness_newest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written by day; their newest load, seen from three moments, out of one day's files."""
    folder = scratch_folder(spark, "events")
    write_by_day(table(spark, sf_dir, "events"), folder, "ts", ["event_id"], mode="overwrite")
    rows = newest_day(spark, folder)
    newest = rows.agg(F.max("ts").alias("ts")).scalar()
    parts = [
        Q.freshness(rows, "ts", newest + F.expr(f"interval {hours}")).withColumn("seen", F.lit(name))
        for name, hours in (("soon", "30 minutes"), ("later", "2 hours"), ("late", "4 hours"))]
    return reduce(DataFrame.union, parts).select("seen", "max_loaded_at", "status")


def dq_starter_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The starter tests (unique, not null) on the authors' ids, of which some are missing."""
    rows = bronze_feed(spark, sf_dir).select(F.col("author_steam_id").alias("id"))
    return Q.run_suite("starter", rows, [Q.UniqueTest("id"), Q.t_not_null("id")])


def _written(flagged: DataFrame, name: str) -> DataFrame:
    """A dimension as the written table the tests run on."""
    folder = scratch_folder(flagged.sparkSession, name)
    dimension(flagged, name).write.mode("overwrite").parquet(folder)
    return flagged.sparkSession.read.parquet(folder)


def _suite(name: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        reviews = name.replace("players", "reviews")
        others, flagged = {}, flagged_table(spark, sf_dir, *{name: 0, reviews: 0})
        if name != reviews:
            others[reviews] = _written(flagged, reviews)
        return Q.run_suite(name, _written(flagged, name), SUITES[name](NOW), others)
    return build


def dq_freshness_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four dimensions by the time of their last merge, seen sooner and later after it.

    One flagged table feeds them all, and the moment is counted from the newest load found.
    """
    parts, flagged = [], flagged_table(spark, sf_dir)
    for name, hours in (("reviews_scd1", 0), ("reviews_scd2", 1), ("players_scd1", 2),
                        ("players_scd2", 4)):
        now = F.col("max_loaded_at") + F.expr(f"interval {hours} hours")
        seen = Q.freshness(dimension(flagged, name), "_dlt_updated_at", now)
        parts.append(seen.select(F.lit(name).alias("table_name"), "max_loaded_at", "status"))
    return reduce(DataFrame.union, parts)


def suite_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uniqueness tests of two of three suites, chosen by patterns."""
    tables = {name: table(spark, sf_dir, name) for name in ("orders", "part", "supplier")}
    suites = {
        "orders": [Q.UniqueTest("o_orderkey"), Q.UniqueTest("o_custkey"), Q.t_not_null("o_orderkey")],
        "part": [Q.UniqueTest("p_partkey"), Q.t_not_null("p_name")],
        "supplier": [Q.UniqueTest("s_nationkey"), Q.t_not_null("s_name")],
    }
    return Q.run_selected(tables, suites, table_like="[op]*", test_like="uni*")


_UNIQUE_REPORT = """SELECT '{t}' AS table_name, 'unique' AS test_name, '{c}' AS column_name,
 count(*) AS failures, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status
 FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""

# --- SQL of the suites ----------------------------------------------------------------------


def _t(value: datetime) -> str:
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"


def _null(c: str):
    return ("not_null", c, f"{c} IS NULL")


def _dated(c: str, low: datetime):
    return ("within_range", c, f"{c} < {_t(low)} OR {c} > {_t(NOW)}")


def _amount(c: str, kind: str, low: int):
    return [_null(c), (f"type_{kind}", c, "false"), ("between", c, f"{c} < {low}")]


def _flag(c: str):
    return [_null(c), ("type_boolean", c, "false"), ("accepted_values", c, "false")]


def _moment(c: str, low: datetime):
    return [_null(c), ("type_timestamp_ntz", c, "false"), _dated(c, low)]


def _validity():
    return [*_flag("is_current"), _null("start_timestamp"), _dated("start_timestamp", AUDIT_FROM),
            _dated("end_timestamp", AUDIT_FROM),
            ("valid_start_no_later_than_end", "start_timestamp", "start_timestamp > end_timestamp")]


def _launch(c: str) -> str:
    return f"TRY_CAST(app_id AS BIGINT) = {LAUNCHED_APP} AND {c} < {_t(LAUNCH_DATE)}"


def _review_tests():
    languages = ", ".join(f"'{x}'" for x in LANGUAGES)
    tests = [_null(c) for c in ("app_id", "review_id", "review", "language", "reactions")]
    tests += [("not_empty_string", c, f"trim({c}) = ''") for c in ("app_id", "review_id")]
    tests += [("accepted_values", "language", f"language NOT IN ({languages})"),
              ("valid_reaction", "reactions", "reactions LIKE '%\"x\"%'")]
    for c in COUNTS:
        tests += _amount(c, "number", 0)
    tests += _amount("weighted_vote_score", "float", 0)
    for c in FLAGS:
        tests += _flag(c)
    tests += _moment("ingested_at", AUDIT_FROM)
    tests += _moment("timestamp_created", CONTENT_FROM) + _moment("timestamp_updated", CONTENT_FROM)
    tests += [_dated("timestamp_dev_responded", CONTENT_FROM), _null("_dlt_updated_at"),
              _dated("_dlt_updated_at", AUDIT_FROM)]
    tests += [
        ("updated_no_earlier_than_created", "timestamp_created",
         "timestamp_created > timestamp_updated"),
        ("responded_no_earlier_than_created", "timestamp_created",
         "timestamp_created > timestamp_dev_responded"),
        ("created_not_before_launch", "timestamp_created", _launch("timestamp_created")),
        ("updated_not_before_launch", "timestamp_updated", _launch("timestamp_updated")),
    ]
    return tests


def _player_tests():
    tests = [_null("author_steam_id")]
    for c, low in PLAYER_MINIMA.items():
        tests += _amount(c, "number", low)
    tests += _moment("author_last_played_timestamp", CONTENT_FROM)
    tests += _moment("ingested_at", AUDIT_FROM)
    return [*tests, _null("_dlt_updated_at"), _dated("_dlt_updated_at", AUDIT_FROM)]


_UNIQUE = ("SELECT '{t}', 'unique', 'review_id', count(*) FROM (SELECT review_id FROM dim "
           "WHERE review_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
_JOINED = ("SELECT '{t}', 'last_played_not_before_launch', 'author_last_played_timestamp', "
           "count(*) FROM dim p JOIN other r ON p.review_id = r.review_id WHERE "
           f"TRY_CAST(r.app_id AS BIGINT) = {LAUNCHED_APP} AND "
           f"p.author_last_played_timestamp < {_t(LAUNCH_DATE)}")


def _suite_sql(name: str, tests, *jobs: str) -> str:
    other = f", other AS ({DIM_QUERIES[name.replace('players', 'reviews')].sql})" \
        if name.startswith("players") else ""
    lines = [
        f"SELECT '{name}' AS table_name, '{test}' AS test_name, '{column}' AS column_name, "
        f"count(*) FILTER ({condition}) AS failures FROM dim"
        for test, column, condition in tests
    ]
    lines += [job.format(t=name) for job in jobs]
    return (f"WITH dim AS MATERIALIZED ({DIM_QUERIES[name].sql}){other}, report AS (\n"
            + "\nUNION ALL ".join(lines)
            + "\n) SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM report")


_PART = f"(SELECT l_orderkey, count(*) AS n_matches FROM lineitem WHERE l_partkey = {LAUNCHED_APP} " \
        "GROUP BY 1)"

QUERIES = {
    "dq_freshness_dimensions": Query(dq_freshness_dimensions, "\nUNION ALL ".join(
        f"""SELECT '{name}' AS table_name, max(_dlt_updated_at) AS max_loaded_at, '{status}'
        AS status FROM ({DIM_QUERIES[name].sql})""" for name, status in (
            ("reviews_scd1", "pass"), ("reviews_scd2", "pass"), ("players_scd1", "warn"),
            ("players_scd2", "error")))),
    "suite_selection": Query(suite_selection, "\nUNION ALL ".join(
        _UNIQUE_REPORT.format(t=t, c=c) for t, c in (
            ("orders", "o_orderkey"), ("orders", "o_custkey"), ("part", "p_partkey")))),
    "dq_not_null": Query(dq_not_null, ctes(FLAGGED_CTES[0], final="""SELECT app_id, review_id
        FROM bronze WHERE language IS NULL""")),
    "dq_unique": Query(dq_unique, ctes(FLAGGED_CTES[0], final="""SELECT review_id,
        count(*) AS n_records FROM bronze WHERE review_id IS NOT NULL GROUP BY 1
        HAVING count(*) > 1""")),
    "dq_accepted": Query(dq_accepted, ctes(FLAGGED_CTES[0], final="""SELECT language,
        count(*) AS n_records FROM bronze WHERE language = 'klingon' GROUP BY 1""")),
    "dq_not_empty": Query(dq_not_empty, "SELECT doc_id, lang FROM documents WHERE lang = 'de'"),
    "dq_type": Query(dq_type, """SELECT 'lineitem' AS table_name, * FROM (VALUES
        ('type_number', 'l_orderkey', CAST(0 AS BIGINT), 'pass'),
        ('type_float', 'l_discount', 0, 'pass'), ('type_timestamp_ntz', 'l_shipdate', 0, 'pass'),
        ('type_number', 'l_returnflag', 1, 'fail'), ('type_boolean', 'l_tax', 1, 'fail'))
        t(test_name, column_name, failures, status) UNION ALL
        SELECT 'lineitem', test_name, column_name, failures,
        CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END FROM (
        SELECT 'not_null' AS test_name, 'l_shipdate' AS column_name,
        count(*) FILTER (l_shipdate IS NULL) AS failures FROM lineitem UNION ALL
        SELECT 'unique', 'l_orderkey', count(*) FROM (
        SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1))"""),
    "dq_between": Query(dq_between, "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"),
    "dq_within_range": Query(dq_within_range, """SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate > TIMESTAMP '1998-12-31'"""),
    "dq_no_later": Query(dq_no_later, """SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate > l_shipdate"""),
    "dq_date_floor": Query(dq_date_floor, ctes(FLAGGED_CTES[0], final=f"""SELECT app_id, review_id,
        ingested_at FROM bronze WHERE app_id = '{LAUNCHED_APP}'
        AND ingested_at < TIMESTAMP '{LAUNCH}'""")),
    "dq_cross_table": Query(dq_cross_table, f"""SELECT o_orderkey AS l_orderkey, o_orderdate,
        n_matches FROM orders JOIN {_PART} ON l_orderkey = o_orderkey
        WHERE o_orderdate < TIMESTAMP '1999-01-01'"""),
    "dq_reactions": Query(dq_reactions, ctes(FLAGGED_CTES[0], final="""SELECT review_id, app_id,
        '{"count":"x","reaction_type":1}' AS element FROM bronze WHERE reactions LIKE '%"x"%'""")),
    "dq_freshness": Query(dq_freshness, """WITH newest AS (SELECT max(ts) AS seen_at FROM events),
        moved AS (SELECT 'soon' AS seen, max(ts) - INTERVAL 30 MINUTE AS loaded FROM events
        UNION ALL SELECT 'later', max(ts) - INTERVAL 2 HOUR FROM events
        UNION ALL SELECT 'late', max(ts) - INTERVAL 4 HOUR FROM events)
        SELECT seen, CASE WHEN seen_at - loaded > INTERVAL 3 HOUR THEN 'error'
        WHEN seen_at - loaded > INTERVAL 1 HOUR THEN 'warn' ELSE 'pass' END AS status
        FROM moved, newest"""),
    "freshness_newest_day": Query(freshness_newest_day, """SELECT seen, max_loaded_at, status FROM
        (SELECT max(ts) AS max_loaded_at FROM events),
        (VALUES ('soon', 'pass'), ('later', 'warn'), ('late', 'error')) t(seen, status)"""),
    "dq_starter_model": Query(dq_starter_model, ctes(FLAGGED_CTES[0], ("counted", """SELECT 'unique'
        AS test_name, (SELECT count(*) FROM (SELECT author_steam_id FROM bronze WHERE
        author_steam_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures UNION ALL
        SELECT 'not_null', count(*) FROM bronze WHERE author_steam_id IS NULL"""),
        final="""SELECT 'starter' AS table_name, test_name, 'id' AS column_name, failures,
        CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM counted""")),
    "suite_reviews_scd1": Query(_suite("reviews_scd1"), _suite_sql(
        "reviews_scd1", _review_tests(), _UNIQUE)),
    "suite_reviews_scd2": Query(_suite("reviews_scd2"), _suite_sql(
        "reviews_scd2", [*_review_tests(), *_validity()])),
    "suite_players_scd1": Query(_suite("players_scd1"), _suite_sql(
        "players_scd1", [*_player_tests(), _null("review_id")], _UNIQUE, _JOINED)),
    "suite_players_scd2": Query(_suite("players_scd2"), _suite_sql(
        "players_scd2", [*_player_tests(), *_validity()], _UNIQUE, _JOINED)),
}
