"""Review feeds derived from the given tables.

``bronze_feed`` reads every ``lineitem`` row as one all-text review: order and line number make the
review id, so a review comes in several versions, and the ship date is the arrival time. Texts that
break exactly one rule are put in by quantity, 1 to 27 in the order of the rules; 28 to 50 are
clean. ``page_feed`` packs every ``events`` row as a review into page documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.catalog import table
from medallion.schemas import BRONZE_TEXT, FIELDS, PLAYER_ROW, REVIEW_ROW

# --- lineitem as bronze rows ----------------------------------------------------------------

_TEXT = "CAST({} AS STRING)"


def _broken(quantity: int, bad: str, value: str) -> str:
    text = "NULL" if bad == "NULL" else f"'{bad}'"
    return f"CASE WHEN l_quantity = {quantity} THEN {text} ELSE {value} END"


def _columns(epoch: str, millis: str) -> dict[str, str]:
    """Bronze columns as SQL both engines read; only the epoch functions are named differently."""
    line = _TEXT.format("l_linenumber")
    return {
        "app_id": _broken(2, "NULL", _TEXT.format("l_partkey")),
        "review_id": _broken(1, "NULL", f"{_TEXT.format('l_orderkey')} || '-' || {line}"),
        "author_steam_id": _broken(20, "NULL", _TEXT.format("76500000000000000 + l_suppkey")),
        "author_num_games_owned": _broken(21, "lots", line),
        "author_num_reviews": _broken(22, "lots", _TEXT.format("l_linenumber - 1")),
        "author_playtime_forever": _broken(
            23, "lots", _TEXT.format("CAST(round(l_extendedprice * 100) AS BIGINT)")),
        "author_playtime_last_two_weeks": _broken(24, "lots", line),
        "author_playtime_at_review":
            f"CASE WHEN l_quantity = 25 OR l_tax = 0.08 THEN 'lots' ELSE {line} END",
        "author_deck_playtime_at_review": _broken(26, "lots", "'0'"),
        "author_last_played": _broken(27, "yesterday", _TEXT.format(epoch)),
        "language": _broken(4, "NULL", "CASE WHEN l_returnflag = 'A' THEN 'english' "
                            "WHEN l_returnflag = 'N' THEN 'german' ELSE 'klingon' END"),
        "review": _broken(3, "NULL", "l_returnflag || ' ' || l_linestatus"),
        "timestamp_created": "CASE WHEN l_quantity = 5 THEN NULL WHEN l_quantity = 6 THEN "
                             f"'not-a-time' ELSE {_TEXT.format(epoch)} END",
        "timestamp_updated": "CASE WHEN l_quantity = 7 THEN 'not-a-time' WHEN l_linenumber = 1 "
                             "THEN NULL ELSE CAST(l_shipdate + INTERVAL '1' DAY AS STRING) END",
        "voted_up": "CASE WHEN l_quantity = 8 THEN NULL WHEN l_quantity = 9 THEN 'maybe' "
                    "WHEN l_returnflag = 'A' THEN 'true' WHEN l_returnflag = 'N' THEN 'off' "
                    "ELSE '1' END",
        "votes_up": _broken(10, "many", line),
        "votes_funny": "CASE WHEN l_quantity = 11 THEN 'many' WHEN l_quantity = 28 THEN '12.7' "
                       f"ELSE {_TEXT.format('l_partkey')} END",
        "weighted_vote_score": _broken(12, "0.5abc", _TEXT.format("l_discount")),
        "comment_count": "CASE WHEN l_quantity = 13 THEN 'many' WHEN l_quantity = 30 THEN '1e3' "
                         f"ELSE {line} END",
        "steam_purchase": _broken(14, "maybe",
                                  "CASE WHEN l_linestatus = 'O' THEN 'yes' ELSE 'no' END"),
        "received_for_free": _broken(15, "maybe", "'F'"),
        "written_during_early_access": _broken(16, "maybe", "'0'"),
        "developer_response": "CASE WHEN l_returnflag = 'R' THEN 'thanks' END",
        "timestamp_dev_responded": "CASE WHEN l_quantity = 17 THEN 'not-a-time' "
                                   f"WHEN l_returnflag = 'R' THEN {_TEXT.format(millis)} END",
        "primarily_steam_deck": _broken(18, "maybe", "'n'"),
        "reactions": "CASE WHEN l_quantity = 19 THEN '[bad' WHEN l_quantity = 31 THEN '[]' "
                     "WHEN l_quantity = 32 THEN '[{\"reaction_type\": 1, \"count\": \"x\"}]' "
                     "ELSE '[{\"reaction_type\": 31, \"count\": ' || " + line + " || '}]' END",
    }


def bronze_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _columns("unix_seconds(CAST(l_shipdate AS TIMESTAMP))",
                       "unix_millis(CAST(l_shipdate AS TIMESTAMP))")
    # A file with one row group is one task; adaptive execution sizes the pieces. Dealt out by the
    # whole row: without columns every map task would sort its rows first.
    lines = table(spark, sf_dir, "lineitem")
    return lines.hint("rebalance", *lines.columns).selectExpr(
        *[f"{columns[c]} AS {c}" for c in BRONZE_TEXT], "l_shipdate AS ingested_at"
    )


def bronze_feed_sql() -> str:
    columns = _columns("CAST(epoch(l_shipdate) AS BIGINT)", "CAST(epoch_ms(l_shipdate) AS BIGINT)")
    listed = ",\n ".join(f"{columns[c]} AS {c}" for c in BRONZE_TEXT)
    return f"SELECT {listed},\n l_shipdate AS ingested_at FROM lineitem"


def _typed_sql(kind: str, raw: str) -> str:
    word = f"lower({raw})"
    return {
        "bigint": f"TRY_CAST({raw} AS BIGINT)",
        "double": f"TRY_CAST({raw} AS DOUBLE)",
        "boolean": f"CASE WHEN {word} IN ('true', 't', 'yes', 'y', 'on', '1') THEN true "
                   f"WHEN {word} IN ('false', 'f', 'no', 'n', 'off', '0') THEN false END",
        "timestamp": f"CASE WHEN length({raw}) >= 12 AND TRY_CAST({raw} AS BIGINT) IS NOT NULL "
                     f"THEN make_timestamp(TRY_CAST({raw} AS BIGINT) * 1000) "
                     f"WHEN TRY_CAST({raw} AS BIGINT) IS NOT NULL "
                     f"THEN make_timestamp(TRY_CAST({raw} AS BIGINT) * 1000000) "
                     f"ELSE TRY_CAST({raw} AS TIMESTAMP) END",
        # Keys sorted, no blanks, as the definition of the canonical text says.
        "json": f"CASE WHEN {raw} = '[bad' THEN NULL WHEN {raw} = '[]' THEN '[]' "
                f"WHEN {raw} LIKE '%\"x\"%' THEN '[{{\"count\":\"x\",\"reaction_type\":1}}]' "
                f"ELSE '[{{\"count\":' || json_extract_string(CASE WHEN json_valid({raw}) "
                f"THEN {raw} END, '$[0].count') || ',\"reaction_type\":31}}]' END",
    }[kind]


def typed_sql(rows: str = "bronze") -> str:
    columns = ["review_id", "app_id", "author_steam_id", "language", "review",
               "developer_response", "ingested_at"]
    for field in FIELDS:
        columns.append(f"{field.bronze} AS {field.bronze}_raw")
        columns.append(f"{_typed_sql(field.kind, field.bronze)} AS {field.typed}")
    return "SELECT " + ",\n ".join(columns) + f" FROM {rows}"


def flagged_sql(rows: str = "typed") -> str:
    """Reasons as comma-separated text in rule order."""
    missing = {"review_id": "miss_review_id", "app_id": "miss_app_id",
               "review": "miss_review_text", "language": "miss_language"}
    review = [f"CASE WHEN {c} IS NULL THEN 'review:{name}' END" for c, name in missing.items()]
    author = ["CASE WHEN author_steam_id IS NULL THEN 'author:miss_author_steam_id' END"]
    for field in FIELDS:
        raw = f"{field.bronze}_raw"
        if field.bronze in ("timestamp_created", "voted_up"):
            review.append(f"CASE WHEN {raw} IS NULL THEN 'review:miss_{field.bronze}' END")
        name = f"{field.grain}:{field.bronze.removeprefix('author_')}_malformed"
        case = f"CASE WHEN {raw} IS NOT NULL AND {field.typed} IS NULL THEN '{name}' END"
        (review if field.grain == "review" else author).append(case)
    return (
        f"SELECT *, concat_ws(',', {', '.join(review)}) AS review_reasons, "
        f"concat_ws(',', {', '.join(author)}) AS author_reasons FROM {rows}"
    )


FLAGGED_CTES = (("bronze", bronze_feed_sql()), ("typed", typed_sql()), ("flagged", flagged_sql()))


def full_order(columns: list[str]) -> list:
    """Tie breaker over all columns: rows equal in it are equal."""
    return [F.col(c).desc_nulls_last() for c in columns]


def _order_sql(columns: list[str]) -> str:
    return (
        "ingested_at DESC NULLS FIRST, timestamp_updated DESC NULLS LAST, "
        + ", ".join(f"{c} DESC NULLS LAST" for c in columns)
    )


REVIEW_ORDER_SQL = _order_sql(REVIEW_ROW)
PLAYER_ORDER_SQL = _order_sql(PLAYER_ROW)

# --- events as page documents ---------------------------------------------------------------

# A block of this many event ids makes a page, so no page is larger; ten pages make an application.
PAGE_SIZE = 100
PAGES_PER_APP = 10

_LANGUAGES = {"click": "english", "error": "french", "purchase": "german", "signup": "latam",
              "view": "thai"}


def _language() -> F.Column:
    chosen = None
    for event_type, language in _LANGUAGES.items():
        condition = F.col("event_type") == event_type
        chosen = F.when(condition, language) if chosen is None else chosen.when(condition, language)
    return chosen


def page_feed(
    spark: SparkSession, sf_dir: str, updated: int = 60, funny: int = 0, two_weeks: int = 30,
) -> DataFrame:
    """Landing rows with keys: ``steam_app_id, block, run_id, ingestion_date, raw_data``.

    ``updated`` seconds lie between the creation and the update of a review.
    """
    events = table(spark, sf_dir, "events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    score = F.col("value").cast("string")
    late_error = (F.col("event_type") == "error") & (F.col("value") > 150)
    review = F.struct(
        F.col("event_id").alias("recommendationid"),
        F.struct(
            F.concat(F.lit("765"), F.col("user_id")).alias("steamid"),
            F.col("user_id").alias("num_games_owned"),
            F.lit(1).alias("num_reviews"),
            (F.col("event_id") + 5).alias("playtime_forever"),
            F.lit(two_weeks).alias("playtime_last_two_weeks"),
            F.lit("60").alias("playtime_at_review"),
            (seconds + 3600).alias("last_played"),
        ).alias("author"),
        _language().alias("language"),
        F.concat(F.lit("é "), F.col("props")).alias("review"),
        F.when(late_error, F.lit("not-a-time")).otherwise(seconds.cast("string"))
        .alias("timestamp_created"),
        (seconds + updated).alias("timestamp_updated"),
        (F.col("value") > 50).alias("voted_up"),
        F.floor("value").cast("bigint").alias("votes_up"),
        F.lit(funny).alias("votes_funny"),
        score.alias("weighted_vote_score"),
        F.lit(2).alias("comment_count"),
        (F.col("event_type") == "purchase").alias("steam_purchase"),
        F.lit(False).alias("received_for_free"),
        F.lit(False).alias("written_during_early_access"),
        F.lit(False).alias("primarily_steam_deck"),
        F.array(F.struct(F.lit(31).alias("reaction_type"), F.lit(2).alias("count")))
        .alias("reactions"),
    )
    block = F.floor(F.col("event_id") / PAGE_SIZE).cast("bigint")
    # Dealt out as plain events: reviews are put together, and pages collected, in all tasks of the
    # shuffle and not in the few that read the file.
    packed = (
        events.withColumn("block", block)
        .withColumn("steam_app_id", F.floor(F.col("block") / PAGES_PER_APP).cast("bigint"))
        .repartition("steam_app_id", "block").groupBy("steam_app_id", "block")
        .agg(F.collect_list(review).alias("reviews"), F.to_date(F.min("ts")).alias("day"))
    )
    summary = F.struct(
        F.size("reviews").alias("num_reviews"),
        # Only the first page of an application has the total.
        F.when(F.col("block") == F.col("steam_app_id") * PAGES_PER_APP, F.lit(1000))
        .alias("total_reviews"),
    )
    page = F.struct(
        F.lit(1).alias("success"), F.col("steam_app_id").alias("app_id"),
        F.concat(F.lit("c"), F.col("block")).alias("cursor"), summary.alias("query_summary"),
        F.col("reviews"),
    )
    return packed.select(
        "steam_app_id", "block",
        F.concat(F.lit("run:"), F.col("block"), F.lit("+0")).alias("run_id"),
        F.col("day").alias("ingestion_date"), F.to_json(page).alias("raw_data"),
    )


def as_run(pages: DataFrame, name: str) -> DataFrame:
    """The pages as those of one run: a load is written, and written again, as a whole."""
    return pages.withColumn("run_id", F.lit(name))


def landing_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_feed(spark, sf_dir).select(
        "raw_data", F.lit("2026-03-01 00:00:00").cast("timestamp_ntz").alias("ingested_at")
    )


def page_rows_sql() -> str:
    """The bronze rows the pages of ``events`` must give."""
    language = "CASE event_type " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in _LANGUAGES.items()) + " END"
    seconds = "CAST(floor(epoch(ts)) AS BIGINT)"
    return f"""
SELECT CAST(CAST(floor(event_id / {PAGE_SIZE * PAGES_PER_APP}) AS BIGINT) AS VARCHAR) AS app_id,
 CAST(event_id AS VARCHAR) AS review_id,
 '765' || CAST(user_id AS VARCHAR) AS author_steam_id,
 CAST(user_id AS VARCHAR) AS author_num_games_owned, '1' AS author_num_reviews,
 CAST(event_id + 5 AS VARCHAR) AS author_playtime_forever,
 '30' AS author_playtime_last_two_weeks, '60' AS author_playtime_at_review,
 '0' AS author_deck_playtime_at_review,
 CAST({seconds} + 3600 AS VARCHAR) AS author_last_played,
 {language} AS language, 'é ' || props AS review,
 CASE WHEN event_type = 'error' AND value > 150 THEN 'not-a-time'
      ELSE CAST({seconds} AS VARCHAR) END AS timestamp_created,
 CAST({seconds} + 60 AS VARCHAR) AS timestamp_updated,
 CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS voted_up,
 CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS votes_up, '0' AS votes_funny,
 CAST(value AS VARCHAR) AS weighted_vote_score, '2' AS comment_count,
 CASE WHEN event_type = 'purchase' THEN 'true' ELSE 'false' END AS steam_purchase,
 'false' AS received_for_free, 'false' AS written_during_early_access,
 CAST(NULL AS VARCHAR) AS developer_response,
 CAST(NULL AS VARCHAR) AS timestamp_dev_responded, 'false' AS primarily_steam_deck,
 '[{{"reaction_type":31,"count":2}}]' AS reactions,
 TIMESTAMP '2026-03-01 00:00:00' AS ingested_at,
 user_id, CAST(floor(event_id / {PAGE_SIZE}) AS BIGINT) AS block, ts, value, event_type
FROM events"""
