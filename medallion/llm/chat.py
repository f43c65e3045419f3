"""Chat formatting by quotation linking; DataFrame functions only.

Lines that begin with ``>`` are quotes, nested as deep as there are marks. Runs of one level are
passages. Normalised passages, and their lines, are hashed and joined to the message of the same
conversation that said it first; the nearest level that finds its original names the message
replied to. Conversations are then written out without quotes, each reply behind what it replies to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import ascii_lower, written

#: Distinct messages of a conversation in one part of its chat.
PART = 256
#: Characters of a text that say where rows are dealt to; only equal ones are compared further.
PREFIX = 256
_MARKS = r"^((?:[ \t]*>)+)"
_MARKS_AND_BLANK = r"^(?:[ \t]*>)+[ \t]?"
_KEY = ["conv_id", "turn", "role", "text"]


def quote_level(line: Column) -> Column:
    marks = F.regexp_extract(line, _MARKS, 1)
    return F.char_length(marks) - F.char_length(F.replace(marks, F.lit(">"), F.lit("")))


def without_quotes(text: Column) -> Column:
    own = F.array_join(F.filter(F.split(text, "\n"), lambda line: quote_level(line) == 0), "\n")
    return F.when(F.contains(text, F.lit(">")), F.btrim(own, F.lit(" \t\n\r"))).otherwise(text)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(text), r"[ \t\n\x0b\f\r]+", " "))


def _hashes(text: Column) -> Column:
    """128 bits of a normalised passage."""
    return F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"))


def messages(conversations: DataFrame) -> DataFrame:
    """Distinct messages with ``copies``; a null role or text counts as empty."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.groupBy(*_KEY).agg(F.count("*").alias("copies"))


def quotes(said: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, passage, level, whole, h``: every passage and each of its lines.

    The windows run within one message.
    """
    lines = said.where(F.contains("text", F.lit(">"))).select(
        *_KEY, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    leveled = lines.withColumn("level", quote_level(F.col("line"))).withColumn(
        "line", F.regexp_replace("line", _MARKS_AND_BLANK, ""))
    order = Window.partitionBy(*_KEY).orderBy("pos")
    new = F.when(F.col("level") == F.lag("level").over(order), 0).otherwise(1)
    runs = leveled.withColumn("new", new).withColumn("passage", F.sum("new").over(order)).where(
        "level > 0")
    passages = runs.groupBy(*_KEY, "passage", "level").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))),
                    lambda x: x["line"]).alias("lines"))
    units = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"),
                         normalised(F.array_join("lines", "\n")).alias("said"))),
        F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"),
                                                normalised(x).alias("said"))))
    return passages.select(*_KEY, "passage", "level", F.explode(units).alias("u")).where(
        "u.said <> ''").select(*_KEY, "passage", "level", F.col("u.whole").alias("whole"),
                               _hashes(F.col("u.said")).alias("h"))


def originals(said: DataFrame) -> DataFrame:
    """``conv_id, h, original``: the first turn that said a text, paragraph or line itself."""
    body = without_quotes(F.col("text"))
    units = F.array_distinct(F.transform(
        F.concat(F.array(body), F.split(body, "\n[ \t]*\n"), F.split(body, "\n")), normalised))
    return said.select("conv_id", "turn", F.explode(units).alias("said")).where(
        "said <> ''").select("conv_id", "turn", _hashes(F.col("said")).alias("h")).groupBy(
        "conv_id", "h").agg(F.min("turn").alias("original"))


def links(said: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n_quotes, n_linked, reply_to`` of each message with quotes."""
    found = quotes(said).join(originals(said), ["conv_id", "h"], "left").withColumn(
        "original", F.when(F.col("original") < F.col("turn"), F.col("original")))
    # The nearest level, whole passages before single lines, the latest message.
    best = F.min(F.when(F.col("original").isNotNull(), F.struct(
        "level", (~F.col("whole")).alias("part"), (-F.col("original")).alias("back"))))
    by_passage = found.groupBy(*_KEY, "passage").agg(
        best.alias("best"), F.max(F.col("original").isNotNull()).alias("linked"))
    return by_passage.groupBy(*_KEY).agg(
        F.count("*").alias("n_quotes"), F.sum(F.col("linked").cast("long")).alias("n_linked"),
        (-F.min("best")["back"]).alias("reply_to"))


def threads(replies: DataFrame) -> DataFrame:
    """``conv_id, turn, thread``: the first message of the chain of replies, by pointer doubling.

    A reply points to an earlier turn, so there are no rings; the rounds are the logarithm of the
    longest chain. Of several messages of one turn the earliest target counts.
    """
    up = written(replies.where("reply_to is not null").groupBy("conv_id", "turn").agg(
        F.min("reply_to").alias("thread")), "chat")
    while True:
        above = up.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"))
        stepped = written(up.join(above, ["conv_id", "thread"], "left").select(
            "conv_id", "turn", F.coalesce("next", "thread").alias("thread"),
            F.col("next").isNotNull().alias("moved")), "chat")
        up = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            return up


def linked_messages(conversations: DataFrame) -> DataFrame:
    """One row per distinct message: ``conv_id, turn, role, said, copies, n_quotes, n_linked,
    reply_to, thread, text_hash``; ``said`` is the text without quotes, ``thread`` the turn its chain of
    replies starts from (its own without a link)."""
    said = messages(conversations)
    replies = written(links(said), "chat")
    rows = said
    if replies.isEmpty():
        for name in ("n_quotes", "n_linked", "reply_to", "thread"):
            rows = rows.withColumn(name, F.lit(None).cast("long"))
    else:
        rows = rows.join(replies, _KEY, "left").join(
            threads(replies), ["conv_id", "turn"], "left")
    return rows.select(
        "conv_id", "turn", "role", without_quotes(F.col("text")).alias("said"), "copies",
        F.coalesce("n_quotes", F.lit(0).cast("long")).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"), "reply_to",
        F.coalesce("thread", "turn").alias("thread"), F.xxhash64("text").alias("text_hash"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``linked_messages`` with ``number``, the place in the conversation from 0 in reply order.

    Rows are dealt out by ranges of the whole order, so that no key lands in one task; places are
    counted within a range, and a conversation that began in an earlier range goes on from there.
    """
    never = F.lit(1 << 62)
    head = F.left("said", F.lit(PREFIX))
    long = F.char_length("said") > PREFIX
    ordered = rows.withColumns({
        "by_thread": F.coalesce("thread", never), "by_turn": F.coalesce("turn", never), "head": head,
        # The hash parts messages that say the same, and comes behind the text of those that do not.
        "long": long, "short_hash": F.when(long, 0).otherwise(F.col("text_hash"))})
    keys = ["conv_id", "by_thread", "by_turn", "role", "head", "long", "short_hash"]
    dealt = written(ordered.repartitionByRange(*keys).sortWithinPartitions(
        *keys, "said", "text_hash").select(
        *rows.columns, F.monotonically_increasing_id().alias("id")), "chat").withColumn(
        "range", F.shiftright("id", 33))
    runs = dealt.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1))
    # In each range only the first conversation can have begun before.
    begun = runs.withColumn("before", before).where("before > 0").select(
        F.col("conv_id").alias("of"), F.col("range").alias("at"), "before")
    placed = dealt.withColumn("place", F.row_number().over(
        Window.partitionBy("conv_id", "range").orderBy("id")))
    return placed.join(F.broadcast(begun), (F.col("range") == F.col("at")) & F.col(
        "conv_id").eqNullSafe(F.col("of")), "left").select(
        *rows.columns, (F.col("place") - 1 + F.coalesce("before", F.lit(0))).alias("number"))


def format_chats(conversations: DataFrame, part: int = PART) -> DataFrame:
    """``conv_id, part, section, n_messages, n_quotes, n_linked, first_turn, last_turn, chat``.

    ``chat`` holds the messages as ``<|role|>`` lines, each followed by the text without quotes, in
    reply order: by the thread's first turn, then by turn (ties: role, then text). A conversation
    of up to ``part`` distinct messages is one row; longer ones are rows of ``part`` at most, whatever
    their turns are, ordered by ``part``, so that no group grows with the conversation (``section``
    is always 0). Repeated rows are one message, and are counted in ``n_messages``. Quotes without an original are dropped like others,
    but link nothing. A null ``turn`` comes last and is never linked; messages with a null
    ``conv_id`` belong together under a null id, and are not linked. Other columns are not read; an
    empty table gives no rows.
    """
    rows = _numbered(linked_messages(conversations))
    grouped = rows.groupBy("conv_id", F.floor(F.col("number") / part).alias("part")).agg(
        F.sum("copies").alias("n_messages"), F.sum("n_quotes").alias("n_quotes"),
        F.sum("n_linked").alias("n_linked"), F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"),
        F.array_sort(F.collect_list(F.struct("number", "role", "said"))).alias("rows"))
    line = F.transform("rows", lambda x: F.concat(
        F.lit("<|"), x["role"], F.lit("|>\n"), x["said"]))
    return grouped.select("conv_id", "part", F.lit(0).cast("long").alias("section"), "n_messages", "n_quotes", "n_linked",
                          "first_turn", "last_turn", F.array_join(line, "\n").alias("chat"))


def _sql_normalised(text: str) -> str:
    return (f"trim(regexp_replace(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\v\\f\\r]+', ' ', 'g'), ' ')")


#: The default of 256 messages a part. Texts are compared themselves, not their hashes.
SQL = rf"""
WITH RECURSIVE m AS MATERIALIZED (
  SELECT row_number() OVER () AS id, * FROM (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           count(*) AS copies
    FROM conversations GROUP BY ALL)),
v AS MATERIALIZED (
  SELECT id, pos, line, length(marks) - length(replace(marks, '>', '')) AS level
  FROM (SELECT *, regexp_extract(line, '^((?:[ 	]*>)+)', 1) AS marks
        FROM (SELECT id, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS pos
              FROM m WHERE contains(text, '>')))),
b AS MATERIALIZED (
  SELECT m.*, CASE WHEN contains(text, '>')
    THEN trim(coalesce(own, ''), ' ' || chr(9) || chr(10) || chr(13)) ELSE text END AS said
  FROM m LEFT JOIN (SELECT id, string_agg(line, chr(10) ORDER BY pos) AS own
                    FROM v WHERE level = 0 GROUP BY id) USING (id)),
r AS (
  SELECT id, pos, level, regexp_replace(line, '^(?:[ 	]*>)+[ 	]?', '') AS line,
         CASE WHEN level = lag(level) OVER (PARTITION BY id ORDER BY pos) THEN 0 ELSE 1 END AS new
  FROM v),
p AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY pos) AS passage FROM r),
u AS (
  SELECT id, passage, level, 0 AS part,
         {_sql_normalised("string_agg(line, chr(10) ORDER BY pos)")} AS said
  FROM p WHERE level > 0 GROUP BY id, passage, level
  UNION ALL SELECT id, passage, level, 1, {_sql_normalised("line")} FROM p WHERE level > 0),
o AS (
  SELECT conv_id, said, min(turn) AS original
  FROM (SELECT conv_id, turn, {_sql_normalised("x")} AS said
        FROM (SELECT conv_id, turn, unnest(list_concat([said],
                string_split_regex(said, '
[ 	]*
'), string_split(said, chr(10)))) AS x FROM b))
  WHERE said <> '' GROUP BY conv_id, said),
f AS (
  SELECT u.id, passage, level, part, CASE WHEN original < turn THEN original END AS original
  FROM u JOIN m USING (id) LEFT JOIN o ON o.conv_id = m.conv_id AND o.said = u.said
  WHERE u.said <> ''),
q AS (
  SELECT id, conv_id, turn, count(*) AS n_quotes, sum(linked) AS n_linked,
         -(min(best)[3]) AS reply_to
  FROM (SELECT id, passage, max(CAST(original IS NOT NULL AS BIGINT)) AS linked,
               min([level, part, -original]) FILTER (original IS NOT NULL) AS best
        FROM f GROUP BY id, passage) JOIN m USING (id)
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY id, conv_id, turn),
up AS (
  SELECT conv_id, turn, min(reply_to) AS target FROM q WHERE reply_to IS NOT NULL
  GROUP BY conv_id, turn),
walk(conv_id, turn, root) AS (
  SELECT conv_id, turn, target FROM up
  UNION ALL SELECT w.conv_id, w.turn, up.target
  FROM walk w JOIN up ON up.conv_id = w.conv_id AND up.turn = w.root),
n AS (
  SELECT b.*, coalesce(q.n_quotes, 0) AS n_quotes, coalesce(q.n_linked, 0) AS n_linked,
         row_number() OVER (PARTITION BY b.conv_id ORDER BY coalesce(t.root, b.turn) NULLS LAST,
                            b.turn NULLS LAST, role, said) - 1 AS number
  FROM b LEFT JOIN q ON q.id = b.id
  LEFT JOIN (SELECT conv_id, turn, min(root) AS root FROM walk GROUP BY conv_id, turn) t
    ON t.conv_id = b.conv_id AND t.turn = b.turn)
SELECT conv_id, number // 256 AS part, CAST(0 AS BIGINT) AS section,
       CAST(sum(copies) AS BIGINT) AS n_messages, CAST(sum(n_quotes) AS BIGINT) AS n_quotes,
       CAST(sum(n_linked) AS BIGINT) AS n_linked, min(turn) AS first_turn, max(turn) AS last_turn,
       string_agg('<|' || role || '|>' || chr(10) || said, chr(10) ORDER BY number) AS chat
FROM n GROUP BY conv_id, number // 256
"""
