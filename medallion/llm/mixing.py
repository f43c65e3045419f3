"""Mixing sources to target weights in blocks of words; DataFrame functions only.

The words of each source stand in one row, document after document in the order of a hash, and are
packed into blocks of ``BLOCK`` words; the last block of a source is shorter. Output shards of
``SHARD`` slots draw their source counts multinomially, with the blocks each source is to give as
weights. Slots drawn beyond that number pass on to sources that were drawn too rarely, so the totals
are exact. The n-th slot of a source takes block ``p(n)``, where p is a pseudorandom permutation of
the source's block numbers, another one each time round; nothing is sorted or shuffled for it. Slots
and documents then meet by block number.

All randomness comes from the data and from numbers of slots, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import written

BLOCK = 64
SHARD = 1024
#: Weights by rank of the source, repeating, and the most often that a word is taken.
WEIGHTS, MOST = 3, 3
#: Cells of equal width that ranges of numbers are looked up by, at least.
CELLS = 4096
WORD = r"[^\x20\x09-\x0D]+"
_BLANKS = r"[\x20\x09-\x0D]+"
_SOURCE = ["none", "name"]


def running(rows: DataFrame, order: Sequence[str], value: str, by: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``before``, the sum of ``value`` in front of each row, in order, within ``by``.

    Rows are dealt out by ranges of (by, order), so a group of any size is spread; sums run within
    a range, and there is one more sum per range and group. ``by`` columns hold no nulls.
    """
    keys = [*by, *order]
    dealt = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "id_", F.monotonically_increasing_id()), "mix").withColumn(
        "range_", F.shiftright("id_", 33))
    front = (Window.unboundedPreceding, -1)
    runs = dealt.groupBy(*by, "range_").agg(F.sum(value).alias("sum_"))
    begins = runs.select(*by, "range_", F.coalesce(F.sum("sum_").over(
        Window.partitionBy(*by).orderBy("range_").rowsBetween(*front)), F.lit(0)).alias("begin_"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy(*by, "range_").orderBy(
        "id_").rowsBetween(*front)), F.lit(0))
    return dealt.withColumn("inside_", inside).join(begins, [*by, "range_"]).select(
        *rows.columns, (F.col("begin_") + F.col("inside_")).alias("before"))


def looked_up(numbers: DataFrame, number: str, ranges: DataFrame, start: str, length: str,
              total: int, parts: int) -> DataFrame:
    """``numbers`` with the columns of the range [start, start + length) that holds ``number``.

    Both sides meet by cells of the numbers' line, so this is an equi join.
    """
    width = max(1, -(-total // max(CELLS, 4 * parts)))
    cells = ranges.where(F.col(length) > 0).withColumn("cell_", F.explode(F.expr(
        f"sequence({start} div {width}L, ({start} + {length} - 1) div {width}L)")))
    return numbers.withColumn("cell_", F.expr(f"{number} div {width}L")).join(
        cells, "cell_").where(
        (F.col(number) >= F.col(start)) & (F.col(number) < F.col(start) + F.col(length))).drop(
        "cell_")


def _scatter(x: str, step: int) -> str:
    return (f"(({x} * 48271 + seed + {step} * 40692) % 2147483647) * 69621 % 2147483629")


def permuted(number: str) -> str:
    """SQL: one step of a permutation of 0 .. wide * high - 1, two coordinates moved in turn.

    It reads ``seed``, ``wide`` and ``high`` beside the number, and is good SQL in DuckDB too.
    """
    left, right = f"({number} // high)", f"({number} % high)"
    for step in (1, 2):
        left = f"(({left} + {_scatter(right, 2 * step)}) % wide)"
        right = f"(({right} + {_scatter(left, 2 * step + 1)}) % high)"
    return f"({left} * high + {right})"


def _block_of(position: str) -> Column:
    """Place of a position in the permutation of 0 .. full - 1: steps are repeated while outside."""
    step = permuted("v").replace("//", "div")
    first = permuted(position).replace("//", "div")
    return F.expr(f"""aggregate(CASE WHEN {first} < full THEN array(0) ELSE
        sequence(0, CAST(wide * high - full AS INT)) END, {first},
        (v, i) -> CASE WHEN v < full THEN v ELSE {step} END)""")


@dataclass(frozen=True)
class Mix:
    """``rows``: per row of the table ``doc_id, none, name, digest, size, offset``, offset in its
    source; ``sources``: per source its ``rank, size, target`` and block numbers; ``slots``: ``shard,
    slot, rank, block, words``, what each slot of the mix takes."""

    rows: DataFrame
    sources: DataFrame
    slots: DataFrame

    def pieces(self) -> DataFrame:
        """``shard, slot, rank, offset, doc_id, digest, start, words, place``: runs of words of one
        document, ``start`` counted in the document, ``place`` in the slot."""
        spans = self.rows.where("size > 0").join(
            self.sources.select(*_SOURCE, "rank"), _SOURCE).select(
            "rank", "offset", "doc_id", "digest", "size", F.explode(F.expr(
                f"sequence(offset div {BLOCK}L, (offset + size - 1) div {BLOCK}L)")).alias("block"))
        begin = F.greatest("offset", F.col("block") * BLOCK)
        end = F.least(F.col("offset") + F.col("size"), F.col("block") * BLOCK + F.col("words"))
        return spans.join(self.slots, ["rank", "block"]).where(end > begin).select(
            "shard", "slot", "rank", "offset", "doc_id", "digest",
            (begin - F.col("offset")).alias("start"), (end - begin).alias("words"),
            (begin - F.col("block") * BLOCK).alias("place"))


def _sources(rows: DataFrame) -> DataFrame:
    """Sources in order of code points, null last, with the targets of their weights."""
    sizes = written(rows.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size")), "mix")
    ranked = written(running(sizes.withColumn("one", F.lit(1).cast("long")), _SOURCE, "one").select(
        *_SOURCE, F.col("before").alias("rank"), "source_size",
        (F.col("before") % WEIGHTS + 1).alias("weight")), "mix")
    most = F.col("source_size") * MOST
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # Sources above their bound are held there, until a sharing leaves none above.
    held, rest, weights, before = F.lit(False), total, None, -1
    while True:
        count, bound, weights = ranked.agg(
            F.count(F.when(held, 1)), F.sum(F.when(held, most)),
            F.sum(F.when(~held, F.col("weight")))).first()
        rest = total - (bound or 0)
        if count == before or not weights:
            break
        before = count
        held = (F.col("weight").cast("decimal(38,0)") * F.lit(rest)) > (
            most.cast("decimal(38,0)") * F.lit(weights))
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(weights or 1).cast("double")
    return ranked.withColumn(
        "target", F.when(held, most.cast("double")).otherwise(share)).selectExpr(
        *_SOURCE, "rank", "source_size", "target", "CAST(floor(target) AS BIGINT) AS quota",
        f"source_size div {BLOCK}L AS full", f"source_size % {BLOCK} AS tail").selectExpr(
        "*", "full + CAST(tail > 0 AS BIGINT) AS blocks",
        "coalesce(quota div nullif(source_size, 0L), 0L) AS rounds").selectExpr(
        "*", f"least((quota - rounds * source_size) div {BLOCK}L, full) AS further").selectExpr(
        "*", f"quota - rounds * source_size - further * {BLOCK} AS cut").selectExpr(
        "*", "rounds * blocks + further + CAST(cut > 0 AS BIGINT) AS wanted")


def _draws(sources: DataFrame, total: int, parts: int) -> DataFrame:
    """``t, rank, nth``: the source that each slot draws, and how often it was drawn before.

    A slot beyond what its source gives goes on to a source that was drawn too rarely.
    """
    lots = running(sources.select("rank", "wanted"), ["rank"], "wanted").withColumnRenamed(
        "before", "first")
    tickets = sources.sparkSession.range(total).select(
        F.col("id").alias("t"), F.expr("CAST(conv(substr(md5(CAST(id AS STRING)), 1, 15), 16, 10) "
                                       f"AS BIGINT) % {total}L").alias("u"))
    drawn = written(looked_up(tickets, "u", lots, "first", "wanted", total, parts).selectExpr(
        "t", f"t div {SHARD}L AS shard", "rank", "wanted"), "mix")
    counts = drawn.groupBy("shard", "rank").agg(F.count("*").alias("n"))
    begun = running(counts, ["shard"], "n", by=["rank"]).select("shard", "rank", "before")
    in_shard = F.row_number().over(Window.partitionBy("shard", "rank").orderBy("t")) - 1
    nth = written(drawn.withColumn("place", in_shard).join(begun, ["shard", "rank"]).select(
        "t", "rank", "wanted", (F.col("before") + F.col("place")).alias("nth")), "mix")
    times = counts.groupBy("rank").agg(F.sum("n").alias("times"))
    settled = sources.select("rank", "wanted").join(times, "rank", "left").selectExpr(
        "rank", "coalesce(times, 0L) AS times", "greatest(coalesce(times, 0L) - wanted, 0L) AS over",
        "greatest(wanted - coalesce(times, 0L), 0L) AS under")
    settled = written(settled, "mix")
    over = running(settled, ["rank"], "over").selectExpr("rank", "before AS over_first")
    under = running(settled, ["rank"], "under").selectExpr(
        "rank AS heir", "times", "under", "before AS under_first")
    moved = settled.agg(F.sum("over")).first()[0] or 0
    spare = nth.where("nth >= wanted").join(over, "rank").selectExpr(
        "t", "over_first + nth - wanted AS g")
    given = looked_up(spare, "g", under, "under_first", "under", moved, parts).selectExpr(
        "t", "heir AS rank", "times + g - under_first AS nth")
    return nth.where("nth < wanted").select("t", "rank", "nth").unionByName(given)


def mix(documents: DataFrame) -> Mix:
    """The mix of all documents, as large as they are together; see ``Mix`` and ``mixed_counts``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.col("source").cast("string")
    sized = written(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.isNull().alias("none"),
        F.coalesce(source, F.lit("")).alias("name"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                       text)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("at")), "mix")
    # Rows alike in all else differ in ``at`` alone; it deals out a group of copies.
    rows = written(running(sized, ["digest", "at"], "size", by=_SOURCE).select(
        "doc_id", *_SOURCE, "digest", "size", F.col("before").alias("offset")), "mix")
    sources = written(_sources(rows), "mix")
    total, parts = sources.agg(F.sum("wanted"), F.count("*")).first()
    if not total:
        return Mix(rows, sources, sources.sparkSession.createDataFrame(
            [], "shard long, slot long, rank long, block long, words long"))
    uses = _draws(sources, total, parts).join(sources.selectExpr(
        "rank", "full", "tail", "blocks", "wanted", "cut",
        "greatest(CAST(ceil(sqrt(CAST(full AS DOUBLE))) AS BIGINT), 1L) AS wide"), "rank")
    turned = uses.selectExpr(
        "*", "(full + wide - 1) div wide AS high", "nth % blocks AS position",
        f"(rank * {MOST + 1} + nth div blocks + 1) * 7919 % 2147483647 AS seed")
    slots = turned.withColumn("block", F.when(
        F.col("position") < F.col("full"), _block_of("position")).otherwise(F.col("full")))
    # The last slot of a source takes only the words that are left of its target.
    words = F.expr(f"""CASE WHEN nth = wanted - 1 AND cut > 0 THEN cut
        WHEN block < full THEN {BLOCK}L ELSE tail END""")
    return Mix(rows, sources, written(slots.select(
        F.expr(f"t div {SHARD}L").alias("shard"), F.col("t").alias("slot"), "rank",
        F.col("block").cast("long").alias("block"), words.alias("words")), "mix"))


def mixed_counts(documents: DataFrame) -> DataFrame:
    """One row per row of the table: ``doc_id, size, source_size, target, taken``.

    ``size`` counts the words of the text (null: 0), ``taken`` the words of it that the mix takes,
    repeats counted, at most three times its size. Sources in order of code points, null last, weigh
    1, 2, 3 and again; a target is at most three times its source, and each source gives its target
    rounded down. Repeated rows and rows without id stand in the mix each. Other columns are not
    read. An empty table gives no rows; without any word all targets are 0.
    """
    made = mix(documents)
    taken = made.pieces().groupBy("rank", "offset").agg(F.sum("words").alias("taken"))
    rows = made.rows.join(made.sources.select(*_SOURCE, "rank", "source_size", "target"), _SOURCE)
    found = rows.where("size > 0").join(taken, ["rank", "offset"], "left")
    result = ["doc_id", "size", "source_size", "target"]
    return found.select(*result, F.coalesce("taken", F.lit(0).cast("long")).alias("taken")).unionByName(
        rows.where("size = 0").select(*result, F.lit(0).cast("long").alias("taken")))


def mixed_texts(documents: DataFrame) -> DataFrame:
    """The mix itself: ``shard, slot, rank, n_words, text``, words of a slot joined by blanks."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    as_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # One row per digest, which names id and text.
    texts = documents.select(
        F.md5(F.concat(as_text, F.lit(":"), text)).alias("digest"), text.alias("text")).groupBy(
        "digest").agg(F.any_value("text").alias("text"))
    words = F.split(F.regexp_replace("text", rf"^{_BLANKS}", ""), _BLANKS)
    runs = mix(documents).pieces().join(texts, "digest").select(
        "shard", "slot", "rank", "place", "words", F.array_join(F.slice(
            words, F.col("start").cast("int") + 1, F.col("words").cast("int")), " ").alias("run"))
    return runs.groupBy("shard", "slot", "rank").agg(
        F.sum("words").alias("n_words"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "run"))),
                                 lambda x: x["run"]), " ").alias("text"))


SQL = f"""
WITH d AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS name,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
  FROM documents),
rows AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY none, name ORDER BY digest
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o
  FROM d),
sizes AS (SELECT none, name, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY none, encode(name)) - 1 AS rank,
         (row_number() OVER (ORDER BY none, encode(name)) - 1) % {WEIGHTS} + 1 AS weight
  FROM sizes),
-- Sources by how soon they meet their bound: the first k are held there.
shares AS (
  SELECT *, row_number() OVER w - 1 AS k,
         (SELECT sum(n) FROM sizes) - coalesce(sum({MOST} * n) OVER before, 0) AS rest,
         (SELECT sum(weight) FROM ranked) - coalesce(sum(weight) OVER before, 0) AS weights
  FROM ranked
  WINDOW w AS (ORDER BY n / weight, rank),
         before AS (ORDER BY n / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT k, CAST(rest AS BIGINT) AS rest, CAST(weights AS BIGINT) AS weights FROM shares
  WHERE weight * rest <= {MOST} * n * weights ORDER BY k LIMIT 1),
targets AS (
  SELECT s.none, s.name, s.rank, s.n, CASE WHEN s.k < l.k THEN CAST({MOST} * n AS DOUBLE)
         ELSE CAST(weight * l.rest AS DOUBLE) / CAST(l.weights AS DOUBLE) END AS target
  FROM shares s, level l),
blocks0 AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS quota, n // {BLOCK} AS "full", n % {BLOCK} AS tail
  FROM targets),
blocks1 AS (
  SELECT *, "full" + CAST(tail > 0 AS BIGINT) AS blocks,
         coalesce(quota // nullif(n, 0), 0) AS rounds FROM blocks0),
blocks2 AS (
  SELECT *, least((quota - rounds * n) // {BLOCK}, "full") AS further FROM blocks1),
blocks3 AS (SELECT *, quota - rounds * n - further * {BLOCK} AS cut FROM blocks2),
sources AS (
  SELECT *, rounds * blocks + further + CAST(cut > 0 AS BIGINT) AS wanted,
         greatest(CAST(ceil(sqrt(CAST("full" AS DOUBLE))) AS BIGINT), 1) AS wide FROM blocks3),
lots AS (SELECT rank, wanted, sum(wanted) OVER (ORDER BY rank) - wanted AS first FROM sources),
tickets AS (
  SELECT t, CAST('0x' || substr(md5(CAST(t AS VARCHAR)), 1, 15) AS BIGINT)
         % (SELECT sum(wanted) FROM sources) AS u
  FROM range((SELECT CAST(sum(wanted) AS BIGINT) FROM sources)) AS r(t)),
drawn AS (
  SELECT t, rank, wanted, row_number() OVER (PARTITION BY rank ORDER BY t) - 1 AS nth
  FROM tickets ASOF JOIN (SELECT * FROM lots WHERE wanted > 0) l ON u >= l.first),
settled AS (
  SELECT s.rank, coalesce(c.n, 0) AS times, greatest(coalesce(c.n, 0) - wanted, 0) AS over_,
         greatest(wanted - coalesce(c.n, 0), 0) AS under
  FROM sources s LEFT JOIN (SELECT rank, count(*) AS n FROM drawn GROUP BY rank) c USING (rank)),
lines AS (
  SELECT *, sum(over_) OVER (ORDER BY rank) - over_ AS over_first,
         sum(under) OVER (ORDER BY rank) - under AS under_first FROM settled),
spare AS (
  SELECT d.t, l.over_first + d.nth - d.wanted AS g
  FROM drawn d JOIN lines l USING (rank) WHERE d.nth >= d.wanted),
uses AS (
  SELECT t, rank, nth FROM drawn WHERE nth < wanted
  UNION ALL
  SELECT t, l.rank, CAST(l.times + g - l.under_first AS BIGINT)
  FROM spare ASOF JOIN (SELECT * FROM lines WHERE under > 0) l ON g >= l.under_first),
turned AS (
  SELECT u.t, u.rank, u.nth, s."full", s.tail, s.wanted, s.cut, s.wide,
         (s."full" + s.wide - 1) // s.wide AS high, u.nth % s.blocks AS position,
         (u.rank * {MOST + 1} + u.nth // s.blocks + 1) * 7919 % 2147483647 AS seed
  FROM uses u JOIN sources s USING (rank)),
stepped AS (
  SELECT *, CASE WHEN position < "full" THEN {permuted("position")} ELSE "full" END AS v0
  FROM turned),
slots AS (
  SELECT rank, block, CASE WHEN nth = wanted - 1 AND cut > 0 THEN cut
         WHEN block < "full" THEN {BLOCK} ELSE tail END AS words
  FROM (SELECT *, CASE WHEN position >= "full" OR v0 < "full" THEN v0 ELSE list_reduce(
          list_prepend(v0, range(wide * high - "full" + 1)),
          lambda v, i: CASE WHEN v < "full" THEN v ELSE {permuted("v")} END) END AS block
        FROM stepped)),
spans AS (
  SELECT s.rank, r.o, r.size, unnest(range(r.o // {BLOCK}, (r.o + r.size - 1) // {BLOCK} + 1)) AS block
  FROM rows r JOIN sources s USING (none, name) WHERE r.size > 0),
taken AS (
  SELECT p.rank, p.o, CAST(sum(greatest(least(p.o + p.size, p.block * {BLOCK} + u.words)
         - greatest(p.o, p.block * {BLOCK}), 0)) AS BIGINT) AS taken
  FROM spans p JOIN slots u USING (rank, block) GROUP BY p.rank, p.o)
SELECT r.doc_id, r.size, s.n AS source_size, s.target,
       CASE WHEN r.size > 0 THEN coalesce(t.taken, 0) ELSE 0 END AS taken
FROM rows r JOIN sources s USING (none, name)
LEFT JOIN taken t ON t.rank = s.rank AND t.o = r.o
"""
