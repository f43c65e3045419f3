"""Exact dedup through an extendible-hash index on shared files; DataFrame functions only.

The key of a text is the 64-bit hash of its normalised form. The directory starts with one bucket
and doubles as long as a bucket holds more than ``capacity`` keys or too many bytes; only overfull
buckets are split. Each bucket is a range of keys with one owner task, to which the documents of the
range send their raw texts. The owner sorts them and compares neighbours byte by byte: equal texts
share a link of their key's chain, and every document gets back (bucket, key, link). A key with many
rows or bytes, such as a text that makes up a third of the table, is dealt to several owners by a
salt; their chains, one text per link, are then merged by the same comparison.

The index on shared files holds one entry per link, with the largest id and the number of rows. A
document is answered by the entry its link names; no digest of a text takes part in that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import ascii_lower, free_name, id_and_text, written

CAPACITY = 65_536
#: Bytes of text a bucket holds before it is split. Small, so that a task owns many buckets and all
#: tasks about as much.
BUCKET_BYTES = 4 << 20
#: Rows of one key that go to one owner; beyond them, or beyond ``BUCKET_BYTES``, a key is salted.
OWNER_ROWS = 4_096
#: Buckets, and salted keys, that a table has at most: the three limits above rise with the table
#: so far that the routing tables, which are broadcast, stay below some 50 MB.
ROUTES = 1 << 20
#: Directory bits added per round.
STEP = 12
#: What names a text: where its owner put it, and its place in the merged chain of its key.
LINK = ["bucket", "key", "salt", "link"]
ENTRY = ["bucket", "key", "chain"]


def _prefix(key, depth):
    """The first ``depth`` bits of the key, as a number."""
    if isinstance(depth, int):
        return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftrightunsigned", key, (F.lit(64) - depth).cast("int")))


def directory(keys: DataFrame, capacity: int = CAPACITY,
              bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The directory as a written table: ``depth, prefix, bucket``, one row per bucket.

    ``keys`` holds each ``key`` once, with the ``bytes`` one owner gets of it. A bucket is named by
    the first key of its range, as a signed number. One whose keys are all equal is not split.

    Each round looks ``STEP`` bits further into the overfull buckets: cells are counted and summed
    up to the buckets above them in Spark, and those that fit below one that does not are done. The
    driver sees one number per round.
    """
    spark = keys.sparkSession
    sums = (F.sum("n").alias("n"), F.sum("bytes").alias("bytes"),
            F.min("a").alias("a"), F.max("b").alias("b"))
    start, leaves = 0, None
    overfull = spark.range(1).select(F.lit(0).cast("long").alias("prefix"))
    while True:
        depth = min(start + STEP, 64)
        inside = keys.withColumn("prefix", _prefix(F.col("key"), start)).join(
            overfull, "prefix", "left_semi")
        cells = inside.groupBy(_prefix(F.col("key"), depth).alias("cell")).agg(
            F.count("*").alias("n"), F.sum("bytes").alias("bytes"),
            F.min("key").alias("a"), F.max("key").alias("b"))
        # The first round starts with the whole table as a bucket, later ones below known buckets.
        levels = F.explode(F.sequence(F.lit(start + 1 if start else 0), F.lit(depth)))
        above = F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.call_function(
            "shiftrightunsigned", F.col("cell"), F.lit(depth) - F.col("depth")))
        full = ((F.col("n") > capacity) | (F.col("bytes") > bucket_bytes)) & (
            F.col("a") != F.col("b"))
        nodes = written(
            cells.withColumn("depth", levels).groupBy("depth", above.alias("prefix")).agg(*sums)
            .select("depth", "prefix", full.alias("full")), "dedup-nodes")
        split = nodes.where("full").select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        top = nodes.where((F.col("depth") == (start + 1 if start else 0)) & ~F.col("full"))
        below = nodes.where(~F.col("full") & (F.col("depth") > 0)).withColumn(
            "parent", F.call_function("shiftrightunsigned", F.col("prefix"), F.lit(1)))
        done = top.select("depth", "prefix").unionByName(
            below.join(split, ["depth", "parent"], "left_semi").select("depth", "prefix"))
        leaves = done if leaves is None else leaves.unionByName(done)
        overfull = nodes.where(F.col("full") & (F.col("depth") == depth)).select("prefix")
        if depth == 64 or not overfull.limit(1).count():
            break
        start = depth
    bucket = F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", F.col("prefix"), F.lit(64) - F.col("depth")))
    return written(leaves.select("depth", "prefix", bucket.alias("bucket")), "dedup-directory")


def _routed(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """``rows`` with the ``bucket`` of their key: the one whose prefix it starts with.

    Every row meets one cell of the directory, whatever the number of depths. A cell is a prefix of
    as many bits as there are doublings in the number of buckets: a bucket above takes all cells
    below it, fewer than there are buckets, and buckets below a cell are a list in it.
    """
    buckets = slots.count()
    if not buckets:
        return rows.withColumn("bucket", F.lit(0).cast("long"))
    depth = buckets.bit_length() - 1
    above = F.greatest(F.lit(depth) - F.col("depth"), F.lit(0))
    first = _prefix(F.col("bucket"), depth)
    last = first + F.call_function("shiftleft", F.lit(1).cast("long"), above) - 1
    cells = slots.select("bucket", F.explode(F.sequence(first, last)).alias("cell")).groupBy(
        "cell").agg(F.collect_list("bucket").alias("starts"))
    # Keys of a cell share its bits, the sign among them, so signed numbers are in order there.
    own = F.when(F.size("starts") == 1, F.col("starts")[0]).otherwise(
        F.array_max(F.filter("starts", lambda start: start <= F.col("key"))))
    return rows.join(F.broadcast(cells), _prefix(F.col("key"), depth) == F.col("cell")).withColumn(
        "bucket", own).drop("cell", "starts")


def build_index(documents: DataFrame, capacity: int = CAPACITY, key_bits: int = 64,
                bucket_bytes: int = BUCKET_BYTES,
                owner_rows: int = OWNER_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(log, links, index)``, all on shared files.

    ``log``: ``doc_id, bucket, key, salt, salted, link`` per row of the table, as its owner found
    it; the first row of a link holds the digest and, of a salted key, the text. ``index``:
    ``bucket, key, chain, salted, keep_id, group_size, text_sha256`` per different text; ``chain``
    counts the texts that share a key. ``links``: the ``chain`` of each ``salt, link`` of a salted
    key; other keys have one owner, whose links are the chain. Fewer ``key_bits`` make keys collide,
    for tests.
    """
    norm = ascii_lower(F.col("text"))
    key = F.xxhash64("norm")
    if key_bits < 64:
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)
    rows = id_and_text(documents).select("doc_id", norm.alias("norm")).withColumn("key", key)
    counted = written(
        rows.groupBy("key").agg(F.count("*").alias("n"),
                                F.sum(F.octet_length("norm")).alias("bytes")), "dedup-keys")
    total = counted.agg(F.count("*").alias("keys"), F.sum("n").alias("n"),
                        F.sum("bytes").alias("bytes")).first()
    share = ROUTES // 2
    capacity = max(capacity, (total["keys"] or 0) // share)
    bucket_bytes = max(bucket_bytes, (total["bytes"] or 0) // share)
    owner_rows = max(owner_rows, (total["n"] or 0) // share)
    salts = F.ceil(F.greatest(F.col("n") / owner_rows, F.col("bytes") / bucket_bytes, F.lit(1.0)))
    # A single text beyond the limit stays one piece: no more salts than rows.
    salts = F.least(salts.cast("long"), F.col("n"))
    counted = counted.withColumn("salts", salts)
    slots = directory(counted.select("key", (F.col("bytes") / F.col("salts")).alias("bytes")),
                      capacity, bucket_bytes)
    hot = counted.where("salts > 1").select("key", "salts")
    # Numbered by place in the scan, so that rows of one id, or of none, are dealt out as well.
    dealt = _routed(rows.withColumn("place", F.monotonically_increasing_id()), slots).join(
        F.broadcast(hot), "key", "left")
    salt = F.when(F.col("salts").isNull(), F.lit(0).cast("long")).otherwise(
        F.pmod(F.xxhash64("place"), F.col("salts")))
    owned = dealt.select("doc_id", "norm", "key", "bucket", salt.alias("salt"),
                         F.col("salts").isNotNull().alias("salted")).repartition("bucket", "salt")
    within = Window.partitionBy("bucket", "key", "salt").orderBy("norm")
    linked = owned.withColumn("link", F.dense_rank().over(within)).withColumn(
        "first", ~F.col("norm").eqNullSafe(F.lag("norm").over(within)))
    log = written(linked.select(
        "doc_id", "bucket", "key", "salt", "salted", "link",
        F.when(F.col("first"), F.sha2("norm", 256)).alias("text_sha256"),
        F.when(F.col("first") & F.col("salted"), F.col("norm")).alias("norm")), "dedup-log")
    # Owners of one salted key have a chain each: the same text gets the same place in one chain.
    merged = Window.partitionBy("bucket", "key").orderBy("norm")
    links = written(log.where("salted AND norm IS NOT NULL").select(
        *LINK, F.dense_rank().over(merged).alias("chain")), "dedup-links")
    log = log.drop("norm")
    plain = log.where("NOT salted").withColumn("chain", F.col("link"))
    index = plain.unionByName(log.where("salted").join(links, LINK)).groupBy(
        *ENTRY, "salted").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"),
            F.max("text_sha256").alias("text_sha256"))
    return log, links, written(
        index.repartition("bucket").sortWithinPartitions(*ENTRY), "dedup-index")


def exact_dedup(documents: DataFrame, capacity: int = CAPACITY, key_bits: int = 64,
                bucket_bytes: int = BUCKET_BYTES, owner_rows: int = OWNER_ROWS) -> DataFrame:
    """One row per row of the table: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal
    texts the row with the largest ``doc_id`` stays. A row whose ``doc_id`` is null counts in its
    group, and stays only if no row of the group has an id. A row repeated with its id stays or
    goes as often as it is there. Other columns are not read. An empty table gives no rows.
    """
    log, links, index = build_index(documents, capacity, key_bits, bucket_bytes, owner_rows)
    # Only copies need the lookup: a text that is alone is its own group.
    copies = index.where("group_size > 1").withColumnRenamed("text_sha256", "sha")
    of_owner = copies.where("NOT salted").withColumn("salt", F.lit(0).cast("long")).withColumn(
        "link", F.col("chain"))
    answers = of_owner.unionByName(copies.where("salted").join(links, ENTRY)).select(
        *LINK, "keep_id", "group_size", "sha")
    # No more than the rows of one owner meet one answer.
    found = log.join(answers, LINK, "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.coalesce("sha", "text_sha256").alias("text_sha256"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of repeated rows of one id, one."""
    own_id, sha = free_name(documents, "_id"), free_name(documents, "_sha")
    stay = exact_dedup(documents).where("kept").select(
        F.coalesce("doc_id", F.lit(-1 << 63)).alias(own_id), F.col("text_sha256").alias(sha))
    norm = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    marked = documents.withColumns({
        own_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)), sha: F.sha2(norm, 256)})
    return marked.join(stay.distinct(), [own_id, sha], "left_semi").dropDuplicates(
        [own_id, sha]).drop(own_id, sha)


SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
