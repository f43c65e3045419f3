"""SimHash near-dedup by tiled exact comparison.

Fingerprints are compared exactly: exclusive-or and bit counts over tiles of numpy arrays. Two
things spare work and lose no pair. Fingerprints within ``radius`` bits agree in at least one of
the ways to leave ``radius`` of ``blocks`` blocks out, so only those that agree there meet in one
tile set. Within a set, sorted by population count, tile pairs whose counts differ beyond the
radius are skipped, and so are pairs that are known to be connected already.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import free_name, id_and_text, prepare_workers, text_name, written
from medallion.llm.components import components

SEED = 42
WIDTH = 4
RADIUS = 4
TILE = 512
#: Fingerprints of one tile set that a task compares at once; larger sets are cut into pairs of
#: chunks, so the memory of a task does not grow with the set.
CHUNK = 16_384
#: Fingerprints to a tile set on average before more, narrower sets are used.
SET_SIZE = 2_048
_SLICE = 16_384


def fingerprint(text: str, width: int = WIDTH) -> int:
    """64 bits; bit i is set if it is set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - (lengths - 1)
    take = min(width, len(words))
    n = len(words) - take + 1
    counts = np.zeros((8, 8), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _SLICE):
        to = min(at + _SLICE, n)
        hashes = np.array(
            [digest(joined[s:e], SEED) for s, e in zip(
                starts[at:to].tolist(), ends[at + take - 1:to + take - 1].tolist(), strict=True)],
            np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64).reshape(8, 8)
    packed = np.packbits((2 * counts > n).astype(np.uint8), axis=1, bitorder="little")
    return int(packed.reshape(8).view("<u8")[0])


def fingerprints(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, th, fp`` per row: id, the text's hash, and the fingerprint as a signed 64-bit
    integer; a text without words gives 0."""
    prepare_workers(documents.sparkSession)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(fps.view(np.int64))],
                names=["doc_id", "th", "fp"])

    rows = id_and_text(documents).withColumn("th", text_name(F.col("text")))
    return rows.mapInArrow(run, "doc_id long, th string, fp long")


def _agreeing(blocks: int, radius: int) -> list[int]:
    """Masks of the blocks that agree, one for each way to leave ``radius`` blocks out."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def blocks_for(count: int, radius: int) -> int:
    """The fewest blocks whose tile sets hold about SET_SIZE fingerprints or fewer."""
    for blocks in range(radius + 1, 2 * radius + 1):
        if count >> (64 * (blocks - radius) // blocks) <= SET_SIZE:
            return blocks
    return 2 * radius


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def tile_sets(distinct: DataFrame, blocks: int, radius: int, chunk: int = CHUNK) -> DataFrame:
    """``key, i, j, part, fp``: each fingerprint in every set it belongs to.

    A set of more than ``chunk`` is dealt into chunks, and every pair (i, j) of them is one set.
    """
    keys: list[Column] = [
        F.struct(F.lit(n).alias("way"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("bits"))
        for n, mask in enumerate(_agreeing(blocks, radius))]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select(
        F.col("k.way").alias("way"), F.col("k.bits").alias("bits"), "fp")
    large = rows.groupBy("way", "bits").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
    sized = rows.join(large, ["way", "bits"], "left")
    chunks = F.coalesce(F.ceil(F.col("n") / chunk), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    placed = sized.select("way", "bits", "fp", chunks.alias("chunks"), own.alias("own")).select(
        "way", "bits", "fp", "own",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    return placed.select(
        "way", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "fp")


class _Forest:
    """Union-find over the positions of one set."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.joined: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.joined.append((a, b))


def _stars(near: np.ndarray) -> list[tuple[int, int]]:
    """Row and column pairs that connect what the matrix connects, at most rows plus columns."""
    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near = near[np.ix_(rows, columns)]
    # Smallest row each column reaches, then each row, until nothing changes.
    of_row = np.arange(len(rows))
    pairs = set()
    while True:
        reach = np.where(near, of_row[:, None], len(rows))
        of_column, first = reach.min(axis=0), reach.argmin(axis=0)
        pairs.update((int(rows[r]), int(columns[c])) for c, r in enumerate(first))
        back = np.where(near, of_column[None, :], len(rows))
        better, where = back.min(axis=1), back.argmin(axis=1)
        changed = better < of_row
        pairs.update((int(rows[r]), int(columns[where[r]])) for r in np.flatnonzero(changed))
        if not changed.any():
            return list(pairs)
        of_row = np.minimum(of_row, better)


def linked(fps: np.ndarray, radius: int = RADIUS, tile: int = TILE) -> np.ndarray:
    """Pairs (rows of two) that connect all fingerprints of a set linked within it: a forest."""
    fps = fps[np.argsort(np.bitwise_count(fps), kind="stable")]
    counts = np.bitwise_count(fps).astype(np.int64)
    n = len(fps)
    forest = _Forest(n)
    for a in range(0, n, tile):
        left = fps[a:a + tile]
        for b in range(a, n, tile):
            if counts[b] - counts[min(a + tile, n) - 1] > radius:
                break  # sorted: no later tile is nearer
            right = fps[b:b + tile]
            if forest.joined:
                root = forest.find(a)
                if all(forest.find(x) == root for x in (
                        *range(a, a + len(left)), *range(b, b + len(right)))):
                    continue
            near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
            if a == b:
                np.fill_diagonal(near, False)
            if near.any():
                for x, y in _stars(near):
                    forest.join(a + x, b + y)
    return fps[np.array(forest.joined, np.int64).reshape(-1, 2)]


def _compare(radius: int):
    def run(batches):
        def link(fps: np.ndarray):
            if len(fps) > 1:
                found = linked(np.unique(fps.view(np.uint64)), radius)
                if len(found):
                    pairs = found.view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ascontiguousarray(pairs[:, 0])),
                         pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["a", "b"])

        held: list[np.ndarray] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.stack([batch.column(c).to_numpy().astype(np.int64)
                                for c in ("way", "bits", "i", "j")])
            fps = batch.column("fp").to_numpy()
            new = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
            cuts = [0, *new.tolist(), len(fps)]
            for at, to in zip(cuts, cuts[1:], strict=False):
                own = tuple(columns[:, at].tolist())
                if own != key and held:
                    yield from link(np.concatenate(held))
                    held = []
                key = own
                held.append(fps[at:to])
        if held:
            yield from link(np.concatenate(held))
    return run


def links(distinct: DataFrame, radius: int = RADIUS, chunk: int = CHUNK,
          blocks: int | None = None) -> DataFrame:
    """``a, b``: links between different fingerprints ``fp`` that connect all within ``radius``."""
    prepare_workers(distinct.sparkSession)
    blocks = blocks or blocks_for(distinct.count(), radius)
    key = ["way", "bits", "i", "j"]
    sets = tile_sets(distinct, blocks, radius, chunk)
    return sets.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _compare(radius), "a long, b long")


def labelled(documents: DataFrame, width: int = WIDTH, radius: int = RADIUS,
             chunk: int = CHUNK) -> DataFrame:
    """``doc_id, th, fp, root, component_id`` per row; ``root`` is a component's smallest
    fingerprint and stands for it even where no row has an id."""
    rows = written(fingerprints(documents, width), "simhash")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"),
                                              F.count("*").alias("n")), "simhash")
    roots = components(links(distinct.select("fp"), radius, chunk), "simhash")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.sum("n").alias("rows")).where("rows > 1")
    # What is alone names itself and needs no lookup.
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp", "left").select(
        "doc_id", "th", "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"))


def near_dedup(documents: DataFrame, width: int = WIDTH, radius: int = RADIUS,
               chunk: int = CHUNK) -> DataFrame:
    """One row per row of the table: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the smallest ``doc_id`` that can
    be reached over links, equal fingerprints included. Null and blank texts have fingerprint zero
    and are linked like any other. A null ``doc_id`` is in its component but never names it; a
    component of such rows alone has a null id. Repeated rows come out each. Other columns are not
    read; an empty table gives no rows.
    """
    return labelled(documents, width, radius, chunk).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(documents: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """The documents without their near copies, with all their columns: of each component the row
    with the smallest ``doc_id`` (rows without an id come last; ties by the text's hash); of rows
    that repeat it, one."""
    last, (sid, th) = F.lit((1 << 63) - 1), (free_name(documents, n) for n in ("_sid", "_th"))
    stay = labelled(documents, width, radius).groupBy("root").agg(
        F.min(F.struct(F.coalesce("doc_id", last).alias("id"), "th")).alias("s")).select(
        F.col("s.id").alias(sid), F.col("s.th").alias(th)).distinct()
    marked = documents.withColumns({
        sid: F.coalesce(F.col("doc_id").cast("long"), last),
        th: text_name(F.col("text"))})
    return marked.join(stay, [sid, th], "left_semi").dropDuplicates([sid, th]).drop(sid, th)
