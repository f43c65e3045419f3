"""Every operator against a plain version of itself, on awkward tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from tokenizers import Tokenizer

from medallion.llm import (
    exact_dedup, language_id, line_dedup, lm_scoring, packing, simhash, token_counts, toxicity,
)
from medallion.llm.components import components
from tests.llm import edge

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORD_BPE)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def bag(rows):
    return Counter(tuple(row) for row in rows)


# Token counts

def test_token_counts_are_the_librarys(spark, tokenizer):
    found = token_counts.count_tokens(edge.documents(spark), WORD_BPE, limit=5)
    want = bag((d, len((t or "").encode()), len(ids(tokenizer, t)), len(ids(tokenizer, t)) > 5)
               for d, t, *_ in edge.ROWS)
    assert bag(found.collect()) == want
    assert token_counts.count_tokens(edge.empty(spark), WORD_BPE).count() == 0


def test_word_encoder_on_odd_text(tokenizer):
    from medallion.llm.wordbpe import WordEncoder, prove_whole_tokens

    whole = prove_whole_tokens(WORD_BPE)
    encoder = WordEncoder(WORD_BPE, whole)
    random = np.random.default_rng(3)
    letters = list("aAbZ thTHé ñßÑ'\n\t\x0b\x1c\x85\xa0 　!?..,ΣςİḰﬁ中😀") + [
        "<|endoftext|>", "<|STARTOFTEXT|>", "'s", "'re"]
    for _ in range(1_500):
        text = "".join(random.choice(letters, random.integers(0, 25)))
        want = ids(tokenizer, text)
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, repr(text)
        assert encoder.count(text) == len(want)
    for word in list(whole)[::701]:
        assert len(tokenizer.model.tokenize(word)) == 1


# Packing

def test_packing_is_whole_and_tight(spark, tokenizer):
    capacity = 64
    found = packing.pack(edge.documents(spark), WORD_BPE, capacity=capacity, keep_ids=True).collect()
    want = Counter()
    for d, t, *_ in edge.ROWS:
        own = [*ids(tokenizer, t), 1]
        for piece, at in enumerate(range(0, len(own), capacity)):
            part = own[at:at + capacity]
            want[(d, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    least = math.ceil(sum(r.length for r in found) / capacity)
    assert len(bins) <= least + 1
    assert packing.pack(edge.empty(spark), WORD_BPE).count() == 0


def test_sequences_join_the_pieces(spark):
    pieces = packing.pack(edge.documents(spark), WORD_BPE, capacity=4096, keep_ids=True)
    for row in packing.sequences(pieces).collect():
        assert len(row.ids) == 4 * row.length


def test_best_fit_takes_the_fullest_bin():
    bins = packing.best_fit(np.array([6, 5, 4, 4, 1]), 10)
    fills = np.bincount(bins, weights=[6, 5, 4, 4, 1])
    assert sorted(fills) == [10, 10]


def test_packing_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "PER_TASK", 40)
    random = np.random.default_rng(1)
    rows = [(i, " ".join(["cat"] * int(n)), "en", "s")
            for i, n in enumerate(random.integers(0, 60, 400))]
    found = packing.pack(edge.documents(spark, rows).repartition(8), WORD_BPE, capacity=64).collect()
    assert sorted(r.doc_id for r in found) == list(range(400))
    assert len({r.sequence_id for r in found}) <= 1.1 * math.ceil(sum(r.length for r in found) / 64)


# Exact dedup

def copies(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[(t or "").translate(LOWER)].append(d)
    out = []
    for d, t, *_ in rows:
        norm = (t or "").translate(LOWER)
        own = groups[norm]
        named = [x for x in own if x is not None]
        keep = max(named) if named else None
        out.append((d, keep, len(own), d == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("key_bits", [64, 3, 1])
@pytest.mark.parametrize("owner_rows", [4_096, 1])
def test_exact_dedup(spark, key_bits, owner_rows):
    """Few bits make most keys collide; one row an owner salts every copy."""
    found = exact_dedup.exact_dedup(
        edge.documents(spark), capacity=2, key_bits=key_bits, owner_rows=owner_rows)
    assert bag(found.collect()) == copies(edge.ROWS)
    assert exact_dedup.exact_dedup(edge.empty(spark)).count() == 0


def test_copies_of_one_text_are_dealt_to_several_owners(spark):
    rows = [(i % 50 or None, "the same TEXT" if i % 3 else f"text {i % 40}", "en", "s")
            for i in range(600)]
    table = edge.documents(spark, rows).repartition(5)
    log, links, index = exact_dedup.build_index(table, capacity=8, key_bits=4, owner_rows=20)
    assert max(Counter((r.key, r.salt) for r in log.collect()).values()) <= 45
    assert links.count() > index.count()
    found = exact_dedup.exact_dedup(table, capacity=8, key_bits=4, owner_rows=20)
    assert bag(found.collect()) == copies(rows)


def test_the_index_answers(spark, monkeypatch):
    """What the files of the index say is what comes out."""
    build = exact_dedup.build_index

    def changed(*arguments):
        log, links, index = build(*arguments)
        return log, links, index.withColumn("keep_id", index.keep_id + 1_000)

    monkeypatch.setattr(exact_dedup, "build_index", changed)
    found = exact_dedup.exact_dedup(edge.documents(spark)).where("group_size > 1")
    assert found.count() and not found.where("keep_id < 1000").count()


def test_directory_splits_only_overfull_buckets(spark):
    log, _, index = exact_dedup.build_index(edge.documents(spark), capacity=2)
    sizes = Counter(r.bucket for r in index.collect())
    assert max(sizes.values()) <= 2
    assert log.count() == len(edge.ROWS)


def plain_directory(keys, capacity, depth=0, prefix=0):
    """The buckets by plain recursion over the bits; ``keys`` as unsigned numbers."""
    if not keys and depth:
        return set()
    if len(keys) <= capacity or len(set(keys)) == 1 or depth == 64:
        return {(depth, prefix)}
    side = [[], []]
    for key in keys:
        side[key >> (63 - depth) & 1].append(key)
    return {leaf for bit in (0, 1) for leaf in
            plain_directory(side[bit], capacity, depth + 1, 2 * prefix + bit)}


def test_a_row_is_routed_by_one_join_whatever_the_depths(spark):
    random = np.random.default_rng(11)
    keys = [int(k) for k in random.integers(-1 << 63, 1 << 63, 200, dtype=np.int64)]
    keys += [-1, -2, -3, 0, 1, -1 << 63, (1 << 63) - 1, 1 << 40, (1 << 40) + 1]
    table = spark.createDataFrame([(k, 1.0) for k in keys], "key long, bytes double")
    slots = exact_dedup.directory(table, capacity=2, bucket_bytes=1 << 40)
    assert len({r.depth for r in slots.collect()}) > 3
    routed = exact_dedup._routed(table.select("key"), slots)
    assert routed._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    starts = sorted(r.bucket % (1 << 64) for r in slots.collect())
    found = {r.key: r.bucket for r in routed.collect()}
    assert len(found) == len(set(keys)) and routed.count() == len(keys)
    for key, bucket in found.items():
        assert bucket % (1 << 64) == max(s for s in starts if s <= key % (1 << 64))
    alone = slots.where("false").unionByName(spark.createDataFrame([(0, 0, 0)], slots.schema))
    assert {r.bucket for r in exact_dedup._routed(table, alone).collect()} == {0}


def test_directory_in_several_rounds(spark, monkeypatch):
    """Keys that share their first bits need more rounds; the driver sees a number per round."""
    random = np.random.default_rng(7)
    keys = [int(k) for k in random.integers(0, 1 << 63, 300, dtype=np.int64)]
    keys += [(0xABC << 52) | (0x123 << 40) | int(k) for k in random.integers(0, 1 << 40, 60)]
    keys += [(1 << 64) - 1, (1 << 64) - 2, (1 << 64) - 3]
    signed = [k - (1 << 64) if k >> 63 else k for k in keys]
    table = spark.createDataFrame([(k, 1.0) for k in signed], "key long, bytes double")
    frame, collected = type(table), []
    plain_collect = frame.collect

    def counting(self):
        rows = plain_collect(self)
        collected.append(len(rows))
        return rows

    monkeypatch.setattr(frame, "collect", counting)
    slots = exact_dedup.directory(table, capacity=2, bucket_bytes=1 << 40)
    assert sum(collected) == 0
    monkeypatch.undo()
    rows = slots.collect()
    unsigned = {(r.depth, r.prefix % (1 << 64)) for r in rows}
    assert unsigned == plain_directory(keys, 2)
    assert max(r.depth for r in rows) > 2 * exact_dedup.STEP
    assert len({r.bucket for r in rows}) == len(rows)
    heavy = spark.createDataFrame([(1, 10.0), (-1, 10.0)], "key long, bytes double")
    assert exact_dedup.directory(heavy, 100, 30).count() == 1
    assert exact_dedup.directory(heavy, 100, 15).count() == 2


def test_deduplicated_keeps_columns_and_one_row(spark):
    kept = exact_dedup.deduplicated(edge.documents(spark))
    assert kept.columns == edge.documents(spark).columns
    assert kept.count() == len({(t or "").translate(LOWER) for _, t, *_ in edge.ROWS})


# Line dedup

def deduped_lines(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    rank = lambda d: -(1 << 63) if d is None else d
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(rank(d))
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (
            len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs
            and max(holders[key(x)]) != rank(d))]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_line_dedup(spark, partitions):
    """A line in half of the rows is cut over many ranges when there are seven."""
    rows = list(edge.ROWS) + [
        (100 + i, f"{edge.SHARED}\nline number {i % 40} that comes again\n \t{edge.SHARED.upper()} ",
         "en", "s") for i in range(120)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = line_dedup.dedup_lines(edge.documents(spark, rows).repartition(3))
        assert bag(found.collect()) == deduped_lines(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert line_dedup.dedup_lines(edge.empty(spark)).count() == 0


def test_bitmap_round_trip():
    bitmap = line_dedup.pack_bitmap(np.array([1, 9]), 11)
    assert line_dedup.unpack_bitmap(bitmap, 11).tolist() == [1, 0, 1, 1, 1, 1, 1, 1, 1, 0, 1]


# SimHash

def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(
        bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=4):
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ordered = sorted(up)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {f: find(f) for f in up}


def test_near_dedup(spark):
    rows = list(edge.ROWS) + [
        (200 + i, " ".join(f"w{j}" for j in range(300)) + f" tail{i}", "en", "s") for i in range(20)]
    found = simhash.near_dedup(edge.documents(spark, rows), chunk=4).collect()
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    roots = plain_components(fps)
    least = {}
    for (d, *_), fp in zip(rows, fps, strict=True):
        if d is not None:
            least[roots[fp]] = min(least.get(roots[fp], d), d)
    want = Counter((d, f"{fp:016x}", least.get(roots[fp]))
                   for (d, *_), fp in zip(rows, fps, strict=True))
    assert bag(found) == want
    assert simhash.near_dedup(edge.empty(spark)).count() == 0
    kept = simhash.representatives(edge.documents(spark, rows))
    assert kept.count() == len(set(roots.values()))


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_tiles_lose_no_link(spark, blocks):
    random = np.random.default_rng(2)
    fps = set()
    for base in random.integers(0, 2**63, 40):
        for _ in range(12):
            fp = int(base)
            for bit in random.integers(0, 64, random.integers(0, 6)):
                fp ^= 1 << int(bit)
            fps.add(fp)
    want = plain_components(fps)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = simhash.links(table, chunk=30, blocks=blocks).collect()
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in found:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 4
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    assert {f: find(f) for f in fps} == want


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 9)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(1, 31)}, **{100 + i: 100 for i in range(1, 9)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Language identification

def test_language_id(spark):
    words = {"en": "the and that with from there", "de": "der und nicht schön über größe",
             "es": "el los niño señor mañana que"}
    random = np.random.default_rng(4)
    rows = [(i, " ".join(random.choice(words[lang].split(), 30)), lang, "s")
            for i, lang in enumerate(["en", "de", "es"] * 60)]
    rows += [(1000, None, "en", "s"), (1001, "12 !?", "de", "s"), (1002, "", None, "s"),
             (None, "der und nicht", None, "s"), (1003, "the and " * 200_000, "en", "s")]
    found = language_id.identify(edge.documents(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for d, _, lang, _ in rows[:180]:
        assert by_id[d].lang_pred == lang
        assert by_id[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0.5 < by_id[d].score <= 1
    assert [by_id[d].lang_pred for d in (1000, 1001, 1002)] == ["und"] * 3
    assert by_id[1003].lang_pred == "en" and by_id[None].lang_pred == "de"
    nothing = language_id.identify(edge.documents(spark, [(1, "text", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert language_id.identify(edge.empty(spark)).count() == 0


def test_filter_gives_all_languages_and_few_others():
    built = language_id.Filter.empty([f"l{i}" for i in range(70)], slot_bits=14)
    keys = np.arange(1, 301, dtype=np.uint64) * np.uint64(7919)
    built.add(keys, np.zeros(300, np.int64))
    built.add(keys[:100], np.full(100, 69))
    masks = built.containing(keys)
    assert ((masks[:, 0] & np.uint64(1)) == 1).all()
    assert ((masks[:100, 1] >> np.uint64(5)) & np.uint64(1) == 1).all()
    others = built.containing(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))
    assert ((others[:, 0] & np.uint64(1)) == 1).mean() < built.false_positives()[0] + 0.01


# Toxicity

def test_toxicity_finds_labelled_words(spark):
    random = np.random.default_rng(5)
    plain = "river stone garden window table morning little yellow".split()
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = list(random.choice(plain, 40))
        if toxic:
            words[5] = words[20] = words[30] = "blorgface"
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(toxic)))
    rows += [(None, "river", "en", "s"), (9000, None, "en", "s"), (9001, "", "en", "s")]
    labels += [(None, 1), (9000, None), (12345, 1), labels[0]]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.score_toxicity(edge.documents(spark, rows), table).collect()
    assert len(found) == len(rows)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 50
    assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert {r.predicted for r in found if r.doc_id in (9000, 9001)} == {0}
    none = toxicity.score_toxicity(edge.documents(spark, rows[:3]), table.where("toxic = 0"))
    assert {r.score for r in none.collect()} == {0.0}
    assert toxicity.score_toxicity(edge.empty(spark), table).count() == 0


def plain_features(texts, own=None):
    """Kneser-Ney by its definition, document by document; ``own``: class of the text taken out."""
    labels = [int("vile" in t) for t in texts]
    sets = [set(re.findall(r"\w+", t.lower())) for t in texts]
    def model(skip):
        n = [Counter(), Counter()]
        for k, (words, label) in enumerate(zip(sets, labels)):
            n[label].update(words)
        known = {w for w in n[0] | n[1] if n[0][w] + n[1][w] >= 2}
        totals, kinds = [sum(c.values()) for c in n], [len(c) for c in n]
        whole = sum(n[0][w] + n[1][w] for w in known) + 0.5 * (len(known) + 1)
        def ratio(word):
            c = [n[y][word] - (skip is not None and y == labels[skip] and word in sets[skip])
                 if word in known else 0 for y in (0, 1)]
            back = (c[0] + c[1] + 0.5) / whole
            p = [(max(c[y] - 0.75, 0) + 0.75 * kinds[y] * back) / totals[y] for y in (0, 1)]
            return math.log(p[1] / p[0])
        return ratio
    rows = []
    for k, text in enumerate(texts):
        ratio = model(k if own else None)
        values = [ratio(w) - ratio("\0") for w in re.findall(r"\w+", text.lower())]
        runs = [sum(values[i:i + 3]) / 3 for i in range(len(values) - 2)]
        rows.append((np.mean(values), max(values), max(runs, default=np.mean(values))))
    return np.array(rows)


def test_toxicity_is_plain_kneser_ney(spark):
    random = np.random.default_rng(4)
    words = [f"w{k}" for k in range(30)] + ["Vile", "Ärger", "mean"]
    texts = [" ".join(random.choice(words[:-3] + words[-3:] * (k % 3 == 0), random.integers(2, 20)))
             + (" vile" if k % 3 == 0 else "") for k in range(60)]
    model = plain_model(texts)
    assert np.allclose(model.features(texts), plain_features(texts))
    assert np.allclose(model.features(texts, [int("vile" in t) for t in texts]),
                       plain_features(texts, own=True))
    # Spark's counts are those of the plain model.
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    trained = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5]
    labels = spark.createDataFrame([(k, int("vile" in texts[k])) for k in range(60)],
                                   "doc_id long, toxic int")
    found = toxicity.train(edge.documents(spark, rows + rows[:9]), labels)
    want = plain_model([texts[k] for k in trained])
    assert found.words == want.words and found.totals == want.totals and found.kinds == want.kinds
    assert (found.ordinary == want.ordinary).all() and (found.toxic == want.toxic).all()


def plain_model(texts):
    n = [Counter(), Counter()]
    for text in texts:
        n[int("vile" in text)].update(set(re.findall(r"\w+", text.lower())))
    words = sorted(w for w in n[0] | n[1] if n[0][w] + n[1][w] >= 2)
    return toxicity.Model(
        words, *(np.array([float(c[w]) for w in words]) for c in n),
        tuple(sum(c.values()) for c in n), tuple(len(c) for c in n))


def test_a_run_goes_on_over_slices(monkeypatch):
    from medallion.llm.common import slices

    model = plain_model(["vile one two"] * 3 + ["one two three"] * 4)
    text = "one two vile vile vile three one"
    want = model.features([text])
    monkeypatch.setattr(toxicity, "slices", lambda t: slices(t, 5))
    assert np.allclose(model.features([text]), want)


def test_toxicity_beats_a_bag_of_words_on_given_tables(spark):
    """Held out at sf0.01 there are few toxic rows: ordinary ones are to be left alone."""
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    found = toxicity.score_toxicity(spark.read.parquet(f"{at}/documents.parquet"), labels)
    rows = found.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    ordinary = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in ordinary) < 0.05 * len(ordinary)
    above = [(t.score > o.score) + 0.5 * (t.score == o.score)
             for t in rows if t.toxic == 1 for o in ordinary]
    assert sum(above) / len(above) >= 0.75


# Language-model scores

def test_base_scores_and_counts(spark):
    found = lm_scoring.score_documents(edge.documents(spark), frequent=3).collect()
    words = [((t or "").encode().lower().split(), d) for d, t, *_ in edge.ROWS]
    training = [w for w, d in words if zlib.crc32(b"" if d is None else str(d).encode()) % 7 != 2]
    counts = Counter(x for w in training for x in w)
    counts["end"] = len(training)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for w, d in words:
        own = [*w, "end"]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in own)
        want[(d, len(own), sum(counts[x] > 0 for x in own), n, round(base, 4))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                   for r in found) == want
    assert all(r.score < 0 for r in found)
    assert lm_scoring.score_documents(edge.empty(spark)).count() == 0


@pytest.mark.parametrize("least", [1, 3])
def test_trie_probabilities_add_up_to_one(least):
    order, texts = 3, [b"the cat sat", b"the dog sat on the cat", b"", b"aaab"] * 3
    total = Counter()
    for _, keys in lm_scoring.windows(texts, order):
        total.update(keys.tolist())
    grams = {}
    for n in range(1, order + 2):
        summed = Counter()
        for key, count in total.items():
            summed[key & ((1 << 8 * n) - 1)] += count
        kept = sorted((k, c) for k, c in summed.items() if c >= least)
        grams[n] = (np.array([k for k, _ in kept], np.uint64), np.array([c for _, c in kept]))
    trie = lm_scoring.Trie.build(grams, order)
    contexts = {key >> 8 for key in total} | {int.from_bytes(b"xyz", "big")}
    symbols = np.array([s for s in range(256) if s != lm_scoring.BEFORE], np.uint64)
    for context in contexts:
        keys = (np.uint64(context) << np.uint64(8)) | symbols
        assert abs((10 ** trie.logs(keys)).sum() - 1) < 1e-9


def test_windows_of_long_texts_overlap(monkeypatch):
    text = bytes(range(97, 123)) * 5
    want = Counter(k for _, keys in lm_scoring.windows([text], 4) for k in keys.tolist())
    monkeypatch.setattr(lm_scoring, "CHUNK", 17)
    cut = Counter(k for _, keys in lm_scoring.windows([text], 4) for k in keys.tolist())
    assert cut == want and sum(cut.values()) == len(text) + 1


def test_scores_keep_every_string(spark):
    rnd = np.random.default_rng(5)
    words = ["the", "cat", "dog", "sat", "zebra", "quilt", "über", "mat", "hat"]
    rows = list(edge.ROWS) + [
        (100 + i, " ".join(rnd.choice(words, 12)) + f" {'qxjzvk'[i % 6]}{i * 7919}", "en", "s")
        for i in range(60)]
    texts = [b" ".join(lm_scoring.words_of(t or "")) for _, t, *_ in rows]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2 for d, *_ in rows]
    assert any(held)
    order, total = lm_scoring.ORDER, Counter()
    for _, keys in lm_scoring.windows([t for t, out in zip(texts, held) if not out], order):
        total.update(keys.tolist())
    grams = {}
    for n in range(1, order + 2):
        summed = Counter()
        for key, count in total.items():
            summed[key & ((1 << 8 * n) - 1)] += count
        grams[n] = (np.array(sorted(summed), np.uint64), np.array([summed[k] for k in sorted(summed)]))
    plain = lm_scoring.Trie.build(grams, order).score(texts)
    want = Counter((d, round(s, 4)) for (d, *_), s in zip(rows, plain))
    for nodes in (1, 300, lm_scoring.NODES):  # how much is broadcast changes nothing
        found = lm_scoring.score_documents(edge.documents(spark, rows), nodes=nodes).collect()
        assert Counter((r.doc_id, round(r.score, 4)) for r in found) == want


def test_window_counts_given_away_in_parts_add_up(monkeypatch):
    texts = [" ".join(random_words) for random_words in
             np.random.default_rng(4).choice(["ab", "cde", "fgh", "ij", "k"], (40, 30))]
    want = Counter(k for _, keys in lm_scoring.windows([t.encode() for t in texts], 3)
                   for k in keys.tolist())
    monkeypatch.setattr(lm_scoring, "GRAMS", 50)
    monkeypatch.setattr(lm_scoring, "FLUSH_GRAMS", 30)
    monkeypatch.setattr(lm_scoring, "CHUNK", 64)
    monkeypatch.setattr(lm_scoring, "FLUSH_WORDS", 3)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 10])], names=["text"])
               for i in range(0, 40, 10)]
    grams, words = Counter(), Counter()
    for batch in lm_scoring._gather(3)(iter(batches)):
        for row in batch.to_pylist():
            (words if row["gram"] is None else grams)[row["word"] or row["gram"]] += row["n"]
    assert grams == want
    assert words == Counter(w.encode() for t in texts for w in t.split())
    assert list(lm_scoring._gather(3)(iter([]))) == []


def test_held_out_text_scores_above_the_unigram_base():
    """The plain trie, which the Spark scores equal, on whole texts of sf0.1."""
    rows = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"])
    words = [lm_scoring.words_of(t or "") for t in rows["text"].to_pylist()]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d in rows["doc_id"].to_pylist()]
    training = [w for w, out in zip(words, held) if not out]
    counts = Counter(x for w in training for x in w)
    counts[None] = len(training)
    total = sum(counts.values()) + len(counts) + 1
    rest = [w for w, out in zip(words, held) if out]
    base = sum(math.log10((counts[x] + 1) / total) for w in rest for x in [*w, None])
    order = lm_scoring.ORDER
    keys = np.concatenate(
        [k for _, k in lm_scoring.windows([b" ".join(w) for w in training], order)])
    grams = {n: np.unique(keys & np.uint64((1 << 8 * n) - 1), return_counts=True)
             for n in range(1, order + 2)}
    score = lm_scoring.Trie.build(grams, order).score([b" ".join(w) for w in rest]).sum()
    assert score > 0.98 * base


def test_no_letter_counts_as_a_blank(spark):
    from medallion.llm import chartext

    assert all(number != chartext.SPACE for point in (0x10020, 0x20000, 0x20020, 0x2A020, 0x30020)
               if chr(point).isalpha() for number in chartext.letters(chr(point))[1:-1])
    assert len(chartext.letters(chr(0x20020) * 3)) == 5
    rows = [(i, "the and that", "en", "s") for i in range(20)] + [
        (i, chr(0x20020) * 9, "zh", "s") for i in range(20, 40)]
    found = {r.doc_id: r.lang_pred for r in language_id.identify(edge.documents(spark, rows)).collect()}
    assert {found[i] for i in range(20, 40)} == {"zh"}
