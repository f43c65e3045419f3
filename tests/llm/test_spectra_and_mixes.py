"""Whitening, alignment and mixing against plain versions of themselves."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from medallion.llm import alignment, mixing, whitening
from tests.llm import edge

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


# Whitening

def vectors(spark, rows):
    return spark.createDataFrame(
        [(k, v, "x", "x") for k, v in rows],
        "vec_id long, embedding array<double>, whitened string, component string")


def plain_whitening(rows, components=32):
    width = max(len(v) for v in rows)
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]]
                  for v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    c = np.array([[float(a - s // n) - (s % n) / n for a, s in zip(row, sums)] for row in x])
    values, directions = np.linalg.eigh(c.T @ c / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    real = values > 1e-10 * values[0]
    return (c @ directions[:, real] / np.sqrt(values[real]), values[real] / (c * c).sum() * n,
            deviation)


def check_whitening(spark, rows, components=32, within=1e-8):
    kept = [(k, v) for k, v in rows if v is not None and all(
        c is not None and np.isfinite(c) for c in v)]
    found = whitening.whiten(vectors(spark, rows), components=components).collect()
    white, explained, deviation = plain_whitening([v for _, v in kept], components)
    assert len(found) == white.size
    by = defaultdict(dict)
    for row in found:
        by[row.vec_id][row.component] = row
        assert row.n == len(kept) and row.identity_error <= 1e-4
    ours = np.array([[by[k][j + 1].whitened for j in range(white.shape[1])] for k, _ in kept])
    signs = np.sign((ours * white).sum(axis=0))
    assert np.abs(ours * signs - white).max() < within
    for place, (k, _) in enumerate(kept):
        assert all(r.deviation == deviation[place] for r in by[k].values())
        assert np.allclose([by[k][j + 1].explained for j in range(white.shape[1])], explained,
                           rtol=1e-6)


def test_whitening_is_the_plain_one(spark):
    random = np.random.default_rng(1)
    mixing_matrix = random.standard_normal((90, 90)) * np.linspace(0.2, 3, 90)
    rows = [(k, (random.standard_normal(90) @ mixing_matrix).tolist()) for k in range(400)]
    rows += [(1000, None), (1001, [None] * 90), (1002, [float("nan")] * 90),
             (1003, [float("inf")] + [0.0] * 89), (1004, [1.0] * 89 + [None]),
             (1005, [2.0, -3.0])]
    check_whitening(spark, rows, components=8)


def test_whitening_of_few_dimensions_and_of_low_rank(spark):
    random = np.random.default_rng(2)
    check_whitening(spark, [(k, random.standard_normal(5).tolist()) for k in range(30)])
    wide = random.standard_normal((3, 100)) * 100
    rows = [(k, np.round(random.standard_normal(3) * 9) @ np.round(wide)) for k in range(40)]
    check_whitening(spark, [(k, v.tolist()) for k, v in rows])


def test_whitening_without_spread(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 5)).count() == 0


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(None, [1e18, 0.0]), (2, [-1e18, 1.0]), (3, [0.0, 5.0])]
    found = whitening.whiten(vectors(spark, rows)).collect()
    assert {r.vec_id: r.deviation is None for r in found} == {None: True, 2: True, 3: False}


def test_a_value_outside_the_block_is_found(spark, monkeypatch):
    """The block starts without the leading direction; the probe has to bring it in."""
    monkeypatch.setattr(whitening, "GUARD", 1)

    class Known:
        base = whitening.Lattice(1, (0,) * 40)

        def __init__(self):
            self.matrix = np.diag(np.linspace(1, 5, 40))

        def __matmul__(self, block):
            return self.matrix @ block

    values, directions = whitening.eigenpairs(Known(), 6)
    assert np.allclose(values, np.linspace(1, 5, 40)[::-1][:6])
    found, _, vectors = whitening.lanczos(Known(), np.ones(40), directions[:, 1:])
    assert abs(found[-1] - 5) < 1e-3


# Alignment

def plain_alignment(texts):
    a, b = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    a.encode_special_tokens = True
    tables = alignment.Aligner(BYTE_BPE, PIECE_BPE)
    per_text = []
    for text in texts:
        full = (" " + text).encode() if text else b""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [tables.bytes_a[i] for i in ids_a]
        bytes_b = [tables.bytes_b[i] for i in ids_b]
        if not text or b"".join(bytes_a) != full or b"".join(bytes_b) != full:
            per_text.append(None)
            continue
        ends_a = np.cumsum([len(x) for x in bytes_a]).tolist()
        ends_b = np.cumsum([len(x) for x in bytes_b]).tolist()
        at_a, at_b = ({end: n for n, end in enumerate(ends, 1)} for ends in (ends_a, ends_b))
        links, groups, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = at_a[end], at_b[end]
            groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
            links.append((ids_b[q - 1], ids_a[p - 1]))
            i, j = p, q
        per_text.append((len(ids_a), len(ids_b), links, ";".join(groups)))
    counts = Counter(link for found in per_text if found for link in found[2])
    best = {}
    for (side, _), n in counts.items():
        best[side] = max(best.get(side, 0), n)
    return [(0,) * 6 + ("",) if f is None else (
        f[0], f[1], len(f[2]), len(f[2]), sum(counts[x] == best[x[0]] for x in f[2]),
        sum(counts[x] for x in f[2]), hashlib.sha256(f[3].encode()).hexdigest()) for f in per_text]


def odd_texts(n, seed):
    random = np.random.default_rng(seed)
    letters = list("aAbZ thTHé ñßÑ'\n\t\x0b\x1c\x85\xa0 　!?..,ΣςİḰﬁ中😀\x00") + [
        "<|endoftext|>", "<s>", "<0x0A>", "'s", "  ", "the ", " of", "▁"]
    weights = np.ones(len(letters))
    weights[-1] = 0.2
    return ["".join(random.choice(letters, random.integers(0, 30), p=weights / weights.sum()))
            for _ in range(n)]


def test_alignment_is_the_plain_one(spark):
    texts = [*odd_texts(600, 5), *odd_texts(20, 5), "▁", "a ▁b", "the " * 3_000, None, ""]
    rows = [(k % 590 if k != 7 else None, t, "en", "s") for k, t in enumerate(texts)]
    found = alignment.align_tokenizers(edge.documents(spark, rows).repartition(3),
                                       BYTE_BPE, PIECE_BPE).collect()
    want = Counter((row[0], *plain) for row, plain in zip(rows, plain_alignment(texts)))
    assert Counter(tuple(row) for row in found) == want


def test_alignment_of_awkward_tables(spark):
    found = alignment.align_tokenizers(edge.documents(spark), BYTE_BPE, PIECE_BPE).collect()
    want = Counter((row[0], *plain) for row, plain in zip(
        edge.ROWS, plain_alignment([row[1] for row in edge.ROWS])))
    assert Counter(tuple(row) for row in found) == want
    assert alignment.align_tokenizers(edge.empty(spark), BYTE_BPE, PIECE_BPE).count() == 0


def test_alignment_with_salts_small_blocks_and_early_letting_go(spark, monkeypatch):
    for name in ("SALT_PAIRS", "SALT_RECORDS"):
        monkeypatch.setattr(alignment, name, 20)
    texts = odd_texts(80, 6) + ["the cat of the cat"] * 30
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    documents = edge.documents(spark, rows).repartition(7)
    runs = alignment.spilled_runs(documents, BYTE_BPE, PIECE_BPE)
    _, salts = alignment.pair_counts(runs)
    assert salts.agg({"salts": "max"}).first()[0] > 1
    found = alignment.align_tokenizers(documents, BYTE_BPE, PIECE_BPE).collect()
    want = Counter((k, *plain) for k, plain in enumerate(plain_alignment(texts)))
    assert Counter(tuple(row) for row in found) == want


def test_merge_of_runs():
    random = np.random.default_rng(7)
    runs = [np.sort(random.choice(500, 60, replace=False)) for _ in range(9)]
    blocks = [(r[i:i + 7], np.arange(len(r[i:i + 7])) + 1) for r in runs for i in range(0, 60, 7)]
    blocks.sort(key=lambda block: block[0][0])
    want = Counter()
    for pairs, counts in blocks:
        for pair, count in zip(pairs.tolist(), counts.tolist()):
            want[pair] += count
    assert list(alignment.merge_runs(blocks)) == sorted(want.items())
    assert list(alignment.merge_runs([])) == []


# Mixing

WORD = re.compile(mixing.WORD)


def targets(sizes):
    """By resharing the excess until no source is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: k % 3 + 1 for k, s in enumerate(names)}
    held, total = set(), sum(sizes.values())
    while True:
        free = sum(weights[s] for s in names if s not in held)
        rest = total - sum(3 * sizes[s] for s in held)
        share = {s: 3 * sizes[s] if s in held else weights[s] * rest / free for s in names}
        above = {s for s in names if s not in held and share[s] > 3 * sizes[s]}
        if not above:
            return share
        held |= above


def check_mix(found, rows):
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want, taken = targets(sizes), Counter()
    left = Counter((d, len(WORD.findall(t or "")), sizes[s], want[s]) for d, t, _, s in rows)
    for row in found:
        left[row.doc_id, row["size"], row.source_size, row.target] -= 1
        taken[row.source_size, row.target] += row.taken
        assert 0 <= row.taken <= 3 * row["size"]
    assert not +left and not -left
    groups = Counter((sizes[s], want[s]) for s in sizes)
    for (size, target), n in taken.items():
        assert n == int(target) * groups[size, target]


def test_mix_of_awkward_tables(spark):
    check_mix(mixing.mixed_counts(edge.documents(spark)).collect(), edge.ROWS)
    assert mixing.mixed_counts(edge.empty(spark)).count() == 0
    blank = [(1, None, "en", "a"), (1, "", "en", None), (None, " \n", "en", "a")]
    assert [r.taken for r in mixing.mixed_counts(edge.documents(spark, blank)).collect()] == [0] * 3


def mixed_rows():
    random = np.random.default_rng(8)
    sizes = {"a": 40, "b": 5_000, "c": 300, "é": 1, None: 900, "Z": 2_500}
    rows, k = [], 0
    for source, words in sizes.items():
        while words > 0:
            n = min(words, int(random.integers(0, 400)))
            rows.append((k, " ".join(f"w{random.integers(99)}" for _ in range(n)), "en", source))
            words, k = words - n, k + 1
    return rows + [(None, "same words here", "en", "b")] * 40 + rows[:5]


def test_mix_keeps_targets_bounds_reruns_and_is_that_of_its_sql(spark):
    rows = mixed_rows()
    found = mixing.mixed_counts(edge.documents(spark, rows)).collect()
    check_mix(found, rows)
    again = mixing.mixed_counts(edge.documents(spark, rows[::-1]).repartition(5)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    documents = pd.DataFrame([(d, t, s) for d, t, _, s in rows], columns=["doc_id", "text", "source"])
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents)
    want = Counter(con.execute(
        f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall())
    assert Counter(map(tuple, found)) == want


def test_mixed_texts_are_words_of_their_source(spark):
    rows = mixed_rows()
    found = mixing.mixed_texts(edge.documents(spark, rows)).collect()
    assert all(len(row.text.split(" ")) == row.n_words <= mixing.BLOCK for row in found)
    assert {w for row in found for w in row.text.split(" ")} <= {
        w for _, t, _, _ in rows for w in (t or "").split()}
    assert len({row.slot for row in found}) == len(found)


def test_permutation_hits_every_block(spark):
    for full in (1, 2, 3, 5, 17, 64, 65, 1000):
        wide = int(np.ceil(np.sqrt(full)))
        rows = spark.range(full).selectExpr(
            "id AS position", f"{full}L AS full", f"{wide}L AS wide",
            f"{-(-full // wide)}L AS high", "77L AS seed")
        found = [r[0] for r in rows.select(mixing._block_of("position")).collect()]
        assert sorted(found) == list(range(full))
