"""Benchmark decontamination, chat formatting, the pipeline, and the registered queries."""

from __future__ import annotations

import os
import random
import re
import shutil
from collections import Counter

import pytest

from medallion.llm import chat, decontamination
from medallion.llm.catalog import QUERIES
from tests.llm import edge

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


# Decontamination

def plain_distance(item, text):
    """Smallest word edit distance of ``item`` to any stretch of ``text``."""
    before = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        now = [i + 1]
        for j, y in enumerate(text):
            now.append(min(before[j] + (x != y), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def edited(words, count, vocabulary, rnd):
    words = list(words)
    for _ in range(count):
        kind, at = rnd.randrange(3), rnd.randrange(len(words))
        if kind == 0:
            words[at] = rnd.choice(vocabulary)
        elif kind == 1:
            words.insert(at, rnd.choice(vocabulary))
        elif len(words) > 1:
            del words[at]
    return words


def test_leaks_are_found_up_to_the_distance(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["the"] * 20
    items = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(5, 50))] for _ in range(30)]
    items += [["the"] * 12, ["a", "b", "a", "b", "a", "b", "c"]]
    rows = list(edge.ROWS)
    for i in range(150):
        item = items[i % len(items)]
        before, after = ([rnd.choice(vocabulary) for _ in range(rnd.randrange(80))] for _ in "ab")
        middle = edited(item, rnd.randrange(0, max(1, len(item) // 5) + 2), vocabulary, rnd)
        if i % 5 == 4:
            middle = []
        mark = [".", ",", "!!", ""][i % 4]
        rows.append((1000 + i, (mark + " ").join(before + middle + after).upper(), "en", "s"))
    table = [(n, " ".join(w), "x") for n, w in enumerate(items)] + [
        (500, None, "x"), (501, "", "x"), (502, "too short", "x"), (None, "w1 w2 w3 w4 w5 w6", "x")]
    benchmark = spark.createDataFrame(table, "item_id long, text string, doc_id string")
    want = {}
    for d, text, *_ in rows:
        words = decontamination.words_of(text or "")
        for n, item in enumerate(items):
            distance = plain_distance(item, words) if words else len(item)
            if distance <= decontamination.allowed(len(item)):
                want[(d, n)] = distance
    for block_bytes in (8 << 20, 700):  # one block, and several
        found = decontamination.contaminated(
            edge.documents(spark, rows), benchmark, block_bytes=block_bytes).collect()
        got = {(r.doc_id, r.item_id): r.distance for r in found}
        assert len(got) == len(found)
        missed = set(want) - set(got)
        assert not set(got) - set(want)
        assert len(missed) <= 0.03 * len(want), missed
        assert not {k for k in missed if want[k] == 0}
        assert all(want[k] == v for k, v in got.items())
        texts = {d: (t or "").lower() for d, t, *_ in rows}
        for r in found:
            span = texts[r.doc_id][r.start_char:r.end_char]
            assert len(decontamination.words_of(span)) == r.end_word - r.start_word
    assert decontamination.contaminated(edge.empty(spark), benchmark).count() == 0
    assert decontamination.contaminated(edge.documents(spark), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("length", [100, 150, 300, 400])
def test_long_items_are_found_at_the_border(length):
    rnd = random.Random(length)
    vocabulary = [f"w{i}" for i in range(3_000)]
    items = [[rnd.choice(vocabulary) for _ in range(length)] for _ in range(40)]
    index = decontamination.Index.build([(n, " ".join(w)) for n, w in enumerate(items)])
    texts, want = [], {}
    for n, item in enumerate(items):
        around = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(60))] for _ in "ab"]
        middle = edited(item, decontamination.allowed(length), vocabulary, rnd)
        texts.append(" ".join(around[0] + middle + around[1]))
        want[n] = plain_distance(item, texts[-1].split())
    found = {r[0]: r for r in index.matches(texts)}
    assert len(set(want) - set(found)) <= 0.03 * len(want)
    assert all(r[1] == n and r[3] == want[n] for n, r in found.items())


def test_best_stretch():
    import numpy as np

    item, text = np.array([1, 2, 3, 4]), np.array([9, 1, 2, 8, 3, 4, 9, 1, 2, 3, 4])
    assert decontamination.best_stretch(item, text) == (0, 7, 11)


# Chats

CHAT = [
    (1, 0, "user", "Hello there\nSecond line here"),
    (1, 1, "assistant", "Answer one."),
    (1, 2, "user", "> Answer one.\nI disagree"),
    (1, 3, "assistant", "> hello  there\nhm"),
    (1, 4, "user", "> > Answer one.\n> I disagree\nok"),
    (1, 5, "user", "> unknown stuff\nbye"),
    (1, 6, None, None), (1, 6, None, None),
    (1, 7, "user", "> > Hello there\n> > Second line here\nlate"),
    (2, 0, "user", "a > b stays, it is no quote"),
    (2, None, "user", "> a > b stays, it is no quote\nno turn"),
    (None, 0, "user", "x"), (None, 1, "user", "> x\nno conversation"),
    (3, 0, "user", "say\nsay"), (3, 1, "assistant", ">say\n>  say \n>>say\n\tleft"),
]


def chats(spark, rows=CHAT):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "conv_id long, turn long, role string, text string, h string, copies int")


def test_quotes_are_linked(spark):
    rows = {(r.conv_id, r.turn): r for r in chat.linked_messages(chats(spark)).collect()}
    assert rows[1, 2].said == "I disagree" and rows[1, 2].reply_to == 1
    assert rows[1, 3].reply_to == 0 and rows[1, 3].thread == 0
    assert (rows[1, 4].reply_to, rows[1, 4].thread, rows[1, 4].n_quotes, rows[1, 4].n_linked) == (
        2, 1, 2, 2)
    assert rows[1, 5].reply_to is None and rows[1, 5].said == "bye" and rows[1, 5].thread == 5
    assert rows[1, 6].copies == 2
    assert rows[1, 7].reply_to == 0
    assert rows[2, 0].said == "a > b stays, it is no quote" and rows[2, 0].n_quotes == 0
    assert rows[2, None].reply_to is None and rows[2, None].said == "no turn"
    assert rows[None, 1].reply_to is None
    assert rows[3, 1].said == "left" and rows[3, 1].reply_to == 0 and rows[3, 1].n_quotes == 2


def test_chats_follow_the_replies(spark):
    found = {(r.conv_id, r.part, r.section): r for r in chat.format_chats(chats(spark)).collect()}
    said = found[1, 0, 0].chat
    order = [said.index(x) for x in ("Hello", "hm", "late", "Answer one.", "I disagree", "ok", "bye")]
    assert order == sorted(order) and ">" not in said.replace("|>", "")
    assert found[1, 0, 0].n_messages == 9
    small = chat.format_chats(chats(spark), part=2).where("conv_id = 1").orderBy("part", "section")
    joined = "\n".join(r.chat for r in small.collect())
    assert joined.index("Hello") < joined.index("late") and joined.index("one.") < joined.index("ok")
    assert chat.format_chats(chats(spark, [])).count() == 0


def test_a_long_chain_of_replies(spark):
    rows = [(5, 0, "user", "message number 0")] + [
        (5, i, "user", f"> message number {i - 1}\nmessage number {i}") for i in range(1, 40)]
    linked = chat.linked_messages(chats(spark, rows)).collect()
    assert {r.thread for r in linked} == {0}
    assert all(r.reply_to == r.turn - 1 for r in linked if r.turn)


def test_parts_are_bounded_whatever_the_turns(spark):
    rows = [(None, i % 3, "user", f"lost {i}") for i in range(700)]
    rows += [(7, None, "user", f"no turn {i}") for i in range(600)]
    rows += [(8, 5, "user", f"{'x' * 300} {i:04}") for i in range(513)]
    rows += [(9, t, "user", f"late {t}") for t in range(250, 261)]
    rows += [(7, None, "user", f"> said by nobody {i}") for i in range(100)]
    found = {}
    for r in chat.format_chats(chats(spark, rows).repartition(7)).collect():
        found.setdefault(r.conv_id, []).append(r)
    sizes = {c: [r.n_messages for r in sorted(own, key=lambda r: r.part)]
             for c, own in found.items()}
    assert sizes == {None: [256, 256, 188], 7: [256, 256, 188], 8: [256, 256, 1], 9: [11]}
    for c, own in found.items():
        said = "\n".join(r.chat for r in sorted(own, key=lambda r: r.part)).split("<|user|>\n")[1:]
        want = sorted(((t if t is not None else 1 << 62), "" if x.startswith(">") else x)
                      for d, t, _, x in rows if d == c)
        assert [x.rstrip("\n") for x in said] == [x for _, x in want]


def quoted_talk(random, conv, turns):
    """Messages that quote earlier ones: whole, by paragraph or line, nested, twisted or made up."""
    say = lambda: " ".join(random.choice(WORDS) for _ in range(random.randint(1, 4)))
    rows = []
    for turn in range(turns):
        parts = []
        for _ in range(random.randint(0, 3)):
            source = random.choice(rows)[3] if rows and random.random() < 0.85 else say()
            cut = random.choice([lambda t: t, lambda t: t.split("\n\n")[0],
                                 lambda t: t.split("\n")[-1], lambda t: "  " + t.upper() + " \t"])
            marks = random.choice(["> ", ">", "> > ", " >", ">>\t"])
            parts.append("\n".join(marks + line for line in cut(source).split("\n")))
            if random.random() < 0.3:
                parts.append("")
        parts += [random.choice([say(), say() + "\n" + say(), say() + "\n \n" + say(), "", "a > b"])]
        random.shuffle(parts)
        at = None if random.random() < 0.05 else random.choice([turn, turn, turn, max(0, turn - 1)])
        row = (conv, at, random.choice(["user", "assistant", None]), "\n".join(parts))
        rows += [row] * random.choice([1, 1, 1, 2])
    return rows


WORDS = ["Yes", "no", "café", "MAYBE", "the", "plan", "x"]


@pytest.mark.parametrize("seed", [1, 2])
def test_chats_equal_sql_on_quoted_messages(spark, seed):
    """The given table holds no quotes, so the SQL is held against talks full of them."""
    import duckdb

    draw = random.Random(seed)
    rows = CHAT + [r for conv in (*range(10, 40), None)
                   for r in quoted_talk(draw, conv, draw.randint(1, 14))]
    rows += [(50, i, "user", f"> said {i - draw.randint(1, 4)}\nsaid {i}") for i in range(600)]
    table = chats(spark, rows).repartition(5)
    con = duckdb.connect()
    con.register("conversations", table.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.sql(chat.SQL)
    found = chat.format_chats(table).select(*want.columns).collect()
    assert Counter(map(tuple, found)) == Counter(want.fetchall())
    assert sum(r.n_linked for r in found) > 600 and sum(r.n_quotes for r in found) > 700


# Pipeline and queries

def write(spark, folder, rows, items):
    shutil.rmtree(folder, ignore_errors=True)
    edge.documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_decides_at_every_stage(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(3)
    english = "the and that with from there would could about little house garden water".split()
    german = "der und nicht schoen ueber haus garten wasser strasse kleine morgen abend".split()
    prose = lambda words: " ".join(rnd.choice(words) for _ in range(60))
    texts = [prose(english) if i % 2 else prose(german) for i in range(40)]
    rows = [(i, t, "en" if i % 2 else "de", "s") for i, t in enumerate(texts)]
    passage = " ".join(f"item{i} the" for i in range(12))
    shared = "a line that three documents or more all share"
    rows += [(100, None, "en", "s"), (101, "12345 !!", None, "s"), (102, "", "en", "s"),
             (103, texts[1], "en", "s"), (104, texts[3].upper(), "en", "s"),
             (105, f"{prose(english)} {passage} {prose(english)}", "en", "s")]
    rows += [(110 + i, f"{prose(english)}\n{shared}", None, "s") for i in range(3)]
    folder = write(spark, tmp_path / "tables", rows, [(1, passage), (2, None)])
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        documents = stage(spark, documents, folder)
        assert documents.columns == edge.documents(spark).columns
        path = str(tmp_path / name)
        documents.write.parquet(path)
        documents = spark.read.parquet(path)
        ids[name] = {r.doc_id: r for r in documents.collect()}
    assert set(ids["language_id"]) == {r[0] for r in rows} - {100, 101, 102}
    assert ids["language_id"][110].lang == "en"
    lines = ids["line_dedup"]
    assert shared in lines[112].text and shared not in lines[110].text
    assert set(lines) == set(ids["language_id"])
    assert set(ids["simhash_near_dedup"]) == set(lines) - {103, 104}
    assert set(ids["benchmark_decontamination"]) == set(ids["simhash_near_dedup"]) - {105}
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == set(ids["benchmark_decontamination"])
    empty = write(spark, tmp_path / "none", [], [(1, passage)])
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_leaks_go_row_by_row(spark, tmp_path):
    import corpus_pipeline

    first, second = (" ".join(f"{c}{i} the" for i in range(12)) for c in "ab")
    rows = [(None, f"before {first} after", "en", "s"), (None, "clean without an id", "en", "s"),
            (1, f"leak {first}", "en", "s"), (1, "clean of the same id", "en", "s"),
            (2, f"leak {second}", "en", "s"), (3, None, "en", "s"), (4, "clean", "en", "s")]
    folder = write(spark, tmp_path / "tables", rows, [(1, first), (None, second)])
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.drop_contaminated(spark, documents, folder)
    assert kept.columns == documents.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "clean without an id"), (1, "clean of the same id"), (3, ""), (4, "clean")]


@data
@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_equals_sql(spark, name):
    from tests.compare import compare, connect

    assert compare(spark, connect(SF_DIR), QUERIES[name], SF_DIR) == ""


@data
@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.sql))
def test_query_runs(spark, name):
    assert QUERIES[name].build(spark, SF_DIR).count() > 0


# Items that the filter of word pairs cannot help with

def test_short_items_are_found_as_exact_copies(spark):
    texts = {1: "One two THREE four five", 2: "two three one four", 3: "a four-word item, here!",
             4: "", 5: None, 6: "这 是 一句 话 这是一句话", 7: "one two three"}
    items = {1: "two three", 2: "four", 3: "four word item here", 4: "missing words", 5: "",
             6: "这是一句话", 7: "one two three four", 8: "two three"}
    documents = edge.documents(spark, [(d, t, "en", "s") for d, t in texts.items()])
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontamination.contaminated(documents, benchmark).collect()
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    want = set()
    for d, text in texts.items():
        for item, wanted in items.items():
            own, look = words(text), words(wanted)
            for at in range(len(own) - len(look) + 1):
                if look and own[at:at + len(look)] == look:
                    want.add((d, item, len(look), 0, at, at + len(look)))
                    break
    assert {(r.doc_id, r.item_id, r.item_words, r.distance, r.start_word, r.end_word)
            for r in found} == want and len(found) == len(want) > 8


def test_an_item_of_one_repeated_word(spark):
    documents = edge.documents(spark, [
        (1, "no " + "row " * 10 + "yes", "en", "s"), (2, "row " * 4 + "x " + "row " * 5, "en", "s"),
        (3, "row x " * 9, "en", "s"), (4, "row " * 8, "en", "s")])
    benchmark = spark.createDataFrame([(1, "row " * 10)], "item_id long, text string")
    found = {r.doc_id: r.distance for r in decontamination.contaminated(
        documents, benchmark).collect()}
    assert found == {1: 0, 2: 1, 4: 2}
