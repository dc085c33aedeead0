import random

import numpy as np

from pyspark.sql import functions as F

from flowguard.llm.decontaminate import Items, banded, contaminated, drop_contaminated, match_texts, normalise
from flowguard.llm.queries import op2_decontaminate
from tests.llm.util import SF, SF01, read


def least_edits(item, text):
    """Plain dynamic program: fewest edits of item against any substring of text."""
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(prev[j - 1] + (c != d), prev[j] + 1, now[j - 1] + 1))
        prev = now
    return min(prev)


def edited(rnd, s, n):
    s = list(s)
    for _ in range(n):
        at = rnd.randrange(len(s))
        kind = rnd.random()
        if kind < 0.4:
            s[at] = rnd.choice("abcxyz ")
        elif kind < 0.7:
            s.insert(at, rnd.choice("abcxyz"))
        else:
            del s[at]
    return "".join(s)


def test_same_pairs_as_the_plain_alignment(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7)))
    items = [" ".join(word() for _ in range(n)) for n in (6, 8, 12, 20, 30, 5, 9)]
    docs = []
    for n in range(60):
        body = " ".join(word() for _ in range(rnd.randint(0, 40)))
        if n % 2:
            it = rnd.choice(items)
            body += " " + edited(rnd, it, rnd.randint(0, max(1, len(it) // 9))) + " " + word()
        docs.append(body)
    docs += [items[0], items[1][5:], items[2] * 3, ""]
    want = set()
    for d, text in enumerate(docs):
        for i, it in enumerate(items):
            it = normalise(it)
            if len(it) >= 20 and least_edits(it, normalise(text)) <= len(it) * 0.08:
                want.add((d, i))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    it = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block in (60, 1 << 20):
        got = contaminated(df, it, block_bytes=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
        for r in got:
            assert least_edits(normalise(items[r["item_id"]]), normalise(docs[r["doc_id"]])) == r["edits"]
            stretch = normalise(docs[r["doc_id"]][r["start"]:r["end"]])
            assert abs(len(stretch) - len(normalise(items[r["item_id"]]))) <= r["edits"] + 1
    assert len(want) > 15


def test_exact_passages_of_the_given_table(spark):
    items = read(spark, "benchmark", SF01).collect()
    docs = read(spark, "documents", SF01).select("doc_id", "text").collect()
    exact = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    got = op2_decontaminate(spark, SF01).collect()
    assert exact <= {(r["doc_id"], r["item_id"]) for r in got}
    text = {d["doc_id"]: d["text"] for d in docs}
    for r in got:
        if r["edits"] == 0:
            assert normalise(text[r["doc_id"]][r["start"]:r["end"]]) == normalise(
                next(i["text"] for i in items if i["item_id"] == r["item_id"]))


def test_long_text_and_borders():
    item = "the quick brown fox jumps over the lazy dog and runs away"
    index = Items([0], [item], 0.08, 10)
    import flowguard.llm.decontaminate as m
    old, m.SEGMENT = m.SEGMENT, 500
    try:
        for at in (0, 430, 470, 499, 500, 501, 940, 2000):
            text = ("zq " * 1000)[:at] + item + " " + "vw " * 300
            found = match_texts(["nothing here", text, item], index)
            assert [(t, e) for t, _, _, _, e in found] == [(1, 0), (2, 0)]
            assert normalise(text[found[0][2]:found[0][3]]) == item
    finally:
        m.SEGMENT = old


def test_banded_matches_plain():
    rnd = random.Random(2)
    for _ in range(50):
        a = "".join(rnd.choice("ab") for _ in range(8))
        t = "".join(rnd.choice("ab") for _ in range(14))
        code = lambda s: np.array([ord(c) for c in s], dtype=np.uint32)
        e, _ = banded([code(a)], [code(t)], np.array([-9]), 30)
        assert e[0] == least_edits(a, t)


def test_nulls_and_clashing_columns(spark):
    item = "a passage that is long enough to be one"
    df = spark.createDataFrame([(None, item, 1), (1, None, 2), (2, "", 3), (3, "A  passage that\nis LONG enough to be one", 4),
                                (3, item, 5)], "doc_id long, text string, item_id int")
    it = spark.createDataFrame([(7, item), (8, None), (9, ""), (None, item), (7, item)], "item_id long, text string")
    got = sorted([(r["doc_id"], r["item_id"]) for r in contaminated(df, it).collect()], key=str)
    assert got == sorted([(d, i) for d in (None, 3, 3) for i in (7, 7, None)], key=str)
    assert contaminated(df.limit(0), it).collect() == [] and contaminated(df, it.limit(0)).collect() == []


def test_items_in_three_blocks(spark):
    """Blocks of a few hundred bytes: the same rows go as with one block."""
    docs = read(spark, "documents").limit(60).selectExpr("*", "1 AS _digest", "2 AS _text")
    items = read(spark, "benchmark")
    more = docs.unionByName(docs.limit(5)).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    one = drop_contaminated(more, items)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0]
    three = drop_contaminated(more, items, block_bytes=size // 3 + 1)
    assert sorted(map(str, one.collect())) == sorted(map(str, three.collect()))
    assert three.columns == docs.columns and 0 < three.count() < more.count()
    assert drop_contaminated(more, items.limit(0)).count() == more.count()
