import math
import random
import re
from collections import Counter

from flowguard.llm.quality_rules import quality_rules
from flowguard.llm.queries import op7_quality_rules
from tests.llm.util import SF01, read

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if often[r] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules_and_scores_of_the_given_table(spark):
    docs = {r["doc_id"]: r["text"] for r in read(spark, "documents", SF01).collect()}
    good = {r["doc_id"] for r in read(spark, "labels", SF01).where("quality = 1").collect()}
    bad = {r["doc_id"] for r in read(spark, "labels", SF01).where("quality = 0").collect()}
    got = {r["doc_id"]: r for r in op7_quality_rules(spark, SF01).collect()}
    assert len(got) == len(docs)
    for i, t in docs.items():
        assert tuple(got[i][c] for c in COLS) == brute(t)
        assert got[i]["kept"] == (not got[i]["base_failed"] and got[i]["score"] >= THRESHOLD)
    long_enough = lambda ids: [i for i in ids if i in got and not got[i]["base_failed"]]
    kept = [got[i]["kept"] for i in long_enough(good)]
    assert sum(kept) >= 0.98 * len(kept)
    dropped = [not got[i]["kept"] for i in long_enough(bad)]
    assert sum(dropped) >= 0.5 * len(dropped)


from flowguard.llm.quality_rules import THRESHOLD  # noqa: E402


def test_scores_by_brute_force(spark):
    """With as many buckets as to tell all n-grams apart, the score is the plain mean."""
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 30)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(40)], "doc_id long, q boolean").selectExpr(
        "doc_id", "CAST(q AS INT) AS quality")
    b = 20_011
    got = {r["doc_id"]: r["score"] for r in quality_rules(df, labels, buckets=b).collect()}
    gram = lambda t: t.split() + list(zip(t.split(), t.split()[1:]))
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(gram(t))
        target.update(gram(t) if i % 3 == 0 else [])
    lr = {g: math.log((target[g] + 1) / (sum(target.values()) + b)) - math.log((raw[g] + 1) / (sum(raw.values()) + b))
          for g in raw}
    want = {i: sum(lr[g] for g in gram(t)) / len(gram(t)) for i, t in rows}
    close = sum(abs(got[i] - w) < 1e-9 for i, w in want.items())
    assert close >= 36      # the rest: bucket collisions


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c a b c a"), (5, "x y z x y z"), (5, "x y z x y z"),
            (6, "é|é # <b>\nq\n\nq\n q"), (7, "w " * 5000), (8, "a b c d a b c e b c d"), (9, "\x0b\x0c\r one\x85two three")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS words", "2 AS h", "3 AS _good")
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (5, None)], "doc_id long, quality int")
    got = [tuple(r[c] for c in ["doc_id", *COLS]) for r in quality_rules(df, labels).collect()]
    assert sorted(got, key=str) == sorted([(i, *brute(t)) for i, t in rows], key=str)
    assert quality_rules(df.limit(0), labels).collect() == []
    assert len(quality_rules(df, labels.limit(0)).collect()) == len(rows)
