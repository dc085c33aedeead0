import hashlib
import random
import re

import pytest

from flowguard.llm.queries import op3_substring_dedup
from flowguard.llm.substring_dedup import substring_dedup
from tests.llm.util import SF, read

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """rows: (id, text); the plain definition, one dictionary of all windows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), {}
    for i in order:
        words = WORDS.findall(rows[i][1] or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.add(key)
        out[i] = (rows[i][0], len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return sorted(out.values(), key=str)


def run(spark, rows, window, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted([tuple(r) for r in substring_dedup(df, window=window, **kw).collect()], key=str)


def test_equals_brute_force_on_the_given_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, "documents").select("doc_id", "text").collect()]
    want = {(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(rows, 20)}
    got = [tuple(r) for r in op3_substring_dedup(spark, SF).collect()]
    assert len(got) == len(rows) and set(got) == want
    assert sum(k for _, _, k, _ in got) > 0


def test_random_repeats_over_many_chunks(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(40)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randint(6, 30))] for _ in range(12)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(rnd.randint(0, 5)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p))
            words += p[a:] if rnd.random() < 0.5 else p
            words += [rnd.choice(vocab) for _ in range(rnd.randint(0, 4))]
        rows.append((i, rnd.choice([" ", "  ", "\n", "\t"]).join(words)))
    for window in (5, 6, 2):
        assert run(spark, rows, window, chunk_bytes=300, bucket_runs=50) == brute(rows, window)


def test_edge_rows(spark):
    p = " ".join(f"p{i}" for i in range(8))
    rows = [(None, p), (3, None), (4, ""), (5, "  \n\t "), (7, p), (7, p), (6, "é" + p + " ü"),
            (8, "a a a a a a a a a"), (9, " ".join([p] * 200)), (10, "x " * 3)]
    assert run(spark, rows, 4) == brute(rows, 4)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, [], 20) == []
    df = spark.createDataFrame([(1, "a b", 5, "q"), (2, "a b", 6, None)],
                               "doc_id long, text string, chunk long, bucket string")
    assert sorted(map(tuple, substring_dedup(df, window=2).collect())) == [(1, 2, 0, "a b"), (2, 2, 2, "")]


def _repeated_ids():
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(30)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randint(4, 20))] for _ in range(10)]
    rows = []
    for i in range(240):
        words = [w for _ in range(rnd.randint(0, 4)) for w in rnd.choice(passages) + [rnd.choice(vocab)]]
        rows.append((None if i % 3 == 0 else 7 if i % 3 == 1 else i, " ".join(words)))
    return rows + [(None, rows[0][1])] * 5 + [(9, "a b c d e f")] * 2500 + [(9, "a  b")] * 3 + [(11, None), (11, "")]


def test_rows_that_share_an_id(spark):
    rows = _repeated_ids()
    for window in (4, 5):
        assert run(spark, rows, window, chunk_bytes=300, bucket_runs=50) == brute(rows, window)
    top = [((1 << 63) - 1, "p q r s"), (None, "p q r s"), (None, "p q r s t")]
    assert run(spark, top, 3) == brute(top, 3)


def test_rows_that_share_an_id_spread_over_chunks(spark):
    """No group of the grouped passes gets the rows of a key."""
    from pyspark.sql import functions as F
    from flowguard.llm.substring_dedup import _chunked, _ranked
    src = spark.createDataFrame([(None, f"t {i}") for i in range(500)] + [(None, "same")] * 300, "_id long, _text string")
    rows, equal = _ranked(src, 5000)
    assert rows.count() == 501 and equal.collect() == [(None, "same", 300)]
    assert _chunked(rows, 64).groupBy("chunk").count().agg(F.max("count")).first()[0] < 50


def test_structured_words_do_not_collide(spark):
    """Words that a polynomial hash modulo 2^64 cannot tell apart: Thue-Morse and its complement."""
    bits = "0"
    while len(bits) < 2048:
        bits += bits.translate(str.maketrans("01", "10"))
    a, b = bits.replace("0", "a").replace("1", "b"), bits.replace("0", "b").replace("1", "a")
    same = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{same} {a}"), (2, f"{same} {b}")]
    for word_a, word_b in ((a, b), (a[:200], b[:200])):
        rows = [(1, f"{same} {word_a}"), (2, f"{same} {word_b}"), (3, f"{same} {word_a}")]
        got = {r["doc_id"]: r["n_removed"] for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {1: 0, 2: 0, 3: 20}
    # the same pattern in whole words, over windows
    words = {1: ["a" if c == "0" else "b" for c in bits], 2: ["b" if c == "0" else "a" for c in bits]}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in words.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup(df, window=1024).collect()}
    seen, want = set(), {}
    for i in (1, 2):
        gone = set()
        for at in range(len(words[i]) - 1023):
            w = tuple(words[i][at:at + 1024])
            if w in seen:
                gone.update(range(at, at + 1024))
            seen.add(w)
        want[i] = len(gone)
    assert got == want


def test_text_ids_are_an_error(spark):
    with pytest.raises(ValueError, match="whole numbers"):
        substring_dedup(spark.createDataFrame([("x", "t")], "doc_id string, text string"))
