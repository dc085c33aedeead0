import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import kneser_ney as kn
from flowguard.llm.common import WORD, Words
from flowguard.llm.queries import op12_lm_scoring
from tests.llm.util import SF01, read

START, STOP = "<s>", "</s>"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(WORD, low) + [STOP]


class Brute:
    def __init__(self, texts):
        self.n, self.c = Counter(), Counter()
        for t in texts:
            seq = tokens(t)
            self.c.update(seq)
            self.n.update(zip([START] + seq, seq))
        self.N, self.V = sum(self.c.values()), len(self.c)
        self.follows, self.after = Counter(), defaultdict(list)
        for (v, w), k in self.n.items():
            self.follows[w] += 1
            self.after[v].append(k)
        self.upper = self.discounts(self.n.values())
        self.lower = self.discounts(self.follows.values())

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        if not all(n[k] for k in (1, 2, 3, 4)):
            return [0, 0.5, 1.0, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) for k in (1, 2, 3)]

    def p1(self, w):
        types = sum(self.follows.values())
        if not types:
            return 1.0
        spare = sum(self.lower[min(a, 3)] for a in self.follows.values()) / types
        a = self.follows[w]
        return (a - self.lower[min(a, 3)]) / types + spare / (self.V + 1)

    def p2(self, v, w):
        total = sum(self.after[v])
        if not total:
            return self.p1(w)
        k = self.n[v, w]
        return (k - self.upper[min(k, 3)]) / total + sum(self.upper[min(x, 3)] for x in self.after[v]) / total * self.p1(w)

    def row(self, text):
        seq = tokens(text)
        base = sum(math.log10((self.c[w] + 0.5) / (self.N + 0.5 * (self.V + 1))) for w in seq)
        return len(seq), sum(self.c[w] > 0 for w in seq), base, sum(math.log10(self.p2(v, w)) for v, w in zip([START] + seq, seq))


def near(got, want):
    assert got[:2] == want[:2]
    assert got[2:] == pytest.approx(want[2:], rel=1e-9, abs=1e-9)


def trained_on(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1


def test_given_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, "documents", SF01).select("doc_id", "text").collect()]
    brute = Brute([t for i, t in docs if trained_on(i)])
    # the same formulas with the sums over all words taken once
    types = sum(brute.follows.values())
    spare = sum(brute.lower[min(a, 3)] for a in brute.follows.values()) / types
    low = {w: (a - brute.lower[min(a, 3)]) / types + spare / (brute.V + 1) for w, a in brute.follows.items()}
    brute.p1 = lambda w: low.get(w, spare / (brute.V + 1))
    mass = {v: (sum(k), sum(brute.upper[min(x, 3)] for x in k) / sum(k)) for v, k in brute.after.items()}

    def p2(v, w):
        if v not in mass:
            return brute.p1(w)
        k = brute.n[v, w]
        return (k - brute.upper[min(k, 3)]) / mass[v][0] + mass[v][1] * brute.p1(w)
    brute.p2 = p2
    got = {r["doc_id"]: r for r in op12_lm_scoring(spark, SF01).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        r = got[i]
        assert r["held_out"] == (not trained_on(i)) and r["train_tokens"] == brute.N
        near((r["n_tokens"], r["n_known"], r["base_score"], r["score"]), brute.row(t))
    # the model knows more than single words do, on texts it has not seen as well
    unseen = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


ODD = [(None, None), (1, ""), (1, "A a A b"), (2, "a b\x0bc d É é"), (3, "a b a b a b"), (3, "a b a b a b"), (4, "zz " * 400),
       (5, "one two three one two four one two"), (6, " \n\t "), (7, "x" * 700 + " " + "x" * 699 + " y")]


@pytest.mark.parametrize("piece", [kn.PIECE_BYTES, 16])
def test_odd_rows_and_texts_in_pieces(spark, piece, monkeypatch):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 AS _id", "2 AS _text", "3 AS score")
    small = 64 if piece == 16 else kn.CHUNK_BYTES
    brute = Brute([t for i, t in ODD if i != 5])
    model = kn.train(df.where("doc_id is null or doc_id != 5").repartition(3), chunk_bytes=small)
    assert (model.tokens, model.vocabulary, model.pairs) == (brute.N, brute.V, len(brute.n))
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["base_score"], r["score"], r["perplexity"])
                 for r in kn.score_documents(df, model, chunk_bytes=small).collect())
    want = sorted((str(i), *brute.row(t)) for i, t in ODD)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0]
        near(g[1:5], w[1:])
        assert g[5] == pytest.approx(10 ** (-w[4] / w[1]))


def test_pieces_and_chunks_join_to_the_same_tokens(monkeypatch):
    rnd = random.Random(0)
    texts = ["".join(rnd.choice("ab \n") for _ in range(rnd.randint(0, 90))).encode() for _ in range(60)]
    whole = kn._Tokens(texts, [True] * len(texts), kn.BOS)
    pairs = Counter(zip(*[whole.known[x].tolist() for x in whole.split(whole.code)]))
    monkeypatch.setattr(kn, "PIECE_BYTES", 7)
    for size in (1, 40, 10**6):
        got, before, i = Counter(), kn.BOS, []
        pieces = [(k, p, last) for k, t in enumerate(texts) for p, last in kn._pieces(t)]
        assert [b"".join(p for k, p, _ in pieces if k == n) for n in range(len(texts))] == texts
        while pieces:
            part, pieces = pieces[:size], pieces[size:]
            t = kn._Tokens([p for _, p, _ in part], [last for _, _, last in part], before)
            before = t.after
            got.update(zip(*[t.known[x].tolist() for x in t.split(t.code)]))
        assert got == pairs


def test_probabilities_sum_to_one(spark):
    texts = ["a b c d a b", "a c", "b b b", "d e f", "a b c", ""] + [" ".join(random.Random(i).choices("abcdefghij", k=9)) for i in range(9)]
    model = kn.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    words = sorted({w for t in texts for w in t.split()}) + ["never"]
    keys = np.concatenate((Words([w.encode() for w in words]).keys(), [kn.END, kn.BOS]))
    known = np.sort(keys)
    place = {w: int(np.searchsorted(known, k)) for w, k in zip(words + [STOP, START], keys)}
    seconds = np.array([place[w] for w in words + [STOP]])
    for v in [*words, START]:
        p, _, have = kn.pair_probabilities(model, np.full(len(seconds), place[v]), seconds, known)
        assert p.sum() == pytest.approx(1) and (p > 0).all()
        assert have.sum() == model.vocabulary == len(words)


def test_empty_tables_and_folder(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = kn.train(df.limit(0))
    assert (model.tokens, model.vocabulary, model.pairs) == (0, 0, 0)
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["score"]) for r in kn.score_documents(df, model).collect()} == {
        (1, 3, 0, 0.0), (2, 1, 0, 0.0)}
    assert kn.score_documents(df.limit(0), kn.train(df)).collect() == []
    with pytest.raises(ValueError, match="mounted folder"):
        kn._local_folder("hdfs://host/x")
    assert kn._local_folder("file:/a%20b/c") == "/a b/c"
    assert df.where(kn.held_out()).count() == sum(not trained_on(i) for i in (1, 2))
    assert df.select(F.lit(None).cast("long").alias("doc_id")).where(kn.held_out()).count() == 0
