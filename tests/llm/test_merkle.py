import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import merkle
from flowguard.llm.merkle import fold, leaf_digest, merkle_manifest, siblings
from flowguard.llm.queries import op11_merkle_manifest
from tests.llm.util import SF01, read

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def grow(nodes):
    """Levels of the tree above a list of nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def climb(levels, at):
    """The (side, sibling) steps from node ``at`` to the top, None without a sibling."""
    steps = []
    for nodes in levels[:-1]:
        run = nodes[at // 2 * 2:at // 2 * 2 + 2]
        steps.append(None if len(run) == 1 else (at % 2, run[1 - at % 2]))
        at //= 2
    return steps


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars) -> the query's columns."""
    by_lang = defaultdict(list)
    for i, t, lang, s, n in rows:
        bad = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
        by_lang[lang].append((i is not None, i or 0, leaf(i, s, lang, n, t), leaf(i, s, lang, n + bad if bad else n, t), i))
    order = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {g: sorted(by_lang[g], key=lambda x: x[:4]) for g in order}
    trees = {g: grow([x[2] for x in leaves[g]]) for g in order}
    top = grow([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        up, root = climb(top, k), top[-1][0]
        for at, (_, _, own, claim, i) in enumerate(leaves[g]):
            path, node = climb(trees[g], at) + up, claim
            for step in path:
                node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
            out.append((i, own, trees[g][-1][0], root, h(*[s[1] for s in path if s]), node, node == root))
    return Counter(out)


def query(docs):
    n_chars = F.col("n_chars") + F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, 1).otherwise(0)
    out = merkle_manifest(docs, claim=leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")))
    folded = fold(F.col("claim"), F.col("path"))
    return Counter(tuple(r) for r in out.select(
        "id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")).cast("binary"), 256), folded,
        folded == F.col("root")).collect())


def test_given_table(spark):
    docs = read(spark, "documents", SF01)
    got = Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
                  for r in op11_merkle_manifest(spark, SF01).collect())
    want = brute([tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    assert got == want
    assert 0.8 < sum(n for k, n in got.items() if k[-1]) / sum(got.values()) < 0.9


def test_sparse_negative_repeated_and_null_ids(spark):
    rnd = random.Random(12)
    rows = [(rnd.choice([None, 7, rnd.randint(-50, 50), rnd.randint(-2**63, 2**63 - 1)]), rnd.choice([None, "", "x", "é\n"]),
             rnd.choice(["en"] * 6 + ["", None, "zü", "z"]), rnd.choice([None, "s"]), rnd.choice([None, 0, 5])) for _ in range(60)]
    rows += [(7, "same", "en", "s", 1)] * 40
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS g", "2 AS key", "3 AS at", "4 AS n", "5 AS path", "6 AS hi")
    assert query(df.repartition(5)) == brute(rows)
    # the operator's own outputs: positions without gaps
    out = merkle_manifest(df).select("group", "position", "claim", "leaf").collect()
    for g in {r["group"] for r in out}:
        assert sorted(r["position"] for r in out if r["group"] == g) == list(range(sum(r["group"] == g for r in out)))
    assert all(r["claim"] == r["leaf"] for r in out)


def test_more_than_one_array(spark):
    """Over 4,096 leaves: two rounds, the last array with an odd end."""
    n = 2 * (1 << merkle.BLOCK_LEVELS) + 1
    rows = [(3 * i - 4000, str(i), "en", "s", i) for i in range(n)]
    docs = spark.range(n).selectExpr("3 * id - 4000 AS doc_id", "CAST(id AS STRING) AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    assert query(docs) == brute(rows)


def test_small_tables(spark):
    one = [(5, None, None, None, None)]
    assert query(spark.createDataFrame(one, SCHEMA)) == brute(one)
    out = merkle_manifest(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and out.columns == merkle_manifest(spark.createDataFrame(one, SCHEMA)).columns
    text_ids = spark.createDataFrame([("a", "t", "en", "s", 1)], SCHEMA.replace("doc_id long", "doc_id string"))
    with pytest.raises(ValueError, match="whole numbers"):
        merkle_manifest(text_ids)


def test_containers_round_trip():
    rnd = np.random.default_rng(0)
    for size in (1, 5, 288, 289, 4000, 4096):
        low = np.sort(rnd.choice(4096, size, replace=False))
        count = rnd.integers(1, 3, size)
        card, total, blob, extra = merkle.pack_container(low, count)
        got = merkle.unpack_container(card, blob, extra)
        assert (got[0] == low).all() and (got[1] == count).all() and total == count.sum()
        want = np.concatenate(([0], np.cumsum(count)[:-1]))
        assert (merkle.rank_in_container(card, blob, extra, low) == want).all()
