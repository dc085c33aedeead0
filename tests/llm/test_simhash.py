import random

import numpy as np
import xxhash

from flowguard.llm.components import components
from flowguard.llm.queries import op6_simhash
from flowguard.llm.simhash import links, simhash_components
from tests.llm.util import SF, read


def brute_fp(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in low).split(" ") if w]
    runs = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=4):
    fps = sorted(set(fps))
    arr = np.array(fps, dtype=np.uint64)
    label = np.arange(len(arr))
    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= bits):
            a, b = label[i], label[j]
            label[label == max(a, b)] = min(a, b)
    return dict(zip(fps, label.tolist()))


def want(rows):
    fps = [brute_fp(t) for _, t in rows]
    comp = brute_components(fps)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    return sorted([(i, f"{f:016x}", least.get(comp[f])) for (i, _), f in zip(rows, fps)], key=str)


def test_equals_brute_force_on_the_given_table(spark):
    rows = [tuple(r) for r in read(spark, "documents").select("doc_id", "text").collect()]
    got = sorted([tuple(r) for r in op6_simhash(spark, SF).collect()], key=str)
    assert got == want(rows)
    assert any(c != i for i, _, c in got)


def test_edge_rows(spark):
    rows = [(5, None), (2, ""), (9, " \n"), (None, "a b c d e"), (1, "A b C d E"), (7, "one two"),
            (7, "one two"), (None, "lonely words are here now"), (3, "é" * 5000 + " z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS key")
    assert sorted([tuple(r) for r in simhash_components(df).collect()], key=str) == want(rows)
    assert simhash_components(df.limit(0)).collect() == []


def test_links_connect_the_same_as_all_pairs(spark):
    rnd = random.Random(3)
    fps = set()
    for _ in range(60):
        x = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 30])):
            fps.add(x)
            for _ in range(rnd.randint(1, 6)):
                x ^= 1 << rnd.randrange(64)
    centre = rnd.getrandbits(64)     # one dense group, above the hot limit
    for _ in range(500):
        fps.add(centre ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    expect = brute_components(fps)
    n = sum(1 for v in set(expect.values()) if list(expect.values()).count(v) > 1)
    for hot in (40, 4096):
        got = {r["node"] % (1 << 64): r["root"] for r in components(links(df, 4, hot_rows=hot)).collect()}
        assert len(set(got.values())) == n
        groups = {}
        for f, c in expect.items():
            groups.setdefault(c, set()).add(got.get(f, f))
        assert all(len(g) == 1 for g in groups.values())


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
