import random
import zlib
from collections import Counter, defaultdict

from flowguard.llm.queries import op5_sharding
from flowguard.llm.sharding import interleaved_shards
from tests.llm.util import SF01, read


def check(got, rows, shards):
    """got: rows of the operator; rows: (id, source, text)."""
    assert Counter((g["doc_id"], g["source"], g["size"], g["text_crc32"]) for g in got) == Counter(
        (i, s, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, s, t in rows)
    slots = defaultdict(list)
    for g in got:
        slots[g["shard"]].append(g["slot"])
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    whole = Counter(s for _, s, _ in rows)
    cells = Counter((g["shard"], g["source"]) for g in got)
    for s, n in whole.items():
        for k in range(shards):
            # an equal stretch of each source, up to a row at either border
            assert abs(cells[k, s] - n / shards) <= 2


def test_given_table(spark):
    rows = [tuple(r) for r in read(spark, "documents", SF01).select("doc_id", "source", "text").collect()]
    got = op5_sharding(spark, SF01).collect()
    assert {g["law"] for g in got} == {"rows"} and {g["grown_shard"] for g in got} == {None}
    out = interleaved_shards(read(spark, "documents", SF01)).collect()
    check(out, rows, 16)
    assert {(g["doc_id"], g["shard"], g["slot"]) for g in got} == {(g["doc_id"], g["shard"], g["slot"]) for g in out}


def test_hot_source_nulls_and_repeats(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 400) or None, rnd.choice(["hot"] * 6 + ["a", "b", None]),
             rnd.choice([None, "", "x", "é" * rnd.randint(1, 50)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 AS size", "2 AS slot", "3 AS _rank")
    for shards in (16, 7):
        check(interleaved_shards(df, shards).collect(), rows, shards)
    a, b = (Counter(map(tuple, interleaved_shards(d, 16).collect())) for d in (df, df.repartition(13)))
    assert a == b      # no dependence on the partitioning
    assert len({g["shard"] for g in interleaved_shards(df.limit(3), 16).collect()}) == 3
    assert interleaved_shards(df.limit(0)).collect() == []
