import corpus_pipeline as cp
from flowguard.llm.decontaminate import normalise
from flowguard.llm.quality_classifier import fit_classifier, held_out, score_texts
from flowguard.llm.secret_scan import RULES
from flowguard.llm.unigram import Unigram, read_vocabulary
from tests.llm.test_decontaminate import least_edits
from tests.llm.test_secret_scan import brute
from tests.llm.test_simhash import brute_components, brute_fp
from tests.llm.util import SF, read


def by_hand(spark):
    docs = [r.asDict() for r in read(spark, "documents").collect()]
    model = fit_classifier(read(spark, "documents"), read(spark, "labels").where(~held_out()))
    docs = [d for d, s in zip(docs, score_texts(model, [d["text"] for d in docs])) if s >= 0.3]
    comp = brute_components([brute_fp(d["text"]) for d in docs])
    first = {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        first.setdefault(comp[brute_fp(d["text"])], d)
    docs = list(first.values())
    items = [normalise(r["text"]) for r in read(spark, "benchmark").collect()]

    def clean(text):
        text = normalise(text)
        for it in items:
            if it in text:
                return False
            # a candidate has to share some long stretch; the full alignment is quadratic
            if any(it[k:k + 10] in text for k in range(0, len(it) - 10, 5)) and least_edits(it, text) <= 0.08 * len(it):
                return False
        return True
    docs = [d for d in docs if clean(d["text"])]
    for d in docs:
        out, at = "", 0
        for s, _, e, _ in brute(d["text"], RULES):
            if s >= at:
                out, at = out + d["text"][at:s] + "[SECRET]", e
            at = max(at, e)
        d["text"] = out + d["text"][at:]
    enc = Unigram(read_vocabulary(cp.MODEL))
    return {d["doc_id"]: enc.encode(d["text"]) for d in docs}


def test_run_equals_brute_force(spark):
    got = cp.run(spark, SF).collect()
    want = by_hand(spark)
    assert len(got) == len(want) and all(r["round_trip"] for r in got)
    assert {r["doc_id"]: list(r["ids"]) for r in got} == want
    assert 0 < len(want) < read(spark, "documents").count()


def test_stages_handle_odd_rows(spark):
    text = "the secret = abcdefghijklmnop and password: ABCDEFGHIJKLMNOP 0123456789abcdef0123 end"
    rows = [(None, text, "en", None, None, 1), (1, text, None, "s", 9, 2), (1, text, None, "s", 9, 2), (2, None, "en", "s", 0, 3),
            (3, "", "en", "s", 0, 4), (4, "word " * 3000, "en", "s", 15000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, found int").selectExpr(
        "*", *[f"{i} AS {c}" for i, c in enumerate(
            ["_row", "_quality", "_spans", "_digest", "key", "fp", "row", "score", "_id", "_text", "_k0", "rules", "bin", "first", "root"])])
    for frame in (docs, docs.limit(0)):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == docs.columns and out.count() <= frame.count(), name
        assert cp.encoding(spark, frame, SF).count() == frame.count()
    kept = cp.near_duplicates(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "4"]
    red = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cp.secrets(spark, docs, SF).collect()}
    want = "the [SECRET] and [SECRET] [SECRET] end"
    assert red[1] == (want, len(want)) and red[2] == (None, 0) and red[3] == ("", 0)
