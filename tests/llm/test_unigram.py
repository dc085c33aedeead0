import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from flowguard.llm.queries import MODEL, op8_token_counts, op9_sentencepiece  # noqa: E402
from flowguard.llm.sentencepiece_scan import _Chunk, decoded, encode, product  # noqa: E402
from flowguard.llm.token_counts import count_tokens  # noqa: E402
from flowguard.llm.unigram import Unigram, Vocabulary, decode, prepare, read_vocabulary  # noqa: E402
from tests.llm.util import SF, SF01, read  # noqa: E402


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(MODEL)


def sequential(model, text):
    """The plain program over the whole text, without parts or caches."""
    text = prepare(text)
    best, back = model.forward(text, {0: 0.0})
    return model.trace(text, back, len(text))[0]


LEAST = -40000.0     # stands for the -1e9 of 15 pieces, beside which 32-bit sums lose the rest


def library():
    """The library itself with the same pieces and scores as a unigram model."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for piece in proto.pieces:
        piece.score = max(piece.score, LEAST)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_equals_the_library_where_its_sums_are_exact(spark, vocabulary):
    sp = library()
    model = Unigram(vocabulary._replace(scores=[max(s, LEAST) for s in vocabulary.scores]))
    n = 0
    for r in read(spark, "documents", SF01).select("text").collect():
        for line in r["text"].split("\n"):
            words = line.split(" ")
            for at in range(0, len(words), 40):    # sums stay below 2**24
                text = " ".join(words[at:at + 40])
                if text:
                    assert model.encode(text) == sp.encode(text), text
                    n += 1
    assert n > 3000


def test_counts_equal_paths_and_brute_force(spark, vocabulary):
    model = Unigram(vocabulary)
    docs = {r["doc_id"]: r["text"] for r in read(spark, "documents").collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in op8_token_counts(spark, SF).collect()}
    assert got == {i: len(sequential(model, t)) for i, t in docs.items()}


def all_paths(model, text):
    """Best score and piece counts of all segmentations, by plain recursion."""
    def go(at):
        if at == len(text):
            return [(0.0, 0)]
        ways = [(n, model.v.scores[i]) for i, p in enumerate(model.v.pieces) if p and text.startswith(p, at)
                for n in [len(p)]]
        if text[at] not in model.single:
            ways.append((1, model.unknown))
        return [(s + t, c + 1) for n, s in ways for t, c in go(at + n)]
    return go(0)


def toy(pieces):
    byte = [len(pieces) + b for b in range(256)]
    return Vocabulary([p for p, _ in pieces] + [""] * 256, [s for _, s in pieces] + [0.0] * 256, byte,
                      [p.replace("▁", " ").encode() for p, _ in pieces] + [bytes([b]) for b in range(256)])


TOY = toy([("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("aa", -4.0), ("▁a", -3.0), ("ba", -3.0),
           ("aba", -6.0), ("bb▁a", -4.0)])


def test_toy_brute_force():
    rnd, model = random.Random(1), Unigram(TOY)
    assert model.parts is None
    for _ in range(200):
        text = "".join(rnd.choice("ab c") for _ in range(rnd.randint(1, 7)))
        whole = prepare(text)
        best, back = model.forward(whole, {0: 0.0})
        paths = all_paths(model, whole)
        top = max(s for s, _ in paths)
        assert best[-1] == top
        assert model.count(text) == len(model.encode(text))
        assert decode(TOY.surface, model.encode(text)) == text


@pytest.mark.parametrize("which", ["toy", "file"])
def test_scan_equals_sequential(which, vocabulary):
    v = TOY if which == "toy" else vocabulary
    rnd, model = random.Random(4), Unigram(v)
    letters = "ab  c" if which == "toy" else "the rain in  spain éñ\n漢字"
    for n in range(40):
        text = prepare("".join(rnd.choice(letters if n % 3 else letters.replace(" ", "")) for _ in range(rnd.randint(60, 300))))
        size = 2 * model.longest + rnd.randint(0, 9)
        chunks = [_Chunk(model, text[s:s + size + model.longest], min(size, len(text) - s)) for s in range(0, len(text), size)]
        mats = [c.matrix() for c in chunks]
        v_in = [np.array([0.0] + [-np.inf] * (model.longest - 1))]
        for m in mats:
            v_in.append((v_in[-1][:, None] + m).max(axis=0))
        assert np.allclose(product(product(mats[0], mats[1]), mats[2]) if len(mats) > 2 else 0,
                           product(mats[0], product(mats[1], mats[2])) if len(mats) > 2 else 0, equal_nan=True)
        leave, ids = 0, []
        for c, s in zip(reversed(chunks), reversed(v_in[:-1])):
            ids = c.path(s, leave) + ids
            leave = int(c.entries(s)[leave])
        best, back = model.forward(text, {0: 0.0})
        assert ids == model.trace(text, back, len(text))[0]


def test_giant_texts_in_spark(spark, vocabulary):
    model = Unigram(vocabulary)
    rnd = random.Random(9)
    long = " ".join("".join(rnd.choice("abcdefghijé") for _ in range(rnd.randint(1, 9))) for _ in range(4000))
    rows = [(1, long), (2, "x" * 9000), (3, "short"), (None, long), (4, None), (5, ""), (1, long), (6, " " * 700),
            (7, "a▁b"), (8, "\x00퟿")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS ids", "3 AS n")
    out = encode(df, MODEL, giant_chars=600, chunk_chars=40)
    got = out.collect()   # 2 levels of the scan
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    want = sorted([(str(i), sequential(model, t) if t else []) for i, t in rows])
    assert sorted([(str(r["doc_id"]), list(r["ids"])) for r in got]) == want
    assert encode(df.limit(0), MODEL).collect() == [] and count_tokens(df.limit(0), MODEL).collect() == []
    back = decoded(out, MODEL).where("decoded <> replace(coalesce(text, ''), '\u2581', ' ')")
    assert back.count() == 0
    assert {(str(r["doc_id"]), r["n_tokens"]) for r in count_tokens(df, MODEL).collect()} == {
        (i, len(x)) for i, x in want}


def test_query_round_trip(spark):
    got = op9_sentencepiece(spark, SF).collect()
    assert got and all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in got)


def test_counts_keep_no_paths(vocabulary, monkeypatch):
    """Words of known and unknown characters are counted in the ring, without back pointers."""
    texts = ["a few known words", "x" * 40 + " internationalisation", "ab \U0001f9ff cd", "z" * 300, "", " "]
    model = Unigram(vocabulary)
    want = [len(sequential(model, t)) if t else 0 for t in texts]
    for name in ("_part_ids", "forward", "trace"):
        monkeypatch.setattr(Unigram, name, None)
    assert [model.count(t) for t in texts] == want
