"""SentencePiece coding against the library, token counts against plain Viterbi."""
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import sentencepiece_codec as codec
from tidemark.llm import token_counts as counts


@pytest.fixture(scope="module")
def model():
    return codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def strings():
    rnd = random.Random(3)
    out = ["", " ", "   ", "a" * 5000, "ab" * 3000, "the" * 1000, " " * 3000, "▁▁a", "\n\n x\n", "<s></s><unk><0x0A>", "\x00a", "\r\n\x0b\x0c x", "²2.²"]
    out += ["".join(rnd.choice("ab ▁\n\té中\U0001f600\x00thern<0x0A>.,!'\"  ²") for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    return out + ["".join(rnd.choice("abathein") for _ in range(rnd.randint(0, 300))) for _ in range(60)]


def test_equals_the_library(spark, model, library):
    texts = strings()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in codec.decode(codec.encode(df, model), model).collect():
        ids = library.encode(texts[r.doc_id], num_threads=1)
        assert r.ids == ids, texts[r.doc_id][:50]
        assert r.decoded == library.decode(ids)


def test_decodes_any_ids(spark, model, library):
    """Ids that no encoder gives: lone and broken bytes, control and unknown pieces, spaces in front."""
    rnd = random.Random(5)
    rows = [[rnd.choice([0, 1, 2, 3, 200, 230, 240, 13, 259, 260, 300, 29871, 31000]) for _ in range(rnd.randint(0, 6))] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<int>")
    bad = [r for r in codec.decode(df, model).collect() if "�" not in r.decoded and r.decoded != library.decode(rows[r.doc_id])]
    assert not bad


def test_one_at_a_time_path_agrees(model):
    vocabulary = codec.Vocabulary(model)
    words = [w for t in strings() for w in vocabulary.words(t)][:800]
    a, na, _ = vocabulary.rounds(words, one=False)
    b, nb, _ = vocabulary.rounds(words, one=True)
    assert a.tolist() == b.tolist() and na.tolist() == nb.tolist()


def test_query_digests(documents, model, library):
    got = {r.doc_id: r for r in codec.digests(documents, model).collect()}
    for doc in documents.collect():
        ids = library.encode(doc.text or "", num_threads=1) if doc.text else []
        r = got[doc.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(odd, empty, model, library):
    got = codec.digests(odd, model).collect()
    assert len(got) == odd.count() and codec.digests(empty, model).count() == 0
    none = hashlib.sha256(b"").hexdigest()
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, none, none) for r in got if r.doc_id in (2, 3))
    assert [r.n_tokens for r in got if r.doc_id == 6] == [len(library.encode("Hello there, General.\nA second line."))] * 2
    out = codec.encode(odd, model)
    assert set(out.columns) == set(odd.columns) and out.schema["ids"].dataType.typeName() == "array"


def best(word, pieces, unknown):
    """Plain Viterbi: (score, tokens) of the best segmentation, fewer tokens at a tie."""
    at = [(0.0, 0)]
    for j in range(1, len(word) + 1):
        options = [(at[j - 1][0] + unknown, at[j - 1][1] + len(word[j - 1].encode()))]
        options += [(at[i][0] + pieces[word[i:j]], at[i][1] + 1) for i in range(max(0, j - 20), j) if word[i:j] in pieces]
        at.append(max(options, key=lambda o: (o[0], -o[1])))
    return at[-1]


def test_token_counts(spark, documents, odd, empty, model):
    pieces = counts.scores(model)
    unknown = min(pieces.values()) - counts.UNKNOWN_PENALTY
    seen = {}
    for df in (documents, odd.where("doc_id <> 5")):
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in counts.token_counts(df, model).collect():
            t = texts[r.doc_id]
            words = [w.replace(" ", "▁") for w in counts.PRE_TOKEN.findall((" " + t).replace("▁", " "))] if t else []
            for w in set(words) - seen.keys():
                seen[w] = best(w, pieces, unknown)[1]
            assert (r.n_pretokens, r.n_tokens) == (len(words), sum(seen[w] for w in words)), r.doc_id
    assert counts.token_counts(empty, model).count() == 0
    assert counts.token_counts(odd, model).where("doc_id = 5").first().n_tokens > 30_000
