"""The registered queries and the pipeline, stage by stage against brute force."""
import hashlib
import re

import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tidemark.llm import langid, mixing, pii, simhash
from tidemark.llm.queries import QUERIES, piece_model

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = list(entry.queries())
    assert [n for n in names if re.match(r"op\d+_", n)] == list(QUERIES) and "pipeline" in names
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert {"op8_mixing", "op10_fingerprints", "op11_lexical_search", "op12_line_dedup", "op13_filter_audit"} <= set(entry.oracle_sql()) and pipeline.ORACLE_SQL is None
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_copies", "personal_data", "mix", "tokens"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows, by way of Parquet."""
    base, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        after = spark.read.parquet(f"{base}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_language_stage(stages):
    before, after = stages["language"]
    assert after.columns == COLUMNS
    kept = {r.doc_id for r in after.collect()}
    found = langid.identify(before, langid.train(before)).collect()
    assert kept == {r.doc_id for r in found if r.lang_pred != "und" and r.score >= pipeline.LEAST_SCORE}
    assert len(kept) >= 0.98 * before.where("text rlike '[a-z]'").count()  # clean documents stay


def test_near_copy_stage(stages):
    before, after = stages["near_copies"]
    groups = simhash.simhash_groups(before).collect()
    assert after.columns == COLUMNS and sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in groups})


def test_personal_data_stage(stages):
    before, after = stages["personal_data"]
    assert after.columns == COLUMNS
    weights = pii.train(before)
    field = pii.Field(weights)
    texts = {r.doc_id: r for r in after.collect()}
    assert len(texts) == before.count()
    for r in before.collect():
        spans = field.spans(r.text, pii.base_spans(r.text)) if re.search("[0-9@]", r.text) else []
        out, done = "", 0
        for a, b, k in sorted(spans, key=lambda s: (s[0], -s[1])):
            if a >= done:
                out, done = out + r.text[done:a] + f"<{k.upper()}>", b
        out += r.text[done:]
        assert texts[r.doc_id].text == out and texts[r.doc_id].n_chars == len(out) and not [s for s in pii.base_spans(out) if s[2] in ("email", "card")]


def test_mix_stage(stages):
    before, after = stages["mix"]
    assert after.columns == COLUMNS
    want = {r.doc_id: int(r.taken / max(r.size, 1) + 0.5) for r in mixing.mix(before).collect()}
    got = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_token_stage(stages):
    before, after = stages["tokens"]
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    exp = sorted((r.doc_id, tuple(library.encode(r.text, num_threads=1)), hashlib.sha256(r.text.replace("▁", " ").encode()).hexdigest()) for r in before.collect())
    assert sorted((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in after.collect()) == exp


def test_run_applies_all(spark, stages):
    out = pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in df.collect())
    assert key(out) == key(stages["tokens"][1])


def test_odd_tables(spark, odd, empty):
    """Every stage takes odd rows and an empty table, and keeps the columns."""
    for table in (odd, empty):
        docs = table.select(*COLUMNS)
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.count()
            assert rows == 0 or table is odd
            if name != "tokens":
                assert out.columns == COLUMNS
