import corpus_pipeline
import sentencepiece

from cartwise.llm import queries
from cartwise.llm.shared import written
from tests.conftest import SF
from tests.llm.test_lines_and_rules import _lines_by_hand
from tests.llm.test_near_duplicates import _components, _fingerprint
from tests.llm.test_substrings import _marks_by_hand


def test_every_stage_like_by_hand(spark):
    docs = queries.read(spark, SF, "documents")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in queries.op1_quality_classifier(spark, SF).where("predicted = 1").collect()}
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        out[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "sentencepiece_encoding" or docs.columns == columns

    kept = {i: t for i, t in kept.items() if i in good}
    assert {i: r.text for i, r in out["quality_classifier"].items()} == kept

    kept = {r[0]: r[1] for r in _lines_by_hand([(i, t, None, None, None) for i, t in kept.items()], 10)}
    assert {i: r.text for i, r in out["line_dedup"].items()} == kept
    assert all(r.n_chars == len(r.text) for r in out["line_dedup"].values())

    prints = {i: _fingerprint(t) for i, t in kept.items()}
    roots, least = _components(set(prints.values()), 2), {}
    for i in sorted(kept):
        least.setdefault(roots[prints[i]], i)
    kept = {i: kept[i] for i in least.values()}
    assert {i: r.text for i, r in out["simhash_near_dedup"].items()} == kept

    items = [(r.item_id, r.text) for r in queries.read(spark, SF, "benchmark").collect()]
    clean = {r[0] for r in _marks_by_hand([(i, t, None, None) for i, t in kept.items()], items, 13) if not r[-1]}
    kept = {i: t for i, t in kept.items() if i in clean}
    assert {i: r.text for i, r in out["benchmark_decontamination"].items()} == kept

    peer = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    assert {i: r.token_ids for i, r in out["sentencepiece_encoding"].items()} == {i: peer.encode(t) for i, t in kept.items()}
    assert all(r.n_tokens == len(r.token_ids) for r in out["sentencepiece_encoding"].values())


def test_the_whole_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
