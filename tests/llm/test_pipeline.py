"""The corpus pipeline, stage by stage, against plain Python on each stage's own input."""

import hashlib

import sentencepiece

import corpus_pipeline
from opsight.llm import mixing, sentencepiece_bpe
from opsight.llm.common import shared_table
from tests.llm import brute


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_jaccard_join", "mixing", "sentencepiece"]
    outs, rows = {}, {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        before = outs[name] = shared_table(stage(spark, before, folder), name)
        rows[name] = before.collect()
        if name != "sentencepiece":
            assert before.columns == docs.columns
    given = {r.doc_id: r.text for r in docs.collect()}

    good = {r.doc_id: r.text for r in rows["quality_rules"]}
    assert all(good[i] == given[i] and not brute.quality_base(good[i])[5] for i in good)

    lines = {r.doc_id: r for r in rows["line_dedup"]}
    assert set(lines) <= set(good)
    norm = lambda x: tuple(brute.WORD.findall(brute.lowered(x)))
    seen = [norm(x) for i in sorted(lines) for x in lines[i].text.split("\n") if norm(x)]
    assert len(seen) == len(set(seen))
    assert set(seen) <= {norm(x) for t in good.values() for x in t.split("\n")}
    assert all(r.n_chars == len(r.text) for r in lines.values())

    groups = brute.jaccard_components([(i, r.text) for i, r in lines.items()])
    assert {r.doc_id for r in rows["ngram_jaccard_join"]} == {i for i, (_, c) in groups.items() if c == i}

    taken = {r.doc_id: r.taken for r in mixing.mix_report(outs["ngram_jaccard_join"]).collect() if r.taken}
    got = {}
    for r in rows["mixing"]:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(brute.WORD.findall(r.text))
    assert got == taken

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    want = []
    for r in rows["mixing"]:
        ids = library.encode(r.text, add_eos=True)
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(tuple(r) for r in rows["sentencepiece"]) == sorted(want)
    assert corpus_pipeline.run(spark, folder).count() == len(want)
