"""Awkward tables for every pipeline stage: clashing column names, NULLs, repeated rows, empty tables."""

import hashlib

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from opsight.llm import warc
from tests.llm.conftest import HARD_TEXTS

NAMES = ("_slot", "_word", "_maybe", "maybe", "__maybe", "__gone", "__removed", "__repeated", "__id", "__copy", "__ranges", "__quality",
         "slot_word", "slot_bits", "row", "removed", "left", "gone", "h", "mark", "Maybe_", "kept", "component")
GOOD = " ".join(f"common words of an ordinary sentence number {k} about topic {k * 7}." for k in range(12))


@pytest.fixture(scope="session")
def clashing(spark):
    texts = [*HARD_TEXTS, GOOD, GOOD, GOOD.replace("topic 7.", "matter 7."), None, ""]
    rows = [Row(doc_id=None if k % 11 == 10 else k, text=t, lang="en", source=[None, "b", "a"][k % 3], n_chars=len(t or ""),
                **{f"x{j}": j for j in range(len(NAMES))}) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                  + ", ".join(f"x{j} int" for j in range(len(NAMES))))
    return frame.toDF(*frame.columns[:5], *NAMES)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_tables(spark, folder, clashing, name, stage):
    docs = clashing.union(clashing.filter("doc_id is null or doc_id % 3 = 0"))
    out = stage(spark, docs, folder)
    rows = out.collect()
    assert stage(spark, docs.limit(0), folder).collect() == []
    if name == "sentencepiece":
        assert len(rows) == docs.count()
        return
    assert out.columns == docs.columns
    assert all(r[5:] == tuple(range(len(NAMES))) for r in rows)
    assert all(r.n_chars == len(r.text or "") for r in rows)
    given = {(r.doc_id, r.text) for r in docs.collect()}
    if name in ("line_dedup", "ngram_jaccard_join"):
        assert any(r.text == GOOD for r in rows)
    if name in ("quality_rules", "ngram_jaccard_join"):
        assert {(r.doc_id, r.text) for r in rows} <= given
    if name in ("line_dedup", "ngram_jaccard_join"):  # rows without an id stay
        assert sum(r.doc_id is None for r in rows) == docs.filter("doc_id is null").count()


def test_pipeline_of_an_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_warc_of_repeated_page_ids(spark):
    a, b, c = "a" * 2000, "b" * 3000, "c" * 1500
    rows = [(5, "u", a), (9, "u", a), (5, "v", c), (5, "w", b), (8, "w", b), (9, "u", a), (7, "t", "short"), (6, "t", "short"), (None, "n", a)]
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_report(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=str)

    def want(page_id, html):
        last = max([i for i, _, h in rows if i is not None and h == html])
        revisit = len(html) >= 1000 and page_id is not None and page_id < last
        return page_id, len(html), hashlib.sha1(html.encode()).hexdigest(), "revisit" if revisit else "response", last if revisit else None
    assert got == sorted((want(i, h) for i, _, h in rows), key=str)


def test_warc_records_of_one_page_id_are_found_apart(spark, tmp_path):
    rows = [(5, "u", "a" * 2000), (5, "v", "c" * 1500), (5, "v", None)]
    folder = f"file://{tmp_path}/archive"
    index = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), folder).collect()
    assert len({r.record_id for r in index}) == 3
    blocks = {warc.BundleReader(folder, r.bundle).record(r.frame, r.offset, r.length)[1] for r in index}
    assert blocks == {(h or "").encode() for _, _, h in rows}


def test_clashing_names_of_the_operators(spark, clashing):
    from opsight.llm import fingerprints, mixing, ngram_join, periodic_runs, secret_ledger, sentencepiece_bpe, spelling_variants, substring_dedup
    n = clashing.count()
    for report in (ngram_join.jaccard_components, mixing.mix_report, sentencepiece_bpe.token_report, fingerprints.fingerprint_report,
                   secret_ledger.secret_report, substring_dedup.dedup_report, periodic_runs.run_report):
        assert report(clashing).count() == n
    assert spelling_variants.spelling_variants(clashing).filter(F.col("n") < 3).count() == 0
