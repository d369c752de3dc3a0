"""The operators that use Python inside tasks, against plain Python and the libraries they must equal."""

import hashlib
import html as entities
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import Row
from pyspark.sql import functions as F

from opsight.llm import (components, fingerprints, hashing, html_crf, line_dedup, ngram_join, queries, sentencepiece_bpe,
                         url_rules, warc)
from opsight.session import shared_path
from tests.llm import brute


def _docs(folder):
    return duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet' order by 1").fetchall()


def test_shingle_sets_follow_the_words(monkeypatch):
    monkeypatch.setattr(hashing, "PIECE", 64)  # rows cross the pieces
    texts = ["a b c d e f", None, "", "A B c d E F", "a", "a a a a a a a", "x " * 200, "é\n漢 字\tb c d e", "w" * 300 + " b c d e"]
    sizes = [len(s) for _, s in hashing.shingle_sets(pa.array(texts, pa.string()))]
    assert sizes == [len(brute.shingles(t)) for t in texts]
    sets = [s.tobytes() for _, s in hashing.shingle_sets(pa.array(texts, pa.string()))]
    assert sets[0] == sets[3] and len(set(sets)) == len(sets) - 2


def test_jaccard_components(spark, folder, hard, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op1_ngram_jaccard_join(spark, folder).collect()}
    assert got == brute.jaccard_components(_docs(folder))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(hard).collect()}
    assert got == brute.jaccard_components([(r.doc_id, r.text) for r in hard.collect()])
    assert ngram_join.jaccard_components(empty).collect() == []
    twice = hard.union(hard).withColumn("doc_id", F.expr("nullif(doc_id, 0)"))
    assert ngram_join.jaccard_components(twice).count() == 2 * hard.count()
    kept = ngram_join.keep_one_per_group(hard)
    assert kept.columns == hard.columns and kept.count() == hard.count() - 2


def test_jaccard_group_of_near_copies(spark):
    """A group beyond the rare classes, whose members link in chains; prefixes use combinations."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(90):
        words = list(base)
        for j in rng.choice(120, int(rng.integers(0, 7)), replace=False):
            words[j] = f"x{rng.integers(9)}"
        rows.append((k, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string"), rare_df=3).collect()}
    assert got == brute.jaccard_components(rows)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.component for r in components.connected_components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def test_url_rules(spark, folder):
    rows = duckdb.sql(f"select page_id, url from '{folder}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in queries.op2_url_rules(spark, folder).collect()}
    assert len(got) == len(rows)
    for i, u in rows:
        host, path, rule, verdict = brute.url(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict or rule is None and got[i].verdict in ("allow", "block")


def test_url_rules_hard_cases_and_mined_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/EN/", "x://a.example.com/en/1?q#f", "x://com/", "x://com",
            "x://net/es/", "x://notnet/es/", "x://é.net/fr/é", "a://b://c/d", "x://www.example.com/en/", "x://y.www.example.com/en/z",
            "x://user@host.net:80/es/", "x://a.net?x=/es/", "http://h\nx.com/a\nb?c"]
    # outside the fixed rules: hosts whose tokens the labelled urls know
    urls += [f"http://bad{k % 2}.example.com/en/casino/{k}" for k in range(30)] + [f"http://good.example.org/en/{k}" for k in range(3)]
    urls += ["http://other.example.org/en/casino/7", "http://other.example.org/de/plain"]
    pages = spark.createDataFrame([Row(page_id=k, url=u, host="x", tokens=1, verdict="v") for k, u in enumerate(urls)],
                                  "page_id long, url string, host string, tokens int, verdict string")
    got = {r.page_id: r for r in url_rules.url_verdicts(pages).collect()}
    for k, u in enumerate(urls):
        host, path, rule, verdict = brute.url(u)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule), u
        assert verdict is None or got[k].verdict == verdict
    assert got[urls.index("http://other.example.org/en/casino/7")].verdict == "block"
    assert got[0].verdict == "allow"
    assert url_rules.url_verdicts(pages.limit(0)).collect() == []


def test_url_rules_use_path_parts_and_endings_with_digits(spark):
    urls = [f"http://a{k}.example.com/en/4u-casino/{k}" for k in range(30)] + [f"http://b{k}.example.com/en/{k}/x{k}.mp3" for k in range(30)]
    urls += [f"http://site{k}.com/web/{k}" for k in range(60)]
    urls += ["http://other.net/de/4u-casino/999", "http://other.net/de/song.mp3", "http://other.net/de/web"]
    got = {r.url: r for r in url_rules.url_verdicts(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).join(
        spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), "page_id").collect()}
    assert [got[u].verdict for u in urls[-3:]] == ["block", "block", "allow"]
    assert (got[urls[-3]].mined_rule, got[urls[-2]].mined_rule) == ("path=4u-casino", "ending=mp3")


def test_line_dedup_keeps_one_line_of_each_group(spark, hard, empty):
    line = " ".join(f"word{k}" for k in range(80))

    def bits(x):
        return np.unpackbits(line_dedup.simhashes(*list(hashing.word_runs(pa.array([x], pa.large_string())))[0][1:]).view(np.uint8))

    # the blocks promise to find what differs in fewer bits than there are blocks
    near = next(x for x in (line.replace("word40", f"other{k}") for k in range(500)) if (bits(x) != bits(line)).sum() < line_dedup.BLOCKS)
    rows = [(1, f"first here\n{line}\nown words of the first document only"), (2, f"{line.upper()}\nsomething else that is new here"),
            (3, f"{near}\n{near}\nthird document with its own line"), (4, line), (5, None), (6, ""), (7, "too short\ntoo short"), (None, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.line_report(docs).collect()}
    assert got == {1: rows[0][1], 2: "something else that is new here", 3: "third document with its own line", 4: "", 5: None,
                   6: "", 7: "too short", None: line}
    kept = {r.doc_id for r in line_dedup.without_repeated_lines(docs).collect()}
    assert kept == {1, 2, 3, 5, 6, 7, None}
    out = line_dedup.without_repeated_lines(hard)
    assert out.columns == hard.columns and out.schema["n_chars"] == hard.schema["n_chars"]
    assert all(r.n_chars == len(r.text or "") for r in out.collect())
    assert line_dedup.line_report(empty).collect() == []
    assert line_dedup.line_report(hard.union(hard)).count() == 2 * hard.count()


def test_line_dedup_exact_repeats(spark, folder):
    """No normal form is left twice, and the first occurrence of each group is kept."""
    docs = _docs(folder)
    got = {r.doc_id: r.text for r in queries.op3_line_dedup(spark, folder).collect()}
    norm = lambda x: tuple(brute.WORD.findall(brute.lowered(x)))
    seen = set()
    for i, _ in docs:
        for x in (got[i] or "").split("\n"):
            if norm(x):
                assert norm(x) not in seen
                seen.add(norm(x))
    for i, t in docs:
        assert set((got[i] or "").split("\n")) <= set((t or "").split("\n")) | {""}
    lost = {norm(x) for _, t in docs for x in (t or "").split("\n") if norm(x)} - seen
    left = [set(s) for s in seen]
    assert all(len(x) >= line_dedup.MIN_FUZZY and any(len(set(x) & s) >= 0.5 * len(set(x)) for s in left) for x in lost)


def _edited(rng, words, edits):
    """``words`` after so many random substitutions, deletions and insertions."""
    words = list(words)
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(words)))
        words[at:at + (kind < 2)] = [f"new{rng.integers(1 << 30)}"] if kind != 1 else []
    return words


def test_line_dedup_recall(spark):
    """Against brute-force edit similarity: lines of 4 to 90 words with up to a fifth of them changed."""
    rng = np.random.default_rng(11)
    rows, wanted = [], []
    common = [f"c{k}" for k in range(40)]  # phrases that many lines share
    for k in range(1500):
        n = int(rng.integers(4, 91))
        base = [f"w{rng.integers(1 << 30)}" for _ in range(n)] if k % 3 else [*common[:n // 2], *(f"w{rng.integers(300)}" for _ in range(n - n // 2))]
        other = _edited(rng, base, int(rng.integers(0, n // 5 + 2)))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
        if line_dedup.edit_distance(base, other) * 10 <= max(len(base), len(other)):
            wanted.append(2 * k + 1)
    got = {r.doc_id: r.n_removed for r in line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(wanted) > 500 and sum(got[i] for i in wanted) >= 0.9 * len(wanted)
    words = {i: t.split() for i, t in rows}
    union = brute.Union(words)
    for i, a in words.items():
        for j in range(i):
            b, longer = words[j], max(len(a), len(words[j]))
            if 10 * min(len(a), len(b)) >= 9 * longer and 5 * len(set(a) & set(b)) >= 2 * len(set(a)) and line_dedup.edit_distance(a, b) * 10 <= longer:
                union.join(i, j)
    assert {i for i, n in got.items() if n} <= {i for i in words if union.find(i) != i}


def test_line_dedup_of_many_versions(spark, monkeypatch):
    """A line with very many versions: lists too long for pairs still link all that are near."""
    monkeypatch.setattr(line_dedup, "LONG_LIST", 6)
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(300):
        words = list(base)
        words[int(rng.integers(60))] = f"v{k}"
        rows.append((k, " ".join(words)))
    got = {r.doc_id: r.n_removed for r in line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: int(k > 0) for k in range(300)}


def test_line_dedup_short_lines_and_scripts_without_blanks(spark):
    """Equal lines of any length stay once; lines without blanks have units to compare."""
    chinese, thai, token = "这是一个没有空格的很长的中文句子用来测试", "ภาษาไทยไม่มีช่องว่างระหว่างคำ", "QmFzZTY0IHRva2VuIHdpdGhvdXQgYmxhbmtz"
    rows = [(1, f"All rights reserved.\nown\n{chinese}\n{token}"), (2, "other words\nall  rights reserved."),
            (3, f"x\n{chinese[:5]}那{chinese[6:]}\n{thai}"), (4, f"x\n{thai}\n{thai}\n{token[:9]}Z{token[10:]}"), (5, "own\nown\nlast")]
    got = {r.doc_id: r.text for r in line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "other words", 3: f"x\n{thai}", 4: "", 5: "last"}


def test_html_blocks_keep_formulas_and_fallback_texts():
    texts = lambda page: [b.text for b in html_crf.leaf_blocks(page)]
    assert texts("<p>so <math><mi>E</mi><mo>=</mo><mn>3</mn></math> holds</p>") == ["so E=3 holds"]
    assert texts("<p>a</p><noscript><p>fallback</p></noscript><iframe>frame</iframe>") == ["a", "fallback", "frame"]
    for tag in ("math", "object", "select", "svg", "noscript", "textarea", "template", "title"):
        assert texts(f"<div><p>before</p><{tag}></div><p>the rest of the page</p>")[-1] == "the rest of the page"
    assert texts("<p>a</p><select><option>x</select><script>y</script><style>z") == ["a"]
    long = html_crf.leaf_blocks("<p>" + "words " * 100 + "all rights reserved</p>")[0]
    assert "says=True" in long.features


def test_fingerprint_errors_by_length(spark):
    """Estimates against whole shingle sets: near copies of 5, 20 and 200 words, a tenth of them changed."""
    rng = np.random.default_rng(3)
    for n, most in ((5, 0.2), (20, 0.13), (200, 0.04)):
        errors = []
        for _ in range(150):
            a = [f"word{k}" for k in rng.integers(0, 5000, n)]
            b = [f"other{rng.integers(5000)}" if k in set(rng.choice(n, max(1, n // 10), replace=False)) else w for k, w in enumerate(a)]
            a, b = " ".join(a), " ".join(b)
            x, y = brute.byte_shingles(a), brute.byte_shingles(b)
            errors.append(abs(len(x & y) / len(x | y) - fingerprints.likeness(fingerprints.kept_hashes(a), fingerprints.kept_hashes(b))))
        assert np.mean(errors) < most
    kept = fingerprints.kept_hashes("ABC def " * 9000 + "é漢字")
    assert (kept == fingerprints.kept_hashes("abc def " * 9000 + "é漢字")).all() and len(kept) < 40
    some = "".join(rng.choice(list("abcdefgh "), 400_000))
    assert len(fingerprints.kept_hashes(some)) == pytest.approx(fingerprints.FRACTION * len(brute.byte_shingles(some)), rel=0.02)


def test_edit_distance_and_simhash():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            above, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                above, row[j] = row[j], min(above + (x != y), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = (rng.integers(0, 4, rng.integers(0, 12)).tolist() for _ in range(2))
        assert line_dedup.edit_distance(a, b) == plain(a, b)
    words = hashing.mix(np.arange(1, 1300, dtype=np.uint64))
    sims = line_dedup.simhashes(np.concatenate((words, words[:8], words)), np.array([0, 1299, 1307, 2606]))
    assert (sims[0] == sims[2]).all() and (sims[0] != sims[1]).any()
    # the bits of more than half of a line's distinct units, whatever its length
    sizes = [*range(30), 255, 256, 511, 512, 700]
    lines = [rng.integers(0, 400, n).astype(np.uint64) << np.uint64(20) for n in sizes]
    sims = line_dedup.simhashes(np.concatenate(lines), np.cumsum([0, *sizes]))
    for line, sim in zip(lines, sims):
        units = hashing.mix(np.unique(line >> np.uint64(16)))
        bits = np.unpackbits(line_dedup._bits(units).view(np.uint8), axis=1, bitorder="little").astype(int)
        assert (np.unpackbits(sim.view(np.uint8), bitorder="little") == (2 * bits.sum(axis=0) > len(units))).all()


def test_sentencepiece_equals_the_library(spark, folder, hard, empty):
    model = sentencepiece_bpe.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=model)

    def want(text):
        ids = library.encode(text or "", add_eos=True)
        return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())

    got = {r.doc_id: tuple(r)[1:] for r in queries.op5_sentencepiece(spark, folder).collect()}
    assert got == {i: want(t) for i, t in _docs(folder)}
    got = {r.doc_id: tuple(r)[1:] for r in sentencepiece_bpe.token_report(hard).collect()}
    assert got == {r.doc_id: want(r.text) for r in hard.collect()}
    ids = {r.doc_id: r.ids for r in sentencepiece_bpe.encoded(hard).collect()}
    assert all(ids[r.doc_id] == library.encode(r.text or "", add_eos=True) for r in hard.collect())
    assert sentencepiece_bpe.token_report(empty).collect() == []


def test_sentencepiece_random_texts():
    model = sentencepiece_bpe.default_model()
    library, own = sentencepiece.SentencePieceProcessor(model_file=model), sentencepiece_bpe.PrefixTableEncoder(model)
    rng = np.random.default_rng(7)
    alphabet = [*"ab e\n\t tThesai▁é漢字ß\x00\u3000\u200b😀ﬁ<>/0xA.,*", "the", "ing", "  ", "<s>", "</s>", "<0x41>", "▁▁", "un"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet, rng.integers(0, 16)))
        ids = library.encode(text, add_eos=True)
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids), text
        assert own.digest(text)[2] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    for _ in range(500):
        ids = rng.choice([*range(3, 300), 0, 1, 2], rng.integers(0, 8)).tolist()
        assert own.decode(ids) == library.decode(ids), ids


def _article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(x for x in parts if x)


def test_html_extraction(spark, folder):
    pages = duckdb.sql(f"select page_id, html from '{folder.replace('0.001', '0.01')}/pages.parquet'").fetchall()
    got = {r.page_id: (r.text, r.n_chars) for r in queries.op6_html_extraction(spark, folder.replace("0.001", "0.01")).collect()}
    right = sum(got[i][0] == _article(h) for i, h in pages)
    assert right >= 0.99 * len(pages)
    assert all(n == len(t) for t, n in got.values())


def test_html_field_on_held_out_layouts():
    sentences = ["Some words of a longer text", "Another line", "A last one, which is rather longer than the others are"]
    crf = html_crf.train(html_crf.labelled_blocks(sentences))
    held = html_crf.labelled_blocks(sentences, 200, 99)
    right = [a == b for blocks, labels in held for a, b in zip(labels, crf.labels(blocks))]
    assert sum(right) >= 0.98 * len(right)
    page = ("<body><div class='cookie-banner'>We use cookies.</div><header><a href=/>Site</a></header><ul class=menu><li><a href=/a>Home</a>"
            "<li><a href=/b>News</a></ul><article><h1>A &lt;title&gt;</h1><p>First &amp; <i>second</i>\n words<!-- no -->.</p><script>var x='<p>'</script>"
            "<div class=advert>Buy this now.</div><p>Last words.</p></article><section id=comments><p>I liked this.</p></section>"
            "<form><p>Your mail</p></form><footer>&copy; all</footer></body>")
    assert html_crf.main_text(page, crf) == "A <title>\n\nFirst & second words.\n\nLast words."


def test_html_hard_pages(spark):
    pages = [None, "", " ", "<p", "<<>>", "</p></div>", "<div>" * 2000 + "deep", "<article><p>" + "long words " * 50000, "<script>x", "<!-- open"]
    table = spark.createDataFrame([Row(page_id=k, url=None, html=h, text="x", n_chars=1) for k, h in enumerate(pages)],
                                  "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r.text for r in html_crf.extracted(table.union(table)).collect()}
    assert all(t is not None for t in got.values()) and got[0] == got[1] == ""
    assert got[7] == ("long words " * 50000).strip()
    assert html_crf.extracted(table.limit(0)).collect() == []


def test_fingerprints(spark, folder, hard, empty):
    rows = _docs(folder)
    got = {r.doc_id: r for r in queries.op7_fingerprints(spark, folder).collect()}
    texts = dict(rows)
    exact = lambda a, b: len(a & b) / len(a | b) if a | b else 0.0
    ids = [i for i, _ in rows]
    errors = []
    for k, (i, n, text) in enumerate(brute.edited(rows)):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())
        own, other = brute.byte_shingles(texts[i]), brute.byte_shingles(texts[ids[(k + 1) % len(ids)]])
        errors.append(abs(r.near_edited - exact(own, brute.byte_shingles(text))))
        errors.append(abs(r.near_next - exact(own, other)))
    assert np.mean(errors) < 0.05
    got = {r.doc_id: r for r in fingerprints.fingerprint_report(hard).collect()}
    for i, n, text in brute.edited(sorted((r.doc_id, r.text) for r in hard.collect())):
        assert (got[i].n_chars, got[i].edited_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())
    same = [r.doc_id for r in hard.collect() if r.text and r.text.startswith("w0 ") and r.text.endswith("w199")]
    assert got[same[0]].fingerprint == got[same[1]].fingerprint and got[same[0]].near_next == 1.0
    assert fingerprints.fingerprint_report(empty).collect() == []
    assert fingerprints.fingerprint_report(hard.limit(1)).count() == 1
    twice = hard.union(hard).withColumn("doc_id", F.expr("nullif(doc_id, 6)"))
    assert fingerprints.fingerprint_report(twice).count() == 2 * hard.count()


def test_fingerprints_merge_and_containment():
    words = [f"w{k}" for k in range(4000)]
    texts = [" ".join(words), " ".join(words[:200])]
    whole, part = (fingerprints.to_text(fingerprints.kept_hashes(t)) for t in texts)
    assert fingerprints.containment(part, whole) > 0.97  # but for the shingles over the part's end
    assert fingerprints.containment(whole, part) == pytest.approx(len(texts[1]) / len(texts[0]), abs=0.02)
    whole = fingerprints.merge(whole, part)
    assert fingerprints.containment(part, whole) == 1.0
    assert fingerprints.merge(whole, part) == whole
    assert fingerprints.to_text(fingerprints.from_text(whole)) == whole


def test_warc(spark, folder):
    pages = duckdb.sql(f"select page_id, html from '{folder}/pages.parquet'").fetchall()
    got = {r.page_id: tuple(r)[1:5] for r in queries.op10_warc(spark, folder).collect()}
    assert got == brute.archive(pages)


def test_warc_hard_cases_and_random_access(spark, monkeypatch):
    big, small = "x" * 1000, "x" * 999
    pages = [(1, "u\r\nv", big), (2, None, big), (3, "http://é", small), (4, "u", small), (5, "u", None), (6, "u", ""), (7, "u", "é" * 500),
             (8, "u", "é" * 500), (9, "u", "WARC/1.1\r\n\r\n" * 200), (10, "u", big)]
    table = spark.createDataFrame([(*p, 1, "b") for p in pages], "page_id long, url string, html string, frame int, bundle string")
    got = {r.page_id: tuple(r)[1:5] for r in warc.archive_report(table).collect()}
    assert got == brute.archive([(i, h) for i, _, h in pages])
    assert warc.archive_report(table.limit(0)).collect() == []
    assert warc.archive_report(table.union(table).withColumn("page_id", F.expr("nullif(page_id, 3)"))).count() == 2 * len(pages)
    folder = "file://" + shared_path(spark, "test-warc").removeprefix("file:")
    index = warc.write_archive(table, folder).collect()
    for r in index:
        headers, block = warc.BundleReader(folder, r.bundle).record(r.frame, r.offset, r.length)
        assert headers["WARC-Record-ID"] == r.record_id
        if headers["WARC-Type"] == "response":
            assert block == (dict((i, h) for i, _, h in pages)[r.page_id] or "").encode()


def test_links_of_buckets_over_several_rounds(spark, monkeypatch):
    """Links that only a later round finds, in a large bucket whose members are compared in parts."""
    monkeypatch.setattr(components, "PART", 50)
    rows = [(s, i, 10, 0, 10) for s in range(3) for i in range(s, 400, 2)]
    postings = spark.createDataFrame(rows, "sig long, id long, size long, rank long, usable long")
    verify = lambda pairs: pairs.select("a", "b", F.lit(None).cast("long").alias("shared"), F.expr("a % 7 = b % 7").alias("link"))
    found, links = components.links_from_buckets(postings, verify)
    union = brute.Union(range(400))
    members = [sorted({i for s, i, *_ in rows if s == k}) for k in range(3)]
    for own in members:
        for a in own:
            for b in own:
                if a < b and a % 7 == b % 7:
                    union.join(a, b)
    assert {r.id: r.component for r in found.collect()} == {i: union.find(i) for i in range(400)}
    assert links.filter("a % 7 <> b % 7").count() == 0


def test_html_of_deep_and_unclosed_markup():
    """Blocks of awkward pages are found in linear time, their features reached through the open elements."""
    import time

    for unit in ("<ul><li><p>x</b></i>", "<div>x ", "<p ", "<b><p>y", "<b><div>x</b>", "<!-- ", "<a href='x'>y"):
        took = []
        for n in (3000, 12000):
            start = time.process_time()
            blocks = html_crf.leaf_blocks(unit * n)
            html_crf.Field(weights={"in=div": 0.1, "tag=p": -1.0}).labels(blocks)
            took.append(time.process_time() - start)
        assert took[1] < 8 * took[0] + 1
    blocks = html_crf.leaf_blocks("<div class='menu top'><ul><li>one</b><li><b>two</li></ul></div><p>three <i>four</i>")
    assert [b.text for b in blocks] == ["one", "two", "three four"]
    assert {"in=div", "name=menu", "in=ul", "in=li", "tag=li"} <= set(blocks[0].features) and "in=div" not in blocks[2].features
    field = html_crf.Field(weights={"in=div": -2.0, "bias": 1.0})
    assert field.labels(blocks) == [0, 0, 1]


def test_url_rules_of_deep_hosts_and_long_urls(spark):
    """A host of 20 labels, repeated rows and a long URL do not multiply the item sets; rules of one and two tokens are found."""
    deep = ".".join(f"l{k}" for k in range(20)) + ".com"
    rows = [(url, "block") for url in [f"x://{deep}/shop/{k}" for k in range(30)] * 2]
    rows += [(f"x://a{k}.org/shop/{k}", "allow") for k in range(40)] + [(f"x://{deep}/news/{k}", "allow") for k in range(40)]
    frame = spark.createDataFrame(rows, "url string, verdict string")
    labelled = url_rules.judged_urls(frame.withColumn("page_id", F.lit(1))).select("tokens", "verdict")
    rules = {(tuple(r.tokens), r.verdict): r for r in url_rules.mine_rules(labelled, min_support=0.05).collect()}
    assert len(rules) < 200
    assert (("domain=org",), "allow") in rules and (("path=news",), "allow") in rules
    pairs = [r for (tokens, verdict), r in rules.items() if verdict == "block" and len(tokens) == 2]
    assert any(set(r.tokens) == {f"domain={deep}", "path=shop"} and r.confidence == 1.0 and r.matches == 60 for r in pairs)
    urls = ["x://example.com/en/1"] * 40 + ["x://y.net/es/" + "a/" * 3000, "x://" + "z." * 400 + "com/?" + "k=v&" * 2000] + [f"x://b{k}.org/q" for k in range(9)]
    got = {r.page_id: r for r in url_rules.url_verdicts(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert len(got) == len(urls) and [got[k].rule for k in (0, 40, 41, 42)] == ["example.com/en/", "net/es/", "com/", None]
    twice = [(1, "x://example.com/en/1"), (1, "x://example.com/en/1"), (1, "x://other.net/es/")]
    assert url_rules.url_verdicts(spark.createDataFrame(twice, "page_id long, url string")).count() == 3


def test_url_rules_leave_no_combination_out(spark):
    """Rules equal those of all token subsets, with domains above the deepest one and tokens that occur together."""
    from itertools import combinations, product

    rng = np.random.default_rng(5)
    rows = []
    for k in range(400):
        host = f"{rng.choice(['a', 'b', 'www'])}.{rng.choice(['p', 'q', 'r'])}.{rng.choice(['net', 'org'])}"
        path = f"{rng.choice(['ads', 'x'])}/{rng.choice(['y', 'z'])}"
        bad = host.endswith(".net") and path.startswith("ads") and rng.random() < 0.95 or rng.random() < 0.1
        rows.append((f"x://{host}/{path}", "block" if bad else "allow"))
    rows += [("x://s0.s1.org/ads/y", "block")] * 9 + [("x://s0.s1.org/x/y", "allow")] * 9
    frame = spark.createDataFrame(rows, "url string, verdict string")
    labelled = url_rules.judged_urls(frame.withColumn("page_id", F.lit(1))).select("tokens", "verdict")
    seen, n = {}, len(rows)
    for tokens, verdict in labelled.collect():
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                seen.setdefault(part, {}).setdefault(verdict, []).append(1)
    share = {v: sum(x[1] == v for x in rows) / n for v in ("allow", "block")}
    every = {(part, v): len(hit) / sum(map(len, per.values())) for part, per in seen.items() for v, hit in per.items() if len(hit) >= max(5, 0.01 * n)}
    every = {k: c for k, c in every.items() if c >= 0.8 and c > share[k[1]]}
    want = {(part, v): c for (part, v), c in every.items()
            if not any(every.get((part[:i] + part[i + 1:], v), -1) >= c for i in range(len(part) if len(part) > 1 else 0))}
    found = url_rules.mine_rules(labelled, min_support=0.01).collect()
    got = {(tuple(sorted(one)), r.verdict): r.confidence for r in found for one in product(*r.alike)}
    assert got == want and any({"domain=net", "path=ads"} == set(part) for part, _ in got)
    # a token that always occurred with another one decides by itself
    urls = spark.createDataFrame([(["host=s0", "path=ads"],), (["domain=net", "host=new", "path=ads"],)], "tokens array<string>")
    assert [r.mined for r in url_rules.match_rules(urls, url_rules.mine_rules(labelled, min_support=0.01)).collect()] == ["block", "block"]


def test_url_rules_of_nested_hosts(spark):
    """Hosts within one another, each with both verdicts, give no subsets of their labels."""
    rows = []
    for k in range(16):
        host = ".".join(f"l{i}" for i in range(k, 16)) + ".com"
        rows += [(f"x://{host}/shop/", "block")] * 6 + [(f"x://{host}/news/", "allow")] * 6 + [(f"x://{host}/shop/top", "allow")] * 1
    frame = spark.createDataFrame(rows, "url string, verdict string")
    labelled = url_rules.judged_urls(frame.withColumn("page_id", F.lit(1))).select("tokens", "verdict")
    rules = url_rules.mine_rules(labelled, min_support=0.01).collect()
    assert len(rules) < 200 and any(set(r.tokens) == {"path ends with /", "path=shop"} and r.confidence == 1.0 for r in rules)


def test_line_dedup_forms_few_pairs_of_a_group_that_is_not_linked(spark):
    """Lines that differ from a common line by a quarter of their words, each by others, are told apart by their bitmaps."""
    rng = np.random.default_rng(8)
    base = [f"word{k}" for k in range(60)]
    lines = []
    for k in range(120):
        own = list(base)
        for at in rng.choice(60, int(rng.integers(2, 20)), replace=False):
            own[at] = f"x{rng.integers(40)}"
        lines.append(own)
    found = [(h, w, b) for _, w, b in hashing.word_runs(pa.array([" ".join(x) for x in lines], pa.large_string()))
             for h in [hashing.sequence_hashes(w, b).view(np.int64)]]
    ids = np.concatenate([h for h, _, _ in found]).tolist()
    bits = np.concatenate([line_dedup.unit_bitmaps(w, b) for _, w, b in found]).tolist()
    details = spark.createDataFrame(list(zip(ids, [60] * len(ids), bits)), "id long, n long, bits array<long>")
    similar = {(a, b) for i, a in enumerate(ids) for j, b in enumerate(ids) if a < b and line_dedup.similar(lines[i], lines[j])}
    truth = spark.createDataFrame([(*x, True) for x in similar], "a long, b long, ok boolean")
    formed = []

    def verify(pairs):
        formed.append(pairs.count())
        return pairs.join(truth, ["a", "b"], "left").select("a", "b", F.lit(None).cast("long").alias("shared"), F.coalesce("ok", F.lit(False)).alias("link"))

    postings = spark.createDataFrame([(1, i, 1, 0, 1) for i in ids], "sig long, id long, size long, rank long, usable long")
    want = {r.id: r.component for r in components.links_from_buckets(postings, verify)[0].collect()}
    before, formed[:] = formed[-1], []
    got = {r.id: r.component for r in components.links_from_buckets(postings, verify, details=details, may_link=line_dedup._MAY_LINK)[0].collect()}
    assert got == want and len(got) > 5 and formed[-1] < before / 5
    # no pair within the threshold is ruled out, repeated units and different lengths included
    pairs = []
    for k in range(300):
        a = [f"u{rng.integers(30)}" for _ in range(int(rng.integers(10, 90)))]
        b = list(a)
        for _ in range(int(rng.integers(0, 1 + len(a) // 8))):
            at = int(rng.integers(len(b)))
            b[at:at + int(rng.integers(2))] = [f"u{rng.integers(30)}"] * int(rng.integers(2))
        runs = [next(iter(hashing.word_runs(pa.array([" ".join(x)], pa.large_string())))) for x in (a, b)]
        pairs.append((line_dedup.similar(a, b), len(a), line_dedup.unit_bitmaps(*runs[0][1:])[0].tolist(), len(b), line_dedup.unit_bitmaps(*runs[1][1:])[0].tolist()))
    frame = spark.createDataFrame(pairs, "link boolean, n long, bits array<long>, o_n long, o_bits array<long>")
    assert frame.filter("link").count() > 100 and frame.filter(f"link and not ({line_dedup._MAY_LINK})").count() == 0
    assert frame.filter(f"not ({line_dedup._MAY_LINK})").count() > 0


def test_jaccard_blocks_take_few_bytes():
    """Shingles and block keys are packed without loss, in fewer bytes than they have."""
    rng = np.random.default_rng(3)
    for bits in (8, 11, 12, 14, 18):
        for bucket in (0, 5, (1 << bits) - 1):
            tokens = np.sort(rng.integers(0, 1 << 48 - bits, 3000, dtype=np.uint64)) | np.uint64(bucket << 48 - bits)
            tokens[7:40] = tokens[7]
            high, low = ngram_join._halves(tokens)
            packed = ngram_join._packed_high(high, bucket, bits)
            assert (ngram_join._unpacked_tokens(packed, low.tobytes(), bucket, bits) == tokens).all()
            assert len(pa.compress(packed, codec="lz4", asbytes=True)) < 3000 or bits > 8
            none = ngram_join._packed_high(high[:0], bucket, bits)
            assert not len(ngram_join._unpacked_tokens(none, b"", bucket, bits))


def test_line_dedup_block_keys_take_two_bytes():
    """A bucket and the rest of a key are a permutation of the keys; rows of the block lists have 14 bytes a key."""
    keys = np.arange(0, line_dedup.BLOCKS << line_dedup.BLOCK_BITS, 37, dtype=np.uint32)
    for bits in (10, 14, 18):
        bucket, left = line_dedup._split_keys(keys, bits)
        assert left.dtype == np.uint16 and bucket.max() < 1 << bits and len(np.unique(bucket.astype(np.int64) << 32 | left)) == len(keys)
        assert np.bincount(bucket).max() < 2 * len(keys) / (1 << bits) + 20
    lines = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{k * 20 + j}" for j in range(20)) for k in range(50)])], ["text"])
    rows = [r for b in line_dedup._block_lists(10)(iter([lines])) for r in b.to_pylist()]
    assert sum(len(r["ids"]) for r in rows) == 8 * 50 * line_dedup.BLOCKS
    assert sum(len(r["keys"]) + len(r["ids"]) + len(r["checks"]) for r in rows) == 14 * 50 * line_dedup.BLOCKS


def test_line_dedup_lists_of_the_same_lines_are_one():
    """Two lines that agree in several blocks share one signature, not one for each block."""
    ids = np.array([11, 22, 11, 22, 11, 22, 33], np.uint64)
    sigs, members = line_dedup.candidate_lists(np.array([5, 5, 9, 9, 7, 7, 7], np.uint32), ids, np.array([0, 0, 0, 0, 0, 0, 1], np.uint32))
    lists = {}
    for s, x in zip(sigs.tolist(), members.tolist()):
        lists.setdefault(s, set()).add(x)
    assert sorted(map(sorted, lists.values())) == [[11, 22], [11, 22, 33]]


def test_line_dedup_bound_of_edits():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = rng.integers(0, 6, rng.integers(1, 30)).astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 3)))
        b[rng.random(len(b)) < 0.1] = 7
        for x, y in ((a, b), (b, a)):
            assert line_dedup.edit_distance(x.tolist(), y.tolist()) <= line_dedup._edits_at_most(x, y) <= max(len(x), len(y))


def test_line_dedup_reads_only_listed_lines(monkeypatch):
    """A row without a repeat of its own is hashed at its listed lines only; rows that share a doc_id may differ."""
    hashed = []
    line_hashes = line_dedup._line_hashes
    monkeypatch.setattr(line_dedup, "_line_hashes", lambda x: (hashed.append(len(x)), line_hashes(x))[1])
    h = [int(x) for x in line_hashes(pa.array(["one a", "two b", "six c"], pa.large_string()))[0].view(np.int64)]
    rows = pa.StructArray.from_arrays([pa.array([1, 1, 2]), pa.array(["one a\ntwo b\n\nsix c", "two b", "One a\none  A\n\ntwo b"])], names=["doc_id", "text"])
    batch = pa.RecordBatch.from_arrays([rows, pa.array([[1, 3], [1, 3], [-1, 3]], pa.list_(pa.int32())),
                                        pa.array([[h[1], h[0]], [h[1], h[0]], [0, h[1]]], pa.list_(pa.int64()))], ["row", "numbers", "hashes"])
    out = pa.Table.from_batches(list(line_dedup._kept(iter([batch])))).to_pylist()
    assert [(r["row"]["text"], r["removed"], r["left"]) for r in out] == [("one a\n\nsix c", 1, 2), ("two b", 0, 1), ("One a\n", 2, 1)]
    assert hashed == [2, 4]


def test_new_links_join_components(spark):
    """Components and new ids that later links connect, as if all links were searched at once."""
    first, later = [(5, 9), (9, 7), (2, 8), (30, 31)], [(7, 8), (31, 40), (50, 51), (51, 9), (60, 61)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    found = components.joined_components(components.connected_components(frame(first)), frame(later))
    want = components.connected_components(frame(first + later))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    none = spark.createDataFrame([], "id long, component long")
    assert sorted(map(tuple, components.joined_components(none, frame(first + later)).collect())) == sorted(map(tuple, want.collect()))
