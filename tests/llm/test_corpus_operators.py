"""Operators that compare texts with one another, URL rules, and the pipeline, against plain versions."""

import os
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from brute import components as plain_components
from brute import leaks, lettered, passages, quality, spaced, without_words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spindlewatch.llm import passages as passages_module
from spindlewatch.llm import quality_rules, queries, shingle_join
from spindlewatch.llm.components import components
from spindlewatch.llm.passages import remove_repeats
from spindlewatch.llm.shingle_join import similar_components
from spindlewatch.llm.url_rules import judge, rule_table
from spindlewatch.session import shared_dir


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_shingle_components(docs, all_rows, size, percent):
    rows = [r[:2] for r in all_rows]
    expected = [(i, *c) for (i, _), c in zip(rows, plain_components(rows, size, percent))]
    assert ordered(map(tuple, similar_components(docs, size=size, percent=percent).collect())) == ordered(expected)


def test_shingle_components_of_many_near_copies(make_docs, monkeypatch):
    """Copies at varying distance from one another, in blocks so small that many of them are compared."""
    monkeypatch.setattr(shingle_join, "BLOCK", 4)
    rng = np.random.default_rng(11)
    base = [f"v{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(int(rng.integers(0, 5))):
            words[int(rng.integers(0, 60))] = f"e{int(rng.integers(0, 12))}"
        if i % 3 == 0:
            words += [f"t{j}" for j in range(int(rng.integers(0, 9)))]
        rows.append((i, " ".join(words), None, None, None))
    for size, percent in ((3, 90), (1, 80)):
        expected = [(i, *c) for (i, *_), c in zip(rows, plain_components([r[:2] for r in rows], size, percent))]
        found = similar_components(make_docs(rows), size=size, percent=percent)
        assert ordered(map(tuple, found.collect())) == ordered(expected)


def test_positions_follow_the_order_by_which_sets_were_cut(spark):
    """Sets of 20 inside 22, of whose shared shingles, all beyond the counted share, the smaller one has a rarer one."""
    y, a, b, c = range(10, 14)
    sets = [(1, 20, [a, b, c]), (2, 22, [y, a, b]), (3, 20, [c, 50, 51]), (4, 20, [y, 60, 61])]
    sets += [(i, 20, [a, b, 100 + i]) for i in range(5, 9)]
    classes = spark.createDataFrame([(*s, 0) for s in sets], "node bigint, n bigint, low array<bigint>, n_first int")
    at = {(r.node, r.token): r.n - r.pos for r in shingle_join._prefixes(classes, 90, 0.05).collect()}
    # 20 of 22 are shared; a is the first shared one of both.
    assert 1 + min(at[1, a], at[2, a]) >= 20


def test_shingle_components_of_short_sets_of_unequal_size(make_docs, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 2)
    rng = np.random.default_rng(7)
    rows = []
    for _ in range(40):
        common = [f"f{i}" for i in rng.choice(60, int(rng.integers(16, 24)), replace=False)]
        for _ in range(6):
            words = [w for w in common if rng.random() > 0.03] + [f"f{i}" for i in rng.choice(60, int(rng.integers(0, 4)))]
            rows.append((len(rows), " ".join(words), None, None, None))
    expected = [(i, *c) for (i, *_), c in zip(rows, plain_components([r[:2] for r in rows], 1, 90))]
    found = similar_components(make_docs(rows), size=1, percent=90)
    assert ordered(map(tuple, found.collect())) == ordered(expected)


def test_shingle_components_of_nothing(no_docs):
    assert similar_components(no_docs).collect() == []


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 80, (60, 2))] + [(i, i + 1) for i in range(200, 260)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    label = {x: x for link in links for x in link}
    for _ in range(300):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: label[x] for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def plain_passages(rows):
    return passages(rows, passages_module.SENTENCES, passages_module.WORDS, passages_module.CUT_EVERY)


def test_passages(docs, no_docs, all_rows):
    rows = [r[:2] for r in all_rows]
    expected = [(i, *p) for (i, _), p in zip(rows, plain_passages(rows))]
    found = remove_repeats(docs)
    assert ordered((r.doc_id, r.n_sentences, r.n_removed, r.text) for r in found.collect()) == ordered(expected)
    assert set(found.columns) == {*docs.columns, "n_sentences", "n_removed"}
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[11].n_removed == 0 and by_id[12].n_removed and "p40" not in by_id[12].text
    assert by_id[12].text.startswith("Something else")
    assert remove_repeats(no_docs).collect() == []


def test_passages_of_rows_without_ids_and_with_clashing_columns(spark):
    """Rows without an id keep theirs; the columns that the operator works with may be in the table, too."""
    passage = "One two three four. Five six seven eight. Nine ten eleven twelve. "
    rows = [(None, passage, "a", [1], True, 7)] * 40 + [(i, passage + f"Own words of {i}.", "b", [i], None, i) for i in range(3)]
    rows.append((9, None, None, None, None, None))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, runs array<int>, itself boolean, n_removed int")
    found = remove_repeats(docs)
    assert set(found.columns) == {*docs.columns, "n_sentences"}
    for r in found.collect():
        if r.doc_id is None:
            assert (r.text, r.n_removed, r.runs, r.itself, r.row) == (passage, 0, [1], True, "a")
        elif r.text is None:
            assert r.doc_id == 9 and r.n_sentences == r.n_removed == 0
        else:
            assert r.n_removed >= 3 and "two" not in r.text and r.text.endswith(f"of {r.doc_id}.") and r.runs == [r.doc_id]


def test_texts_without_repeats_are_cut_once(make_docs, monkeypatch, tmp_path):
    cuts = tmp_path / "cuts"

    class Noted(passages_module.Text):
        def __init__(self, text, known):
            super().__init__(text, known)
            with open(cuts, "ab") as file:
                file.write(text + b"\n")

    monkeypatch.setattr(passages_module, "Text", Noted)
    passage = "One two three four. Five six seven eight. Nine ten eleven twelve."
    texts = [passage, f"{passage} And more.", *(f"Only {i} has this. It is short. That is it." for i in range(6))]
    rows = [*enumerate(texts), (7, "The id of another. A row of its own. Still, it counts.")]
    expected = [(i, *p) for (i, _), p in zip(rows, plain_passages(rows))]
    found = remove_repeats(make_docs([(i, t, None, None, None) for i, t in rows]))
    assert ordered((r.doc_id, r.n_sentences, r.n_removed, r.text) for r in found.collect()) == ordered(expected)
    counts = Counter(cuts.read_text().splitlines())
    assert set(counts) == set(texts) | {rows[-1][1]}
    assert {t for t, n in counts.items() if n > 1} == {texts[1], texts[7], rows[-1][1]}


def test_hashes_of_runs_tell_words_and_their_order(spark):
    known = passages_module.Words()
    words = [f"w{i}" for i in range(2_000)]
    a = passages_module.Text(" ".join(words).encode(), known)
    b = passages_module.Text(" ".join(words[700:] + words[:700]).encode(), known)
    first = np.arange(600)
    assert (a.hashes(first + 700, first + 725) == b.hashes(first, first + 25)).all()
    c = passages_module.Text(b"x y x y y x", known)
    at = np.array([0, 1, 2, 3, 4])
    assert len(set(zip(*c.hashes(at, at + 2).tolist()))) == 3
    assert (c.hashes(at, at + 2) != c.hashes(at, at + 2, passages_module.OF_WINDOWS)).any(axis=0).all()


def test_passages_spliced_anywhere(make_docs):
    """Passages of 51 words without sentence ends, or with clustered ones, inside sentences of other texts."""
    rng = np.random.default_rng(5)
    plain = [w for w in (f"q{i}" for i in range(40_000)) if not passages_module.ends_sentence(w.encode())]
    rows = []
    for k in range(60):
        passage = [str(w) for w in rng.choice(plain, 51)]
        for at in range(k % 4 * 2):
            passage[(10 + at) if k % 8 < 4 else 8 * at] += "."
        for copy in range(2):
            words = [str(w) for w in rng.choice(plain, 140)]
            at = int(rng.integers(0, 141))
            rows.append((2 * k + copy, " ".join([*words[:at], *passage, *words[at:]]), " ".join(passage), at, None))
    docs = make_docs([(i, t, None, None, None) for i, t, *_ in rows])
    found = {r.doc_id: r for r in remove_repeats(docs).collect()}
    for i, text, passage, at, _ in rows:
        left, words = found[i].text.split(), text.split()
        if i % 2 == 0:
            assert found[i].text == text and found[i].n_removed == 0
            continue
        gone = len(words) - len(left)
        assert found[i].n_removed > 0 and gone >= 12
        if passage.count(".") < 4:
            assert gone >= 25
        # All that stands around the passage stays.
        assert left[:at] == words[:at] and left[len(left) - 140 + at :] == words[at + 51 :]


URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "https://Example.ORG/es/x",
    "http://example.org/en/1",
    "http://example.org/en/2",
    "http://a.example.org/en/19?x",
    "http://example.org",
    "http://org/",
    "http://org./",
    "http://xorg/",
    "http://notexample.org/es/",
    "http://com/fr/",
    "http://a.b.c.com/fr/1#de",
    "ftp://a.com/de/",
    "http://a.com/de",
    "http://a.com?/fr/",
    "http://a.com#/de/",
    "x://y://a.com/fr/",
    "http://u@example.org:80/es/",
    "http://example.org/es/" + "p" * 5000,
    "http://a\U0010ffff.org/\U0010ffff\n/",
    "//://a..org/",
] * 3


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        stop = min([rest.find(c, end) for c in "?#" if c in rest[end:]], default=len(rest))
        path = rest[end:stop]
    fits = [
        (len(h + p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


NESTED = [*queries.URL_RULES, ("block", "org", "/es"), ("block", "a.example.org", ""), ("allow", "a.example.org", "/en/19"), ("block", "b.c.com", "/"), ("allow", "b.c.com", "/"), ("block", "c.com", "/fr/12")]


@pytest.mark.parametrize("rules", [queries.URL_RULES, NESTED, []])
@pytest.mark.parametrize("ranges", [1, 7])
def test_url_rules(spark, rules, ranges):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id int, url string, path string, key string")
    found = judge(pages, rule_table(spark, rules), ranges=ranges)
    expected = [(i, *plain_verdict(u, rules)) for i, u in enumerate(URLS)]
    assert ordered((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()) == ordered(expected)
    assert judge(pages.limit(0), rule_table(spark, rules)).collect() == []


def test_url_rules_are_native(spark, capsys):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id int, url string")
    capsys.readouterr()
    judge(pages.where("page_id > 0"), rule_table(spark, NESTED)).explain()
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def plain_pipeline(rows, trusted, items):
    """(doc_id, ids) of the documents that are left."""
    module = quality_rules
    verdicts = quality([r[:2] for r in rows], trusted, module.BUCKETS, module.PRIOR, module.THRESHOLD)
    rows = [r[:2] for r, v in zip(rows, verdicts) if v[2]]
    linked = plain_components(rows, 5, 80)
    gone = {i for (i, _), (_, first) in zip(rows, linked) if i is not None and first < i}
    kept = []
    for row in rows:
        if row[0] is None or (row[0] not in gone and row not in kept):
            kept.append(row)
    cleaned = [(i, p[2]) for (i, t), p in zip(kept, plain_passages(kept)) if not p[1] or spaced(p[2])]
    out = []
    for doc_id, text in cleaned:
        _, hit, _ = leaks(text, items)
        rest = without_words(text, hit) if hit else text
        if not hit or lettered(rest):
            out.append((doc_id, rest))
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    return [(i, tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in out]


def test_pipeline(spark, folder, make_docs, all_rows, items, benchmark, trusted_ids):
    make_docs(all_rows, clashing=False).write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted_ids], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    expected = plain_pipeline(all_rows, set(trusted_ids), items)
    assert ordered((r.doc_id, r.ids) for r in found) == ordered(expected)
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in found)
    assert 20 < len(found) < len(all_rows)


def test_pipeline_leaves_no_texts_or_sets_behind(spark, folder, docs, trusted_ids):
    """Of the first two stages only ids stay in the shared folder, and the plan of the first is not blown up."""
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted_ids], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    shared = shared_dir(spark)
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.near_duplicates):
        assert stage(spark, docs, folder).count()
    left = set(os.listdir(shared)) - before
    assert {c for n in left for c in spark.read.parquet(f"{shared}/{n}").columns} == {"doc_id"}
    plan = corpus_pipeline.quality_rules(spark, docs, folder)._jdf.queryExecution().optimizedPlan().toString()
    judged = quality_rules.judge_quality
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality_rules, "written", lambda df, name: df)
        whole = judged(docs, corpus_pipeline.good_ids(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 2 * len(whole)


def test_pipeline_stages_keep_the_columns(spark, folder, docs, benchmark, trusted_ids):
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), folder).collect() == []
    rest = corpus_pipeline.repeated_passages(spark, docs, folder).where("n_chars != length(text)")
    assert rest.where(F.col("doc_id") > 10).count() == 0
