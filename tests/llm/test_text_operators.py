"""Operators that look at each text by itself, against plain versions."""

import hashlib
import math
import random
from collections import Counter
from math import log10

import numpy as np
import pytest
from brute import LOWER, lettered, leaks, quality, remainder, spaced, text_counts, without_words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spindlewatch.llm import attention_model, byte_pairs, language_id, language_model, quality_rules, queries
from spindlewatch.llm.attention_model import CLASSES, CONTEXT, GROUP, STRIDE, Model
from spindlewatch.llm.byte_pairs import BytePairs, read_vocabulary, tokenize
from spindlewatch.llm.common import Shared, crc_remainder
from spindlewatch.llm.decontaminate import find_leaks, item_blocks, n_hit, without_leaks
from spindlewatch.llm.language_id import fit, predict
from spindlewatch.llm.language_model import count_words, score_texts, words_of_text
from spindlewatch.llm.license_scan import BASE, find_licenses, searches, notices_in
from spindlewatch.llm.quality_rules import judge_quality
from spindlewatch.llm.quality_trees import Trees, fit_quality, fit_trees, score_quality, statistics


def ordered(rows):
    return sorted(rows, key=repr)


def test_quality_rules(spark, docs, all_rows, trusted_ids):
    trusted = spark.createDataFrame([(i,) for i in trusted_ids] + [(None,), (5000,), (trusted_ids[0],)], "doc_id bigint")
    judged = judge_quality(docs, trusted)
    found = judged.select("row.doc_id", "row.text", *judged.columns[2:]).collect()
    assert judged.select("row.*").columns == docs.columns
    rows = [r[:2] for r in all_rows]
    verdicts = quality(rows, set(trusted_ids), quality_rules.BUCKETS, quality_rules.PRIOR, quality_rules.THRESHOLD)
    expected = ordered((i, t, *text_counts(t), v[0]) for (i, t), v in zip(rows, verdicts))
    assert ordered(tuple(r)[:8] for r in found) == expected
    llr = {r.text: (r.llr, r.kept) for r in found}
    for (_, text), (_, value, kept) in zip(rows, verdicts):
        assert llr[text] == (pytest.approx(value, abs=1e-9), kept)


def test_quality_rules_without_trusted_or_documents(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint")
    judged = judge_quality(docs, none).collect()
    assert all(r.llr == 0.0 and r.kept == (not r.base_failed) for r in judged)
    assert judge_quality(no_docs, none).collect() == []


@pytest.mark.parametrize("copied", [quality_rules.BROADCAST_IDS, 10])
def test_quality_rules_learn_from_every_trusted_document(spark, copied):
    """Where all documents are trusted, trusted text is like all text: every weight is zero."""
    ids = spark.range(100_400).toDF("doc_id")
    docs = ids.select("doc_id", F.concat_ws(" ", F.lit("all"), F.col("doc_id") % 5000).alias("text"))
    weights = quality_rules.bucket_weights(docs, ids, copied=copied).first().weights
    assert len(weights) == quality_rules.BUCKETS and not any(weights)
    half = quality_rules.bucket_weights(docs, ids.where("doc_id % 2 = 0"), copied=copied).first().weights
    assert any(half)
    assert half == quality_rules.bucket_weights(docs, ids.where("doc_id % 2 = 0")).first().weights


@pytest.mark.parametrize("column", ["kept", "base_failed"])
def test_a_filter_on_verdicts_leaves_the_plan_small(spark, docs, column):
    judged = judge_quality(docs, spark.range(3).toDF("doc_id"))
    filtered = judged.where(column).select("row.*")
    assert len(filtered._jdf.queryExecution().optimizedPlan().toString()) < 5000
    assert filtered.count() == sum(r[column] for r in judged.collect())


def test_quality_rules_without_rows_of_their_own(spark, docs):
    judged = judge_quality(docs, spark.range(3).toDF("doc_id"), keep=[])
    assert "row" not in judged.columns and judged.count() == docs.count()
    assert judge_quality(docs, spark.range(3).toDF("doc_id"), keep=["lang"]).select("row.*").columns == ["lang"]


def test_quality_rules_are_native(spark, docs, capsys, monkeypatch):
    plans = []
    monkeypatch.setattr(quality_rules, "written", lambda df, name: plans.append(df) or df)
    judge_quality(docs, spark.range(3).toDF("doc_id"))
    assert len(plans) == 2
    for plan in plans:
        plan.explain()
    shown = capsys.readouterr().out
    assert not any(word in shown for word in ("Python", "Pandas", "Arrow"))


def test_trees_walk_like_a_recursion():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = fit_trees(x, y, trees=20, depth=3)

    def value(tree, node, row):
        if node >= model.features.shape[1]:
            return model.leaves[tree, node - model.features.shape[1]]
        right = row[model.features[tree, node]] > model.limits[tree, node]
        return value(tree, 2 * node + 1 + int(right), row)

    plain = [model.start + sum(value(t, 0, row) for t in range(20)) for row in x]
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(-np.array(plain))))
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.9


def test_trees_without_rows_or_with_one_class():
    assert isinstance(fit_trees(np.zeros((0, 3)), np.zeros(0)), Trees)
    assert fit_trees(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (fit_trees(np.ones((9, 3)), np.ones(9)).score(np.zeros((2, 3))) > 0.7).all()


def test_quality_classifier(spark, docs, no_docs, all_rows):
    labels = spark.createDataFrame([(1000 + i, i % 2, 0) for i in range(45)] + [(None, 1, 0), (6, None, 0), (8, 1, 0), (8, 0, 0)], "doc_id bigint, quality int, toxic int")
    trees = fit_quality(docs, labels)
    scored = score_quality(docs, trees, keep=["doc_id"]).collect()
    assert ordered(r.doc_id for r in scored) == ordered(r[0] for r in all_rows)
    assert all(0.0 <= r.score <= 1.0 for r in scored)
    assert score_quality(no_docs, trees).columns.count("score") == 1
    assert score_quality(no_docs, fit_quality(no_docs, labels)).collect() == []
    assert len(statistics(None)) == len(statistics(b" \n ")) == len(statistics(b"a b"))


def test_quality_classifier_on_held_out_rows(spark):
    small = "/root/testdata/sf0.01"
    found = queries.op1_quality_classifier(spark, small).join(spark.read.parquet(f"{small}/labels.parquet"), "doc_id")
    held_out = found.where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in held_out]) > 0.95


def test_licenses(docs, no_docs, all_rows):
    found = find_licenses(docs).collect()
    expected = []
    for doc_id, text, *_ in all_rows:
        words = lettered(text)
        places = [
            (label, i)
            for label, phrase in BASE
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        expected.append((doc_id, text, len(words), sorted(places, key=lambda p: p[1])))
    assert ordered((r.doc_id, r.text, r.n_words, [tuple(p) for p in r.places]) for r in found) == ordered(expected)
    by_id = {r.doc_id: r for r in found}
    assert {n.label: n.errors for n in by_id[14].notices} == {"mit": 2, "cc-by-nc": 0, "gpl": 1}
    assert [n.start for n in by_id[14].notices if n.errors == 0][0] == 1
    assert by_id[14].score == 1.0 and by_id[1].score == 0.0 and by_id[15].places[0].start == 0
    assert find_licenses(no_docs).collect() == []


def test_notices_equal_a_search_without_pieces():
    for search in searches([("mit", "under the mit license"), ("x", "all rights reserved")]):
        words = search.phrase.split()
        for changed in (words, [words[0][1:], *words[1:]], [*words[:-1], words[-1] + b"s"], [w[::-1] for w in words]):
            text = b" before " + b" ".join(changed) + b" after "
            plain = [m for m in search.match.finditer(text) if text[m.start()] != 0x20 and text[m.end() - 1] != 0x20]
            assert [a for a, _, _ in notices_in(text, search)] == [m.start() for m in plain]


@pytest.mark.parametrize("block_windows", [200_000, 60])
def test_leaks(docs, all_rows, benchmark, items, block_windows):
    found = find_leaks(docs, benchmark, block_windows=block_windows)
    found = found.withColumn("hit", n_hit(F.col("leaks"))).collect()
    expected = []
    for doc_id, text, *_ in all_rows:
        n, hit, owners = leaks(text, items)
        expected.append((doc_id, text, n, len(hit), sorted(owners)))
    assert ordered((r.doc_id, r.text, r.n_words, r.hit, sorted(r.leak_items)) for r in found) == ordered(expected)
    assert any(r.hit for r in found)


def test_cutting_leaks(docs, no_docs, all_rows, benchmark, items):
    found = without_leaks(docs, benchmark)
    expected = []
    for doc_id, text, *_ in all_rows:
        _, hit, _ = leaks(text, items)
        rest = without_words(text, hit) if hit else text
        if not hit or lettered(rest):
            expected.append((doc_id, rest))
    assert ordered((r.doc_id, r.text) for r in found.collect()) == ordered(expected)
    assert found.columns == docs.columns
    assert without_leaks(no_docs, benchmark).collect() == []
    unchanged = without_leaks(docs, benchmark.limit(0)).collect()
    assert ordered((r.doc_id, r.text) for r in unchanged) == ordered(r[:2] for r in all_rows)


@pytest.mark.parametrize("block_windows", [200_000, 60])
def test_cutting_leaks_takes_a_worker_for_each_block(docs, benchmark, block_windows):
    found = without_leaks(docs, benchmark, block_windows=block_windows)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("MapInArrow") == len(list(item_blocks(benchmark, block_windows=block_windows)))
    assert ordered(found.collect()) == ordered(without_leaks(docs, benchmark).collect())


def test_cutting_leaks_from_texts_alone(docs, benchmark):
    found = without_leaks(docs.select("text"), benchmark)
    assert ordered(found.collect()) == ordered(without_leaks(docs, benchmark).select("text").collect())


def library():
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_byte_pairs(docs, no_docs, all_rows):
    vocabulary = read_vocabulary(queries.VOCABULARY)
    tokenizer = library()
    found = tokenize(docs, vocabulary).collect()
    expected = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in all_rows]
    assert ordered((r.doc_id, r.ids, r.decoded) for r in found) == ordered(expected)
    assert tokenize(no_docs, vocabulary).collect() == []


def test_byte_pairs_on_random_texts():
    pairs, tokenizer = BytePairs(read_vocabulary(queries.VOCABULARY)), library()
    rng = np.random.default_rng(7)
    letters = list(" \t\n\r\x0b\x0c\x1c\x85\u00a0\u2003\u3000''sltredvm.!=-#019aAetho\u00e9\u00dfZ\u4e2d\u05d0\u0301\u0e33\U0001f600\x00\x7f")
    for size in (3, 8, 30, 400):
        for _ in range(300 if size < 400 else 20):
            text = "".join(rng.choice(letters, size))
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert pairs.encode(text.encode()) == ids
            assert pairs.decode(ids).decode() == tokenizer.decode(ids, skip_special_tokens=False) == text
    some = rng.integers(0, 50257, 200).tolist()
    assert pairs.decode(some).decode() == tokenizer.decode(some, skip_special_tokens=False)


def test_merging_long_pieces_is_the_same():
    pairs = BytePairs(read_vocabulary(queries.VOCABULARY))
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 190):
        data = bytes(rng.choice(list(b"theanri=-"), n).tolist())
        assert pairs.merge(data) == pairs.merge_long([pairs.single[b] for b in data])


def test_byte_pairs_forget_only_what_is_not_met_again(monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 20)
    pairs, tokenizer = BytePairs(read_vocabulary(queries.VOCABULARY)), library()
    rng = np.random.default_rng(11)
    for _ in range(40):
        texts = [" ".join(["the", *("".join(rng.choice(list("abcdez1-"), 5)) for _ in range(6))]) for _ in range(3)]
        coded = [np.frombuffer(c, np.int32).tolist() for c in pairs.encode_all([t.encode() for t in texts])]
        assert coded == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(pairs.recent) <= 40 and len(pairs.former) <= 40
    assert b"the" in pairs.recent


def test_languages(docs, no_docs, all_rows):
    model = fit(docs, rows=100)
    found = predict(docs, model).collect()
    assert len(found) == len(all_rows)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0.0 <= r.score <= 1.0
    right = [r.lang_pred == r.lang for r in found if (r.doc_id or 0) >= 1000]
    assert np.mean(right) > 0.9
    empty = fit(no_docs)
    assert {r.lang_pred for r in predict(docs, empty).collect()} == {"und"}
    assert predict(no_docs, model).collect() == []


def test_a_rare_language_is_learnt(spark):
    """Three rows of one language among 10,000 of another, fitted on a hundred rows of each."""
    common = spark.range(10_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the house number "), F.col("id") % 7, F.lit(" and a tree")).alias("text")
    ).withColumn("lang", F.lit("en"))
    rare = [(20_000, "kala vesi talo", "fi"), (20_001, "talo kala", "fi"), (None, "vesi metsassa", "fi"), (20_002, None, "fi")]
    docs = common.unionByName(spark.createDataFrame(rare, docs_ddl := "doc_id bigint, text string, lang string"))
    model = fit(docs.repartition(8), rows=100)
    asked = spark.createDataFrame([(1, "vesi ja talo", None), (2, "a tree and a house", None), (3, "metsassa", None)], docs_ddl)
    assert {r.doc_id: r.lang_pred for r in predict(asked, model).collect()} == {1: "fi", 2: "en", 3: "fi"}


def plain_language(text, sample):
    """Language of a text and its share, from (text, lang) rows so few that no table is cut."""
    tables = {}
    for content, lang in sample:
        for word in language_id.words_in(content):
            tables.setdefault(0, {}).setdefault(word, Counter())[lang] += 1
            for n in language_id.NGRAMS:
                for gram in language_id.ngrams_of(word, n):
                    tables.setdefault(n, {}).setdefault(gram, Counter())[lang] += 1
    langs = sorted({lang for _, lang in sample})
    half = language_id.SMOOTHING

    def entry(n, key, lang):
        table = tables[n]
        return np.log((table[key][lang] + half) / (sum(c[lang] for c in table.values()) + half * len(table)))

    totals, words = dict.fromkeys(langs, 0.0), language_id.words_in(text)
    for word in words:
        found = [(0, word)] if word in tables[0] else []
        for n in language_id.NGRAMS:
            found = found or [(n, g) for g in language_id.ngrams_of(word, n) if g in tables[n]]
        for lang in langs:
            totals[lang] += np.mean([entry(n, key, lang) for n, key in found]) if found else 0.0
    likely = {lang: np.exp((t - max(totals.values())) / len(words)) for lang, t in totals.items()}
    best = min(langs, key=lambda lang: (-totals[lang], lang))
    return best, likely[best] / sum(likely.values())


def test_languages_against_a_plain_version(spark):
    sample = [("The tree and the house", "en"), ("a house, a tree!", "en"), ("der Baum und das Haus", "de"), ("la casa es grande", "es")]
    asked = ["the Haus", "treehouse", "casas grandes", "zzz", "und", "Baum baum the la qq", "\u4e2d\u6587", "d'un arbre " * 50]
    ddl = "doc_id bigint, text string, lang string"
    model = fit(spark.createDataFrame([(i, *r) for i, r in enumerate(sample)], ddl))
    found = {r.text: r for r in predict(spark.createDataFrame([(1, t, None) for t in asked], ddl), model).collect()}
    for text in asked:
        lang, share = plain_language(text, sample)
        assert found[text].lang_pred == lang and found[text].score == pytest.approx(share)


def test_languages_on_held_out_rows(spark):
    small = "/root/testdata/sf0.01"
    found = queries.op9_language_id(spark, small).join(spark.read.parquet(f"{small}/documents.parquet"), "doc_id")
    assert np.mean([r.lang_pred == r.lang for r in found.where("held_out").collect()]) > 0.98


def some_frequencies(seed):
    return np.random.default_rng(seed).random(CLASSES) + 0.1


def test_attention_scores_every_token_once_by_the_tokens_before_it():
    model = Model.new(some_frequencies(5), seed=2)
    codes = np.random.default_rng(5).integers(0, CLASSES, 3 * STRIDE + 5).astype(np.uint16)
    p = model.parameters
    total = 0.0
    for at, target in enumerate(codes.tolist()):
        chunk = at // STRIDE * STRIDE
        inputs = [model.START, *codes.tolist()][max(0, chunk - (CONTEXT - STRIDE)) : at + 1]
        last = CONTEXT - STRIDE + at - chunk + 1
        x = p["embed"][inputs] + p["place"][last - len(inputs) : last]
        weights = np.exp((x[-1] @ p["query"]) @ (x @ p["key"]).T / 4.0)
        hidden = x[-1] + (weights / weights.sum()) @ (x @ p["value"]) @ p["mix"]
        group, member = divmod(target, GROUP)
        groups = np.exp(hidden @ p["group"] + p["group_bias"])
        members = np.exp(hidden @ p["member"][group] + p["member_bias"][group])
        total += log10(groups[group] / groups.sum() * members[member] / members.sum())
    assert model.log10(model.segments(codes)).sum() == pytest.approx(total, rel=1e-4)


def test_attention_gradients_and_training():
    model = Model.new(some_frequencies(6), seed=4)
    segments = model.segments(np.random.default_rng(6).integers(0, 40, 200).astype(np.uint16))
    count = (segments[:, CONTEXT - STRIDE + 1 :] != model.NONE).sum()

    def loss(model):
        return -model.log10(segments).sum() * np.log(10) / count

    gradients = model.gradients(segments)
    for name in Model.SHAPES:
        at = np.unravel_index(np.abs(gradients[name]).argmax(), gradients[name].shape)
        losses = []
        for step in (0.02, -0.02):
            moved = {n: a.copy() for n, a in model.parameters.items()}
            moved[name][at] += step
            losses.append(loss(Model(moved)))
        assert (losses[0] - losses[1]) / 0.04 == pytest.approx(gradients[name][at], rel=0.05, abs=1e-4)
    same = model.with_flat(model.flat())
    assert all((same.parameters[n] == a).all() for n, a in model.parameters.items())
    trained = model
    for _ in range(20):
        trained = trained.train(segments, 0.02, batch=4)
    assert loss(trained) < 0.8 * loss(model)


def test_attention_multiplies_scored_positions_only(monkeypatch):
    """Query and key are one matrix, and so are value and mix: inputs that are only looked at meet neither, and the
    gradients of the four are those of a plain backward pass through each of them."""
    rows, times = [], attention_model._times

    def noted(a, matrix):
        rows.append(a.size // a.shape[-1])
        return times(a, matrix)

    monkeypatch.setattr(attention_model, "_times", noted)
    model = Model.new(some_frequencies(8), seed=3)
    codes = np.random.default_rng(8).integers(0, CLASSES, 5 * STRIDE + 3).astype(np.uint16)
    segments = model.segments(codes)
    found = model.gradients(segments)
    assert rows and max(rows) <= len(segments) * STRIDE
    rows.clear()
    model.log10(segments)
    assert rows and max(rows) <= len(segments) * STRIDE

    p = {n: a.astype(float) for n, a in model.parameters.items()}
    plain = {n: np.zeros_like(a) for n, a in p.items()}
    for window in segments.astype(int):
        for at in range(CONTEXT - STRIDE, CONTEXT):
            seen, target = [i for i in range(at + 1) if window[i] != Model.NONE], window[at + 1]
            if target == Model.NONE:
                continue
            x = p["embed"][window[seen]] + p["place"][seen]
            q, k, v = x[-1] @ p["query"] / 4.0, x @ p["key"], x @ p["value"]
            weights = np.exp(k @ q) / np.exp(k @ q).sum()
            read = weights @ v
            hidden = x[-1] + read @ p["mix"]
            group, member = divmod(target, GROUP)
            groups = np.exp(hidden @ p["group"] + p["group_bias"])
            members = np.exp(hidden @ p["member"][group] + p["member_bias"][group])
            d_groups, d_members = groups / groups.sum() / len(codes), members / members.sum() / len(codes)
            d_groups[group] -= 1 / len(codes)
            d_members[member] -= 1 / len(codes)
            plain["group"] += np.outer(hidden, d_groups)
            plain["group_bias"] += d_groups
            plain["member"][group] += np.outer(hidden, d_members)
            plain["member_bias"][group] += d_members
            d_hidden = p["group"] @ d_groups + p["member"][group] @ d_members
            plain["mix"] += np.outer(read, d_hidden)
            d_read = p["mix"] @ d_hidden
            d_scores = weights * (v @ d_read - read @ d_read)
            d_q, d_k, d_v = k.T @ d_scores, np.outer(d_scores, q), np.outer(weights, d_read)
            plain["query"] += np.outer(x[-1], d_q) / 4.0
            plain["key"] += x.T @ d_k
            plain["value"] += x.T @ d_v
            d_x = d_k @ p["key"].T + d_v @ p["value"].T
            d_x[-1] += d_hidden + p["query"] @ d_q / 4.0
            np.add.at(plain["embed"], window[seen], d_x)
            plain["place"][seen] += d_x
    for name in Model.SHAPES:
        assert found[name] == pytest.approx(plain[name], rel=1e-3, abs=1e-4 * np.abs(plain[name]).max()), name


def test_training_is_adam():
    """The optimizer in its usual form, on a few steps that the last one makes smaller."""
    model = Model.new(some_frequencies(9), seed=5)
    segments = model.segments(np.random.default_rng(9).integers(0, CLASSES, 50 * STRIDE).astype(np.uint16))
    values, first, second = model.flat(), 0.0, 0.0
    for step, at in enumerate(range(0, len(segments), 16), 1):
        gradients = model.with_flat(values).gradients(segments[at : at + 16])
        g = np.concatenate([gradients[name].ravel() for name in Model.SHAPES]).astype(float)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        values = values - 0.02 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    trained = model.train(segments, 0.02, batch=16).flat()
    assert np.abs(trained - values).max() < 2e-3 and np.abs(trained - values).mean() < 2e-5


def test_language_model(docs, no_docs, all_rows):
    vocabulary = read_vocabulary(queries.VOCABULARY)
    found = score_texts(docs, crc_remainder("doc_id", 7) == 2, vocabulary).collect()
    counts, ends = Counter(), 0
    for doc_id, text, *_ in all_rows:
        if remainder(doc_id, 7) != 2:
            counts.update(spaced((text or "").translate(LOWER)))
            ends += 1
    total, base = sum(counts.values()) + ends, sum(counts.values()) + ends + len(counts) + 2
    expected = []
    for doc_id, text, *_ in all_rows:
        words = spaced((text or "").translate(LOWER))
        logs = sum(log10((counts[w] + 1) / base) for w in words) + log10((ends + 1) / base)
        known = sum(counts[w] > 0 for w in words) + 1
        expected.append((doc_id, remainder(doc_id, 7) == 2, len(words) + 1, known, total, round(logs, 6)))
    assert ordered((*tuple(r)[:5], round(r.base_score, 6)) for r in found) == ordered(expected)
    assert all(r.score < 0 for r in found)
    assert score_texts(no_docs, F.lit(False), vocabulary).collect() == []
    nothing = score_texts(docs.limit(3), F.lit(True), vocabulary).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in nothing)


def test_base_scores_of_words_that_are_joined(docs, all_rows, monkeypatch):
    """Words beyond the most frequent ones: base scores to the last places, however rows are dealt, and the vocabulary
    is parsed once, by the driver."""
    monkeypatch.setattr(language_model, "HOT_WORDS", 3)
    vocabulary, shared = read_vocabulary(queries.VOCABULARY), []

    class Noted(Shared):
        def __init__(self, spark, value):
            shared.append(value)
            super().__init__(spark, value)

    monkeypatch.setattr(language_model, "Shared", Noted)
    held_out = crc_remainder("doc_id", 7) == 2
    found = score_texts(docs, held_out, vocabulary).collect()
    dealt = score_texts(docs.repartition(5), held_out, vocabulary).collect()
    assert not any(isinstance(value, str) for value in shared)
    monkeypatch.undo()
    assert ordered((r.doc_id, r.n_known, r.base_score) for r in found) == ordered((r.doc_id, r.n_known, r.base_score) for r in dealt)
    counts, ends = Counter(), 0
    for doc_id, text, *_ in all_rows:
        if remainder(doc_id, 7) != 2:
            counts.update(spaced((text or "").translate(LOWER)))
            ends += 1
    base = sum(counts.values()) + ends + len(counts) + 2
    expected = []
    for doc_id, text, *_ in all_rows:
        words = spaced((text or "").translate(LOWER))
        logs = [log10((counts[w] + 1) / base) for w in words] + [log10((ends + 1) / base)]
        expected.append((doc_id, sum(counts[w] > 0 for w in words) + 1, math.fsum(logs)))
    found, expected = (ordered(rows) for rows in ([(r.doc_id, r.n_known, r.base_score) for r in found], expected))
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert [r[2] for r in found] == pytest.approx([r[2] for r in expected], rel=1e-13)


def test_language_model_codes_every_text_once_and_every_new_word_in_one_go(spark, make_docs, monkeypatch, tmp_path):
    """The words of texts, to be trained on or held out, go to the tokenizer once in a slice, besides being counted."""
    texts = ["alpha beta alpha", "gamma <|endoftext|> beta \u00c9t\u00e9", None, "delta " * 40]
    seen = tmp_path / "seen"

    class Noted(language_model.Subwords):
        def many(self, words):
            with open(seen, "ab") as file:
                file.write(b"".join(w + b"\n" for w in words))
            return super().many(words)

    monkeypatch.setattr(language_model, "Subwords", Noted)
    docs = make_docs([(i, t, None, None, None) for i, t in enumerate(texts)]).coalesce(1)
    scored = score_texts(docs, F.col("doc_id") == 3, read_vocabulary(queries.VOCABULARY)).collect()
    assert len(scored) == len(texts) and all(r.score < 0 for r in scored)
    words = Counter(seen.read_text().splitlines())
    assert words == {"alpha": 2, "beta": 2, "gamma": 2, "<|endoftext|>": 2, "\u00c9t\u00e9": 2, "delta": 1}
    monkeypatch.undo()
    classes = language_model.Classes(BytePairs(read_vocabulary(queries.VOCABULARY)).tokens, [], 1)
    known = language_model.Words(read_vocabulary(queries.VOCABULARY), classes, remembered=3)
    lists = [[b"alpha", b"beta"], [], [b"<|endoftext|>", b"beta", b"gamma", b"."]]
    for here in (lists, lists[::-1]):
        for words, (codes, share) in zip(here, known.coded(here)):
            ids = [i for w in words for i in known.encode(w)]
            assert codes == classes.of[ids].tobytes() + np.uint16(classes.end).tobytes()
            assert share == pytest.approx(classes.logs[ids].sum())


def test_subwords_of_words_merged_together():
    """The ids of the library, whatever is in a word and however many words are given at a time."""
    rng = random.Random(8)
    parts = ["a", "Bee", "'s", "'", "\x00", "\x1c", "\x85", "\u00a0", "\u3000", "\u0308", "\u00fc", "\u4e2d", "1", "!", "<|endoftext|>", "\U0001f600"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 7))).encode() for _ in range(3000)]
    encode, whole = language_model.Subwords(read_vocabulary(queries.VOCABULARY)), library()
    whole.encode_special_tokens = True
    expected = [whole.encode(f" {w.decode()}", add_special_tokens=False).ids for w in words]
    ids, sizes = encode.many(words)
    assert ids.tolist() == [i for one in expected for i in one] and sizes.tolist() == [*map(len, expected)]
    assert [encode(w) for w in words[:50]] == expected[:50]
    assert [len(x) for x in encode.many([])] == [0, 0]


def test_words_of_texts_by_number():
    """Codes, log frequencies and rare words of several texts at the same time, forgotten words included."""
    vocabulary = read_vocabulary(queries.VOCABULARY)
    classes = language_model.Classes(BytePairs(vocabulary).tokens, [], 1)
    known = language_model.Words(vocabulary, classes, remembered=4, logs={b"hot": -1.0, b"warm": -2.0, b"": -0.5})
    first = [[b"hot", b"cold", b"hot", b"cold"], [], [b"warm", b"cool", b"cold"]]
    for lists in (first, [[b"new"], [b"cold", b"hot", b"colder"]], first):
        numbers, starts = known.numbers(lists)
        logs = np.add.reduceat(np.nan_to_num(known.logs[numbers]), starts)
        assert logs.tolist() == [sum({b"hot": -1.0, b"warm": -2.0}.get(w, 0.0) for w in words) - 0.5 for words in lists]
        found = [{r["word"]: r["k"] for r in rows} for rows in known.rare(numbers, starts).to_pylist()]
        assert found == [Counter(w for w in words if w not in (b"hot", b"warm")) for words in lists]


def test_windows_of_texts_together():
    model = Model.new(some_frequencies(7))
    texts = [np.arange(n, dtype=np.uint16) for n in (1, STRIDE - 1, STRIDE, STRIDE + 1, 1, 7 * STRIDE, 300)]
    windows, counts = model.windows(texts)
    alone = [model.segments(t) for t in texts]
    assert counts.tolist() == [*map(len, alone)]
    assert (windows == np.concatenate(alone)).all()


def test_sha_columns_of_the_token_query(spark):
    found = {r.doc_id: r for r in queries.op8_bpe_round_trip(spark, "/root/testdata/sf0.001").collect()}
    tokenizer = library()
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect():
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids
        assert found[row.doc_id].n_tokens == len(ids)
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[row.doc_id].decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def test_attention_trains_on_every_token_once(spark):
    """A model that counts its targets instead of learning: all subwords of all texts, and their ends."""

    class Counting(Model):
        def __init__(self, counts):
            self.counts = np.asarray(counts, float)

        def flat(self):
            return self.counts

        def with_flat(self, values):
            return Counting(np.round(values))

        def train(self, segments, rate, *step):
            targets = segments[:, CONTEXT - STRIDE + 1 :].ravel()
            return Counting(self.counts + np.bincount(targets[targets != self.NONE], minlength=CLASSES))

    texts = [" ".join(f"w{i % 97} some{i * j}" for i in range(n)) for j, n in enumerate((0, 1, 40, 700, 3000))] + [None]
    vocabulary = read_vocabulary(queries.VOCABULARY)
    classes = language_model.Classes(BytePairs(vocabulary).tokens, [], 1)
    training = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    model = language_model.train(training, Counting(np.zeros(CLASSES)), Shared(spark, vocabulary), Shared(spark, classes))
    expected = np.zeros(CLASSES)
    encode = language_model.Subwords(vocabulary)
    for text in texts:
        expected[classes.end] += 1
        for word in (text or "").encode().split():
            np.add.at(expected, classes.of[encode(word)], 1)
    assert (model.counts == expected).all()


@pytest.mark.parametrize(
    ("text", "errors"),
    [
        (b" under the mot license under the mit license x ", [1, 0]),
        (b" under the mit license under the mot license x ", [0, 1]),
        (b" under the mot license under the mit license under the mxt license ", [1, 0, 1]),
        (b" under the mot license and so on under the mit license x ", [1, 0]),
    ],
)
def test_notices_before_a_better_one_are_found(text, errors):
    (search,) = (s for s in searches([("mit", "under the mit license")]))
    found = notices_in(text, search)
    assert [e for _, _, e in found] == errors
    assert all(text[a:b].startswith(b"under the m") and text[a:b].endswith(b"t license") for a, b, _ in found)


def test_hidden_rows_are_looked_up_as_they_are_computed():
    model = Model.new(1.0 / np.arange(1, CLASSES + 1))
    rng = np.random.default_rng(3)
    windows, _ = model.windows([rng.integers(0, CLASSES, n).astype(np.uint16) for n in (0, 1, 15, 16, 17, 200)])
    looked_up = model._reader()(windows[:, :CONTEXT])
    assert np.allclose(looked_up, model._forward(windows)[-1], atol=1e-5)


def test_fragments_that_are_not_one_word():
    pairs, tokenizer = BytePairs(read_vocabulary(queries.VOCABULARY)), library()
    fragments = " a1b2 _x!?9 'sure it's 's !'s we'll'd 12'ts été nº5 a　b 　 \x1cz a\x00".split(" ")[1:]
    fragments = [space + f for f in [*fragments, "x", "7", "-", " ", "  b"] for space in ("", " ")]
    ids, sizes = pairs.encode_together([f.encode() for f in fragments])
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    expected = [tokenizer.encode(f, add_special_tokens=False).ids for f in fragments]
    assert [p.tolist() for p in parts] == expected


def test_words_of_many_texts_are_counted(docs, all_rows):
    counted = count_words(docs)
    expected = Counter(w for r in all_rows for w in words_of_text((r[1] or "").encode()))
    assert {bytes(r.word): r.c for r in counted.collect()} == expected
