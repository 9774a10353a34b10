"""Every operator against brute force on a small corpus with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute_force import brute_components, by_id, kept_words, words
from pyspark.sql import functions as F

from starloom.llm import (
    components,
    embedding,
    hmm,
    language,
    licenses,
    mixture,
    pieces,
    quality,
    repeats,
    setsketch,
    text,
    toxicity,
)
from starloom.llm.learn import bounded_sample, remainder, sample_by_label, shares


# --- text -------------------------------------------------------------------------------------


def test_words_are_those_between_separators():
    texts = pa.array(["a b\x1fc  d", "", None, "Ü\tx\x0bY ", "end", "tail"])
    for _, part in text.slices(texts):
        w = text.words(part, fold=True)
        found = [[w.word(i) for i in range(w.first[k], w.first[k + 1])] for k in range(len(part))]
    assert found == [words(t, True) for t in texts.to_pylist()]
    h = w.hashes()
    assert len(set(h.tolist())) == len({x for f in found for x in f})


def test_slices_cover_all_texts():
    texts = pa.array(["x" * n for n in (5, 0, 30, 7, 7, 7)])
    parts = list(text.slices(texts, 14))
    assert [t for _, p in parts for t in p.to_pylist()] == texts.to_pylist()
    assert [row for row, _ in parts] == [0, 2, 3, 5]


# --- quality ----------------------------------------------------------------------------------


def test_quality_counts_match_brute_force(docs, corpus, nothing):
    model = quality.fit(nothing.withColumn("quality", F.lit(1)))
    got = by_id(quality.score(docs, model))
    assert len(got) == len(corpus)
    for i, t, _, _ in corpus:
        w, t = words(t), t or ""
        n = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j + k for j in range(len(w) - 2) if n[tuple(w[j : j + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        expected = (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality.score(nothing, model).count() == 0


def test_quality_learns_junk(spark):
    rows = [(i, ("good clean prose here " if i % 2 else "### %%% $$$ junk ") * (20 + i % 7), i % 2) for i in range(200)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = by_id(quality.score(labelled.drop("quality"), quality.fit(labelled)))
    assert all((got[i].quality > 0.5) == bool(q) for i, _, q in rows)


# --- toxicity, language -----------------------------------------------------------------------


def test_toxic_words_are_learned_and_empty_texts_scored(spark, docs, nothing, corpus):
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        w = list(rng.choice(vocabulary, 40))
        if i % 4 == 0:
            w[rng.integers(40)] = ("frobnik", "grumpf")[i % 8 // 4]
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(labelled.where(remainder("doc_id", 4) != 2))
    got = by_id(toxicity.score(labelled, model))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    right = [got[i].predicted == t for i, _, t in held]
    assert sum(right) / len(right) > 0.95
    all_scores = by_id(toxicity.score(docs, model))
    assert len(all_scores) == len(corpus) and all(0 <= r.score <= 1 for r in all_scores.values())
    untrained = toxicity.fit(nothing.withColumn("toxic", F.lit(1)))
    assert {r.predicted for r in toxicity.score(docs, untrained).collect()} == {0}
    assert toxicity.score(nothing, model).count() == 0


def test_language_by_words_then_by_characters(spark, docs, nothing):
    rows = [(i, ("alpha beta gamma " if i % 2 else "zwölf über größe ") * 5, ("aa", "bb")[i % 2 == 0]) for i in range(40)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    probe = [(1, "beta alpha"), (2, "größer zwölfte"), (3, None), (4, "12 34 !"), (5, ""), (6, "alphabet")]
    got = by_id(language.identify(spark.createDataFrame(probe, "doc_id long, text string"), model))
    assert {i: r.lang_pred for i, r in got.items()} == {1: "aa", 2: "bb", 3: "und", 4: "und", 5: "und", 6: "aa"}
    assert got[3].score == 0 and got[1].score > 0.9
    kept = language.determined(docs, model)
    assert kept.columns == docs.columns
    lettered = {i for i, r in by_id(docs).items() if re.search(r"[^\W\d_]", r.text or "")}
    assert set(by_id(kept)) == lettered
    assert language.identify(nothing, model).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.fit(nothing)).collect()} == {"und"}


def test_runs_are_of_characters():
    w = language.tokens(pa.array(["größe aß", "", "日本語"], pa.large_string()))
    of = language.letters(w, w.start, w.end)
    words_ = ["größe", "aß", "日本語"]
    for n in range(1, 5):
        word, place, hashes = language._runs(w, of, n)
        expected = [(i, j + n, t[j : j + n]) for i, t in enumerate(words_) for j in range(len(t) - n + 1)]
        assert list(zip(word, place, strict=True)) == [(i, e) for i, e, _ in expected]
        alone = language.tokens(pa.array([g for _, _, g in expected], pa.large_string()))
        assert (hashes == alone.hashes()).all() and len(alone.start) == len(expected)


def test_quality_groups_are_of_four_characters():
    texts = ["größe!", "", "日本", "日本語あx"]
    w = text.words(pa.array(texts, pa.large_string()), fold=True)
    slots, bounds = quality.grams(w)[2]
    groups = [[t[j : j + 4] for j in range(len(t) - 3)] for t in texts]
    assert list(np.diff(bounds)) == [len(g) for g in groups]
    flat = text.words(pa.array([g for t in groups for g in t], pa.large_string()), in_word=np.ones(256, bool))
    assert list(slots) == list((flat.hashes() >> np.uint64(64 - quality.BITS)).astype(np.int64))


def test_rare_languages_keep_their_rows(spark):
    assert shares({"a": 3, "b": 100, "c": 100}, 50) == {"a": 3, "b": 23, "c": 24}
    assert shares({"a": 3, "b": 4}, 50) == {"a": 3, "b": 4} and shares({}, 5) == {}
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 1000 == 0, "rare").otherwise("much").alias("lang"))
    sample, labels = sample_by_label(rows, "doc_id", "lang", 500)
    assert labels == ["much", "rare"]
    found = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert found["rare"] == 5 and 400 < found["much"] < 600
    model = language.fit(rows.withColumn("text", F.col("lang")), max_rows=500)
    assert model.languages == ["much", "rare"] and len(model.words) == 2


def test_a_sample_is_bounded(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert 300 < bounded_sample(rows, "doc_id", 500).count() < 700
    assert bounded_sample(rows, "doc_id", 5000).count() == 5000


# --- substring dedup --------------------------------------------------------------------------


@pytest.mark.parametrize(("width", "shard_bytes"), [(13, 1 << 20), (13, 2000), (5, 3000)])
def test_repeated_passages_are_cut(docs, corpus, width, shard_bytes):
    got = by_id(repeats.remove_repeats(docs, width=width, shard_bytes=shard_bytes))
    assert {i: (r.n_words, r.n_removed, r.text) for i, r in got.items()} == kept_words(corpus, width)


def test_repeats_of_nothing_and_of_repeated_rows(spark, nothing):
    assert repeats.remove_repeats(nothing).count() == 0
    long = " ".join(f"w{i}" for i in range(30))
    twice = spark.createDataFrame([(1, long), (1, long), (2, long), (None, long)], "doc_id long, text string")
    got = repeats.remove_repeats(twice).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in got) == [(False, 1, 0), (False, 1, 0), (False, 2, 30), (True, 0, 30)]


def test_toxicity_counts_match_brute_force_and_rare_words_say_a_little(spark, monkeypatch):
    import random

    rng = random.Random(6)
    plain = [" ".join(rng.choice("river stone light field cloud grass".split()) for _ in range(12)) for _ in range(120)]
    rows = [(i, t + (" frobnik zap" if i % 3 == 0 else "") + (" zzyzx" if i == 3 else ""), int(i % 3 == 0)) for i, t in enumerate(plain)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    monkeypatch.setattr(toxicity, "FOLDS", 10**9)
    model = toxicity.fit(df)
    texts = {t: y for _, t, y in rows}
    counts = collections.Counter((w, y) for t, y in texts.items() for w in set(t.split()))
    pairs = collections.Counter((a, b, y) for t, y in texts.items() for a, b in set(zip(t.split(), t.split()[1:], strict=False)))
    vocabulary = sorted({w for w, _ in counts})
    hashes = toxicity.tokens(pa.array([" ".join(vocabulary)], pa.large_string())).hashes()
    at, there = text.lookup(model.words, hashes)
    assert there.all()
    shared = np.array([0.5 + len({(a, b) for a, b, _ in pairs if b == w}) for w in vocabulary])
    for k, y in enumerate((1, 0)):
        n = np.array([counts[w, y] for w in vocabulary])
        taken = toxicity.discounts(n)
        expected = (n - taken) / n.sum() + taken.sum() / n.sum() * shared / shared.sum()
        assert np.allclose(model.probabilities[at, k], expected) and expected.sum() == pytest.approx(1)
    assert len(model.bigrams) == len({(a, b) for a, b, _ in pairs})
    seen, unseen = (model.features(toxicity.tokens(pa.array([f"river {w} stone"], pa.large_string())))[0] for w in ("zzyzx", "qqqqq"))
    assert seen[0] > unseen[0] and seen[1] > unseen[1]


# --- language model ---------------------------------------------------------------------------


def test_lm_counts_match_brute_force(docs, corpus, nothing):
    got = by_id(hmm.score(docs, remainder("doc_id", 7) != 2, shard_bytes=3000))
    tokens = {i: [*words(t, True), None] for i, t, _, _ in corpus}
    seen = collections.Counter(x for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for x in w)
    total, distinct = sum(seen.values()), len(seen)
    for i, w in tokens.items():
        base = sum(math.log10((seen[x] + 1) / (total + distinct + 1)) for x in w)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(seen[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(base) and math.isfinite(r.score) and r.score < 0
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())
    assert hmm.score(nothing, F.lit(True)).count() == 0


def test_forward_recursion_and_counts_are_exact():
    rng = np.random.default_rng(3)
    model = hmm.new_model(np.arange(3, dtype=np.uint64))
    classes, first = rng.integers(0, 6, 11), np.array([0, 4, 4, 11])

    def brute(part):
        state = model.start * model.emit[part[0]]
        for c in part[1:]:
            state = (state @ model.move) * model.emit[c]
        return math.log(state.sum())

    found = hmm.log_forward(model, classes, first)
    assert found[0] == pytest.approx(brute(classes[:4])) and found[2] == pytest.approx(brute(classes[4:])) and found[1] == 0
    starts, moves, emits = hmm.expected_counts(model, classes, first)
    assert starts.sum() == pytest.approx(2, rel=1e-4)
    assert moves.sum() == pytest.approx(9, rel=1e-4) and emits.sum() == pytest.approx(11, rel=1e-4)
    better = hmm.improved(model, (starts, moves, emits))
    assert hmm.log_forward(better, classes, first).sum() > found.sum()


def test_expected_counts_match_forward_backward_over_pieces(monkeypatch):
    rng = np.random.Generator(np.random.PCG64(4))
    model = hmm.new_model(np.arange(3, dtype=np.uint64))
    sizes = [11, 1, 4, 5, 9, 23, 3]
    first = np.r_[0, np.cumsum(sizes)]
    classes = rng.integers(0, 12, first[-1])
    whole_logs = []
    starts, moves, emits = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros(model.emit.shape)
    for a, b in zip(first, first[1:], strict=False):
        e = model.emit[classes[a:b]]
        ahead, back = [model.start * e[0]], [np.ones(hmm.STATES)]
        for x in e[1:]:
            ahead.append((ahead[-1] @ model.move) * x)
        for x in e[:0:-1]:
            back.append(model.move @ (x * back[-1]))
        ahead, back = np.array(ahead), np.array(back[::-1])
        whole = ahead[-1].sum()
        whole_logs.append(np.log(whole))
        gamma = ahead * back / whole
        starts += gamma[0]
        np.add.at(emits, classes[a:b], gamma)
        for t in range(1, b - a):
            moves += ahead[t - 1][:, None] * model.move * (e[t] * back[t])[None, :] / whole
    for size, near in ((4, 2), (4, 48), (8, 5), (8, 8), (256, 48)):
        monkeypatch.setattr(hmm, "NEAR", near)
        found = hmm.expected_counts(model, classes, first, size)
        for ours, true in zip(found, (starts, moves, emits), strict=True):
            assert np.allclose(ours, true, rtol=1e-3, atol=1e-5), size
        monkeypatch.setattr(hmm, "PIECE", size)
        assert np.allclose(hmm.log_forward(model, classes, first), whole_logs, rtol=1e-9), size


def test_encoded_texts_are_the_classes(spark):
    texts = ["b a b", None, "", "c " * 50, "A"]
    model = hmm.new_model(np.sort(hmm.words(pa.array(["a b"], pa.large_string())).hashes()))
    rows = [r.ids for r in hmm.encoded(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), model).collect()]
    assert [len(r) // 2 for r in rows] == [4, 1, 1, 51, 2]
    ids, first = hmm._tokens(pa.array(rows, pa.binary()))
    assert ids[0] == ids[2] != ids[1] and ids[1] == ids[-2] and set(ids[first[1:] - 1]) == {model.end}


# --- mixture ----------------------------------------------------------------------------------


def test_mixture_meets_targets(docs, corpus, nothing):
    rows = mixture.mix(docs, block=64).collect()
    sizes = {i: len(words(t)) for i, t, _, _ in corpus}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    source = {i: s for i, _, _, s in corpus}
    names = sorted({s for s in source.values()}, key=lambda s: (s is None, s or ""))
    total = {s: sum(sizes[i] for i in sizes if source[i] == s) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    free, left, target = set(names), 1.5 * sum(total.values()), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * total[s]}
        if not over:
            break
        for s in over:
            target[s] = 2 * total[s]
            left -= target[s]
        free -= over
    target |= share
    taken = collections.Counter()
    for r in rows:
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken == sum(r.passes) <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in names)
    mixed = mixture.mixed_documents(docs, block=64)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(taken.values())
    assert mixture.mix(nothing).count() == 0 and mixture.mixed_documents(nothing).count() == 0


def test_slots_stand_in_low_discrepancy_order(spark):
    wanted = spark.createDataFrame([("a", 6000, 6000.0), ("b", 2000, 2000.0)], "source string, source_size long, target double")
    slots = sorted(mixture.schedule(wanted, block=10).collect(), key=lambda r: r.position)
    assert len({r.position for r in slots}) == len(slots) == 800
    for s in ("a", "b"):
        own = [r for r in slots if r.source == s]
        assert [r["rank"] for r in own] == list(range(len(own)))
    begin = [r.source for r in slots[:80]]
    assert abs(begin.count("a") - 60) <= 4


def test_mixture_keeps_rows_without_an_id(spark):
    rows = [(None if i % 3 else i, "w " * (i + 1), f"s{i % 2}") for i in range(40)] + [(None, None, "s0"), (None, "w w", "s1"), (None, "w w", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixture.mix(df, block=16).collect()
    assert len(got) == len(rows) and sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t, _ in rows)
    for source in {r.target for r in got}:
        same = [r for r in got if r.target == source]
        assert sum(r.taken for r in same) == round(source) and all(r.taken <= 2 * r["size"] for r in same)
    mixed = mixture.mixed_documents(df, block=16).collect()
    assert sum(len(words(r.text)) for r in mixed) == sum(r.taken for r in got)


# --- fingerprints -----------------------------------------------------------------------------


def test_fingerprints_follow_edits(docs, corpus, nothing):
    got = by_id(embedding.with_next(docs))
    ordered = sorted(corpus, reverse=True)
    for k, (i, t, _, _) in enumerate(ordered):
        x, y = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        edited = x[: len(x) - len(x) // 2] + y[: len(x) // 2]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        assert got[i].edited_fingerprint == embedding.as_text(embedding.fingerprints([edited]))[0]
        after = got[ordered[(k + 1) % len(ordered)][0]].fingerprint
        same = sum(a == b for a, b in zip(got[i].fingerprint, after, strict=True)) / embedding.SAMPLES
        assert got[i].near_next == pytest.approx(same)
    assert embedding.with_next(nothing).count() == 0
    near = {(r.a, r.b) for r in embedding.near_pairs(docs.join(embedding.with_next(docs), "doc_id"), least=0.7).collect()}
    texts = {i: t or "" for i, t, _, _ in corpus}
    base = next(t for t in texts.values() if t and list(texts.values()).count(t) == 3)
    group = {i for i, t in texts.items() if t.split()[60:290] == base.split()[60:290]}
    assert len(group) == 7 and near and all(set(p) <= group for p in near)
    prints = {i: embedding.fingerprints([t])[0] for i, t in texts.items() if len(t) > 500}
    own = embedding.fingerprints([base])[0]
    alike = {i: (own == p).mean() for i, p in prints.items()}
    assert min(alike[i] for i in group) > max(a for i, a in alike.items() if i not in group) + 0.1


# --- pieces -----------------------------------------------------------------------------------


def test_pieces_of_many_texts_need_little_memory_at_once(spark):
    """A worker encodes and decodes small parts of a batch, whatever a batch holds."""
    given = {}

    class Rows:
        schema = spark.range(0).withColumnRenamed("id", "doc_id").schema

        def select(self, *columns):
            return self

        def mapInArrow(self, each, schema):
            given["each"] = each

    pieces.encode(Rows())
    pieces.load(pieces.MODEL)
    texts = [f"a few words of text {i} and " * 40 for i in range(2000)]  # 2 MB
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": texts})
    tracemalloc.start()
    n = sum(b.num_rows for b in given["each"](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2000 and peak < 40e6


def test_pieces_are_the_models_and_decode(docs, corpus, nothing):
    library = pieces.load(pieces.MODEL).model
    encoded = pieces.encode(docs)
    got = by_id(encoded)
    assert {i: list(r.pieces) for i, r in got.items()} == {i: library.encode(t or "") for i, t, _, _ in corpus}
    assert all(r.exact for r in got.values() if r.doc_id)
    assert {i: r.text for i, r in by_id(pieces.decode(encoded)).items()} == {i: t or "" for i, t, _, _ in corpus}
    assert pieces.encode(nothing).count() == 0


def test_streaming_viterbi_is_the_best_path_and_keeps_a_short_window():
    rng = np.random.default_rng(4)
    scores = {p: float(-rng.random() * 5) for p in ("a", "b", "c", "ab", "bc", "abc", "ca", "cab", "bb")}
    for _ in range(50):
        t = "".join(rng.choice(list("abcd"), 60))
        best = [(0.0, [])]
        for end in range(1, len(t) + 1):
            options = []
            for begin in range(max(0, end - 3), end):
                p = t[begin:end]
                if p in scores or len(p) == 1:
                    options.append((best[begin][0] + scores.get(p, -20.0), [*best[begin][1], p]))
            best.append(max(options, key=lambda o: o[0]))
        stream, out, widest = pieces.StreamingViterbi(scores, -20.0), [], 0
        for c in t:
            out += stream.push(c)
            widest = max(widest, len(stream.text))
        out += stream.close()
        total = sum(scores.get(p, -20.0) for p in out)
        assert "".join(out) == t and total == pytest.approx(best[-1][0])
        assert widest < 40


# --- near duplicates --------------------------------------------------------------------------


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(docs, corpus, width, percent):
    got = by_id(setsketch.near_duplicates(docs, width=width, percent=percent))
    expected = brute_components(corpus, width, percent)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == expected
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_links_that_no_leader_has_are_found(spark, nothing):
    """A chain: each text is near the one before only."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(8):
        rows.append((k, " ".join(base[: 400 - 25 * k] + [f"x{j}" for j in range(25 * k)]), None, None))
    got = by_id(setsketch.near_duplicates(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), width=3, percent=85))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute_components(rows, 3, 85)
    assert setsketch.near_duplicates(nothing).count() == 0


def test_an_id_of_several_texts_has_the_links_of_each(spark):
    rng = random.Random(5)
    a, b, c = ([f"{x}{rng.randrange(10**6)}" for _ in range(200)] for x in "abc")

    def near(w):
        return " ".join([*w[:-1], "other"])

    a, b, c = (" ".join(x) for x in (a, b, c))
    rows = [(3, a), (3, b), (9, near(a.split())), (7, near(b.split())), (1, b), (5, c), (5, c), (6, near(c.split())), (None, c), (None, "x y z v")]
    found = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found if r.doc_id is not None} == {(1, 1), (3, 1), (7, 1), (9, 1), (5, 5), (6, 5)}
    assert all(r.kept for r in found if r.doc_id in (None, 1, 5)) and not any(r.kept for r in found if r.doc_id in (3, 6, 7, 9))


def test_estimates_are_near_the_similarity():
    values = np.unique(text.mix(np.arange(1, 3001, dtype=np.uint64)))
    a, b = values[:2000], values[400:2400]
    level = setsketch.registers(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    j = setsketch.estimate(level[:1], level[1:], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(j - 1600 / 2400) < 0.15


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (5, 5)], "a long, b long")
    found = {r.id: r.component for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 31)}, 101: 100}


def test_components_after_more_edges(spark):
    def edges(*pairs):
        return spark.createDataFrame(pairs, "a long, b long")

    found = components.components(edges((1, 2), (2, 3), (5, 6), (8, 9)))
    joined = components.joined_components(found, edges((3, 6), (6, 20), (30, 31), (2, 3)))
    assert {r.id: r.component for r in joined.collect()} == {2: 1, 3: 1, 5: 1, 6: 1, 20: 1, 9: 8, 31: 30}


def test_pairs_are_ruled_out_only_where_the_estimate_is_low():
    draw = np.random.default_rng(5)
    for _ in range(200):
        n, m = draw.integers(50, 300, 2)
        both = draw.integers(0, 1 << 63, int(min(n, m) * draw.uniform(0.5, 1)), np.uint64)
        sets = [np.r_[both, draw.integers(0, 1 << 63, k - len(both), np.uint64)] for k in (n, m)]
        level = setsketch.registers(np.concatenate(sets), np.array([0, n, n + m]))
        sizes = np.array([float(n)]), np.array([float(m)])
        full = setsketch.estimate(level[:1], level[1:], *sizes)[0] >= setsketch.floor_for(80)
        fits = 100 * min(n, m) >= 80 * max(n, m)
        assert len(setsketch.likely(level[:1], level[1:], *sizes, 80)[0]) == (full and fits)


def test_every_baum_welch_pass_sees_all_training_documents(docs, monkeypatch):
    train, one_pass, seen = remainder("doc_id", 7) != 2, hmm.baum_welch_pass, []

    def counted(texts, model):
        seen.append(texts.count())
        return one_pass(texts, model)

    monkeypatch.setattr(hmm, "baum_welch_pass", counted)
    hmm.score(docs, train)
    assert seen == [docs.where(train).count()] * hmm.PASSES


def test_the_first_baum_welch_pass_starts_from_a_model_without_a_sample(docs, monkeypatch):
    one_pass, starts = hmm.baum_welch_pass, []

    def noted(texts, model):
        starts.append(model)
        return one_pass(texts, model)

    monkeypatch.setattr(hmm, "baum_welch_pass", noted)
    hmm.score(docs, F.lit(True), passes=1)
    new = hmm.new_model(starts[0].top)
    assert np.array_equal(starts[0].move, new.move) and np.array_equal(starts[0].emit, new.emit)


# --- licenses ---------------------------------------------------------------------------------


def test_license_places_match_brute_force(docs, corpus, nothing):
    got = by_id(licenses.scan(docs))
    for i, t, _, _ in corpus:
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.encode().split()
            own = [j for j in range(len(w) - len(p) + 1) if w[j : j + len(p)] == p]
            places += own
            labels |= {label} if own else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert any("gpl-notice" in r.labels for r in got.values())
    assert licenses.scan(nothing).count() == 0


def test_a_template_is_found_with_words_put_in(spark):
    own = licenses.TEMPLATES["mit"].split()
    changed = " ".join(["before"] * 9 + own[:15] + ["put", "in"] + own[15:] + ["after"])
    r = licenses.scan(spark.createDataFrame([(1, changed)], "doc_id long, text string")).first()
    assert r.labels == "mit" and r.score > 0.8 and (r.spans[0]["first"], r.spans[0]["last"]) == (9, 9 + len(own) + 2)


def test_a_short_notice_is_found_however_often_it_stands_there(spark):
    notice = next(t for name, t in licenses.TEMPLATES.items() if name == "cc-by-nc-4.0") if "cc-by-nc-4.0" in licenses.TEMPLATES else None
    notice = notice or "Licensed under CC BY-NC 4.0"
    rows = [(n, " ".join([notice] * n)) for n in range(1, 7)] + [(7, f"words before {notice} words after"), (8, None)]
    got = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: "cc-by-nc-4.0" in r.labels.split(",") for i, r in got.items()} == {**dict.fromkeys(range(1, 8), True), 8: False}
    assert all(got[i].score == 1 for i in range(1, 8))
