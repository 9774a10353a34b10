"""The pipeline's stages against brute force, one after the other, and the entry file."""

import __spark_entry__ as driver
import corpus_pipeline
from brute_force import brute_components, kept_words, words


def test_stages_keep_what_brute_force_keeps(spark, docs, corpus, tmp_path):
    current = docs.withColumn("n_chars", docs["n_words"].cast("long"))
    columns = current.columns
    rows = {i: t for i, t, _, _ in corpus}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, current, None).write.parquet(path)
        current = spark.read.parquet(path)
        if k < 4:
            assert current.columns == columns
        got = [(r.doc_id, r.text) for r in current.collect()] if k < 4 else []
        if name == "language_id":
            rows = {i: t for i, t in rows.items() if any(c.isalpha() for c in t or "")}
            assert dict(got) == rows and len(got) == len(rows)
        elif name == "near_dedup":
            found = brute_components([(i, t, 0, 0) for i, t in rows.items()], 5, 80)
            rows = {i: t for i, t in rows.items() if found[i][1] == i}
            assert dict(got) == rows and len(got) == len(rows)
        elif name == "substring_dedup":
            kept = kept_words([(i, t, 0, 0) for i, t in rows.items()], 13)
            rows = {i: t if kept[i][1] == 0 else kept[i][2] for i, t in rows.items()}
            assert dict(got) == rows
            assert all(r.n_chars == len(r.text) for r in current.collect())
        elif name == "source_mixture":
            size = sum(len(words(t)) for t in rows.values())
            assert abs(sum(len(words(t)) for _, t in got) - 1.5 * size) <= 3
            assert all(words(rows[i])[: len(words(t))] == words(t) for i, t in got)
            n_mixed = len(got)
    assert current.count() == n_mixed and all(r.exact for r in current.select("exact").collect())


def test_repeated_rows_leave_one(spark):
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    rows = [(1, "a b c d e f g", 1), (1, "a b c d e f g", 1), (2, "a b c d e f g", 2), (3, "", 3)]
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string, extra int"), None)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_rows_of_one_id_with_other_texts_stay(spark):
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    rows = [(1, "a b c d e f g", 1), (1, "q r s t u v w", 1), (1, "a b c d e f g", 2), (2, "k l m n o p", 2)]
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string, extra int"), None)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, rows[0][1]), (1, rows[1][1]), (2, rows[3][1])]


def test_texts_with_a_letter_stay_where_no_language_is_known(spark):
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    rows = [(1, "some words", None), (2, "12 34", None), (3, None, None), (4, "", None), (5, "ü", None)]
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), None)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5]


def test_texts_that_fit_no_language_go(spark):
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    known = {"aa": "alpha beta gamma", "bb": "delta kappa sigma", "cc": "omega theta lambda"}
    rows = [(i, known[k], k) for i, k in enumerate(sorted(known) * 10)]
    rows += [(100, "beta", None), (101, "7 ж 7", None), (102, "alpha 1 kappa 2 theta", None), (103, "sigma kappa ж", None)]
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), None)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(30), 100, 103]


def test_queries_are_registered():
    names = set(driver.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
