"""License scans by diagonal voting over rolling hashes of word groups.

All groups of ``GROUP`` consecutive words of all documents (and of two words, for phrases of two) are joined by
hash with the places of such groups in the templates. A group at word ``p`` that stands at offset ``o`` of a
template votes for the diagonal ``p - o``. Neighbouring diagonals of a document and template, as left by
inserted or missing words, are merged, and a span is verified by how much of the template's
groups it holds and by its length. A phrase is a short template that must be held in whole, on one diagonal.

Defined results: null and empty texts have no word, no label and score 0. Rows alike in id and text are one document.
Labels are the phrases' and the verified templates' names, each once, in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.text import slices, strings, whole_windows, windows, words

GROUP = 3
REACH = 8  # diagonals at most so far apart are neighbours
MIN_SHARE = 0.5  # of a template's groups
MAX_STRETCH = 1.5  # of a template's length in words
MAX_BROADCAST_PLACES = 200_000  # template places up to which the templates are broadcast

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of public license notices.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"
    ),
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
}

_in_word = np.zeros(256, bool)
_in_word[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MARK = 0x1F0E1D2C3B4A5968  # a key for each document, so that those without any hit stay


def groups(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, bounds of texts, and for 2 and ``GROUP`` words the places and hashes of all groups."""
    w = words(texts, fold=True, in_word=_in_word)
    hashes, found = w.hashes(), []
    for k in (2, GROUP):
        at = np.flatnonzero(whole_windows(w.first, k))
        found.append((at, windows(hashes, k)[at]))
    return w.counts, w.first, found


def _packed(batches, id_col: str, text_col: str):
    """A row for each document with the keys of its mark, its pairs and its groups, in this order."""
    for batch in batches:
        ids, ties = strings(batch[id_col]), strings(batch["tie"])
        for row, part in slices(batch[text_col]):
            counts, first, ((two, pairs), (three, triples)) = groups(part)
            sizes = [np.ones(len(counts), np.int64), np.maximum(counts - 1, 0), np.maximum(counts - GROUP + 1, 0)]
            bounds = np.r_[0, np.cumsum(sum(sizes))]
            keys = np.empty(bounds[-1], np.uint64)
            keys[bounds[:-1]] = _MARK
            for at, found, skip in ((two, pairs, sizes[0]), (three, triples, sizes[0] + sizes[1])):
                text = np.searchsorted(first, at, "right") - 1
                keys[bounds[text] + skip[text] + at - first[text]] = found
            lists = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(keys.view(np.int64))).cast(pa.list_(pa.int64()))
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row, n), ties.slice(row, n), pa.array(counts.astype(np.int64)), lists], ["id", "tie", "n_words", "keys"]
            )


def template_places(spark, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """``key``, ``name``, ``kind`` and ``offset`` of all groups of the phrases and templates, and how many groups and words each has."""
    rows = [(_MARK, "", "mark", 0, 1, 1)]
    for kind, texts in (("phrase", phrases), ("template", templates)):
        for text, name in [(t, n) for n, t in texts.items()] if kind == "template" else texts.items():
            counts, _, found = groups(pa.array([text], pa.large_string()))
            at, keys = found[0 if counts[0] == 2 else 1]
            if not len(at):
                raise ValueError(f"{name}: a phrase or template has two words or more")
            for o, key in zip(at.tolist(), keys.view(np.int64).tolist(), strict=True):
                rows.append((key, name, kind, o, len(at), int(counts[0])))
    places = spark.createDataFrame(rows, "key long, name string, kind string, offset long, groups long, length long")
    return F.broadcast(places) if len(rows) <= MAX_BROADCAST_PLACES else places


def scan(docs: DataFrame, *, id_col="doc_id", text_col="text", phrases=None, templates=None) -> DataFrame:
    """One row per document: words, places of phrases, their labels, all labels and a score from 0 to 1.

    ``spans`` lists the verified template spans as (name, first word, last word, share of the template).
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    packed = rows.mapInArrow(lambda b: _packed(b, "id", "text"), f"id {kind}, tie long, n_words long, keys array<long>")
    keyed = packed.select("id", "tie", "n_words", F.posexplode("keys").alias("slot", "key"))
    hits = keyed.join(template_places(docs.sparkSession, phrases, templates), "key")
    pairs = F.greatest(F.col("n_words") - 1, F.lit(0))
    place = F.when(F.col("length") == 2, F.col("slot") - 1).otherwise(F.col("slot") - 1 - pairs)
    hits = hits.select("id", "tie", "n_words", "name", "kind", "offset", "groups", "length", place.cast("long").alias("place")).distinct()
    hits = hits.withColumn("diagonal", F.col("place") - F.col("offset"))

    document = ["id", "tie", "n_words"]
    # neighbouring diagonals of one template in one document
    along = Window.partitionBy(*document, "kind", "name").orderBy("diagonal", "place")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    reach = F.when(F.col("kind") == "template", F.lit(REACH)).otherwise(F.lit(0))
    merged = hits.withColumn("new", (gap.isNull() | (gap > reach)).cast("int"))
    merged = merged.withColumn("cluster", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # a chain that is too wide for one copy is several: it is cut into stretches of neighbours
    chain = Window.partitionBy(*document, "kind", "name", "cluster")
    wide = F.max("place").over(chain) - F.min("place").over(chain) + GROUP > F.col("length") * MAX_STRETCH + REACH
    stretch = F.floor((F.col("diagonal") - F.min("diagonal").over(chain)) / (REACH + 1))
    merged = merged.withColumn("stretch", F.when((F.col("kind") == "template") & wide, stretch).otherwise(F.lit(0)))
    spans = merged.groupBy(*document, "kind", "name", "cluster", "stretch").agg(
        F.countDistinct("offset").alias("votes"), F.min("place").alias("first"), F.max("place").alias("last"),
        F.min("diagonal").alias("diagonal"), F.first("groups").alias("groups"), F.first("length").alias("length"),
    )
    share = F.col("votes") / F.col("groups")
    width = F.col("last") - F.col("first") + GROUP
    whole = (F.col("kind") == "phrase") & (F.col("votes") == F.col("groups"))
    verified = (F.col("kind") == "template") & (share >= MIN_SHARE) & (width <= F.col("length") * MAX_STRETCH + REACH)
    names = F.array_sort(F.collect_set(F.when(whole, F.col("name"))))
    return spans.groupBy(*document).agg(
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_word"),
        F.array_join(names, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(whole | verified, F.col("name")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(whole, F.lit(1.0)).when(verified, share)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(verified, F.struct("name", "first", (F.col("last") + GROUP - 1).alias("last"), share.alias("share"))))).alias("spans"),
    ).withColumnRenamed("id", id_col).drop("tie")
