"""License scan by diagonal voting.

All rolling hashes of ``GRAM`` consecutive words of all texts are joined in
Spark with the positions of the same hashes in the license templates (a fixed
table of some hundred rows, broadcast). A match of text word p with template
word t votes for diagonal p - t. Votes are aggregated per document, template
and diagonal as a bit set of template positions (repeats cannot vote twice,
and partial aggregation runs before the shuffle); neighbouring diagonals, up
to ``gap`` words apart, merge into one candidate, so a few inserted or missing
words do not break it. Candidates with enough votes return to their texts,
where each is verified word by word: a phrase must stand there exactly, a
notice must keep ``NOTICE_SHARE`` of its words in order.

Defined results: null, empty and wordless texts have no words, no labels and
score 0; rows that repeat a doc_id with one text share their result, and with
different texts each have their own; other columns are ignored. An empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicata.llm.common import WordHashes, alnum_words, batched, keyed, list_column, rolling, same_row, signed

GRAM = 2
NOTICE_SHARE = 0.8
NOTICE_GAP = 3

# Phrases and the labels they give.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Well-known sentences of public license notices, and the labels they give (at most 60 words each).
NOTICES = (
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
     "general public license as published by the free software foundation", "lgpl"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed "
     "on an as is basis without warranties or conditions of any kind either express or implied", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
)


class Template:
    def __init__(self, number: int, text: str, label: str, phrase: bool):
        self.number, self.label, self.phrase = number, label, phrase
        self.words = text.encode().split()
        self.grams = len(self.words) - GRAM + 1
        self.gap = 0 if phrase else NOTICE_GAP
        # a notice with a share s of its words in order keeps about 1 - GRAM * (1 - s) of its grams at least
        self.least = self.grams if phrase else max(1, int(self.grams * (1 - GRAM * (1 - NOTICE_SHARE)) * 0.75))


TEMPLATES = [Template(i, text, label, i < len(PHRASES)) for i, (text, label) in enumerate([*PHRASES, *NOTICES])]


def template_table(spark: SparkSession) -> DataFrame:
    """(gram, template, at, gap, least): every template gram; its size is fixed by TEMPLATES."""
    hashes = WordHashes()
    rows = [(int(g), t.number, i, t.gap, t.least)
            for t in TEMPLATES for i, g in enumerate(signed(rolling(hashes.of(t.words), GRAM)))]
    return spark.createDataFrame(rows, "gram long, template int, at int, gap int, least int")


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for some in batched(zip(batch.column("doc_id"), batch.column("tag"), batch.column("text"), strict=True), 500):
            grams = [signed(rolling(hashes.of(alnum_words(t.as_py())), GRAM)) for _, _, t in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.as_py() for i, _, _ in some], pa.int64()), pa.array([g.as_py() for _, g, _ in some], pa.int64()),
                 list_column(grams, pa.int64())], names=["doc_id", "tag", "grams"])


def candidates(rows: DataFrame) -> DataFrame:
    """(doc_id, tag, spans): for each document with enough votes, its (template, first word, last gram's word)."""
    grams = (rows.mapInArrow(_grams, "doc_id long, tag long, grams array<long>")
             .select("doc_id", "tag", F.posexplode("grams").alias("word", "gram")))
    voted = grams.join(F.broadcast(template_table(rows.sparkSession)), "gram")
    key = ["doc_id", "tag", "template"]
    diagonals = (voted.groupBy(*key, (F.col("word") - F.col("at")).alias("diagonal")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("votes"), F.min("word").alias("first"),
        F.max("word").alias("last"), F.first("gap").alias("gap"), F.first("least").alias("least")))
    along = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > F.col("gap")).cast("int"), F.lit(0))
    apart = F.when(F.col("gap") == 0, F.lit(1)).otherwise(apart)
    merged = (diagonals.withColumn("apart", apart)
              .withColumn("group", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*key, "group").agg(F.bit_or("votes").alias("votes"), F.min("first").alias("first"),
                                          F.max("last").alias("last"), F.first("least").alias("least"))
              .filter(F.bit_count("votes") >= F.col("least")))
    return merged.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("template", "first", "last")).alias("spans"))


def in_order(template: Sequence[bytes], words: Sequence[bytes]) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(words) + 1)
    for t in template:
        diagonal = 0
        for j, w in enumerate(words, 1):
            diagonal, row[j] = row[j], diagonal + 1 if t == w else max(row[j], row[j - 1])
    return row[-1]


def verified(words: Sequence[bytes], template: Template, first: int, last: int) -> float:
    """Share of the template's words that stand between the candidate's first and last gram: in a row for a phrase,
    in order for a notice."""
    if template.phrase:
        return float(list(words[first:first + len(template.words)]) == template.words)
    low, high = max(0, first - NOTICE_GAP), min(len(words), last + GRAM + NOTICE_GAP)
    reach = 2 * (len(template.words) + 4 * NOTICE_GAP)  # a candidate may hold several places of the notice
    best = max(in_order(template.words, words[at:min(high, at + reach)])
               for at in range(low, max(low + 1, high - len(template.words) + 1), reach // 4))
    return best / len(template.words)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")}
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            words = alnum_words(text.as_py())
            base, labels, score, places = [], set(), 0.0, []
            for span in spans.as_py() or ():
                template = TEMPLATES[span["template"]]
                share = verified(words, template, span["first"], span["last"])
                if share >= (1.0 if template.phrase else NOTICE_SHARE):
                    score = max(score, share)
                    labels.add(template.label)
                    places.append((template.number, span["first"], span["last"] + GRAM))
                    if template.phrase:
                        base.append((span["first"], template.label))
            out["n_words"].append(len(words))
            out["n_base"].append(len(base))
            out["first_word"].append(min(base)[0] if base else None)
            out["last_word"].append(max(base)[0] if base else None)
            out["base_labels"].append(",".join(sorted({b for _, b in base})))
            out["labels"].append(",".join(sorted(labels)))
            out["score"].append(score)
            out["places"].append([x for p in sorted(places) for x in p])
        kinds = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "places": pa.list_(pa.int32())}
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tag"), *[pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()]],
            names=["doc_id", "tag", *out])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, tag, n_words, n_base, first_word, last_word, base_labels, labels, score, places
    (template, first word, end, ... of every verified span)."""
    rows = keyed(docs, id_col, text_col)
    spans = candidates(rows)
    found = rows.join(spans, same_row(rows, spans), "left").select(rows["doc_id"], rows["tag"], rows["text"], spans["spans"])
    return found.mapInArrow(_labelled, "doc_id long, tag long, n_words long, n_base long, first_word long, last_word long, "
                                       "base_labels string, labels string, score double, places array<int>")
