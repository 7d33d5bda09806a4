"""License scans by diagonal voting.

All rolling word pairs of every text are hashed and joined to the positions of the
same pairs in license templates.  A hit at word i of a text and position p of a
template votes for the diagonal i - p; votes are added up per text, template and
diagonal as a bit set of template positions.  Neighbouring diagonals (a word put in
or left out) are merged, and a merged span holds if enough of the template's pairs,
verified word by word, lie in it.  Where stuttered text makes the merged diagonals wider
than the template, the best window of the template's width is taken out of them.  Phrases
must match whole, on one diagonal.

Templates have at most 63 pairs, so a bit set is one long; longer license texts are
given as several templates with one label.

Defined results: null text counts as empty and has no words; rows that repeat id and
text each get a row; a null doc_id is kept; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import text_of

#: What stands between words once A-Z are lower case; before that, A-Z are word characters too.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SLACK = 3
SHARE = 0.8
#: Pairs of the longest template.
MOST_PAIRS = 63
_DOCUMENT = -1


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    whole: bool = False

    @staticmethod
    def of(label: str, text: str, whole: bool = False) -> "Template":
        words = tuple(text.split())
        if not 2 <= len(words) <= 64:
            raise ValueError(f"a template has 2 to 64 words: {text[:60]}")
        return Template(label, words, whole)


#: The phrases that always count, and opening sentences of common licenses.
PHRASES = (
    Template.of("cc-by", "cc by", True),
    Template.of("gpl", "general public license", True),
    Template.of("reserved", "all rights reserved", True),
)
NOTICES = (
    Template.of("apache", "licensed under the apache license version 2 0 the license you may not "
                          "use this file except in compliance with the license"),
    Template.of("bsd", "redistribution and use in source and binary forms with or without "
                       "modification are permitted provided that the following conditions are met"),
    Template.of("cc-by", "this work is licensed under a creative commons attribution license"),
    Template.of("gpl", "this program is free software you can redistribute it and or modify it "
                       "under the terms of the gnu general public license as published by the "
                       "free software foundation"),
    Template.of("isc", "permission to use copy modify and or distribute this software for any "
                       "purpose with or without fee is hereby granted"),
    Template.of("mit", "permission is hereby granted free of charge to any person obtaining a "
                       "copy of this software and associated documentation files"),
    Template.of("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template.of("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = PHRASES + NOTICES


def words_of(text: Column) -> Column:
    """Lower-case words of a text, in order.

    All letters are lowered, which beyond A-Z neither makes nor breaks word characters.
    """
    parts = F.split(F.lower(text), BETWEEN)
    first = F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
    last = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.slice(parts, first + 1, F.size(parts) - first - last)


def template_positions(spark, templates: tuple[Template, ...]) -> DataFrame:
    """(h, template, p, w0, w1): every word pair of every template; plus one mark per document."""
    rows = [(t, p, a, b) for t, x in enumerate(templates)
            for p, (a, b) in enumerate(zip(x.words, x.words[1:]))]
    return (spark.createDataFrame([(_DOCUMENT, 0, None, None), *rows],
                                  "template int, p int, w0 string, w1 string")
            .withColumn("h", F.xxhash64("w0", "w1")))


def license_spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
                  share: float = SHARE, slack: int = SLACK) -> DataFrame:
    """Verified spans, and a mark for every document.

    Columns: doc_id, text_hash, n_words, copies (on the mark: how many rows have this
    id and text), template (-1: the mark), label, whole, start, end (words, end
    exclusive), coverage.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("t"))
    words = texts.select("doc_id", F.xxhash64("t").alias("text_hash"), words_of(F.col("t")).alias("w"))
    pairs = words.select("doc_id", "text_hash", F.size("w").alias("n_words"), "w", F.concat(
        F.array(F.xxhash64(F.lit(None).cast("string"), F.lit(None).cast("string"))),
        F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1)))).alias("pairs"))
    # The outer form: its inner twin makes Catalyst filter on the hashes before it has split the text.
    rolled = pairs.select("doc_id", "text_hash", "n_words", "w",
                          F.posexplode_outer("pairs").alias("at", "h"))
    same = ((F.col("at") == 0) & (F.col("template") == _DOCUMENT)) | (
        (F.col("at") > 0) & (F.get("w", F.col("at") - 1) == F.col("w0"))
        & (F.get("w", F.col("at")) == F.col("w1")))
    # The templates are constants of a few hundred rows.
    votes = (rolled.join(F.broadcast(template_positions(spark, templates)), "h").filter(same)
             .groupBy("doc_id", "text_hash", "n_words", "template",
                      (F.col("at") - 1 - F.col("p")).alias("diagonal"))
             .agg(F.bit_or(F.expr("shiftleft(1L, p)")).alias("bits"),
                  F.count(F.lit(1)).alias("copies")))

    known = spark.createDataFrame(
        [(_DOCUMENT, "", True, 1)] + [(t, x.label, x.whole, len(x.words) - 1)
                                      for t, x in enumerate(templates)],
        "template int, label string, whole boolean, n_pairs int")
    in_order = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    apart = F.col("whole") | (F.col("diagonal") - F.lag("diagonal").over(in_order) > slack)
    # The template's width of diagonals that ends at each one, within its island: at most 64 entries.
    near = in_order.rangeBetween(-MOST_PAIRS, 0)
    reached = F.filter("near", lambda x: (x["diagonal"] >= F.col("diagonal") - F.col("n_pairs")) & (x["island"] == F.col("island")))
    merged = F.aggregate("reached", F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x["bits"]))
    window = F.struct(F.bit_count(merged).alias("n"), (-F.element_at("reached", 1)["diagonal"]).alias("back"), F.col("diagonal").alias("last"))
    wide = F.col("furthest") - F.col("start") > F.col("n_pairs")
    return (votes.join(F.broadcast(known), "template").repartition("doc_id", "text_hash")
            .withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
            .withColumn("island", F.sum("apart").over(in_order))
            .withColumn("near", F.when(~F.col("whole"), F.collect_list(F.struct("diagonal", "island", "bits")).over(near)))
            .withColumn("reached", F.array_sort(reached))
            .groupBy("doc_id", "text_hash", "n_words", "template", "label", "whole", "n_pairs", "island")
            .agg(F.bit_or("bits").alias("bits"), F.max("copies").alias("copies"),
                 F.min("diagonal").alias("start"), F.max("diagonal").alias("furthest"),
                 F.max(F.when(~F.col("whole"), window)).alias("best"))
            # An island wider than its template is judged, and cut, to the best window of that width.
            .withColumns({"coverage": F.when(wide & F.col("best").isNotNull(), F.col("best.n"))
                                       .otherwise(F.bit_count("bits")) / F.col("n_pairs"),
                          "from": F.when(wide & F.col("best").isNotNull(), -F.col("best.back")).otherwise(F.col("start")),
                          "to": F.when(wide & F.col("best").isNotNull(), F.col("best.last")).otherwise(F.col("furthest"))})
            .filter((F.col("template") == _DOCUMENT) | F.when(F.col("whole"), F.col("coverage") == 1)
                    .otherwise(F.col("coverage") >= share))
            .select("doc_id", "text_hash", "n_words", "copies", "template", "label", "whole", F.col("from").alias("start"),
                    (F.col("to") + F.col("n_pairs") + 1).alias("end"), "coverage"))


def license_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spans = license_spans(docs, **options)
    mark = F.col("template") == _DOCUMENT
    phrase = F.col("whole") & ~mark
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (spans.groupBy("doc_id", "text_hash", "n_words").agg(
        F.max(F.when(mark, F.col("copies"))).alias("copies"),
        F.count(F.when(phrase, 1)).alias("n_base"),
        F.min(F.when(phrase, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(phrase, F.col("label"))).alias("base_labels"),
        joined(F.when(~mark, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(~mark, F.col("coverage"))), F.lit(0.0)).alias("score"))
        .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
        .select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word",
                "last_word", "base_labels", "labels", "score"))
