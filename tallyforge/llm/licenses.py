"""License statements in documents: fixed phrases, and an exact set-similarity join with license texts.

A template is the words of a license statement. A block is a line of a document, or a window of as many words as the
template has, wherever the lines break; it meets a template if it holds at least THRESHOLD of the template's distinct
words. Words are ordered by their count over all documents, rarest first. A block that meets a template of n words
with a need of m must hold one of the template's first n - m + 1 words, so only lines with such a word, and the runs
of words around such words, are read as sets; of them, length and position of the common word must leave m common
words possible, and the rest is counted exactly: in a line once, in a run for every window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.tables import plain_ids, row_keyed, save

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: License statements by label; every text is one template.
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), BETWEEN), "")


def _places(words: str, phrase: list[str]) -> Column:
    """Places where the phrase starts."""

    def here(i: Column) -> Column:
        hit = F.get(words, i) == phrase[0]
        for j, word in enumerate(phrase[1:], 1):
            hit = hit & (F.get(words, i + j) == word)
        return hit

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _template_words(docs: DataFrame, templates, threshold: float, text_col: str) -> DataFrame:
    """(template, label, width, token, uses, i, size, need): each template's words, rarest first over all documents; width counts repeated ones."""
    spark = docs.sparkSession
    rows = spark.createDataFrame([(k, label, text) for k, (label, text) in enumerate(templates)], "template int, label string, text string")
    rows = rows.withColumn("words", _words(F.col("text")))
    rows = rows.select("template", "label", F.size("words").alias("width"), F.explode(F.array_distinct("words")).alias("token"))
    vocabulary = rows.select("token").distinct()
    seen = docs.select(F.explode(_words(F.coalesce(F.col(text_col), F.lit("")))).alias("token")).join(F.broadcast(vocabulary), "token").groupBy("token").agg(F.count("*").alias("uses"))
    rows = rows.join(seen, "token", "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
    size = F.count("*").over(Window.partitionBy("template"))
    ranks = rows.withColumn("i", F.row_number().over(Window.partitionBy("template").orderBy("uses", "token"))).withColumn("size", size)
    return ranks.withColumn("need", F.ceil(F.round(F.col("size") * threshold, 6)).cast("int"))


def _runs(words: str, rare: list[str], width: int) -> Column:
    """The words around the rare ones, as far as windows of ``width`` words with a rare one reach; what overlaps is one run."""
    hits = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(rare))

    def edges(hits: Column) -> Column:
        firsts = F.filter(hits, lambda x, i: (i == 0) | (x - F.get(hits, i - 1) >= width))
        lasts = F.filter(hits, lambda x, i: (i == F.size(hits) - 1) | (F.get(hits, i + 1) - x >= width))
        return F.arrays_zip(firsts.alias("first"), lasts.alias("last"))

    def run(x: Column) -> Column:
        first = F.greatest(x["first"] - (width - 1), F.lit(0))
        return F.array_join(F.slice(words, first + 1, x["last"] + width - first), " ")

    # the hits are bound once, as the element of an array of their own
    return F.array_distinct(F.flatten(F.transform(F.array(hits), lambda h: F.transform(edges(h), run))))


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks) per document.

    A-Z count as a-z. n_base counts the places of all phrases, first_word and last_word are their smallest and largest
    start. labels joins the phrases' and the met templates' labels; score is the largest share of a
    template's words in one block that meets it, else 0. blocks holds the lines that were compared, then the runs of words
(as a-z, joined by one space) whose windows were. Null texts are empty.
    Every row is judged by its own text, also where ids are null or repeated.
    """
    if not plain_ids(docs, id_col):
        rows, once = row_keyed(docs, id_col, text_col)
        found = save(scan(once, phrases, templates, threshold).withColumnRenamed("doc_id", "_row"))
        return rows.select(F.col(id_col).cast("long").alias("doc_id"), "_row").join(found, "_row").drop("_row")
    phrases = PHRASES if phrases is None else phrases
    ordered = save(_template_words(docs, templates, threshold, text_col))
    rare = [r[0] for r in ordered.where("i <= size - need + 1").select("token").distinct().orderBy("token").collect()]
    rare_words = F.array(*map(F.lit, rare)).cast("array<string>")
    width = ordered.agg(F.max("width")).first()[0] or 1

    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), _words(text).alias("words"))
    joined = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    found = {p: F.contains(F.col("joined"), F.lit(f" {' '.join(_split(p))} ")) for p in phrases}
    empty = F.array().cast("array<int>")
    places = F.flatten(F.array(*[F.when(hit, _places("words", _split(p))).otherwise(empty) for p, hit in found.items()]))
    labels = F.array_compact(F.array(*[F.when(hit, F.lit(phrases[p])) for p, hit in found.items()]))
    lines = F.filter(F.split("text", "\n"), lambda x: F.arrays_overlap(_words(x), rare_words))
    base = base.withColumn("joined", joined).withColumn("places", places).withColumn("base", F.array_sort(F.array_distinct(labels)))
    near, none = F.arrays_overlap("words", rare_words), F.array().cast("array<string>")
    base = base.withColumn("blocks", F.when(near, F.array_distinct(lines)).otherwise(none)).withColumn("runs", F.when(near, _runs("words", rare, width)).otherwise(none))
    base = base.select("doc_id", F.size("words").cast("long").alias("n_words"), F.size("places").cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"), "base", "blocks", "runs")
    base = save(base)

    blocks = base.where("doc_id IS NOT NULL").select("doc_id", F.explode(F.array(*(F.struct(F.lit(wide).alias("wide"), F.col(c).alias("all")) for wide, c in ((False, "blocks"), (True, "runs"))))).alias("of"))
    blocks = blocks.select("doc_id", "of.wide", F.explode("of.all").alias("block"))
    of_doc = blocks.join(_met(blocks.select("block", "wide").distinct(), ordered), ["block", "wide"])
    of_doc = of_doc.groupBy("doc_id").agg(F.collect_set("label").alias("more"), F.max("score").alias("score"))
    out = base.join(of_doc, "doc_id", "left").withColumn("more", F.coalesce("more", F.array().cast("array<string>")))
    both = F.array_join(F.array_sort(F.array_distinct(F.concat("base", "more"))), ",")
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), both.alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), F.concat("blocks", "runs").alias("blocks"))


def _split(phrase: str) -> list[str]:
    return phrase.split(" ")


def _met(blocks: DataFrame, ordered: DataFrame) -> DataFrame:
    """(block, wide, label, score) of every distinct block that meets a template; a wide one by its best window."""
    uses = ordered.select("token", "uses").distinct()
    tokens = blocks.select("block", "wide", F.array_distinct(_words(F.col("block"))).alias("tokens"))
    tokens = tokens.select("block", "wide", F.size("tokens").alias("n"), F.explode("tokens").alias("token")).join(F.broadcast(uses), "token")
    of_block = Window.partitionBy("block", "wide")
    tokens = save(tokens.withColumn("j", F.row_number().over(of_block.orderBy("uses", "token"))).withColumn("known", F.count("*").over(of_block)).drop("uses"))
    prefix = ordered.where("i <= size - need + 1").select("template", "need", "size", "i", "token")
    room = F.least("i", "j") + F.least(F.col("size") - F.col("i"), F.col("known") - F.col("j"))
    pairs = tokens.join(F.broadcast(prefix), "token").where((F.col("n") >= F.col("need")) & (room >= F.col("need"))).select("block", "wide", "template").distinct()
    whole = ordered.select("template", "label", "width", "size", "need", "token")
    both = pairs.join(tokens.select("block", "wide", "token"), ["block", "wide"]).join(F.broadcast(whole), ["template", "token"])
    same = both.groupBy("block", "wide", "template", "label", "width", "size", "need").agg(F.count("*").alias("same"), F.collect_list("token").alias("common")).where("same >= need")
    same = same.withColumn("same", F.when(F.col("wide"), _best_window()).otherwise(F.col("same"))).where("same >= need")
    return same.select("block", "wide", "label", (F.col("same") / F.col("size")).alias("score"))


def _best_window() -> Column:
    """Most common words in one window of the template's width; a window may start at a common word without loss."""

    def best(words: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_contains("common", F.get(words, i - 1)))
        return F.array_max(F.transform(starts, lambda i: F.size(F.array_intersect(F.slice(words, i, F.col("width")), F.col("common")))))

    # the words are split once, as the element of an array of their own
    return F.element_at(F.transform(F.array(F.split("block", " ")), best), 1).cast("long")


def oracle() -> str:
    """DuckDB: phrases by place, and every line against every template."""
    split = "list_filter(string_split_regex({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    values = ", ".join("({}, '{}', '{}')".format(k, label, text.replace("'", "''")) for k, (label, text) in enumerate(TEMPLATES))
    places = " UNION ALL ".join(
        f"SELECT doc_id, unnest(list_filter(range(len(w)), lambda i: {' AND '.join(f'w[i + {j + 1}] = {chr(39)}{x}{chr(39)}' for j, x in enumerate(_split(p)))})) AS place, '{label}' AS label FROM words"
        for p, label in PHRASES.items()
    )
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    words AS (SELECT doc_id, {split.format(lower.format('text'))} AS w FROM texts),
    places AS ({places}),
    base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
    templates AS (SELECT label, list_distinct({split.format(lower.format('body'))}) AS t FROM (VALUES {values}) AS v(k, label, body)),
    lines AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS line FROM texts),
    sets AS (SELECT line, list_distinct({split.format(lower.format('line'))}) AS s FROM lines),
    met AS (SELECT line, label, len(list_intersect(s, t)) / len(t) AS score FROM sets, templates WHERE len(list_intersect(s, t)) >= ceil(round(len(t) * {THRESHOLD}, 6))),
    held AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
    method AS (SELECT doc_id, list(DISTINCT label) AS labels, max(score) AS score FROM held JOIN met USING (line) GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(b.n_base, 0) AS BIGINT) AS n_base, b.first_word, b.last_word,
        array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
        array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
        CAST(coalesce(m.score, 0) AS DOUBLE) AS score
    FROM words w LEFT JOIN base b USING (doc_id) LEFT JOIN method m USING (doc_id)"""
