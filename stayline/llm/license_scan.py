"""License scan: an exact set-similarity join of text windows with license
templates, and exact phrase places (native: DataFrame functions only).

``scan`` joins a table of templates with the windows of all texts. A block is
a window of consecutive words, across line ends, that starts with a word of
the template; it is as long as the template, and ``SLACK`` words longer for a
template of more than ``FULL`` distinct words. It meets the template if it
holds at least ``percent`` of its distinct words, and all of a shorter one's.
The join is exact:

* all words of all templates are put into one global order, rarest in the
  corpus first;
* prefix filter: a window that meets a template holds one of its first
  ``n - need + 1`` words in that order (n its words, need the least overlap),
  so only places of those words are exploded and joined, on the word;
* length filter: so many words lie around the place;
* positional filter: windows whose rarest template word is that of the place
  hold none of the words before it in the order; those after it that stand
  around the place must reach ``need``;
* what is left is confirmed window by window on full word sets.

Templates with another label that share at least half of the smaller one's
words are rivals. A window gives way to an overlapping one that meets a rival
in a larger share of its words or, the shares being equal, a rival of more
words: "CC BY-NC" is not "CC BY" as well. Windows of rivals are joined by
blocks of the greatest window length, so no group grows with a text.

``grants`` is the same join with a table of (label, template, key). Its windows
lie in line with the key, the words that tell a template from others, and hold
``SLACK`` words more on either side where there is one. They too are found by
the template's rarest words and pass the length and the positional filter; an
exact check follows: the key's words stand one after another, and the window
holds ``percent`` of the template's distinct words.

What reaches the driver grows with the templates only: one count per template
word, the prefix words and the greatest length. Full license texts are
templates as well, but a window of L words costs L steps for each of its
starts, so thousands of words are better told by their opening paragraph.

Defined results: null text is empty (0 words, no labels, score 0). Rows are
independent, so repeated rows or ids give repeated results, and extra columns
are ignored. An empty table, also of templates, gives no row, and no match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged

#: Phrases of the base scan and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Sentences by which licenses are commonly granted.
TEMPLATES = [
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the Software to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License You may obtain a copy of the License"),
    ("gpl", "This work is licensed under the GNU General Public License version 3"),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License v 2.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("reserved", "All rights reserved"),
    ("cc-by-sa", "Licensed under CC BY SA 4.0"),
    ("cc-by-nc-sa", "Licensed under CC BY NC SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution NonCommercial ShareAlike 4.0 "
                    "International License"),
]
PERCENT = 80
#: Templates of at most so many distinct words count only with all of them.
FULL = 12
#: Fixed values of ``grants``: (label, template, the words that tell it from
#: other licenses). Short templates are told by all their words.
GRANTS = [
    ("mit", "Licensed under the MIT License", None),
    ("mit", TEMPLATES[1][1], "associated documentation files"),
    ("apache", "Licensed under the Apache License Version 2.0", None),
    ("apache", TEMPLATES[3][1], "except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License version 3", None),
    ("gpl", TEMPLATES[5][1], "GNU General Public License"),
    ("bsd", TEMPLATES[6][1], "source and binary forms"),
    ("mpl", TEMPLATES[7][1], "Mozilla Public License"),
    ("cc-by", "Licensed under CC BY 4.0", None),
    ("cc-by", TEMPLATES[10][1], "Attribution 4.0"),
    ("cc-by-nc", "Licensed under CC BY NC 4.0", None),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License",
     "Attribution NonCommercial 4.0"),
    ("cc-by-sa", "Licensed under CC BY SA 4.0", None),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
     "Attribution ShareAlike 4.0"),
    ("reserved", "All rights reserved", None),
]
#: Words beyond the template's own in a window (``grants``: on either side).
SLACK = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def word_list(text: str) -> list[str]:
    """Words of a template in their order, by the rule used for texts."""
    import re

    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))


def template_words(text: str) -> list[str]:
    """Distinct words of a template."""
    return sorted(set(word_list(text)))


def _need(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def _strings(words):
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def lowered(col):
    return F.translate(F.coalesce(col, F.lit("")), UPPER, LOWER)


def spaced(col):
    """Words of lower-cased text with one blank between, before and after."""
    return F.regexp_replace(F.concat(F.lit(" "), col, F.lit(" ")), NOT_WORD, " ")


def template_rule(n: int, length: int, percent: int) -> tuple[int, int]:
    """(least overlap, window) of a template of ``length`` words, ``n`` of them
    distinct."""
    return (n, length) if n <= FULL else (_need(n, percent), length + SLACK)


def template_table(spark) -> DataFrame:
    """The fixed templates as a table of (label, template)."""
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(t).alias("template")) for label, t in TEMPLATES])))


def words_of(col):
    """Words of a text column in their order."""
    return F.filter(F.split(F.trim(spaced(lowered(col))), " "), lambda w: w != "")


def rarest_first(t: DataFrame, flat: DataFrame) -> DataFrame:
    """``t`` (a unique tid, ``all`` the words of a template, more columns) with
    ``words``, the distinct ones in the global order: by the number of rows of
    ``flat`` holding a word, then by word."""
    each = t.select("tid", F.explode(F.array_distinct("all")).alias("w"))
    vocabulary = sorted(r["w"] for r in each.select("w").distinct().collect())
    held = flat.select(F.explode(F.array_intersect(F.split("flat", " "), _strings(vocabulary))).alias("w"))
    order = (each.join(held.groupBy("w").agg(F.count(F.lit(1)).alias("rows")), "w", "left").groupBy("tid")
             .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "w"))).alias("o")))
    return t.join(order, "tid").withColumn("words", F.col("o.w")).drop("o")


def template_index(templates: DataFrame, flat: DataFrame, percent: int) -> DataFrame:
    """(tid, label, words in the global order, n, need, length) of every
    template with a word, ``tid`` its label and text."""
    t = (templates.where("label IS NOT NULL").select("label", "template").distinct()
         .withColumn("all", words_of(F.col("template"))).withColumn("n", F.size(F.array_distinct("all"))).where("n > 0")
         .withColumn("tid", F.to_json(F.array("label", "template"))))
    least = F.when(F.col("n") <= FULL, F.col("n")).otherwise(F.ceil(F.col("n") * percent / 100).cast("int"))
    length = F.when(F.col("n") <= FULL, F.size("all")).otherwise(F.size("all") + SLACK)
    return rarest_first(t, flat).select("tid", "label", "words", "n", least.alias("need"), length.alias("length"))


def grant_table(spark, templates=None) -> DataFrame:
    """Templates with their telling words as a table of (label, template, key)."""
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(t).alias("template"), F.lit(key).cast("string").alias("key"))
        for label, t, key in (GRANTS if templates is None else templates)])))


def grant_index(templates: DataFrame, flat: DataFrame, percent: int, slack: int) -> DataFrame:
    """(tid, label, key words, words in the global order, n, need, words of the
    window before the key, length of the window) of every template with a word.
    Without a key the whole template is the key and the window."""
    t = (templates.where("label IS NOT NULL").select("label", "template", "key").distinct()
         .withColumn("tid", F.to_json(F.array("label", "template", "key")))
         .withColumn("all", words_of(F.col("template"))).withColumn("n", F.size(F.array_distinct("all"))).where("n > 0")
         .withColumn("key", words_of(F.col("key"))).withColumn("near", F.when(F.size("key") > 0, slack).otherwise(0))
         .withColumn("key", F.when(F.size("key") > 0, F.col("key")).otherwise(F.col("all"))))
    at = F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: F.slice("all", i + 1, F.size("key")) == F.col("key"))
    first = F.coalesce(F.try_element_at(at, F.lit(1)), F.raise_error(F.concat(F.lit("key not in its template: "), "tid")).cast("int"))
    return rarest_first(t, flat).select(
        "tid", "label", "key", "words", "n", F.ceil(F.col("n") * percent / 100).cast("int").alias("need"),
        (first + F.col("near")).alias("before"), (F.size("all") + 2 * F.col("near")).alias("length"))


def rivals(index: DataFrame) -> DataFrame:
    """(tid, other, n, other_n) of templates that can stand for each other."""
    w = index.select("tid", "label", "n", F.explode("words").alias("w"))
    o = w.select(F.col("tid").alias("other"), F.col("label").alias("other_label"), F.col("n").alias("other_n"), "w")
    return (w.join(o, "w").where("label <> other_label").groupBy("tid", "other", "n", "other_n")
            .agg(F.count(F.lit(1)).alias("common")).where(2 * F.col("common") >= F.least("n", "other_n")).drop("common"))


def near_places(flat: DataFrame, index: DataFrame) -> DataFrame:
    """Places of the prefix words of ``index`` that pass the length and the
    positional filter: the template's columns, ``tk``, ``pos`` and ``near``, the
    words around from word number ``low`` on."""
    prefixes = index.select("*", F.posexplode(F.slice("words", 1, F.col("n") - F.col("need") + 1)).alias("k", "word"))
    rare = sorted(r["word"] for r in prefixes.select("word").distinct().collect())
    longest = index.agg(F.max("length")).head()[0] or 1
    here = F.col("flat").rlike(f" ({'|'.join(rare)}) ") if rare else F.lit(False)
    texts = flat.where(here).select("tk", F.split(F.trim("flat"), " ").alias("w"))
    hits = F.filter(F.transform("w", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))),
                    lambda h: h["word"].isin(rare))

    def around(h):
        low = F.greatest(h["pos"] - (longest - 1), F.lit(0))
        return F.struct(h["pos"].alias("pos"), h["word"].alias("word"), low.alias("low"),
                        F.slice("w", low + 1, h["pos"] - low + longest).alias("near"))
    places = texts.select("tk", F.explode(F.transform(hits, around)).alias("p")).select("tk", "p.*")
    first = F.greatest(F.col("pos") - F.col("length") + 1, F.lit(0))
    own = F.slice("near", first - F.col("low") + 1, F.col("pos") - first + F.col("length"))
    later = F.slice("words", F.col("k") + 1, F.col("n") - F.col("k"))
    return (places.join(prefixes, "word").withColumn("first", first)
            .where(F.size(own) >= F.col("need"))
            .where(F.size(F.array_intersect(later, own)) >= F.col("need")))


def window_matches(flat: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct (tk, tid, label, n, length, start, shared): every window of the
    texts (``tk``, ``flat``) that meets a template of ``index``."""
    def window(s):
        words = F.slice("near", s - F.col("low") + 1, F.col("length"))
        return F.struct(s.cast("long").alias("start"), F.size(F.array_intersect("words", words)).alias("shared"),
                        F.array_contains("words", words[0]).alias("own"))
    met = F.filter(F.transform(F.sequence("first", "pos"), window),
                   lambda m: m["own"] & (m["shared"] >= F.col("need")))
    return (near_places(flat, index).select("tk", "tid", "label", "n", "length", F.explode(met).alias("m"))
            .select("tk", "tid", "label", "n", "length", "m.start", "m.shared").distinct())


def grant_matches(flat: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct (tk, tid, label, n, start, shared): every place of a key of
    ``index`` whose window meets the template; start is the key's first word."""
    # windows around the place, by their first word; those that begin before
    # the text are cut
    firsts = F.sequence(F.greatest(F.col("pos") - F.col("length") + 1, -F.col("before")), F.col("pos"))
    keyed = F.filter(firsts, lambda s: F.slice("near", s + F.col("before") - F.col("low") + 1, F.size("key")) == F.col("key"))

    def window(s):
        words = F.slice("near", F.greatest(s, F.lit(0)) - F.col("low") + 1, F.col("length") + F.least(s, F.lit(0)))
        return F.struct((s + F.col("before")).cast("long").alias("start"),
                        F.size(F.array_intersect("words", words)).alias("shared"))
    met = F.filter(F.transform(keyed, window), lambda m: m["shared"] >= F.col("need"))
    return (near_places(flat, index).select("tk", "tid", "label", "n", F.explode(met).alias("m"))
            .select("tk", "tid", "label", "n", "m.start", "m.shared").distinct())


def best_matches(met: DataFrame, index: DataFrame) -> DataFrame:
    """The rows of ``met`` that give way to no window of a rival."""
    longest = index.agg(F.max("length")).head()[0] or 1
    block = F.floor(F.col("start") / longest)
    a = met.join(rivals(index), ["tid", "n"]).withColumn("block", block)
    b = met.select("tk", F.col("tid").alias("other"), F.col("start").alias("o_start"), F.col("length").alias("o_length"),
                   F.col("shared").alias("o_shared"), F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    mine, theirs = F.col("shared") * F.col("other_n"), F.col("o_shared") * F.col("n")
    beaten = (a.join(b, ["tk", "other", "block"])
              .where((F.col("o_start") < F.col("start") + F.col("length"))
                     & (F.col("start") < F.col("o_start") + F.col("o_length"))
                     & ((theirs > mine) | ((theirs == mine) & (F.col("other_n") > F.col("n")))))
              .select("tk", "tid", "start").distinct())
    return met.join(beaten, ["tk", "tid", "start"], "left_anti")


def phrase_places(words, phrases: dict[str, str]):
    """Array of (start, label) of every place of a phrase in a word array."""
    def of(parts, label):
        def here(i):
            cond = F.lit(True)
            for k, p in enumerate(parts):
                cond = cond & F.coalesce(F.try_element_at(words, (i + k + 1).cast("int")) == F.lit(p), F.lit(False))
            return cond
        start = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), lambda i: here(i))
        return F.transform(start, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    found = [of(phrase.split(" "), label) for phrase, label in phrases.items()]
    return F.concat(*found)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.md5("text").alias("tk"), spaced(lowered(F.col("text"))).alias("flat"))


def _answer(flat: DataFrame, met: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """doc_id, n_words, places and matches of every row of ``flat``."""
    matches = met.groupBy("tk").agg(F.sort_array(F.collect_list(F.struct(
        "start", "label", (F.col("shared") / F.col("n")).alias("containment")))).alias("matches"))
    last = sorted({p.split(" ")[-1] for p in phrases})
    bare = F.trim("flat")
    n_words = F.when(bare == "", 0).otherwise(F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1)
    d = flat.withColumn("words", F.when(F.col("flat").rlike(f" ({'|'.join(last)}) "), F.split(bare, " ")))
    places = F.when(F.col("words").isNotNull(), phrase_places(F.col("words"), phrases))
    d = d.select("doc_id", "tk", n_words.cast("long").alias("n_words"),
                 F.coalesce(places, F.array().cast("array<struct<start:bigint,label:string>>")).alias("places"))
    none = F.array().cast("array<struct<start:bigint,label:string,containment:double>>")
    return d.join(matches, "tk", "left").select("doc_id", "n_words", "places",
                                                F.coalesce("matches", none).alias("matches"))


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: DataFrame | None = None,
         percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, places (array of (start, label)) and matches (array of
    (start, label, containment)) of every row of ``docs``. ``templates`` is a
    table of (label, template). Matches are found once per text, told by its
    128-bit digest."""
    templates = template_table(docs.sparkSession) if templates is None else templates
    flat = _texts(docs)
    index = staged(template_index(templates, flat, percent), "license-templates")
    met = staged(window_matches(flat, index), "license-windows")
    return _answer(flat, best_matches(met, index), PHRASES if phrases is None else phrases)


def grant_rules(templates, percent: int, slack: int):
    """(label, key words, distinct words, need, words before the key, length of
    the window) of each template, for the SQL statement. Without a key the whole
    template is the key and the window."""
    rules = []
    for label, text, key in templates:
        words, near = word_list(text), slack if key else 0
        key = word_list(key or text)
        before = next(i for i in range(len(words)) if words[i:i + len(key)] == key) + near
        distinct = sorted(set(words))
        rules.append((label, key, distinct, _need(len(distinct), percent), before, len(words) + 2 * near))
    return rules


def grants(docs: DataFrame, phrases: dict[str, str] | None = None, templates=None, percent: int = PERCENT,
           slack: int = SLACK) -> DataFrame:
    """doc_id, n_words, places (as ``scan``) and matches (array of (start,
    label, containment)) of every row of ``docs``. A match is a place of a
    template's key, word after word, around which a window of the template's
    length and ``slack`` words on either side, in line with the key, holds
    ``percent`` of the template's distinct words. Windows run across line
    ends; start is the first word of the key. ``templates`` is a table, or a
    list, of (label, template, key)."""
    if not isinstance(templates, DataFrame):
        templates = grant_table(docs.sparkSession, templates)
    flat = _texts(docs)
    index = staged(grant_index(templates, flat, percent, slack), "license-grants")
    met = staged(grant_matches(flat, index), "license-windows")
    return _answer(flat, met, PHRASES if phrases is None else phrases)


def digest(found: DataFrame) -> DataFrame:
    """One row per document: counts, places and labels as plain columns."""
    base, extra = F.col("places.label"), F.col("matches.label")
    join = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    n = F.size("places").cast("long")
    best = F.coalesce(F.array_max(F.col("matches.containment")), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", n.alias("n_base"), F.array_min(F.col("places.start")).alias("first_word"),
        F.array_max(F.col("places.start")).alias("last_word"), join(base).alias("base_labels"),
        join(F.concat(base, extra)).alias("labels"), F.when(n > 0, F.lit(1.0)).otherwise(best).alias("score"))
