import random
import re

from pyspark.sql import functions as F

from stayline.llm import license_scan as L


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, templates, percent):
    """Every window of every template, rivals compared pair by pair."""
    w = words(text or "")
    places = [(i, label) for phrase, label in L.PHRASES.items() for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
    sets, found = [set(words(t)) for _, t in templates], []
    for t, (label, template) in enumerate(templates):
        n, size = len(sets[t]), len(words(template))
        share, size = (100, size) if n <= L.FULL else (percent, size + L.SLACK)
        for i in range(len(w)):
            have = len(set(w[i:i + size]) & sets[t]) if w[i] in sets[t] else 0
            if have and 100 * have >= share * n:
                found.append((i, i + size, t, label, have / n))

    def beaten(a):
        return any(a[3] != b[3] and a[0] < b[1] and b[0] < a[1] and (b[4], len(sets[b[2]])) > (a[4], len(sets[a[2]]))
                   and 2 * len(sets[a[2]] & sets[b[2]]) >= min(len(sets[a[2]]), len(sets[b[2]])) for b in found)
    matches = sorted({(a[0], a[3], a[4], a[2]) for a in found if not beaten(a)})
    base, every = {b for _, b in places}, {b for _, b in places} | {m[1] for m in matches}
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(every)), 1.0 if places else max([m[2] for m in matches], default=0.0))


def test_matches_brute_force(docs_of):
    rnd = random.Random(2)
    texts = [None, "", "\n\n", "MIT License", "mit\nlicense apache-license", "the general PUBLIC license " * 3,
             "élicense mit license9 mit license", "x" * 100_000 + " mit license",
             "word " * 40_000 + "\nall rights reserved\n"]
    vocabulary = sorted({w for _, t in L.TEMPLATES for w in words(t)} | {"foo", "bar", "été"})
    for _, t in L.TEMPLATES:
        for share in (0.0, 0.05, 0.15, 0.25):
            w = [x for x in t.split() if rnd.random() >= share]
            for _ in range(rnd.randrange(4)):
                w.insert(rnd.randrange(len(w) + 1), rnd.choice(vocabulary))
            if rnd.random() < 0.3:
                rnd.shuffle(w)
            texts.append("intro text the work\n" + rnd.choice([" ", ", ", "\n * "]).join(w * rnd.choice([1, 1, 2])) + "\nend")
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(400)) for _ in range(3)]
    texts += ["\n".join(t for _, t in rnd.sample(L.TEMPLATES, 8)) for _ in range(6)]
    for percent in (80, 100, 50):
        docs = docs_of(list(enumerate(texts))).withColumn("low", F.lit(1)).withColumn("flat", F.lit(None).cast("int"))
        got = {r.doc_id: tuple(r)[1:] for r in L.digest(L.scan(docs, percent=percent)).collect()}
        assert got == {i: brute(t, L.TEMPLATES, percent) for i, t in enumerate(texts)}


def test_templates_as_a_table(spark, docs_of):
    """Own templates, repeated, wordless, without a label; a full license text; none."""
    full = " ".join(f"clause{i} of the agreement" for i in range(40))
    rows = [("own", "Granted by Example Works"), ("own", "Granted by Example Works"), ("none", "--"), (None, "some words"),
            ("nothing", None), ("long", full)]
    table = spark.createDataFrame(rows, "label string, template string")
    docs = docs_of([(1, "x granted\nby example, works"), (2, "some words"), (3, "a\n" + full.replace(" of ", "\nof ") + " b"),
                    (4, " ".join(full.split()[:60])), (5, None)])
    got = labels(L.scan(docs, templates=table))
    assert got == {1: "own", 2: "", 3: "long", 4: "", 5: ""}
    assert set(labels(L.scan(docs, templates=table.limit(0))).values()) == {""}


def test_repeated_rows_null_ids_empty_table(docs_of):
    rows = [(1, "mit license"), (1, "mit license"), (None, "mit license"), (None, None)]
    got = L.digest(L.scan(docs_of(rows))).collect()
    assert sorted((r.doc_id or 0, r.n_base, r.labels) for r in got) == [(0, 0, ""), (0, 1, "mit"), (1, 1, "mit"), (1, 1, "mit")]
    assert L.digest(L.scan(docs_of([]))).count() == 0


def labels(df):
    return {r.doc_id: r.labels for r in L.digest(df).collect()}


def test_short_grants_get_only_their_own_label(docs_of):
    lines = [("Licensed under the Apache License, Version 2.0.", "apache"), ("Licensed under the MIT License", "mit"),
             ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
             ("Licensed under CC BY 4.0", "cc-by"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
             ("Licensed under CC BY-SA 4.0", "cc-by-sa"), ("Licensed under CC BY-NC-SA 4.0", ""),
             ("All rights reserved.", "reserved"), ("reserved " + "word " * 99 + "all rights", ""), (None, ""), ("", "")]
    docs = docs_of([(i, t) for i, (t, _) in enumerate(lines)])
    assert labels(L.grants(docs)) == {i: want for i, (_, want) in enumerate(lines)}


def test_windows_give_each_text_its_own_label(docs_of):
    short = [("Licensed under the Apache License, Version 2.0.", "apache"), ("Licensed under the MIT License", "mit"),
             ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
             ("Licensed under CC BY 4.0", "cc-by"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
             ("Licensed under CC BY-SA 4.0", "cc-by-sa"), ("Licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa"),
             ("All rights reserved.", "reserved"), ("reserved " + "word " * 99 + "all rights", ""), (None, ""), ("", "")]
    cc = "This work is licensed under a Creative\nCommons Attribution%s 4.0\nInternational License."
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided "
           "that the following conditions\nare met:")
    long = [(cc % "", "cc-by"), (cc % "-NonCommercial", "cc-by-nc"), (cc % "-ShareAlike", "cc-by-sa"),
            (cc % "-NonCommercial-ShareAlike", "cc-by-nc-sa"), (bsd, "bsd"),
            ("Copyright the Regents. All rights reserved.\n" + bsd, "bsd,reserved"),
            ("/* Permission is hereby granted, free of charge, to any person obtaining\n * a copy of this software and "
             "associated documentation files (the\n * \"Software\"), to deal in the Software without restriction", "mit"),
            ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "mpl"),
            ("licensed " + "foo " * 50 + "under cc " + "bar " * 50 + "by 4.0 all " + "x " * 50 + "rights y reserved", ""),
            (" foo ".join(L.TEMPLATES[6][1].split()), "")]
    docs = docs_of([(i, t) for i, (t, _) in enumerate(short + long)])
    assert labels(L.scan(docs)) == {i: want for i, (_, want) in enumerate(short + long)}


def test_copies_of_one_text(docs_of):
    docs = docs_of([(i, "intro\nAll rights reserved") for i in range(300)] + [(7, "other")])
    rows = L.scan(docs).collect()
    assert len(rows) == 301 and sum(len(r.matches) for r in rows) == 300


def test_wrapped_texts_are_found_and_scattered_words_are_not(docs_of):
    texts = [
        ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided "
         "that the following conditions\nare met:", "bsd"),
        ("/* Permission is hereby granted, free of charge, to any person obtaining\n * a copy of this software and "
         "associated documentation files (the\n * \"Software\"), to deal in the Software without restriction", "mit"),
        ("# you may not use this file except in compliance with the License.\n# You may obtain a copy of\n"
         "# the License at", "apache"),
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "mpl"),
        ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General "
         "Public License as published by\nthe Free Software Foundation", "gpl"),
        ("This work is licensed under a Creative Commons\nAttribution 4.0 International License", "cc-by"),
        ("This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License", "cc-by-nc"),
        ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License", "cc-by-sa"),
        ("licensed " + "foo " * 50 + "under cc " + "bar " * 50 + "by 4.0 all " + "x " * 50 + "rights y reserved", ""),
        (" foo ".join(L.TEMPLATES[6][1].split()), ""),
        ("source and binary forms", "")]
    docs = docs_of([(i, t) for i, (t, _) in enumerate(texts)])
    assert labels(L.grants(docs)) == {i: want for i, (_, want) in enumerate(texts)}


def test_grants_match_brute_force(docs_of):
    rnd, texts = random.Random(5), [None, "", "all rights reserved all rights reserved"]
    for _, t, _ in L.GRANTS:
        for share in (0.0, 0.1, 0.2):
            w = ["foo"] * rnd.randrange(3) + [x for x in t.split() if rnd.random() >= share] * 2 + ["bar"]
            texts.append(rnd.choice(["\n", " ", "\n * "]).join(w))

    def one(text):
        w, found = words(text or ""), []
        for label, t, key in L.GRANTS:
            t, key, slack = words(t), words(key or t), L.SLACK if key else 0
            for i in range(len(w)):
                lo = i - slack - [t[j:j + len(key)] for j in range(len(t))].index(key)
                have = set(w[max(lo, 0):max(lo + len(t) + 2 * slack, 0)]) & set(t)
                if w[i:i + len(key)] == key and 100 * len(have) >= L.PERCENT * len(set(t)):
                    found.append((i, label, len(have) / len(set(t))))
        return sorted(found)
    rows = L.grants(docs_of(list(enumerate(texts)))).collect()
    assert {r.doc_id: sorted(map(tuple, r.matches)) for r in rows} == {i: one(t) for i, t in enumerate(texts)}


def test_grants_join_a_table_of_templates(spark, docs_of):
    """Templates come as a table; their rarest words lead to the windows, and the key is checked there."""
    text = "the grantor gives the bearer use of the crystal works without charge"
    table = spark.createDataFrame([("own", text, "crystal works"), ("own", text, "crystal works"), ("whole", "open to all", None),
                                   (None, "some words", None), ("wordless", "--", None)], "label string, template string, key string")
    docs = docs_of([(1, "x the grantor gives\nthe bearer use of the crystal works, without charge"), (2, "crystal works"),
                    (3, "the grantor gives the bearer use of the works without crystal charge"), (4, "Open to\nall"), (5, None),
                    (6, "crystal works without charge the grantor gives the bearer use of the")])
    assert labels(L.grants(docs, templates=table)) == {1: "own", 2: "", 3: "", 4: "whole", 5: "", 6: ""}
    assert set(labels(L.grants(docs, templates=table.limit(0))).values()) == {""}
    flat = L._texts(docs)
    index = L.grant_index(table, flat, 80, L.SLACK)
    (own,) = index.where("label = 'own'").collect()
    assert (own.n, own.need, own.before, own.length) == (10, 8, 8 + L.SLACK, 12 + 2 * L.SLACK)
    assert own.words[-1] == "works" and {r.word for r in L.near_places(flat, index).where("label = 'own'").collect()} <= set(own.words[:3])
    assert [(r.start, r.shared) for r in L.grant_matches(flat, index).where("label = 'own'").collect()] == [(9, 10)]
