"""License scans by a positional index of rare words, in DataFrame functions only.

Only words of the licence vocabulary are indexed, with their positions; their document frequencies over all documents
give the rarity of each. A template can stand in a document only if all words of its mandatory phrase do. For each such
pair the rarest of them is looked up: the one of the highest IDF, then with the fewest places in the document. Each
of its postings names a place where the template would start, and the other words are met by their positions relative
to that start. A template counts where its mandatory phrase stands word for word; it also scores by the
rarity-weighted share of its words that stand in place, so that a whole notice scores more than its first line.

Null and empty texts have no words and no places. Repeated rows are scanned each for itself. Ties between words go to
the first by name. Texts are read whole, whatever their length. Other columns are left alone. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stereobate.llm._io import save

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices, their mandatory phrase and label; the words beside the phrase add to the score.
NOTICES = [
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by"
        " the free software foundation either version 2 of the license or at your option any later version",
        "gnu general public license as published by the free software foundation either version 2", "gpl-2.0-or-later",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by"
        " the free software foundation either version 3 of the license or at your option any later version",
        "gnu general public license as published by the free software foundation either version 3", "gpl-3.0-or-later",
    ),
    ("gnu general public license version 2", "gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gnu general public license version 3", "gpl-3"),
    (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as"
        " published by the free software foundation",
        "gnu lesser general public license", "lgpl",
    ),
    ("you should have received a copy of the gnu affero general public license along with this program", "gnu affero general public license", "agpl"),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a"
        " copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software"
        " distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "apache license version 2 0", "apache-2.0",
    ),
    ("cc by sa", "cc by sa", "cc-by-sa"),
    ("cc by nc", "cc by nc", "cc-by-nc"),
    ("cc by nd", "cc by nd", "cc-by-nd"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution", "cc-by"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software"
        " to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"
        " and or sell copies of the software and to permit persons to whom the software is furnished to do so",
        "permission is hereby granted free of charge", "mit",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above"
        " copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and or distribute this software for any purpose", "isc",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
        " redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistribution and use in source and binary forms", "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file"
        " you can obtain one at",
        "mozilla public license", "mpl",
    ),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license", "epl"),
    (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising"
        " from the use of this software",
        "in no event will the authors be held liable for any damages", "zlib",
    ),
    (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute"
        " this software",
        "free and unencumbered software", "unlicense",
    ),
    ("boost software license version 1 0", "boost software license", "bsl"),
    ("all rights reserved", "all rights reserved", "proprietary"),
]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def template_rows() -> list[tuple]:
    """``template, label, base, mandatory, offset, word`` of each word of each template; offsets count from the phrase."""
    rows = []
    for n, (text, must, label, base) in enumerate([*((p, p, x, True) for p, x in PHRASES.items()), *((*x, False) for x in NOTICES)]):
        words, needed = text.split(), must.split()
        first = next(i for i in range(len(words)) if words[i : i + len(needed)] == needed)
        rows += [(n, label, base, first <= i < first + len(needed), i - first, w) for i, w in enumerate(words)]
    return rows


def scan(documents: DataFrame) -> DataFrame:
    """One row for each document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are their smallest and largest
    start. ``score`` is the best rarity-weighted share of a template's words in place, 1 for a whole one.
    """
    spark = documents.sparkSession
    rows = template_rows()  # under 500, fixed
    known = spark.createDataFrame(rows, "template int, label string, base boolean, mandatory boolean, offset int, word string")
    vocabulary = sorted({r[5] for r in rows})
    words = F.split(ascii_lower(F.col("text")), BREAK)
    # A leading break leaves an empty first entry; it is cut, so that positions count words.
    words = F.when(words[0] == "", F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(words)
    words = F.when(F.try_element_at(words, F.lit(-1)) == "", F.slice(words, F.lit(1), F.size(words) - 1)).otherwise(words)
    split = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), words.alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.cast("long").alias("pos"), w.alias("word"))), lambda x: x["word"].isin(vocabulary))
    seen = split.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), hits.alias("hits")).withColumn("held", F.array_distinct("hits.word"))
    # Positions are kept only where some template's mandatory words are all held.
    phrases = sorted({tuple(sorted({r[5] for r in rows if r[0] == n and r[3]})) for n in range(rows[-1][0] + 1)}, key=len)
    least = [p for p in phrases if not any(set(q) < set(p) for q in phrases)]
    whole = lambda p: F.forall(F.array(*map(F.lit, p)), lambda w: F.array_contains("held", w))
    may = F.exists(F.array(*[whole(p) for p in least]), lambda x: x)
    index = save(seen.select("doc_id", "row", "n_words", "held", F.when(may, F.col("hits")).alias("hits")), "index")

    total = index.count()
    frequency = index.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    rarity = F.broadcast(save(frequency.select("word", F.log((F.lit(float(total)) + 1) / F.col("df")).alias("idf")), "rarity"))
    by_template = Window.partitionBy("template")
    weighted = known.join(rarity, "word", "left").withColumn("idf", F.coalesce("idf", F.lit(0.0)))
    weighted = F.broadcast(save(weighted.withColumn("needed", F.sum(F.col("mandatory").cast("int")).over(by_template)).withColumn("weight", F.sum("idf").over(by_template)), "templates"))

    postings = index.where("hits is not null").select("row", F.explode("hits").alias("h")).select("row", "h.pos", "h.word")
    phrase = weighted.where("mandatory").groupBy("template", "word").agg(F.min("offset").alias("offset"), F.first("idf").alias("idf"))
    phrase = F.broadcast(phrase.withColumn("kinds", F.count("*").over(by_template)))
    counted = postings.groupBy("row", "word").agg(F.count("*").alias("n")).join(phrase, "word")
    anchor = counted.groupBy("row", "template").agg(F.count("*").alias("met"), F.first("kinds").alias("kinds"), F.min(F.struct((-F.col("idf")).alias("common"), "n", "word", "offset")).alias("a")).where("met = kinds")
    starts = anchor.select("row", "template", F.col("a.word").alias("word"), F.col("a.offset").alias("at")).join(postings, ["row", "word"]).select("row", "template", (F.col("pos") - F.col("at")).alias("start"))
    met = starts.join(weighted, "template").withColumn("pos", F.col("start") + F.col("offset")).join(postings.withColumnRenamed("word", "here"), ["row", "pos"]).where("here = word")
    places = met.groupBy("row", "template", "start", "label", "base", "needed", "weight").agg(F.sum(F.col("mandatory").cast("int")).alias("held"), F.sum("idf").alias("in_place")).where("held = needed")
    base = F.col("base")
    found = places.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(F.when(F.col("weight") > 0, F.least(F.col("in_place") / F.col("weight"), F.lit(1.0))).otherwise(F.lit(1.0))).alias("score"),
    )
    out = index.select("row", "doc_id", "n_words").join(found, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
