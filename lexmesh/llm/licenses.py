"""License scans by diagonal voting.

All rolling word k-grams of all texts are joined with the positions of the same
k-grams in license templates (a fixed, broadcast table): pairs for the base
phrases, triples for notices and license texts. A hit votes for the diagonal
(document position - template position); votes are gathered per diagonal, and
neighbouring diagonals of a template are merged, so that a changed or inserted
word here or there does not break a match. A merged span is verified: hits that
stand in the template's order count, the words that they cover must be a given
share of the template, and the span must not be much longer than the template.
The base phrases are templates that must match on one diagonal, whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A-Z, a-z; what separates words once A-Z is lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

#: Notices as their licenses ask for them, in words.
NOTICES = [
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

#: License texts, in words.
TEXTS = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with "
        "the software or the use or other dealings in the software",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
        "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
        "negligence or other tortious action arising out of or in connection with the use or performance of this software",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
        "and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages "
        "including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability "
        "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions "
        "the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product "
        "an acknowledgment in the product documentation would be appreciated but is not required altered source versions must be plainly marked as such and must not be misrepresented as being the original software "
        "this notice may not be removed or altered from any source distribution",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary "
        "for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software "
        "to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors "
        "we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law",
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
]

#: Words of a k-gram: of base phrases, of notices and texts.
BASE_GRAM, GRAM = 2, 3
#: Diagonals this close belong to one match.
NEAR = 3
#: The share of a template's words that a match must cover, and how many times longer than it a span may be.
COVER, LONGER = 0.85, 1.5


def template_grams(more: list[tuple[str, str]] = ()) -> tuple[list[tuple], list[tuple]]:
    """((tpl, label, base, words), (tpl, tpos, first, second, third or null)): every k-gram of every template."""
    kinds, grams = [], []
    for tpl, (base, label, text) in enumerate([(True, *p) for p in PHRASES] + [(False, *p) for p in [*NOTICES, *TEXTS, *more]]):
        words = text.split()
        k = BASE_GRAM if base else GRAM
        kinds.append((tpl, label, base, len(words)))
        grams += [(tpl, i, words[i], words[i + 1], None if base else words[i + 2]) for i in range(len(words) - k + 1)]
    return kinds, grams


def words_of(text: Column) -> Column:
    """Lower-cased words; their array may begin or end with an empty string."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), NOT_WORD)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: list[tuple[str, str]] = ()) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for each row of docs.

    spans lists the verified matches (first word, one past the last word, label,
    share of the template). score is the largest share, 1 for a base phrase, 0
    if nothing was hit. `more` adds templates (label, words separated by spaces).
    A null text is empty: no words, nulls for the places, empty labels. Repeated
    rows each get their row, a null id is an id like any other, an empty table
    gives no rows, other columns are ignored.
    """
    spark = docs.sparkSession
    kinds, grams = template_grams(more)
    kinds = F.broadcast(spark.createDataFrame(kinds, "tpl int, label string, base boolean, words int"))
    tpl = spark.createDataFrame(grams, "tpl int, tpos int, a string, b string, c string")
    tpl = F.broadcast(tpl.withColumn("h", F.xxhash64("a", "b")))
    # the row number keeps repeated rows and null ids apart; it is made where the text is read, with all that follows from it
    raw = docs.select(F.monotonically_increasing_id().alias("_rid"), F.col(id_col).alias("_id"), F.array_remove(words_of(F.col(text_col)), "").alias("_w"))
    later = lambda k: F.slice("_w", F.lit(k + 1), F.greatest(F.size("_w") - k + 1, F.lit(1)))
    lists = raw.select("_rid", "_id", F.size("_w").cast("long").alias("n_words"), F.arrays_zip(F.col("_w").alias("a"), later(1).alias("b"), later(2).alias("c")).alias("_grams"))
    rows = lists.select("_rid", "_id", "n_words", F.posexplode_outer("_grams").alias("pos", "g"))
    rows = rows.select("_rid", "_id", "n_words", "pos", F.col("g.a").alias("da"), F.col("g.b").alias("db"), F.col("g.c").alias("dc"))
    rows = rows.withColumn("dh", F.xxhash64("da", "db"))
    same = (rows.dh == tpl.h) & (rows.da == tpl.a) & (rows.db == tpl.b) & (tpl.c.isNull() | (rows.dc == tpl.c))
    # the first row of a document stays without a hit, so that no second pass is needed for n_words
    hits = rows.join(tpl, same, "left").where("tpl is not null or pos = 0 or pos is null")
    diagonal = F.when(F.col("tpl").isNotNull(), F.col("pos") - F.col("tpos")).alias("diag")
    votes = hits.groupBy("_rid", "_id", "tpl", diagonal).agg(F.max("n_words").alias("n_words"), F.collect_set("pos").alias("at"))
    lane = Window.partitionBy("_rid", "tpl").orderBy("diag")
    gap = F.col("diag") - F.lag("diag").over(lane)
    runs = votes.withColumn("run", F.sum(F.coalesce((gap > F.when(F.col("tpl") < len(PHRASES), 0).otherwise(NEAR)).cast("int"), F.lit(1))).over(lane))
    places = F.transform("at", lambda p: F.struct(p.alias("pos"), (p - F.col("diag")).alias("tpos")))
    merged = runs.groupBy("_rid", "_id", "tpl", "run").agg(F.max("n_words").alias("n_words"), F.min("diag").alias("first"), F.sort_array(F.flatten(F.collect_list(places))).alias("hits"))
    merged = merged.join(kinds, "tpl", "left")
    k = F.when(F.col("base"), BASE_GRAM).otherwise(GRAM)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def step(s: Column, x: Column) -> Column:
        """Hits in the template's order: the words that each adds."""
        end = x["tpos"] + k
        more_ = F.struct(x["tpos"].alias("last"), end.alias("upto"), (s["n"] + end - F.greatest(x["tpos"], s["upto"])).alias("n"))
        return F.when(x["tpos"] > s["last"], more_).otherwise(s)

    covered = F.when(F.col("tpl").isNotNull(), F.aggregate("hits", start, step, lambda s: s["n"]) / F.col("words")).otherwise(F.lit(0.0))
    found = merged.select("_rid", "_id", "n_words", F.col("first").alias("diag"), "label", F.coalesce("base", F.lit(False)).alias("base"), "words", covered.alias("cover"), F.get("hits", F.lit(0))["pos"].alias("low"), (F.get("hits", F.size("hits") - 1)["pos"] + k).alias("high"))
    whole = F.col("base") & (F.col("cover") == 1.0)
    fits = F.col("high") - F.col("low") <= LONGER * F.col("words")
    valid = whole | (~F.col("base") & (F.col("cover") >= COVER) & fits)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        found.groupBy("_rid", "_id")
        .agg(
            F.max("n_words").alias("n_words"),
            F.count_if(whole).cast("long").alias("n_base"),
            F.min(F.when(whole, F.col("diag"))).cast("long").alias("first_word"),
            F.max(F.when(whole, F.col("diag"))).cast("long").alias("last_word"),
            joined(F.when(whole, F.col("label"))).alias("base_labels"),
            joined(F.when(valid, F.col("label"))).alias("labels"),
            F.max(F.when(whole | (~F.col("base") & F.coalesce(fits, F.lit(True))), F.col("cover")).otherwise(0.0)).alias("score"),
            F.array_sort(F.collect_list(F.when(valid, F.struct("low", "high", "label", "cover")))).alias("spans"),
        )
        .select(F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
    )
