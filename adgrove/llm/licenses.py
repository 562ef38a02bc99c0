"""License notices in documents, found with DataFrame functions alone.

A text becomes words (runs of a-z and 0-9 in lower case) and overlapping windows, of a length that fits the templates of one
size class. MinHash signatures of the windows' shingles are joined with those of the templates, one row a band; each
pair that meets in a band is verified by exact containment: the share of the template's shingles that the window has.

Before windows are cut, two tests drop texts that cannot verify. A passage that has the asked share of a template's
shingles lacks few of them, and hides at most one of the template's words for each shingle it lacks; so it has one of
a few chosen words of the template, and of its distinct words all but so many.

A window is a quarter longer than its largest template, and windows start every eighth of their length. A passage
within 9/8 of the template's length lies whole in a window, and shares with it at least ``THRESHOLD`` of the template's
shingles; their Jaccard similarity j is then at least 1/3 for the shortest template and above 0.5 for long ones. With
``BANDS`` bands of one row the pair is missed with probability (1 - j)^BANDS: 2.3e-6 at 1/3, 1e-10 at 0.5.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import table

#: Words of a shingle, and of the shortest template.
SHINGLE = 5
#: Share of a template's shingles that a window must have.
THRESHOLD = 0.8
BANDS = 32
#: Largest number of templates; they are part of the plan and of a broadcast.
MOST = 500
#: Words in the windows of the first size class, and the growth from class to class.
SMALLEST, GROWTH = 7, 1.25

# Public license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
     "either express or implied. See the License for the specific language governing permissions and limitations under "
     "the License."),
    ("GPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
     "General Public License for more details."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
     "the Software."),
    ("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-clauses", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for "
     "any purpose, commercial or non-commercial, and by any means."),
)

WORDS = re.compile(r"[a-z0-9]+")


class Template:
    """A notice's words, its size class and what a passage must have to reach the threshold."""

    def __init__(self, name: str, text: str, threshold: float):
        self.name, self.words = name, WORDS.findall(text.lower())
        if len(self.words) < SHINGLE:
            raise ValueError(f"{name} has fewer than {SHINGLE} words")
        shingles = [tuple(self.words[i: i + SHINGLE]) for i in range(len(self.words) - SHINGLE + 1)]
        distinct = set(shingles)
        least = math.ceil(threshold * len(distinct) - 1e-9)
        lacking = len(distinct) - least
        self.vocabulary = sorted(set(self.words))
        self.words_needed = max(1, len(self.vocabulary) - lacking)
        # Long words first, until fewer shingles are without them than a match must have.
        self.marks: list[str] = []
        rest = distinct
        for word in sorted(self.vocabulary, key=lambda w: (-len(w), w)):
            if len(rest) < least:
                break
            self.marks.append(word)
            rest = {s for s in rest if word not in s}
        size = SMALLEST
        while size < 1.25 * len(self.words):
            size = math.ceil(size * GROWTH)
        self.window = size


def words_of(text: str) -> Column:
    return F.filter(F.split(F.lower(F.col(text)), "[^a-z0-9]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Distinct shingles of a word array; fewer words than a shingle has give none."""
    all_ = F.transform(
        F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.concat_ws(" ", F.slice(words, i + 1, F.lit(SHINGLE)))
    )
    return F.when(F.size(words) >= SHINGLE, F.array_distinct(all_)).otherwise(F.array().cast("array<string>"))


def signature_of(shingles: Column) -> Column:
    """Smallest hash of the shingles under each of ``BANDS`` hash functions."""
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, i)))
    )


def stride(window: Column) -> Column:
    return F.ceil(window / 8).cast("int")


def literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def scan(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, license, containment, first_word, n_windows): the notices that each document holds.

    ``containment`` is the largest share of the template's distinct ``SHINGLE``-word shingles in a window,
    ``first_word`` the start of the first window that has it, ``n_windows`` the number of windows that reach ``threshold``.
    ``docs`` has (doc_id, text). NULL, empty and short texts hold nothing; rows with one id (or none) are taken
    together. Templates are a short list of (name, text) with distinct names and at least ``SHINGLE`` words each.
    """
    if len(templates) > MOST or len({n for n, _ in templates}) < len(templates):
        raise ValueError(f"at most {MOST} templates, each with a name of its own")
    known = [Template(n, t, threshold) for n, t in templates]
    marks = literals(sorted({w for t in known for w in t.marks}))
    texts = docs.select("doc_id", words_of("text").alias("words")).where(F.arrays_overlap("words", marks))

    vocabulary = F.array_distinct("words")

    def possible(t: Template) -> Column:
        return F.size(F.array_intersect(vocabulary, literals(t.vocabulary))) >= t.words_needed

    classes = {w: [t for t in known if t.window == w] for w in sorted({t.window for t in known})}
    sizes = F.array_compact(F.array(*[
        F.when(reduce(lambda a, b: a | b, [possible(t) for t in ts]), F.lit(w)) for w, ts in classes.items()
    ]))
    marked = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(marks, F.get("words", i)))
    step, last = stride(F.col("window")), F.greatest(F.size("words") - SHINGLE, F.lit(0))

    def around(place: Column) -> Column:
        """Starts of the windows that hold a place."""
        low = F.greatest(F.ceil((place - F.col("window") + 1) / step).cast("int"), F.lit(0))
        high = F.floor(F.least(place, last) / step).cast("int")
        return F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), lambda k: k * step)).otherwise(
            F.array().cast("array<int>")
        )

    # Windows are cut inside the row and leave it one by one, without the words of the whole text.
    cut = F.transform(
        F.array_distinct(F.flatten(F.transform("places", around))),
        lambda s: F.struct(s.alias("start"), F.slice("words", s + 1, F.col("window")).alias("part")),
    )
    windows = (
        texts.select("doc_id", "words", marked.alias("places"), F.explode(sizes).alias("window"))
        .select("doc_id", "window", F.explode(cut).alias("cut"))
        .select("doc_id", "window", "cut.start", "cut.part")
        .where(F.size("part") >= SHINGLE)
        .select("doc_id", "window", "start", shingles_of(F.col("part")).alias("shingles"))
        .withColumn("signature", signature_of(F.col("shingles")))
    )
    template_rows = docs.sparkSession.createDataFrame(
        [(t.name, t.window, t.words) for t in known], "license string, window int, words array<string>"
    ).select("license", "window", shingles_of(F.col("words")).alias("of_template")).withColumn(
        "signature_t", signature_of(F.col("of_template"))
    )
    banded = template_rows.select("*", F.posexplode("signature_t").alias("band", "value"))
    # A pair that meets in several bands goes on from the first of them only.
    first_band = F.array_position(F.zip_with("signature", "signature_t", lambda a, b: a == b), F.lit(True)) - 1
    share = F.size(F.array_intersect("shingles", "of_template")) / F.size("of_template")
    verified = (
        windows.select("*", F.posexplode("signature").alias("band", "value"))
        .join(F.broadcast(banded), ["window", "band", "value"])
        .where(first_band == F.col("band"))
        .select("doc_id", "license", "start", share.alias("share"))
        .where(F.col("share") >= threshold)
    )
    return verified.groupBy("doc_id", "license").agg(
        F.max("share").alias("containment"), F.min(F.struct((-F.col("share")).alias("s"), "start")).alias("best"),
        F.count(F.lit(1)).alias("n_windows"),
    ).select("doc_id", "license", "containment", F.col("best.start").alias("first_word"), "n_windows")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of all documents."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same windows by definition: matching shingles counted in every window, without signatures."""
    rows = []
    for name, text in TEMPLATES:
        t = Template(name, text, THRESHOLD)
        words = ", ".join(f"'{w}'" for w in t.words)
        rows.append(f"('{name}', {t.window}, {math.ceil(t.window / 8)}, [{words}])")
    n = SHINGLE
    return f"""
with t(license, w, step, words) as (values {', '.join(rows)}),
ts as (
  select distinct license, w, step, array_to_string(words[i + 1:i + {n}], ' ') as shingle
  from t, unnest(range(len(words) - {n - 1})) as u(i)
),
size as (select license, count(*) as m from ts group by license),
d as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') as words from documents
),
ds as (
  select doc_id, len(words) as n, i as p, array_to_string(words[i + 1:i + {n}], ' ') as shingle
  from d, unnest(range(greatest(len(words) - {n - 1}, 0))) as u(i)
),
hits as (select doc_id, n, p, license, w, step, ts.shingle from ds join ts on ds.shingle = ts.shingle),
wins as (
  select doc_id, license, s * step as start, shingle
  from hits, unnest(range(greatest(0, cast(ceil((p + {n} - w) / step) as bigint)), p // step + 1)) as u(s)
  where s * step <= greatest(n - {n}, 0)
),
shares as (
  select doc_id, license, start, cast(count(distinct shingle) as double) / any_value(m) as share
  from wins join size using (license) group by doc_id, license, start
),
good as (select * from shares where share >= {THRESHOLD})
select doc_id, license, max(share) as containment, cast(arg_min(start, (-share, start)) as integer) as first_word,
  count(*) as n_windows
from good group by doc_id, license
"""


SQL = _sql()
