"""Licences of files from notices in their text, else from the nearest directory above, in SQL expressions only.

The sentences of every file that hold a licence word, its SPDX headers (of several identifiers the first), and licence
files as a whole, are compared with
templates by the cosine of sparse TF-IDF vectors. Document frequencies are counted over all such
passages of the corpus, for words that no template has as for those of the templates. A
file without a notice of its own inherits from the nearest directory on its path that has a licence file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved

RESERVED = "Proprietary"
#: Licence names and wordings of their notices; the last one counts only where no other does.
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:")
_BSD_2 = (f"{_BSD} Redistributions of source code must retain the "
          "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
          "binary form must reproduce the above copyright notice, this list of conditions and the following "
          "disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_3 = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
          "or promote products derived from this software without specific prior written permission.")
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under "
                     "the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0, dedicated to the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain under the Unlicense."),
    (RESERVED, "Copyright. All rights reserved."),
)
_NO_WARRANTY = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
                "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
                "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
                "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
                "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
                "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
                "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
                "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
#: Whole licence texts without holders, and SPDX identifiers with the licence each names.
TEXTS = (
    ("MIT", "MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            'software and associated documentation files (the "Software"), to deal in the Software without '
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice "
            "and this permission notice shall be included in all copies or substantial portions of the "
            'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
            "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
            "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
            "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
            "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", f"{_BSD_2} {_NO_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD_2} {_BSD_3} {_NO_WARRANTY}"),
)
IDENTIFIERS = (
    ("Apache-2.0", "Apache-2.0"), ("MIT", "MIT"), ("GPL-3.0", "GPL-3.0"), ("GPL-3.0", "GPL-3.0-only"),
    ("GPL-3.0", "GPL-3.0-or-later"), ("GPL-2.0", "GPL-2.0"), ("GPL-2.0", "GPL-2.0-only"),
    ("GPL-2.0", "GPL-2.0-or-later"), ("LGPL-3.0", "LGPL-3.0"), ("LGPL-3.0", "LGPL-3.0-only"),
    ("LGPL-3.0", "LGPL-3.0-or-later"), ("AGPL-3.0", "AGPL-3.0"), ("AGPL-3.0", "AGPL-3.0-only"),
    ("AGPL-3.0", "AGPL-3.0-or-later"), ("MPL-2.0", "MPL-2.0"), ("BSD-3-Clause", "BSD-3-Clause"),
    ("BSD-2-Clause", "BSD-2-Clause"), ("CC-BY-4.0", "CC-BY-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"),
    ("CC-BY-NC-4.0", "CC-BY-NC-4.0"), ("CC0-1.0", "CC0-1.0"), ("Unlicense", "Unlicense"),
)
SPDX = r"(?i)spdx-license-identifier:\s*\(*\s*"
#: Words that make a sentence worth comparing, names of licence files, and what ends a sentence.
NOTICE = r"(?i)licen[sc]e|copyright|spdx|\bcc0\b|\bcc by|public domain|hereby granted|rights reserved|redistribution and use|endorse or promote"
LICENSE_FILE = r"(?i)^(un)?licen[sc]e\b|^copying\b|^notice\b"
SENTENCE = r"\n+|(?<=[.!?])\s+"
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
TEMPLATES = NOTICES + TEXTS + tuple((name, f"SPDX-License-Identifier: {code}") for name, code in IDENTIFIERS)
LEAST = 0.6
#: Words in one of so many passages are joined by broadcast (at most so many times the words of a passage), others by shuffle.
OFTEN = 1000


def directory_of(path: Column) -> Column:
    """The path up to its last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _words(text: Column) -> Column:
    """An SPDX header is one word with its identifier, so that headers of other licences have nothing in common."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(text, SPDX, "spdx-license-identifier.")), F.lit(WORD), F.lit(0))


def notices(files: DataFrame) -> DataFrame:
    """``(path, passage_no, word, tf)`` of all passages to compare."""
    sentences = F.filter(F.split("text", SENTENCE), lambda s: s.rlike(NOTICE))
    whole = F.when(name_of(F.col("path")).rlike(LICENSE_FILE), F.array("text")).otherwise(F.array().cast("array<string>"))
    headers = F.regexp_extract_all("text", F.lit(SPDX + r"[a-z0-9.-]+"), F.lit(0))
    suspect = files.where(F.col("text").rlike(NOTICE) | (name_of(F.col("path")).rlike(LICENSE_FILE) & F.col("text").isNotNull()))
    passages = suspect.select("path", F.posexplode(F.concat(whole, sentences, headers)).alias("passage_no", "passage"))
    return (passages.select("path", "passage_no", F.explode(_words(F.col("passage"))).alias("word"))
            .groupBy("path", "passage_no", "word").agg(F.count("*").alias("tf")))


def own_licenses(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``(path, license, score)`` of files with a passage whose cosine with a template is at least ``least``.

    The best template counts, of equal ones the first in the list; reserved rights only where nothing is granted.
    """
    spark = files.sparkSession
    words = saved(notices(files), "notices")
    passages = words.select("path", "passage_no").distinct().count()
    listed = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "template int, text string")
    parts = (listed.select("template", F.explode(_words(F.col("text"))).alias("word"))
             .groupBy("template", "word").agg(F.count("*").alias("tf")))
    known = parts.select("word").distinct()  # the words of the templates: a fixed, small table
    counts = saved(words.groupBy("word").agg(F.count("*").alias("df")), "frequencies")
    rarity = F.log((1.0 + passages) / (1 + F.coalesce("df", F.lit(0)))) + 1
    idf = known.join(counts.join(F.broadcast(known), "word"), "word", "left").select("word", rarity.alias("idf"))
    weights = parts.join(idf, "word").withColumn("weight", F.col("tf") * F.col("idf"))
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    by_word = (weights.join(norms, "template").groupBy("word")
               .agg(F.map_from_entries(F.collect_list(F.struct("template", F.col("weight") / F.col("norm")))).alias("in_templates")))
    by_word = saved(by_word, "template-words")
    often = F.col("df") * OFTEN >= passages
    frequent = F.broadcast(counts.where(often))
    seldom = words.join(frequent.select("word"), "word", "left_anti").join(counts.where(~often), "word")
    weighed = (words.join(frequent, "word").unionByName(seldom).join(F.broadcast(by_word), "word", "left")
               .withColumn("weight", F.col("tf") * rarity))
    scores = weighed.groupBy("path", "passage_no").agg(
        F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"),
        *[F.coalesce(F.sum(F.col("weight") * F.col("in_templates")[i]), F.lit(0.0)).alias(f"t{i}") for i in range(len(templates))])
    entry = [F.struct((F.col(f"t{i}") / F.col("norm")).alias("score"), F.lit(-i).alias("place"), F.lit(name).alias("license"))
             for i, (name, _) in enumerate(templates)]
    best = scores.select("path", F.greatest(*entry).alias("best")).where(F.col("best.score") >= least)
    grant = F.col("best.license") != RESERVED
    return best.groupBy("path").agg(F.max_by("best", F.struct(grant, "best.score", "best.place")).alias("best")).select(
        "path", F.col("best.license").alias("license"), F.col("best.score").alias("score"))


def scan(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``files(path, text)`` -> one row for each row: ``path, own_license, score, license, origin``.

    ``license`` is the file's own or the inherited one, ``origin`` the path it comes from. Of several licence files in a
    directory the one with the best score speaks, then the least path. A null or empty text has no notice; a
    null path has no directory and never inherits, nor do its notices count. Rows that share a path share the best notice
    among them. Other columns are not read.
    """
    files = files.select("path", "text")
    own = saved(own_licenses(files.where("path is not null"), templates, least), "own-licenses")
    first = F.min(F.struct((-F.col("score")).alias("back"), F.col("path"), F.col("license")))
    granted = (own.where(name_of(F.col("path")).rlike(LICENSE_FILE)).withColumn("directory", directory_of(F.col("path")))
               .groupBy("directory").agg(first.alias("first"))
               .select("directory", F.col("first.license").alias("inherited"), F.col("first.path").alias("source")))
    directories = files.where("path is not null").select(directory_of(F.col("path")).alias("directory")).distinct()
    levels = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(levels)), lambda n: F.array_join(F.slice(levels, 1, n), "/"))
    lines = directories.select(F.col("directory").alias("below"), F.posexplode(F.array_distinct(above)).alias("depth", "directory"))
    nearest = (lines.join(granted, "directory").groupBy("below")
               .agg(F.max(F.struct("depth", "inherited", "source")).alias("near"))
               .select("below", "near.inherited", "near.source"))
    named = files.select("path", directory_of(F.col("path")).alias("below"))
    return (named.join(own, "path", "left").join(nearest, "below", "left")
            .select("path", F.col("license").alias("own_license"), "score",
                    F.coalesce("license", "inherited").alias("license"),
                    F.when(F.col("license").isNotNull(), F.col("path")).otherwise(F.col("source")).alias("origin")))
