"""License scan: TF-IDF cosine to notice templates, then inheritance along directories (DataFrame functions only).

A file's units are all stretches of 1 to ``WINDOW`` lines (a notice may be
wrapped), its longer paragraphs (lines between lines without a term), and for a
licence file (by its name) the whole text.  A unit's sparse TF-IDF vector is
compared by cosine with the templates'; the best template at or above
``threshold`` is the unit's licence, the best unit's is the file's own.  Files
without their own licence inherit it from the nearest ancestor directory that
holds a licence file, found by joining the directories' ancestor paths.

The document frequencies behind the weights cover all files.  Those of the
templates' terms come first.  A cosine is at most the root of the share of the
template's squared weight that lies on shared terms, so files, and then units,
whose terms cover too little of every template are dropped: this loses nothing.
The other terms of the units that are left get their frequencies from a second
pass over the files, summed before the shuffle and then semi-joined with these terms.
Directories, not files, are joined with their ancestors; the templates' tables
are a few hundred rows.

A row is known by a digest of its path, key and text, so rows without a key, and
texts that share a path and key, keep apart.

Defined cases: null or empty text has no licence of its own; a null path counts
as a file in the root; a null key is a key like any other; repeated rows get the
same result each; equal scores go to the template that is first in the list; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved

# Public license notices, as usually written in headers or at the start of license files.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
            "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
            "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
                     "holder nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
                     "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
                     "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
                     "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
                     "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
                     "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
                     "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
                     "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
)
WINDOW = 10  # lines that a wrapped notice may take
MOST_ROWS = 200_000  # row digests that may be broadcast
TASK_ROWS = 1_000  # texts that one task cuts into units
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
_BREAK = r"[^\p{L}0-9.]+"


def terms(text: str) -> str:
    """SQL array of a text's terms: lower-case letters, digits and inner points."""
    return f"filter(transform(split(lower({text}), '{_BREAK.replace(chr(92), chr(92) * 2)}'), t -> trim(BOTH '.' FROM t)), t -> t != '')"


def _templates(spark) -> DataFrame:
    """(template, license, term, tf), one row per template and term."""
    rows = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text"))
        for i, (name, text) in enumerate(TEMPLATES)])))
    return (rows.select("template", "license", F.explode(F.expr(terms("text"))).alias("term"))
            .groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf")))


def _vocabulary() -> list[str]:
    words = Counter()
    for _, text in TEMPLATES:
        words.update(t.strip(".") for t in re.split(r"[^a-z0-9.]+", text.lower()))
    return sorted(w for w in words if w)


def _sql_array(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _idf(df: Column, n_files: Column) -> Column:
    return F.log((n_files + 1) / (F.greatest(F.coalesce(df, F.lit(1)), F.lit(1)) + 1)) + 1


def _reached(held: Column | str, squares: list[tuple[dict, float]]) -> Column:
    """Whether the terms ``held`` (an array) can reach the threshold with a template.

    A cosine is at most the root of the share of the template's squared weight
    that lies on shared terms.
    """
    held = F.col(held) if isinstance(held, str) else held

    def shared(of: dict) -> Column:
        weight = F.create_map(*[F.lit(x) for t, w in of.items() for x in (t, w)])
        return F.aggregate(held, F.lit(0.0), lambda a, t: a + F.coalesce(F.element_at(weight, t), F.lit(0.0)))

    out = F.lit(False)
    for of, least in squares:
        out = out | (shared(of) >= F.lit(least))
    return out


def _needed(squares: list[tuple[dict, float]]) -> list[str]:
    """Terms of which a text holds at least one if it reaches the threshold with any template.

    Of each template the heaviest terms, until what the others weigh together is too little.
    """
    out = set()
    for of, least in squares:
        rest = sum(of.values())
        for term, weight in sorted(of.items(), key=lambda tw: (-tw[1], tw[0])):
            if rest < least:
                break
            out.add(term)
            rest -= weight
    return sorted(out)


def frequencies(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, df) of the ``wanted`` terms over all files' texts; only partial sums are shuffled."""
    everywhere = files.select(F.explode(F.expr(f"array_distinct({terms("coalesce(text, '')")})")).alias("term"))
    return everywhere.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(wanted, "term", "left_semi")


def scan_units(files: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(row, path, template, license, similarity) of every unit that reaches the threshold.

    ``files`` has row (equal for equal rows only), path and text.
    """
    spark = files.sparkSession
    words = _sql_array(_vocabulary())
    templates = _templates(spark)
    held = saved(files.select("row", F.expr(f"array_intersect({terms("coalesce(text, '')")}, {words})").alias("held")), "held_terms")
    n_files = F.lit(float(max(1, files.count())))
    idf = saved(
        templates.select("term").distinct().join(
            held.select(F.explode("held").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term", "left")
        .select("term", _idf(F.col("df"), n_files).alias("idf")), "idf")  # one row per template term
    weights = templates.join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("template_norm"))
    weights = saved(weights.join(F.broadcast(norms), "template"), "template_weights")
    of_template: dict[int, dict] = {}
    for r in weights.select("template", "term", "w").collect():  # a few hundred rows
        of_template.setdefault(r.template, {})[r.term] = r.w * r.w
    squares = [(of, (threshold * threshold - 1e-6) * sum(of.values())) for of in of_template.values()]

    name = F.regexp_extract("path", r"([^/]*)$", 1)
    # most texts lack every heavy term; the rows of the others are few as a rule, and broadcast up to MOST_ROWS
    heavy = F.array(*[F.lit(t) for t in _needed(squares)])
    rows = saved(held.where(F.arrays_overlap("held", heavy)).where(_reached("held", squares)).select("row").distinct(), "possible_rows")
    n_rows = rows.count()
    possible = files.join(F.broadcast(rows) if n_rows <= MOST_ROWS else rows, "row", "left_semi").select("row", "path", "text")
    # dealt by rows, not by bytes: a text of few bytes has many units
    possible = saved(possible, "license_files").repartition(-(-max(1, n_rows) // TASK_ROWS), "row").dropDuplicates(["row"])
    lines = possible.select(
        "row", "path", name.rlike(FILE_NAME).alias("is_license"),
        F.expr(f"transform(split(coalesce(text, ''), '\n'), line -> {terms('line')})").alias("lines"))
    lines = lines.withColumn("own", F.expr(f"transform(lines, t -> array_intersect(t, {words}))"))
    n = "size(lines)"
    # the stretches of a file: 1 to WINDOW lines that begin and end with template terms, paragraphs, a licence file as a whole;
    # rows carry slices, not the file
    starts = f"""transform(filter(sequence(1, {n}), i -> size(own[i - 1]) > 0), i ->
        struct(i AS at, slice(lines, i, {WINDOW}) AS lines, slice(own, i, {WINDOW}) AS own))"""
    windows = (lines.select("row", "path", F.inline(F.expr(starts)))
               .where(_reached(F.expr("array_distinct(flatten(own))"), squares))
               .select("*", F.explode(F.expr(f"filter(sequence(1, {n}), j -> size(own[j - 1]) > 0)")).alias("length"))
               .withColumns({c: F.expr(f"slice({c}, 1, length)") for c in ("lines", "own")}))
    gaps = f"concat(array(0), filter(sequence(1, {n}), i -> size(lines[i - 1]) = 0), array({n} + 1))"
    parts = f"""transform(filter(sequence(0, size(gaps) - 2), k -> gaps[k + 1] - gaps[k] - 1 > {WINDOW}), k -> struct(gaps[k] + 1 AS at,
        gaps[k + 1] - gaps[k] - 1 AS length, slice(lines, gaps[k] + 1, gaps[k + 1] - gaps[k] - 1) AS lines,
        slice(own, gaps[k] + 1, gaps[k + 1] - gaps[k] - 1) AS own))"""
    paragraphs = lines.withColumn("gaps", F.expr(gaps)).select("row", "path", F.inline(F.expr(parts)))
    whole = lines.where("is_license").select("row", "path", F.lit(1).alias("at"), F.expr(n).alias("length"), "lines", "own")
    units = (windows.unionByName(paragraphs).unionByName(whole)
             .withColumn("held", F.expr("array_distinct(flatten(own))")).where((F.size("held") >= 2) & _reached("held", squares))
             .select("row", "path", "at", "length", F.expr("flatten(lines)").alias("terms"))
             .dropDuplicates(["row", "at", "length"]))
    unit = ["row", "path", "at", "length"]
    counted = saved(units.select(*unit, F.explode("terms").alias("term")).groupBy(*unit, "term").agg(F.count(F.lit(1)).alias("n")),
                    "license_units")

    other = saved(counted.select("term").distinct().join(F.broadcast(idf), "term", "left_anti"), "other_terms")
    others = frequencies(files, other).select("term", _idf(F.col("df"), n_files).alias("idf"))
    vectors = counted.join(saved(others.unionByName(idf), "unit_idf"), "term").withColumn("w", F.col("n") * F.col("idf"))
    lengths = vectors.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    products = (vectors.select(*unit, "term", F.col("w").alias("own"))
                .join(F.broadcast(weights.select("term", "template", "license", "w", "template_norm")), "term")
                .groupBy(*unit, "template", "license").agg(F.sum(F.col("own") * F.col("w") / F.col("template_norm")).alias("dot")))
    return (products.join(lengths, unit).withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 9))
            .where(F.col("similarity") >= threshold)
            .select("row", "path", "template", "license", "similarity"))


def directory(path: Column) -> Column:
    """The path without its last part ('' for files in the root)."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(path, row_key, license, similarity, found, licence_dir) for every row of files (path, row_key, text).

    ``found`` is ``own``, ``inherited`` or ``none``.
    """
    files = files.select(F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "row_key",
                         F.col("text").cast("string").alias("text"))
    files = files.withColumn("row", F.md5(F.concat_ws("\n", F.md5("path"), F.coalesce(F.md5(F.col("row_key").cast("string")), F.lit("-")),
                                                      F.coalesce(F.md5("text"), F.lit("-")))))
    hits = saved(scan_units(files, threshold), "license_hits")
    top = hits.groupBy("row").agg(F.max("similarity").alias("similarity"))
    first = (hits.join(top, ["row", "similarity"]).groupBy("row", "path", "similarity")
             .agg(F.min("template").alias("template")))
    names = F.array(*[F.lit(n) for n, _ in TEMPLATES])
    own = first.withColumn("license", names[F.col("template")]).drop("template")
    of_dir = (own.where(F.regexp_extract("path", r"([^/]*)$", 1).rlike(FILE_NAME))
              .withColumn("dir", directory(F.col("path"))))
    best = of_dir.groupBy("dir").agg(F.max("similarity").alias("similarity"))
    licensed = (of_dir.join(best, ["dir", "similarity"]).groupBy("dir").agg(F.min("license").alias("dir_license"))
                .withColumnRenamed("dir", "ancestor"))
    placed = files.select("row", "path", "row_key", directory(F.col("path")).alias("dir"))
    dirs = placed.select("dir").distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("ancestor")))
    nearest = (dirs.select("dir", F.inline(above)).join(licensed, "ancestor")
               .groupBy("dir").agg(F.max_by("ancestor", "depth").alias("licence_dir"), F.max_by("dir_license", "depth").alias("dir_license")))
    out = placed.join(own.drop("path"), "row", "left").join(nearest, "dir", "left")
    return out.select(
        "path", "row_key", F.coalesce("license", "dir_license").alias("license"), "similarity",
        F.when(F.col("license").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(F.col("license").isNull(), F.col("licence_dir")).alias("licence_dir"))
