"""License scans on DataFrame functions only: MinHash bands over overlapping windows, then exact shingle containment.

A text is lower-cased, cut to words at anything but letters and digits, and hashed to shingles of five words. Windows of
16 and 64 shingles slide over it by half their length; of a window each band keeps one minhash, the least of its shingles
under one of BANDS permutations (an exclusive or with a constant, since shingles are hashes already). Windows of 4 shingles
have one band. A template has a window at every offset, of the largest length that is at most a half of its own, up to 64;
one of under eight shingles is retrieved by single shingles.

A text window of similarity s to a template's shares some band with it with chance 1 - (1 - s) ** BANDS. An occurrence
that holds 80 % of a template of 32 shingles or more has a window that holds as much on average, and so one of s of
0.8 / 1.2 or more: the chance is 0.9986 for that window alone. A template of fewer can only lose shingles near its ends,
since any change inside costs five, so some window of four is whole and found for sure. What the bands retrieve is
confirmed by the exact share of the template's shingles within the stretch of text that the windows align it to.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 6
#: Window lengths in shingles; each is four of the one before.
WINDOWS = (4, 16, 64)
#: The bands' table is broadcast up to so many rows (about 60 bytes each), and joined by a shuffle beyond.
BROADCAST_ROWS = 1_000_000

#: Short licenses and notices as their publishers word them. Longer ones are in the folder license_texts.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nd-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nc-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "bsd-3-clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "gpl-2.0-or-later-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0-or-later-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-2.1-or-later-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "agpl-3.0-or-later-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def known_templates() -> dict[str, str]:
    """TEMPLATES and the whole texts of longer licenses, by name."""
    folder = Path(__file__).parent / "license_texts"
    return TEMPLATES | {p.stem.lower(): p.read_text(encoding="utf-8") for p in sorted(folder.glob("*.txt"))}


def words(text: Column) -> Column:
    """Lower-cased words of letters and digits; null and wordless texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated a single time, however often use reads it inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingles(of: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of `size` words, in order; none if there are fewer words."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))
    return once(of, lambda w: F.when(F.size(w) >= size, runs(w)).otherwise(F.array().cast("array<bigint>")))


def template_table(spark: SparkSession, templates: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """license, h (its shingles in order), shingles (each once), m (how many), w (the length of its windows: 1, 4, 16 or 64).

    templates: rows (license, body) of any number, a dictionary, or the known ones. Those of under five words have no
    shingles and are refused.
    """
    if isinstance(templates, DataFrame):
        rows = templates.select("license", "body")
    else:
        rows = spark.createDataFrame(list((known_templates() if templates is None else templates).items()), "license string, body string")
    found = rows.select("license", shingles(words(F.col("body"))).alias("h")).withColumn("shingles", F.array_distinct("h")).withColumn("m", F.size("shingles"))
    lengths = F.when(F.col("m") < 8, 1)
    for w in reversed(WINDOWS):
        lengths = lengths.when(F.col("m") >= 2 * w, w)
    return found.select("license", "h", "shingles", F.when(F.col("m") > 0, F.col("m")).otherwise(F.raise_error(F.lit("a template needs five words"))).cast("int").alias("m"), lengths.otherwise(WINDOWS[0]).alias("w"))


def _salt(band: int) -> int:
    """A band's permutation; the upper bits differ from band to band, so that bands order shingles apart."""
    return ((band * 8191 + 4099) * 0x9E3779B97F4A7C15 + (band << 61) + (1 << 63)) % (1 << 64) - (1 << 63)


def _permuted(band: int) -> Callable[[Column], Column]:
    return lambda x: x.bitwiseXOR(F.lit(_salt(band)))


def _fours(start: Callable[[Column, int], Column]) -> Callable[[Column], Column]:
    """The least of four values that follow a place; those beyond the end are null and left out."""
    return lambda i: F.least(*(start(i, k) for k in range(4)))


def band_table(templates: DataFrame, bands: int = BANDS) -> DataFrame:
    """key, license, m, w, offset: the minhashes of all template windows, once for each stretch of w offsets."""
    offsets = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("h") - F.col("w")))
    rows = templates.select("license", "h", "m", "w", F.explode(offsets).alias("offset")).withColumn("window", F.slice("h", F.col("offset") + 1, F.col("w")))
    least = [F.array_min(F.transform("window", _permuted(band))) for band in range(bands)]
    keys = F.when(F.col("w") == 1, F.col("window")).when(F.col("w") == WINDOWS[0], F.array(least[0])).otherwise(F.array(*least))
    found = rows.select("license", "m", "w", "offset", F.explode(keys).alias("key"))
    return found.groupBy("key", "license", "m", "w", F.floor(F.col("offset") / F.col("w")).alias("stretch")).agg(F.min("offset").alias("offset")).drop("stretch")


def _of_band(h: Column, band: int) -> Column:
    """A band's keys: windows of 16 shingles and of 64, and for the first band those of 4 before them.

    Each is the least of four of the length before. At the text's end windows are shorter, so short texts have some too.
    """
    permuted = _permuted(band)
    fours = F.transform(F.sequence(F.lit(0), F.size(h) - 1, F.lit(4)), _fours(lambda i, k: permuted(F.get(h, i + k))))

    def all_lengths(of4: Column) -> Column:
        sixteens = F.transform(F.sequence(F.lit(0), F.size(of4) - 1, F.lit(2)), _fours(lambda i, k: F.get(of4, i + k)))
        sixtyfours = lambda of16: F.transform(F.sequence(F.lit(0), F.size(of16) - 1, F.lit(4)), _fours(lambda i, k: F.get(of16, i + 2 * k)))
        longer = once(sixteens, lambda of16: F.concat(of16, sixtyfours(of16)))
        return F.concat(of4, longer) if band == 0 else longer

    return once(fours, all_lengths)


def window_keys(h: Column, bands: int = BANDS) -> Column:
    """The keys of all windows of a text that has shingles: the shingles themselves, then those of each band."""
    return F.concat(h, *(_of_band(h, band) for band in range(bands)))


def _start(place: Column, n: Column) -> Column:
    """Where the window begins whose key lies at a place of window_keys() of a text of n shingles."""
    fours = F.ceil(n / 4).cast("int")
    sixteens = F.ceil(fours / 2).cast("int")
    k = (place - n - fours) % (sixteens + F.ceil(sixteens / 4).cast("int"))
    return F.when(place < n, place).when(place < n + fours, (place - n) * 4).when(k < sixteens, k * 8).otherwise((k - sixteens) * 32)


def scan(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, containment: float = CONTAINMENT, bands: int = BANDS) -> DataFrame:
    """Licenses found in docs (doc_id, text): doc_id, license, containment, first_shingle, n_windows.

    One row per doc_id and license; containment is the largest share of the template's shingles that a stretch of the text
    holds to which windows align it, first_shingle where the first such stretch that has enough begins (from 0), n_windows
    how many band hits led there. A stretch is as long as the template, with margins of half of it at most. Documents
    without a license have no row; null and empty texts have none; rows that share an id are reported together.

    The bands' table is broadcast up to a checked size and joined by a shuffle beyond. Candidates are counted by document, license and alignment before they
    are shuffled, and are a written table; texts meet them by doc_id, whatever way Spark finds best for its size.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    table = stage(band_table(known, bands), "bands")
    if table.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    # the explode of a one-element array makes h a stored column, which later steps read in place of computing it again
    texts = docs.select("doc_id", F.explode(F.array(shingles(words(F.col("text"))))).alias("h")).where(F.size("h") > 0)
    keys = texts.select("doc_id", F.size("h").alias("n"), F.posexplode(window_keys(F.col("h"), bands)).alias("place", "key"))
    met = keys.join(table, "key")
    step = F.greatest(F.lit(1), F.floor(F.col("m") / 4)).cast("int")
    bucket = F.floor((_start(F.col("place"), F.col("n")) - F.col("offset")) / step).cast("int")
    candidates = met.groupBy("doc_id", "license", "m", "w", bucket.alias("bucket")).agg(F.count("*").alias("hits"))
    lists = candidates.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.struct("license", "m", "w", "bucket", "hits")).alias("found"))
    lists = stage(lists, "candidates")
    again = docs.select("doc_id", "text").join(lists, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", F.explode(F.array(shingles(words(F.col("text"))))).alias("h"), "found")
    each = again.select("doc_id", "h", F.explode("found").alias("c")).join(known.select("license", "shingles"), F.col("c.license") == F.col("license"))
    step = F.greatest(F.lit(1), F.floor(F.col("c.m") / 4)).cast("int")
    margin = F.least(step + F.col("c.w"), step * 2)
    low = F.greatest(F.lit(0), F.col("c.bucket") * step - margin)
    high = (F.col("c.bucket") + 1) * step + F.col("c.m") + margin
    region = F.slice("h", low + 1, F.greatest(F.lit(1), high - low))
    share = F.size(F.array_intersect("shingles", region)) / F.col("c.m")
    confirmed = each.select("doc_id", "license", share.alias("containment"), low.alias("start"), F.col("c.hits").alias("hits")).where(F.col("containment") >= containment)
    return confirmed.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min("start").cast("int").alias("first_shingle"), F.sum("hits").alias("n_windows"))
