"""License scans: MinHash bands over text windows retrieve templates, exact shingle
containment verifies them.

A document is cut into windows twice as long as a template and overlapping by half, so
that every copy lies whole in one of them; templates of similar length share windows.
Windows and templates that agree on a band (one minimum hash) are compared on their sets
of shingles. The number of bands follows from the smallest resemblance that a window with
the wanted containment can have, and from the chance of missing it that is allowed.

Only shingles that occur in some template can count. A bit set of bounded size picks them
out while the text is read, so what is shuffled are these shingles and not the texts;
windows without any hold no template. Windows bound every group.

Null text is empty and matches nothing; templates of fewer than five tokens are one
shingle of their own length; templates without tokens are left out. Null ids are reported
as null; repeated rows and repeated templates once. Other columns are not read."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odotrack.llm.common import BitSet, let, terms

SHINGLE = 5
MIN_PERCENT = 75
#: Chance that the bands miss a window with the wanted containment.
MISS = 1e-3

# Wording of public licenses and of the usual notices.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "MIT-notice": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version. This program is distributed in
        the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this
        program. If not, see https://www.gnu.org/licenses/.""",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MPL-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
}


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license_id string, text string")


def bands_for(similarity: float, miss: float = MISS) -> int:
    """Bands of one row that let a pair of this resemblance slip with chance ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-similarity)) if similarity < 1 else 1


def _least_similarity(percent: int) -> float:
    """Resemblance of a template of m shingles and a window of 2 * 2.5 m (see ``_level``)."""
    c = percent / 100
    return c / (5 + 1 - c)


def _level(n: Column) -> Column:
    """log2 of the stride: at least a quarter more than the template, for inserted words."""
    return F.ceil(F.log2(n * F.lit(1.25))).cast("int")


def _shingles(tokens: Column, lengths: list[int]) -> Column:
    """array<struct<at, n, shingle>> of all runs of the given lengths."""

    def at_position(at: Column) -> Column:
        return F.array(
            *(
                F.struct(
                    at.alias("at"),
                    F.lit(n).alias("n"),
                    F.when(
                        at + n <= F.size(tokens),
                        F.xxhash64(F.lit(n), *(F.get(tokens, at + i) for i in range(n))),
                    ).alias("shingle"),
                )
                for n in lengths
            )
        )

    places = F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.flatten(F.transform(places, at_position))


def _hasher(k: int) -> Callable[[Column], Column]:
    return lambda shingle: F.xxhash64(F.lit(k), shingle)


def scan_licenses(
    docs: DataFrame, templates: DataFrame, min_percent: int = MIN_PERCENT, miss: float = MISS
) -> DataFrame:
    """(doc_id, text_hash, license_id, matched, of_template, position) of every template
    of (license_id, text) that a document of (doc_id, text) holds: shingles found in the
    best window, shingles of the template, and the token where that window's first begins."""
    split = templates.select("license_id", terms(F.col("text")).alias("tokens")).filter(F.size("tokens") > 0).distinct()
    short = split.filter(F.size("tokens") < SHINGLE).select(F.size("tokens").alias("n")).distinct()
    lengths = [*sorted(n for (n,) in short.collect()), SHINGLE]  # at most SHINGLE values
    known = (
        split.select(
            "license_id",
            F.array_distinct(
                F.transform(
                    F.filter(
                        _shingles(F.col("tokens"), lengths),
                        lambda x: x["shingle"].isNotNull() & (x["n"] == F.least(F.size("tokens"), F.lit(SHINGLE))),
                    ),
                    lambda x: x["shingle"],
                )
            ).alias("template"),
        )
        .withColumn("level", _level(F.size("template")))
    )
    levels = [n for (n,) in known.select("level").distinct().orderBy("level").collect()] or [0]  # about 20 at most
    n_shingles = known.agg(F.coalesce(F.sum(F.size("template")), F.lit(0))).first()[0]
    bits = BitSet(known.select(F.explode("template").alias("shingle")), "shingle", n_shingles)

    n_bands = bands_for(_least_similarity(min_percent), miss)
    found = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), terms(F.col("text")).alias("tokens")
    ).select(
        "doc_id",
        "text_hash",
        F.inline(
            F.filter(
                let(F.col("tokens"), lambda t: _shingles(t, lengths)),
                lambda x: F.coalesce(bits.may_hold(x["shingle"]), F.lit(False)),
            )
        ),
    )
    # The bit set lets a few strangers in: an exact look keeps the template shingles alone.
    found = found.join(known.select(F.explode("template").alias("shingle")).distinct(), "shingle", "left_semi")
    strides = F.array(*(F.struct(F.lit(n).alias("level"), F.lit(1 << n).alias("stride")) for n in levels))
    placed = found.select("*", F.inline(strides)).withColumn("window", F.floor(F.col("at") / F.col("stride")))
    windows = (
        placed.withColumn("window", F.explode(F.array("window", F.col("window") - 1)))
        .groupBy("doc_id", "text_hash", "level", "window")
        .agg(
            F.collect_set("shingle").alias("held"),
            F.min("at").alias("position"),
            *(F.min(_hasher(k)(F.col("shingle"))).alias(f"band{k}") for k in range(n_bands)),
        )
    )
    bands = F.array(*(F.struct(F.lit(k).alias("band"), F.col(f"band{k}").alias("least")) for k in range(n_bands)))
    template_bands = known.select(
        "license_id",
        "template",
        "level",
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(k).alias("band"),
                        F.array_min(F.transform("template", _hasher(k))).alias("least"),
                    )
                    for k in range(n_bands)
                )
            )
        ),
    )
    keys = ["doc_id", "text_hash", "level", "window", "license_id", "template"]
    retrieved = (
        windows.select("doc_id", "text_hash", "level", "window", "held", "position", F.inline(bands))
        .join(template_bands, ["level", "band", "least"])
        .groupBy(*keys)
        .agg(F.any_value("held").alias("held"), F.any_value("position").alias("position"))
    )
    matched = F.size(F.array_intersect("held", "template"))
    return (
        retrieved.withColumn("matched", matched)
        .filter(F.col("matched") * 100 >= F.size("template") * min_percent)
        .groupBy("doc_id", "text_hash", "license_id")
        .agg(F.max(F.struct("matched", F.size("template").alias("of_template"), (-F.col("position")).alias("at"))).alias("best"))
        .select(
            "doc_id",
            "text_hash",
            "license_id",
            F.col("best.matched").cast("long").alias("matched"),
            F.col("best.of_template").cast("long").alias("of_template"),
            (-F.col("best.at")).cast("long").alias("position"),
        )
    )
