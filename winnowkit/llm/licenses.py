"""License scans by sparse TF-IDF cosine, with DataFrame operations only.

Parts of each text are compared with templates: full licence texts (``license_texts``) and the
forms in which headers, titles and notices name a license. The parts are the whole text, its
header (the comment lines that it begins with), its blocks (what lies between lines that are empty but for a
comment sign) and its single lines. Terms are weighted by their document frequency in the whole corpus; a term that
no template has weighs as much as one that no document has. The best part of a text decides, if
its cosine is ``min_score`` or more; a form counts only where the words that name its license stand in the part
too, for forms of different licenses may differ in those alone. A text that finds no license of its own takes that of the
nearest ancestor directory (its own first) whose licence file has one, by equi-joins on
directory paths.

Most parts needn't be compared, and which is decided without a loss: of each template the rarest
terms are set aside until the others' weights have a norm under ``min_score``. A part with none
of the terms set aside has a cosine under that norm, whatever else it says. Only parts that have
one go to a table in the shared folder and are taken apart.

The texts are read twice, for the frequencies and for the parts, and never shuffled. Only the
templates and the frequencies of their terms, whose number the templates bound, are collected or
broadcast. Directories are resolved once each, not once a file.

Defined results: a null or empty text has no license of its own. A null path inherits nothing. Of
several licence files in a directory the first by path, then by license name, counts. Equal scores go
to the alphabetically first license. Repeated rows and equal keys are rows of their own. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import settle
from .textnorm import lower_ascii

#: The words of a form without which it isn't about that license.
NAMES = [
    "affero", "apache", "boost", "bsd", "bsd-style", "by", "by-nc", "by-sa", "cc", "cc0", "creative", "eclipse", "gnu", "isc", "lesser", "mit", "mit-style", "mozilla", "unlicense", "zlib",
]
#: The forms in which headers, titles and notices name a license.
FORMS = {
    "AGPL-3.0": [
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "GNU Affero General Public License, version 3", "This work is licensed under the GNU Affero General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Apache License, Version 2.0", "Apache License 2.0", "Licensed under the Apache License, Version 2.0", "Released under the Apache License 2.0",
        "Use of this source code is governed by the Apache 2.0 license that can be found in the LICENSE file.", "Licensed under the Apache License 2.0. See LICENSE file in the project root for full license information.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "Licensed under the BSD 2-Clause License", "Redistribution and use are permitted under the BSD 2-Clause License"],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "Licensed under the BSD 3-Clause License", "Redistribution and use are permitted under the BSD 3-Clause License",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "Distributed under the Boost Software License, Version 1.0.", "Use, modification and distribution are subject to the Boost Software License, Version 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal Public Domain Dedication"],
    "EPL-2.0": [
        "Eclipse Public License - v 2.0", "Eclipse Public License, version 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0",
    ],
    "GPL-2.0": [
        "GNU General Public License, version 2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "GNU General Public License, version 3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "This file is licensed under the GNU General Public License, version 3 only.",
    ],
    "ISC": ["ISC License", "Licensed under the ISC License"],
    "LGPL-2.1": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "This work is licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This work is licensed under the GNU Lesser General Public License, version 3",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "MIT License", "Released under the MIT License", "Licensed under the MIT License", "Licensed under the MIT license. See LICENSE file in the project root for full license information.",
        "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.", "Use of this source code is governed by the MIT license that can be found in the LICENSE file.",
    ],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["The Unlicense", "This is free and unencumbered software released into the public domain"],
    "Zlib": ["zlib License", "Licensed under the zlib License", "Released under the zlib license"],
}
TERM = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
COMMENT = r"^[ \t\r]*(//|#|/?\*|--|;|%|<!--|\"\"\"|\z)"
#: Also lines of a comment sign alone.
EMPTY_LINES = r"\n[ \t\r]*(?:/?\*+/?|//+|#+|--+|;+|%+)?[ \t\r]*\n"
MIN_SCORE = 0.75
LICENSE_FILES = r"(^|/)(LICENSE|LICENCE|COPYING)(\.[a-z]+)?$"


def templates() -> list[tuple[str, str]]:
    """(license, text) of every template: full texts, forms, and SPDX lines."""
    full = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    forms = [(name, form) for name, listed in FORMS.items() for form in listed]
    spdx = [(name, f"SPDX-License-Identifier: {name}{kind}") for name in FORMS for kind in (("", "-only", "-or-later") if "GPL" in name else ("",))]
    return sorted(full + forms + spdx)


def needed(template: tuple[str, str]) -> list[str]:
    """Terms that a part must have to be compared with a form or an SPDX line: those that name the license. A full text needs none."""
    name, text = template
    if text not in FORMS.get(name, ()) and not text.startswith("SPDX-"):
        return []
    return sorted({t for t in re.findall(TERM, text.lower()) if t in NAMES or t.startswith(name.lower())})


def terms(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(TERM), F.lit(0))


def parts(text: Column) -> Column:
    """array<string>, distinct: the whole text, its header, its blocks, its lines."""
    lines = F.split(text, "\n")
    code = F.array_position(F.transform(lines, lambda x: F.rlike(x, F.lit(COMMENT))), False).cast("int")
    header = F.array_join(F.slice(lines, F.lit(1), F.greatest(code - 1, F.lit(0))), "\n")
    blocks = F.split(text, EMPTY_LINES)
    return F.array_distinct(F.concat(F.array(text, header), blocks, lines))


def parent(path: Column) -> Column:
    """The directory of a path; '' at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """array<struct<dir, up>>: the directory itself, then each one above it, '' last."""
    names = F.filter(F.split(directory, "/"), lambda p: p != "")
    ups = F.sequence(F.lit(0), F.size(names))
    return F.transform(
        ups, lambda u: F.struct(F.array_join(F.slice(names, F.lit(1), F.size(names) - u), "/").alias("dir"), u.alias("up"))
    )


def template_weights(listed: list[tuple[str, str]], frequency: dict[str, int], total: int) -> tuple[list[Counter], dict[str, float], float]:
    """Unit vectors of the templates, the weight of each of their terms, and that of any other term."""
    weigh = lambda df: math.log((total + 1) / (df + 1)) + 1
    counted = [Counter(re.findall(TERM, text.lower())) for _, text in listed]
    idf = {t: weigh(frequency.get(t, 0)) for c in counted for t in c}
    unit = []
    for c in counted:
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        unit.append(Counter({t: n * idf[t] / norm for t, n in c.items()}))
    return unit, idf, weigh(0)


def telling_terms(unit: list[Counter], idf: dict[str, float], min_score: float) -> list[str]:
    """Terms of which a part must have one to reach ``min_score`` with any template: the rarest of each."""
    found = set()
    for vector in unit:
        rest = sum(w * w for w in vector.values())
        for t in sorted(vector, key=lambda t: (-idf[t], t)):
            if rest < (min_score * 0.999) ** 2:
                break
            found.add(t)
            rest -= vector[t] ** 2
    return sorted(found)


def own_licenses(files: DataFrame, carry: dict[str, Column], text: str, listed: list[tuple[str, str]], min_score: float) -> DataFrame:
    """``carry``, own and own_score: the license that each text names itself, null if none. Settled."""
    spark = files.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    vocabulary = sorted({t for _, x in listed for t in re.findall(TERM, x.lower())} | {""})
    known = F.broadcast(spark.createDataFrame([(t,) for t in vocabulary], "term string"))
    # '' stands in every row, so the same pass counts the rows.
    seen = files.select(F.explode(F.concat(F.array_distinct(terms(whole)), F.array(F.lit("")))).alias("term")).join(known, "term")
    frequency = {r["term"]: r["n"] for r in seen.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a template term
    unit, idf, other = template_weights(listed, frequency, frequency.pop("", 0))
    telling = F.split(F.lit(" ".join(telling_terms(unit, idf, min_score))), " ")

    likely = F.filter(parts(F.col("t")), lambda x: F.arrays_overlap(terms(x), telling))
    read = files.select(*[c.alias(n) for n, c in carry.items()], F.monotonically_increasing_id().alias("row"), whole.alias("t"))
    likely = F.when(F.arrays_overlap(terms(F.col("t")), telling), likely).otherwise(F.array().cast("array<string>"))
    read = settle(read.select(*carry, "row", likely.alias("parts")), "license-parts")

    weights = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))
    names = [needed(x) for x in listed]
    rows = [(t, i, listed[i][0], w, int(t in names[i]), len(names[i])) for i, vector in enumerate(unit) for t, w in sorted(vector.items())]
    vectors = F.broadcast(spark.createDataFrame(rows, "term string, template int, license string, tw double, needed int, of int"))
    each = read.where(F.size("parts") > 0).select("row", F.posexplode("parts").alias("part", "x"))
    counted = each.select("row", "part", F.explode(terms(F.col("x"))).alias("term")).groupBy("row", "part", "term").agg(F.count(F.lit(1)).alias("tf"))
    valued = settle(counted.join(weights, "term", "left").select("row", "part", "term", (F.col("tf") * F.coalesce("idf", F.lit(other))).alias("w")), "license-terms")
    norms = valued.groupBy("row", "part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = valued.join(vectors, "term").groupBy("row", "part", "template", "license", "of").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.sum("needed").alias("has")).where("has = of")
    scored = dots.join(norms, ["row", "part"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= min_score)
    best = scored.groupBy(F.col("row").alias("hit")).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("l"))).alias("b"))
    best = best.select("hit", F.col("b.l").alias("own"), (-F.col("b.s")).alias("own_score"))
    return settle(read.drop("parts").join(best, F.col("row") == F.col("hit"), "left").drop("hit", "row"), "licensed")


def scan(files: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text", listed: list[tuple[str, str]] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """One row a file: (key, license, origin, levels_up, score); origin is own, inherited or none."""
    carry = {"k": F.col(key), "path": F.col(path), "dir": parent(F.col(path))}
    found = own_licenses(files, carry, text, listed or templates(), min_score)
    licence_dirs = (
        found.where(F.col("own").isNotNull() & F.rlike(F.col("path"), F.lit(LICENSE_FILES)))
        .groupBy(F.col("dir").alias("at"))
        .agg(F.min(F.struct("path", "own", "own_score")).alias("f"))
    )
    dirs = found.where(F.col("own").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    up = dirs.select("dir", F.explode(ancestors(F.col("dir"))).alias("a")).select("dir", "a.dir", "a.up").toDF("dir", "above", "up")
    inherited = (
        up.join(licence_dirs, F.col("above") == F.col("at"))
        .groupBy(F.col("dir").alias("of"))
        .agg(F.min(F.struct("up", "f.own", "f.own_score")).alias("i"))
    )
    out = found.join(settle(inherited, "inherited"), (F.col("dir") == F.col("of")) & F.col("own").isNull(), "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("i").isNotNull(), "inherited").otherwise("none")
    return out.select(
        F.col("k").alias(key), F.coalesce("own", "i.own").alias("license"), origin.alias("origin"),
        F.col("i.up").cast("bigint").alias("levels_up"), F.coalesce("own_score", "i.own_score").alias("score"),
    )
