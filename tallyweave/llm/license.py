"""License scans with DataFrame functions only on the main path: a sparse n-gram logistic regression names the family of a line or paragraph, with a calibrated unknown class; a statement of the family confirms it."""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import checkpointed, discard, lower_ascii, table
from tallyweave.llm.decontam import held

# Licence texts, headers and notices of each family. Each sentence is a statement of its own.
_AS_IS = "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."
_GNU_COPY = "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose."
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Released under the Apache 2.0 license.", "Apache License, Version 2.0, January 2004", "Available under the terms of the Apache license.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions. "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS + " In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.",
        "Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT", "The MIT License (MIT)", "Distributed under the terms of the MIT license.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. "
        "In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software.",
        "Licensed under the ISC license.", "SPDX-License-Identifier: ISC",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
        "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. "
        "In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages however caused and on any theory of liability.",
        "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-2-Clause", "SPDX-License-Identifier: BSD-3-Clause", "Released under the BSD license.",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. " + _GNU_COPY + " See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.",
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only", "Licensed under the GNU GPL, version 2.", "Released under the GPL.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation. You should have received a copy of the GNU Lesser General Public License along with this library.",
        "Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only", "Licensed under the LGPL.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation. You should have received a copy of the GNU Affero General Public License along with this program.",
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", "Licensed under the AGPL.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.",
        "SPDX-License-Identifier: Unlicense", "Released under the Unlicense.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions. "
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",
        "SPDX-License-Identifier: Zlib", "Licensed under the zlib license.",
    ],
    "OFL": ["This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and is also available with a FAQ.", "Licensed under the SIL Open Font License.", "SPDX-License-Identifier: OFL-1.1"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Available under the CC-BY 3.0 license."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal.", "Dedicated to the public domain under CC0.", "SPDX-License-Identifier: CC0-1.0"],
    "Proprietary": ["All rights reserved.", "Copyright 2024 Example Inc. All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.", "No part of this publication may be reproduced, stored or transmitted in any form without the prior written permission of the publisher."],
}
#: Paragraphs that speak of licences, rights and copies without granting anything, and plain words.
OTHERS = [
    "", "He lost his driving license and had to walk to work.", "The law protects the rights of workers in all states.", "Permission to enter the building is granted at the desk.", "The restaurant has a license to sell wine.",
    "A public hearing on the general plan was held in version two of the hall.", "The copyright debate went on for years in parliament.", "Free software is discussed at the conference.", "All seats are reserved for guests.", "The source of the river is under the mountain.",
    "She works at the MIT in Boston.", "The Apache people lived in the southwest.", "Creative people share work in common rooms.", "Attribution of the painting is unclear.", "The file was released under pressure.", "The warranty of the car is limited to two years.", "Use of the pool is subject to the rules of the house.",
    "It is the end of the day and all of this is for you, with or without any of that, if you can do so by the way.", "The author of the book was not held to be liable for any of it in the end.", "The form must be signed and the copy must be kept in the office.", "A notice of the court was published in the paper, as is the custom.", "No one was permitted to sell or to distribute the goods in the public market.",
]
WORD = re.compile(r"[a-z0-9]+")
#: Paragraphs end at lines without words.
BLANK = "\\r?\\n[ \\t\\r]*\\n"
#: What the classifier puts above unknown but holds less than LITTLE of any statement of its family calibrates the unknown class.
LITTLE = 0.25


def grams_of(text: str, upto: int = 3) -> list[str]:
    words = WORD.findall(text.lower())
    return list(dict.fromkeys(" ".join(words[i : i + n]) for n in range(1, upto + 1) for i in range(len(words) - n + 1)))


def statements(texts: list[str]) -> list[str]:
    """The sentences of these texts, each once."""
    found = [x for t in texts for x in re.split(r"(?<=[a-z\")])[.;] (?=[A-Z])", t)]
    return list(dict.fromkeys(found))


def variants(text: str) -> list[str]:
    """Statements as they stand in other texts: without every seventh word, without the first or the last third, after other words."""
    words = WORD.findall(text.lower())
    if len(words) < 9:
        return ["this text is " + " ".join(words) + " see below"]
    third = len(words) // 3
    return [" ".join(w for i, w in enumerate(words) if i % 7 != 5), " ".join(words[third:]), " ".join(words[:-third])]


@dataclass
class Model:
    """weights: n-gram to a weight for each family; bias likewise; both against the unknown class."""

    families: list[str]
    weights: dict[str, list[float]]
    bias: list[float]

    def scores(self, text: str) -> np.ndarray:
        return np.array(self.bias) + sum((np.array(self.weights[g]) for g in grams_of(text) if g in self.weights), np.zeros(len(self.bias)))


@functools.lru_cache(maxsize=2)
def train(steps: int = 400, ridge: float = 1e-3) -> Model:
    """Multinomial logistic regression over 1- to 3-grams of all statements, texts and OTHERS; each family weighs the same."""
    families = sorted(TEMPLATES)
    texts = [(grams_of(t), families.index(f)) for f in families for t in dict.fromkeys([*TEMPLATES[f], *statements(TEMPLATES[f])])] + [(grams_of(t), len(families)) for t in OTHERS]
    vocabulary = sorted({g for t, y in texts if y < len(families) for g in t})
    index = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(texts), len(vocabulary) + 1))
    for i, (t, _) in enumerate(texts):
        known = [index[g] for g in t if g in index]
        x[i, known] = 1
    x[:, -1] = 1
    y = np.array([c for _, c in texts])
    weight = 1 / np.maximum(1, np.bincount(y, minlength=len(families) + 1))[y]
    rate = 1 / np.maximum(1, x.sum(axis=1).mean() / 8)
    w = np.zeros((len(vocabulary) + 1, len(families) + 1))
    for _ in range(steps):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        w -= rate * 4.0 * (x.T @ (p * weight[:, None]) / len(families) + ridge * w)
    w -= w[:, -1:]
    return Model(families, {g: [round(float(v), 6) for v in w[i, :-1]] for g, i in index.items()}, [round(float(v), 6) for v in w[-1, :-1]])


def cues(model: Model, floor: float = 0.0) -> list[str]:
    """Words of which every text that scores over floor in any family has one; none if there are texts without.

    Each n-gram's positive weight goes to one of its words, so a text scores at most the bias and
    what its words hold. Words that together can't lift any family over floor are no cues.
    """
    holds: dict[str, np.ndarray] = {}
    for g, v in model.weights.items():
        word = max(g.split(), key=lambda a: (len(a), a))
        holds[word] = holds.get(word, 0) + np.maximum(v, 0)
    total, out = np.array(model.bias), []
    if (total > floor - 1e-6).any():
        return []
    for word in sorted(holds, key=lambda a: (holds[a].max(), a)):
        if (total + holds[word] <= floor - 1e-6).all():
            total = total + holds[word]
        else:
            out.append(word)
    return out


def calibrate(model: Model, others: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and shift of the probability that a score is a licence's: logistic regression of held-out variants of the statements against others, (score, how many) of paragraphs that are none, both sides weighing the same."""
    right = [float(model.scores(v)[model.families.index(f)]) for f, ts in TEMPLATES.items() for t in statements(ts) for v in variants(t)]
    wrong = [(float(model.scores(v).max()), 1) for t in OTHERS for v in variants(t)] + others
    z = np.array([*right, *(x for x, _ in wrong)])
    y = np.array([1.0] * len(right) + [0.0] * len(wrong))
    weight = np.array([1 / len(right)] * len(right) + [n / sum(m for _, m in wrong) for _, n in wrong])
    a, b = 1.0, -float(np.average(z, weights=weight))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        d, s = weight * (p - y), weight * p * (1 - p)
        step = np.linalg.solve(np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]]), np.array([(d * z).sum() + 1e-3 * (a - 1), d.sum()]))
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -2, 2))
    return max(a, 1e-3), b


def words_in(paragraph: Column) -> Column:
    return F.filter(F.split(lower_ascii(paragraph), "[^a-z0-9]+"), lambda w: w != "")


def known_grams(words: Column, model: Model) -> Column:
    """The n-grams of 1 to 3 words that the model knows, each once. All words of such an n-gram are known ones, so the others are passed over first."""
    single, every = sorted(g for g in model.weights if " " not in g), sorted(g for g in model.weights if " " in g)
    at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), lambda i: F.get(words, i).isin(single))
    pair = F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    three = F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.array_distinct(F.concat(F.transform(at, lambda i: F.get(words, i)), F.filter(F.concat(pair, three), lambda g: g.isin(every))))


def scored(texts: DataFrame, model: Model, floor: float = 0.0) -> DataFrame:
    """(id, paragraph, line, row, known, f0 ..., best): the lines, and the paragraphs of several lines (line null), of texts (id, text) that score over floor in any family."""
    n, words = len(model.families), cues(model, floor)
    cued = (lambda w: F.exists(w, lambda x: x.isin(words))) if words else (lambda w: F.lit(True))
    text = F.coalesce("text", F.lit(""))
    parts = texts.select("id", F.posexplode(F.split(text, BLANK)).alias("paragraph", "p")).select("id", "paragraph", "p", held(words_in(F.col("p")), "w")).where(cued(F.col("w")))
    one = F.struct(F.lit(0).alias("line"), F.col("w").alias("w"))
    lines = F.transform(F.split("p", "\n"), lambda x, i: F.struct(i.alias("line"), words_in(x).alias("w")))
    several = F.concat(F.array(F.struct(F.lit(None).cast("int").alias("line"), F.col("w").alias("w"))), lines)
    units = parts.select("id", "paragraph", F.explode(F.when(F.contains("p", F.lit("\n")), several).otherwise(F.array(one))).alias("u"))
    units = units.where(cued(F.col("u.w"))).select("id", "paragraph", "u.line", held(known_grams(F.col("u.w"), model), "known"), F.monotonically_increasing_id().alias("row"))
    weights = F.broadcast(texts.sparkSession.createDataFrame([(g, *v) for g, v in model.weights.items()], "g string, " + ", ".join(f"f{i} double" for i in range(n))))
    # Only the known n-grams are exploded and shuffled, never the words of a paragraph.
    out = units.select("id", "paragraph", "line", "row", F.explode("known").alias("g")).join(weights, "g").groupBy("id", "paragraph", "line", "row")
    out = out.agg(F.collect_list("g").alias("known"), *[(F.round(F.sum(f"f{i}"), 6) + F.lit(model.bias[i])).alias(f"f{i}") for i in range(n)])
    return out.withColumn("best", F.greatest(*[F.col(f"f{i}") for i in range(n)])).where(F.col("best") > floor)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(id_col, paragraph, line, family, probability, template, similarity, confirmed): where the classifier sees a licence family.

    Paragraphs end at blank lines and count from 0, lines count within their paragraph. Each line is
    judged by itself, and each paragraph of several lines as a whole (line null), so that wrapped
    notices are found; a whole paragraph gives no row if one of its lines confirms the same family.
    template is the family's statement of which most bigrams (words, for one word) stand there,
    similarity their share, confirmed whether that is least or more; probability is that of the family
    among all and the unknown class, whose score is calibrated on held-out variants of the statements
    and on all paragraphs of docs that hold little of any statement. What the classifier or the
    calibrated class calls unknown gives no row, like null and empty texts. Rows that repeat an id, and
    repeated texts, each give their rows; other columns don't reach the result; an empty table gives
    none. The model and the statements are constants of fixed size, so their tables are broadcast.
    """
    model = train()
    found = checkpointed(scored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model))
    n = len(model.families)
    family = F.coalesce(*[F.when(F.col(f"f{i}") == F.col("best"), F.lit(name)) for i, name in enumerate(model.families)])
    rows = [(f, t, [g for g in grams_of(t, 2) if " " in g] or grams_of(t, 1)) for f, ts in TEMPLATES.items() for t in statements(ts)]
    templates = F.broadcast(docs.sparkSession.createDataFrame(rows, "family string, template string, parts array<string>"))
    compared = found.withColumn("family", family).join(templates, "family").withColumn("similarity", F.size(F.array_intersect("parts", "known")) / F.size("parts"))
    among = sum((F.exp(F.col(f"f{i}") - F.col("best")) for i in range(n)), F.lit(0.0))
    top = compared.groupBy("id", "paragraph", "line", "row", "family", "best", among.alias("among")).agg(F.max(F.struct("similarity", "template")).alias("m"))
    top = checkpointed(top.select("id", "paragraph", "line", "row", "family", "best", "among", "m.similarity", "m.template"))
    little = top.where(F.col("similarity") < LITTLE).groupBy(F.round("best", 1).alias("score")).agg(F.count("*").alias("n"))
    a, b = calibrate(model, [(r["score"], r["n"]) for r in little.collect()])
    licence = 1 / (1 + F.exp(-(F.lit(a) * F.col("best") + F.lit(b))))
    named = top.withColumn("sure", licence).where(F.col("sure") >= 0.5).withColumn("confirmed", F.col("similarity") >= least)
    own = named.where("line is not null and confirmed").select("id", "paragraph", "family").distinct()
    whole = named.where("line is null").alias("w").join(own.alias("o"), F.col("w.id").eqNullSafe(F.col("o.id")) & (F.col("w.paragraph") == F.col("o.paragraph")) & (F.col("w.family") == F.col("o.family")), "left_anti")
    out = named.where("line is not null").unionByName(whole)
    out = checkpointed(out.select(F.col("id").alias(id_col), "paragraph", "line", "family", (F.col("sure") / F.col("among")).alias("probability"), "template", "similarity", "confirmed"))
    discard(found, top)
    return out


def op8_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
