"""Licence statements in documents: a trained paragraph classifier, confirmed by templates.

Every line with a letter is scored by a logistic regression over word one- and
two-grams: one class for each licence family, one for unknown licences, one for
other text.  Lines found side by side, of which the first does not end a
sentence, are one hard-wrapped paragraph, which is judged again as a whole.
Probabilities are calibrated by a temperature fitted on held-out rows; a family
that is not probable enough counts as unknown, and so does one whose templates
share too few words with the paragraph.

The classifier is trained on variations and parts of the templates below and on
other sentences, ``TRAINING_ROWS`` at most.  Everything runs on Spark ML and SQL
functions.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut

TRAINING_ROWS = 10_000
# Words and word pairs are features if so many training rows hold them; others say nothing.
FEATURES, LEAST_ROWS = 1 << 13, 4
# A licence is at least so many times as probable as other text.
LEAST_ODDS = 1.5
LEAST_PROBABILITY = 0.5
# Words that paragraph and template share, out of the template's words.
LEAST_OVERLAP = 0.6
# A line with so large a share is a statement of its own, not a part of one.
WHOLE_OVERLAP = 0.9

OTHER, UNKNOWN = "none", "unknown"

# Usual wordings of licence statements, by family.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "This software is distributed under the Apache License 2.0"),
    "MIT": ("Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT", "This project is MIT licensed",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "BSD": ("Licensed under the BSD 3-Clause License", "Released under the BSD License",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "GPL": ("This work is licensed under the GNU General Public License, version 3", "Released under the GNU GPL v2 or later",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    "LGPL": ("Licensed under the GNU Lesser General Public License, version 2.1", "Released under the LGPL v3",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    "AGPL": ("Licensed under the GNU Affero General Public License, version 3", "Released under the AGPL-3.0"),
    "MPL": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0"),
    "CC-BY": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
              "This work is available under Creative Commons Attribution 4.0"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
                 "Text is available under the Creative Commons Attribution-ShareAlike License"),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND": ("Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "Public domain": ("Released into the public domain", "This work is dedicated to the public domain under CC0 1.0 Universal",
                      "This is free and unencumbered software released into the public domain",
                      "This text is in the public domain"),
    "All rights reserved": ("All rights reserved", "Copyright 2020 by the author. All rights reserved", "No part of this publication may be reproduced without prior written permission",
                            "Alle Rechte vorbehalten", "Tous droits réservés", "Todos los derechos reservados"),
}
# Short names of the families, and how sources name a licence in few words.
SHORT = {"Apache-2.0": ("Apache 2.0", "Apache License"), "MIT": ("MIT", "MIT License"), "BSD": ("BSD", "BSD 2-Clause"), "GPL": ("GPL", "GNU GPL v3", "GPLv3"),
         "LGPL": ("LGPL", "GNU LGPL"), "AGPL": ("AGPL", "GNU AGPL"), "MPL": ("MPL 2.0", "Mozilla Public License"), "CC-BY": ("CC BY", "Creative Commons Attribution"),
         "CC-BY-SA": ("CC BY-SA", "Creative Commons Attribution-ShareAlike"), "CC-BY-NC": ("CC BY-NC", "Creative Commons Attribution-NonCommercial"),
         "CC-BY-ND": ("CC BY-ND", "Creative Commons Attribution-NoDerivatives"), "Public domain": ("CC0", "public domain"), UNKNOWN: ("Creative Commons", "open source")}
NOTICES = ("License: {}", "Available under {}", "Released under {}", "The code is under {}", "{} licensed software", "This program is {} software", "Lizenz: {}", "Steht unter {}", "Freigegeben unter der Lizenz {}",
           "Licence : {}", "Publié sous {}", "Licencia: {}", "Publicado bajo {}", "Disponible bajo la licencia {}")
UNKNOWN_LICENSES = (
    "Licensed under the {} License", "Released under the {} Public License, version {}", "This work is licensed under the terms of the {} licence",
    "Use of this material is subject to the {} license agreement", "Distributed under the {} License; see the file LICENSE for details",
    "Commercial use of {} requires a license from the author", "Free for personal and non-commercial use only, see {}", "The code of {} is licensed, see LICENSE for details",
    "The copyright of {} is held by its authors; it may not be copied or reproduced without permission", "Dual licensed under {} and another licence",
    "Reproduction only with the written permission of the rights holder {}", "Toute utilisation sans autorisation de {} est interdite",
    "Toute reproduction, même partielle, est interdite sans accord de {}", "Prohibida la copia total o parcial sin autorización de {}",
    "The content of {} is protected by copyright and may not be copied", "Die Rechte an diesem Text liegen bei {}", "Nachdruck, auch in Teilen, nur mit Genehmigung von {}",
    "Queda prohibida toda copia de {}", "Licensed under the {} Open License", "See {} for the terms of use", "By using this file you accept the terms and conditions of {}", "You may copy and redistribute this work under the conditions of the {} agreement",
    "Dieses Werk steht unter der {} Lizenz", "Veröffentlicht unter der Lizenz {} in der Version {}", "Nachdruck und Weitergabe nur mit Genehmigung von {}",
    "Ce document est publié sous la licence {}", "Sous licence {} version {}", "Reproduction interdite sans autorisation de {}",
    "Esta obra está bajo la licencia {}", "Publicado con licencia {} versión {}", "Prohibida la reproducción sin permiso de {}")
OTHER_TEXT = (
    "She was licensed to fly at the age of {}", "He lost his driving licence after the {}", "Human rights groups criticised the {}",
    "They asked for permission to leave the {}", "The warranty covers the {} for two years", "The {} has the film rights to the novel",
    "The warrant was issued by the court in {}", "Nobody is permitted to enter the {}", "The bill would redistribute land to the {}",
    "The copyright dispute about the {} went on for years", "Civil rights were discussed at the {}", "A licensed doctor must sign the {}",
    "The old {} was no longer in the public domain of the town", "Fishing in the {} requires a licence",
    "The software was sold to {} schools", "The first version of the {} was released in May", "The film was released under the name of {}",
    "The work of {} is available in the library", "The general public was invited to the {}", "You can obtain a copy of the {} at the desk",
    "You may use the {} without a key", "The conditions in the {} were bad", "Attribution of the painting to {} is common among creative people",
    "The use of the {} is subject to the weather", "A free {} was distributed to everybody", "All members of the {} reserved a table",
    "Die Rechte der Frauen wurden in {} erkämpft", "Er verlor den Schein nach der Fahrt unter der {}", "Das Werk steht unter der Leitung von {}",
    "Les droits de la femme ont été défendus à {}", "Le document a été publié sous le nom de {}", "Il a obtenu une licence de lettres à {}",
    "Los derechos de las mujeres en {}", "La obra está bajo el puente de {}", "Tiene una licencia de pesca en {}")
# Words of ordinary text, and words that licences share with it.
COMMON = {
    "en": "the of and to in a is that it was for on with as be at by this from are an or not which you may any see all under without use".split(),
    "de": "der die das und in zu den mit von auf ist für nicht ein eine sich dem des im an auch als nach bei aus unter alle ohne nur".split(),
    "fr": "le la les de des et à en un une que qui dans pour sur au par est pas avec il ce se sous tous sans sa du".split(),
    "es": "el la los las de del y en a un una que por con para se no su al es lo como más bajo todos sin está".split(),
}
SHARED = ("rights licence license permission warranty copyright permitted cc0 terms conditions software version public free file work international general copy "
          "Rechte Lizenz Genehmigung Werk droits licence autorisation document derechos licencia permiso obra by sa nc nd").split()
NAMES = "Larkspur Quill Tamarind Ember Sable Juniper Mosaic Harbor Cobalt Thistle Meridian Falcon Willow Granite Orchid Lantern".split()
SYLLABLES = "an be co da el fi go ha in ju ka le mo ni or pa que ri sa te un vo wa xi yo zu ler ton mar sen vil dor tion the for".split()
FILLER = "the project this file document and its data for more details see below text author page".split()


def training_rows(seed: int = 11) -> list[tuple[str, str, bool]]:
    """(text, family, held out): variations of templates and of other sentences."""
    r = random.Random(seed)

    def varied(text: str) -> str:
        words = text.split()
        if len(words) > 5 and r.random() < 0.35:
            del words[r.randrange(len(words))]
        if r.random() < 0.35:
            words = [r.choice(FILLER) for _ in range(r.randint(1, 4))] + words
        if r.random() < 0.35:
            words += [r.choice(FILLER) for _ in range(r.randint(1, 4))]
        text = " ".join(words)
        return text + "." if r.random() < 0.5 else text

    def wrapped(text: str) -> list[str]:
        """The lines of a long text, broken at different widths."""
        words, out = text.split(), []
        for n in (range(7, 13) if len(words) > 13 else ()):
            out += [" ".join(words[i:i + n]) for i in range(0, len(words) - 5, n)]
        return out

    rows = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            rows += [(varied(text), family) for _ in range(40)]
            rows += [(part, family) for part in wrapped(text)]
    for family, names in SHORT.items():
        rows += [(varied(text.format(name)), family) for name in names for text in NOTICES for _ in range(4)]
    for text in UNKNOWN_LICENSES:
        rows += [(varied(text.format(r.choice(NAMES), r.randint(1, 9))), UNKNOWN) for _ in range(50)]
    for text in OTHER_TEXT:
        rows += [(varied(text.format(r.choice(NAMES).lower())), OTHER) for _ in range(40)]
    def invented() -> str:
        if r.random() < 0.05:
            return "".join(r.choice("0123456789abcdef") for _ in range(r.randint(8, 40)))
        return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))

    # Ordinary text of any length, some of it with a word that licences use.
    for n in (2, 5, 10, 20, 40, 80, 160, 320, 640, 1280, 2560):
        for i in range(max(12, min(450, 48_000 // n))):
            usual, share = COMMON[r.choice(list(COMMON))], r.choice([0.0, 0.3, 0.6])
            words = [r.choice(usual) if r.random() < share else invented() for _ in range(n)]
            if i % 2:
                for _ in range(1 + n // 40):
                    words[r.randrange(n)] = r.choice(SHARED)
            rows.append((" ".join(words), OTHER))
    r.shuffle(rows)
    return [(t, f, i % 5 == 0) for i, (t, f) in enumerate(rows[:TRAINING_ROWS])]


def classes() -> list[str]:
    return [OTHER, UNKNOWN, *TEMPLATES]


class Classifier:
    """The fitted pipeline and its temperature."""

    def __init__(self, model: PipelineModel, temperature: float) -> None:
        self.model, self.temperature = model, temperature

    def best(self, rows: DataFrame, text: str) -> DataFrame:
        """Adds ``first``, the most probable licence class of ``text`` or that of other text, and its calibrated ``probability``."""
        raw = F.col("__scores")
        licences = F.slice(raw, 2, len(classes()) - 1)
        top, other = F.array_max(licences), raw[0]
        total = F.aggregate(raw, F.lit(0.0), lambda a, v: a + F.exp((v - F.greatest(top, other)) / self.temperature))
        named = F.element_at(F.array(*[F.lit(c) for c in classes()[1:]]), F.array_position(licences, top).cast("int"))
        first = F.when(top - other >= self.temperature * math.log(LEAST_ODDS), named).otherwise(F.lit(OTHER))
        own = F.when(first == OTHER, other).otherwise(top)
        probability = F.exp((own - F.greatest(top, other)) / self.temperature) / total
        scored = self.model.transform(rows.withColumn("__line", F.col(text))).select(*rows.columns, vector_to_array("__raw").alias("__scores"))
        # Exploded, so that a filter on the class is not pushed below and the scores are not computed once for each mention.
        return (scored.select(*rows.columns, F.explode(F.array(F.struct(first.alias("first"), probability.alias("probability")))).alias("__best"))
                .select(*rows.columns, "__best.first", "__best.probability"))


def train(spark: SparkSession) -> Classifier:
    names = classes()
    # A literal that Spark parses: a table made from Python rows would start Python workers.
    text = json.dumps([{"__line": t, "__label": float(names.index(f)), "held": h} for t, f, h in training_rows()])
    rows = cut(spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<__line string, __label double, held boolean>>"))).coalesce(1))
    stages = [
        RegexTokenizer(inputCol="__line", outputCol="__words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        NGram(n=2, inputCol="__words", outputCol="__pairs"),
        CountVectorizer(inputCol="__words", outputCol="__f1", vocabSize=FEATURES, minDF=LEAST_ROWS, binary=True),
        CountVectorizer(inputCol="__pairs", outputCol="__f2", vocabSize=FEATURES, minDF=LEAST_ROWS, binary=True),
        VectorAssembler(inputCols=["__f1", "__f2"], outputCol="__features"),
        LogisticRegression(featuresCol="__features", labelCol="__label", rawPredictionCol="__raw", probabilityCol="__p", predictionCol="__pred",
                           family="multinomial", regParam=1e-3, maxIter=40),
    ]
    model = Pipeline(stages=stages).fit(rows.where("NOT held"))
    # The held-out rows are a fifth of the bounded training rows.
    held = [(list(r["raw"]), int(r["__label"])) for r in model.transform(rows.where("held")).select(vector_to_array("__raw").alias("raw"), "__label").collect()]

    def loss(temperature: float) -> float:
        total = 0.0
        for raw, label in held:
            z = [v / temperature for v in raw]
            top = max(z)
            total += math.log(sum(math.exp(v - top) for v in z)) + top - z[label]
        return total
    return Classifier(model, min((0.05 * 1.15 ** i for i in range(36)), key=loss))


def words_of(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def overlap(family: Column, words: Column) -> Column:
    """The largest share of a template's words that the paragraph holds, over the templates and short names of its family."""
    def share(template: str) -> Column:
        own = words_of(F.lit(template))
        return F.size(F.array_intersect(own, words)) / F.size(own)

    best = F.lit(0.0)
    for name, texts in TEMPLATES.items():
        best = F.when(family == name, F.greatest(*[share(t) for t in (*texts, *SHORT.get(name, ()))], F.lit(0.0))).otherwise(best)
    return best


def judged(rows: DataFrame, classifier: Classifier, text: str) -> DataFrame:
    """``rows`` with the first class of their text, its probability and overlap, and the family if that is sure."""
    return (classifier.best(rows, text)
            .withColumn("overlap", F.when(F.col("first") != OTHER, overlap(F.col("first"), words_of(F.col(text)))).otherwise(0.0))
            .withColumn("sure", (F.col("probability") >= LEAST_PROBABILITY) & (F.col("overlap") >= LEAST_OVERLAP))
            .withColumn("family", F.when(F.col("sure"), F.col("first")).otherwise(F.lit(UNKNOWN))))


def license_scan(docs: DataFrame, classifier: Classifier | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each licence paragraph: doc_id, paragraph (number of its first line, from 0), n_lines, family,
    probability (calibrated), overlap (with the family's nearest template), paragraph_text (lines joined by a space).

    ``family`` is "unknown" for a licence of no known family.  Neighbouring
    lines found, and one line between two found, are one paragraph unless a line
    before the last ends a sentence, two are whole statements of different families,
    or all together are no licence's.  Null and empty texts have
    no paragraphs; null ids are kept; repeated rows give equal rows; of equally
    probable classes the first of ``classes()`` counts; lines of any length are
    read whole; an empty table gives an empty result.  Other columns are ignored.
    """
    classifier = classifier or train(docs.sparkSession)
    lines = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
             .select("doc_id", F.sha2("text", 256).alias("key"), F.split("text", "\n", -1).alias("lines"))
             .select("doc_id", "key", F.posexplode(F.arrays_zip("lines", F.slice("lines", 2, F.size("lines")).alias("after"))).alias("line", "l"))
             .select("doc_id", "key", "line", F.col("l.lines").alias("line_text"), F.col("l.after").alias("after"))
             .where(F.col("line_text").rlike(r"\p{L}")))
    result = ["family", "probability", "overlap"]
    # The lines found in one text, once for all of its copies.
    own = F.struct("line", "line_text", "after", *result, "sure")
    by_text = (judged(lines, classifier, "line_text").where(F.col("first") != OTHER).groupBy("doc_id", "key").agg(F.collect_set(own).alias("own"), F.count("*").alias("n"))
               .select("doc_id", "key", (F.col("n") / F.size("own")).cast("int").alias("copies"), F.explode("own").alias("own"))
               .select("doc_id", "key", "copies", "own.line", "own"))
    by = Window.partitionBy("doc_id", "key").orderBy("line")
    last, ends = F.lag("own").over(by), r"[.!?:;]\s*$|^\s*$"
    goes_on = ~last["line_text"].rlike(ends) & ((last["line"] + 1 == F.col("line")) | (last["line"] + 2 == F.col("line")) & ~last["after"].rlike(ends))
    runs = (by_text.withColumn("new", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("run", F.sum("new").over(by))
            .groupBy("doc_id", "key", "copies", "run").agg(F.sort_array(F.collect_list("own")).alias("own")))
    first, final = F.col("own")[0]["line"], F.element_at("own", -1)["line"]
    # A line between two that were found belongs to them.
    with_gaps = F.transform("own", lambda x: F.when((x["line"] < final) & ~F.exists("own", lambda y: y["line"] == x["line"] + 1),
                                                    F.concat_ws(" ", x["line_text"], x["after"])).otherwise(x["line_text"]))
    # Judged once more as a whole; lines that are no licence together stay as they are.
    whole = judged(runs.withColumn("text", F.array_join(with_gaps, " ")), classifier, "text")
    families = F.size(F.array_distinct(F.transform(F.filter("own", lambda x: x["sure"] & (x["overlap"] >= WHOLE_OVERLAP)), lambda x: x["family"])))

    def statement(x: Column) -> Column:
        return F.struct(x["line"].alias("paragraph"), F.lit(1).alias("n_lines"), *[x[c].alias(c) for c in result], x["line_text"].alias("paragraph_text"))
    joined = F.struct(first.alias("paragraph"), (final - first + 1).alias("n_lines"), *result, F.col("text").alias("paragraph_text"))
    return (whole.withColumn("out", F.when((families <= 1) & (F.col("first") != OTHER), F.array(joined)).otherwise(F.transform("own", statement)))
            .select("doc_id", "copies", F.explode("out").alias("out"))
            .select("doc_id", "out.*", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy"))
