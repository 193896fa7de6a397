import pytest
from llm.helpers import DOCUMENTS, PROSE, awkward, none

from clientgrain.llm import license_scan as s


@pytest.fixture(scope="module")
def classifier(spark):
    return s.train(spark)


def found(df):
    return sorted((r.doc_id, r.paragraph, r.family) for r in df.collect())


def test_statements_are_named(spark, classifier):
    lines = [("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Released under the MIT License.", "MIT"), ("All rights reserved.", "All rights reserved"),
             ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"), ("This work is licensed under the GNU General Public License, version 3.", "GPL"),
             ("Licensed under the Larkspur Commons License, see below", "unknown"), ("The text is licensed under CC BY-SA 4.0", "CC-BY-SA"),
             ("He lost his licence after the accident and asked for his rights", None), (PROSE, None), ("", None)]
    docs = spark.createDataFrame([(i, f"{PROSE}\n{line}\n{PROSE}", "en", "a", 1) for i, (line, _) in enumerate(lines)], DOCUMENTS)
    assert found(s.license_scan(docs, classifier)) == sorted((i, 1, f) for i, (_, f) in enumerate(lines) if f)


def test_held_out_accuracy(spark, classifier):
    held = [(t, f) for t, f, h in s.training_rows() if h]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, (t, _) in enumerate(held)], DOCUMENTS)
    got = {r.doc_id: r.family for r in s.license_scan(docs, classifier).collect()}
    assert sum(got.get(i, s.OTHER) == f for i, (_, f) in enumerate(held)) >= 0.93 * len(held)


# Wordings that no template or training sentence has.
OTHER_WORDINGS = [
    "available under Creative Commons Attribution 4.0 International", "of this software and associated documentation files", "See www.apache.org for the terms of use",
    "All content on this site is copyright of its authors and may not be copied", "This file may be distributed under the terms of the GNU GPL",
    "The source code is made available under a BSD-style license", "Code is MIT licensed, see LICENSE.txt", "You are free to share this work under the CC BY-SA license",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "Unless required by applicable law, software distributed under the License is distributed on an AS IS basis without warranties",
    "The author has placed this work in the public domain", "Copyright (c) 2011 Example Press. All rights reserved worldwide.", "Subject to the Mozilla Public License Version 2.0",
    "No commercial use of this work is permitted without a license from the author", "Alle Rechte liegen beim Verlag, Nachdruck nur mit Genehmigung",
    "Dieser Text ist unter der Lizenz Creative Commons verfügbar", "Tous droits de reproduction réservés", "Texte disponible sous licence Creative Commons",
    "Reservados todos los derechos", "El texto está disponible bajo la licencia Creative Commons", "Licensed to you under the Quartz Open License 1.1",
    "You may reproduce this text only with the consent of the rights holder", "The images are released under CC0", "Dual licensed under GPL and MIT", "This library is LGPL software",
    "Content licensed under Creative Commons BY-NC 4.0 unless stated otherwise", "Gemeinfreies Werk, keine Rechte vorbehalten",
    "Toute reproduction sans l'accord de l'auteur est interdite", "Queda prohibida la copia sin autorización del autor"]


def test_other_wordings_are_found(spark, classifier):
    docs = spark.createDataFrame([(i, f"{PROSE}.\n{t}\n\n{PROSE}", "en", "a", 1) for i, t in enumerate(OTHER_WORDINGS)], DOCUMENTS)
    got = {r.doc_id for r in s.license_scan(docs, classifier).collect() if r.paragraph == 1}
    assert len(got) >= 0.9 * len(OTHER_WORDINGS), [t for i, t in enumerate(OTHER_WORDINGS) if i not in got]


def test_translations_are_named(spark, classifier):
    lines = ["Alle Rechte vorbehalten", "Tous droits réservés", "Todos los derechos reservados."]
    docs = spark.createDataFrame([(i, t, "de", "a", 1) for i, t in enumerate(lines)], DOCUMENTS)
    assert found(s.license_scan(docs, classifier)) == [(i, 0, "All rights reserved") for i in range(3)]


@pytest.mark.parametrize("width", [50, 64, 76])
def test_hard_wrapped_notices_are_one_paragraph(spark, classifier, width):
    import textwrap
    notices = [("MIT", s.TEMPLATES["MIT"][3]), ("BSD", s.TEMPLATES["BSD"][3]), ("GPL", s.TEMPLATES["GPL"][2])]
    docs = spark.createDataFrame([(i, f"{PROSE}.\n" + "\n".join(textwrap.wrap(t, width)) + f".\n{PROSE}", "en", "a", 1) for i, (_, t) in enumerate(notices)], DOCUMENTS)
    rows = s.license_scan(docs, classifier).collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in rows) == [(i, 1, f) for i, (f, _) in enumerate(notices)]
    # A last line of a word or two may stay behind.
    assert all(t.startswith(r.paragraph_text.rstrip(".")) and len(r.paragraph_text) >= 0.75 * len(t) for r in rows for t in [notices[r.doc_id][1]])


def test_neighbouring_statements_stay_apart(spark, classifier):
    text = "Released under the MIT License.\nAll rights reserved\nLicensed under the Apache License, Version 2.0\n\nAll rights reserved."
    docs = spark.createDataFrame([(d, text, "en", "a", 1) for d in (1, 1, None)], DOCUMENTS)
    want = [(0, 1, "MIT"), (1, 1, "All rights reserved"), (2, 1, "Apache-2.0"), (4, 1, "All rights reserved")]
    got = sorted((str(r.doc_id), r.paragraph, r.n_lines, r.family) for r in s.license_scan(docs, classifier).collect())
    assert got == sorted((d, *w) for w in want for d in ("1", "1", "None"))


def test_ordinary_text_is_left_alone(spark, classifier):
    """Every other line of the given documents, and of made-up rows with other seeds."""
    other = [t for t, f, _ in s.training_rows(seed=77) if f == s.OTHER]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(other)], DOCUMENTS)
    assert s.license_scan(docs, classifier).count() <= 0.02 * len(other)


def test_planted_lines_and_nothing_else(spark, classifier):
    """Whole table against a search for the five planted lines."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = {"Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "All rights reserved.", "Licensed under CC BY-NC 4.0.",
               "This work is licensed under the GNU General Public License, version 3."}
    want = sorted((r.doc_id, i) for r in docs.collect() for i, line in enumerate(r.text.split("\n")) if line in planted)
    assert [(d, p) for d, p, _ in found(s.license_scan(docs, classifier))] == want


def test_awkward_rows_and_empty(spark, classifier):
    assert found(s.license_scan(awkward(spark), classifier)) == []
    assert found(s.license_scan(none(spark), classifier)) == []
