"""Whole license texts as license files have them."""

import textwrap
from pathlib import Path

import pytest

from tablewright.llm import licenses

GIVEN = Path("/usr/share/common-licenses")


def found(spark, texts, known=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.license_id for r in licenses.scan(docs, known).orderBy("doc_id").collect()]


def test_whole_licenses(spark):
    if not GIVEN.exists():
        pytest.skip("needs the license texts of a Debian system")
    names = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1",
             "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    texts = {n: (GIVEN / n).read_text() for n in names}
    assert found(spark, texts.values()) == list(names.values())
    cut = [texts[n][: texts[n].index(licenses.END)] for n in ("Apache-2.0", "GPL-2", "GPL-3")]
    assert found(spark, cut) == ["Apache-2.0", "GPL-2.0", "GPL-3.0"]
    filled = texts["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2019 Some One")
    assert filled != texts["Apache-2.0"] and found(spark, [filled, texts["GPL-3"] + " but not quite"]) == ["Apache-2.0", None]


def test_forms_of_short_licenses(spark):
    mit = (licenses.TEXTS / "MIT.txt").read_text()
    bare = mit.removeprefix("MIT License").replace("<year> <copyright holders>", "2021 A. Person")
    old = (licenses.TEXTS / "ISC.txt").read_text().removeprefix("ISC License").replace("and/or distribute", "and distribute")
    wide = textwrap.fill(bare.split("Person")[1], 10_000)
    texts = [bare, "The MIT License (MIT)\n" + bare, wide, old, *((licenses.TEXTS / f"BSD-{n}.txt").read_text() for n in ("2-Clause", "3-Clause"))]
    assert found(spark, texts) == ["MIT", "MIT", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause"]


def test_known_texts_are_a_table(spark):
    known = spark.createDataFrame([("own", "Use it,\nor leave it."), (None, "no name"), ("blank", " - ")], "license_id string, text string")
    assert found(spark, ["use it or\n\nleave it", "no name", "", None], known) == ["own", None, None, None]
    assert found(spark, ["use it"], known.limit(0)) == [None]
