import pytest

from ledgerlens.llm import licences
from tests.llm.helpers import ROWS, SF, no_rows, odd_rows


@pytest.fixture(scope="module")
def model():
    return licences.train(["the lake lies still in the morning", "twelve boats left the harbour", "und dann kam der Winter mit Schnee"] * 5)


def test_held_out_accuracy(model):
    held = licences.examples([])[1]
    assert sum(model.predict(x)[0] == f for x, f in held) >= 0.95 * len(held)


def test_probabilities_are_calibrated(model):
    """Among held-out predictions the mean probability is near the share that is right."""
    held = licences.examples([])[1]
    p = [model.predict(x) for x, _ in held]
    right = sum(f == g for (f, _), (_, g) in zip(p, held)) / len(held)
    assert abs(sum(x for _, x in p) / len(p) - right) < 0.05


@pytest.mark.parametrize("text, family", [
    ("Licensed under the Apache License, Version 2.0.", "apache"), ("Released under the MIT License.", "mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
])
def test_notices(model, text, family):
    padded = f"é Some line before.\n{text}\nand one after"
    (found,) = licences.scan(model, padded.encode())
    assert found[0] == family and padded[found[1]:found[2]] == text


@pytest.mark.parametrize("family, lines", [
    ("gpl", ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
             "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]),
    ("bsd", ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions are met:"]),
    ("isc", ["Permission to use, copy, modify, and/or distribute this software for any", "purpose with or without fee is hereby granted."]),
])
@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
def test_hard_wrapped_notices(model, family, lines, mark):
    notice = f"\n{mark}".join(lines)
    text = f"{mark.rstrip()}\n{mark}{notice}\n{mark.rstrip()}\nint x;"
    (found,) = [r for r in licences.scan(model, text.encode()) if r[0] != licences.UNKNOWN]
    assert found[0] == family and text[found[1]:found[2]] == notice


@pytest.mark.parametrize("name, family", [("MIT", "mit"), ("GPL-3.0", "gpl"), ("GPL-3.0-only", "gpl"), ("BSD-2-Clause", "bsd"), ("ISC", "isc")])
def test_identifiers(model, name, family):
    assert [r[0] for r in licences.scan(model, f"// SPDX-License-Identifier: {name}".encode())] == [family]


def test_version_forms(model):
    for text in ("Licensed under GPLv3", "Released under the GNU General Public License v3.0"):
        assert [r[0] for r in licences.scan(model, text.encode())] == ["gpl"]


def test_other_text_is_left_alone(model):
    for text in ("He renewed his driver license in May.", "The apache helicopter landed.", "Permission to land was granted.", "mit der Bahn", "", None):
        assert [f for f in licences.scan(model, text.encode() if text is not None else None) if f[0] != licences.UNKNOWN] == []


def test_all_notices_of_the_table_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.families for r in licences.find_licences(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        for words, family in (("MIT License", "mit"), ("Apache License", "apache"), ("CC BY-NC", "cc-by-nc"), ("GNU General", "gpl")):
            assert (words in r.text) == (family in got[r.doc_id].split(",")), (r.doc_id, family)


def test_odd_rows(spark):
    out = licences.find_licences(odd_rows(spark)).collect()
    assert len(out) == len(ROWS) and {r.n_licences for r in out} == {0}
    assert licences.find_licences(no_rows(spark)).count() == 0
