import random

from newslake.llm import license

SCHEMA = "doc_id long, text string, labels string"


def scan(spark, rows, **how):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA)
    return license.scanned(docs, **how).collect()


def brute(text):
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    starts, labels = [], set()
    for label, phrase in license.PHRASES:
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_against_brute_force(spark):
    rng = random.Random(1)
    parts = ["GNU", "General", "public", "license", "MIT", "apache", "CC", "by", "-", "K", "É", "x1", ".", "İ", "\n"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(300)]
    for r in scan(spark, rows):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(rows[r.doc_id][1])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.score == 1.0 if r.n_base else r.score < 1 or r.labels


def test_changed_notices(spark):
    notice = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files"
    )
    rows = [
        (1, "x y z " + notice),
        (2, notice.replace("any person", "any single person").replace("copy of", "copy from")),
        (3, "Permission is hereby granted, free of charge"),
        (4, notice.replace("free of charge", "free of all and any sort or kind of charge")),
    ]
    found = {r.doc_id: (r.labels, round(r.score, 2), r.n_base) for r in scan(spark, rows)}
    assert found[1] == ("mit", 1.0, 0)
    assert found[2][0] == "mit" and 0.8 <= found[2][1] < 1
    assert found[3] == ("", 0.0, 0)
    assert found[4][0] == ""


def test_lists_and_repeats(spark):
    notice = next(text for label, text in license.NOTICES if label == "mit")
    words = notice.split()
    changed = " ".join(words[:8] + ["other"] + words[8:])
    rows = [
        (1, "CC BY, CC BY-SA, CC BY-NC, CC BY-ND"),
        (2, "CC BY, CC BY-SA, CC BY-NC"),
        (3, "CC BY-NC CC BY-NC CC BY-NC"),
        (4, "cc by nc " * 5_000),
        (5, "CC BY, CC BY, CC BY, CC BY, CC BY"),
        (6, "CC BY-NC, CC BY, CC BY, CC BY, CC BY"),
        (7, "of this of this of this of this " + changed + " of this of this of this of this"),
        (8, " ".join(words[:4] + ["of this software and"] * 9)),
    ]
    found = {r.doc_id: r.labels for r in scan(spark, rows)}
    assert found == {
        1: "cc-by,cc-by-nc,cc-by-nd,cc-by-sa", 2: "cc-by,cc-by-nc,cc-by-sa", 3: "cc-by,cc-by-nc",
        4: "cc-by,cc-by-nc", 5: "cc-by", 6: "cc-by,cc-by-nc", 7: "mit", 8: "",
    }


def test_short_names(spark):
    rows = [
        (1, "BSD 3-Clause License"), (2, "SPDX-License-Identifier: MIT"), (3, "Licensed under the GNU GPL v3"),
        (4, "Mozilla Public License 2.0"), (5, "apache-2.0"), (6, "the public domain"),
    ]
    found = {r.doc_id: r.labels for r in scan(spark, rows)}
    assert found == {1: "bsd", 2: "mit", 3: "gpl,gpl-3", 4: "mpl", 5: "apache-2.0", 6: ""}


def test_templates_of_any_length(spark):
    text = [f"w{i}" for i in range(500)]
    gone = text[:100] + text[150:300] + ["x", "y"] + text[300:450] + ["z"] + text[460:]
    rows = [
        (1, " ".join(text)), (2, "a b " * 300 + " ".join(text) + " w0 w1" * 400), (3, " ".join(text[:399])),
        (4, " ".join(text[:400])), (5, " ".join(text[:59] + ["x"] + text[60:])), (6, " ".join(text[:61] * 9)),
        (7, " ".join(gone)), (8, " ".join(text[250:] + text[:250])),
    ]
    found = {r.doc_id: (r.labels, r.score) for r in scan(spark, rows, notices=[("long", " ".join(text))])}
    assert found == {
        1: ("long", 1.0), 2: ("long", 1.0), 3: ("", 0.0), 4: ("long", 0.8), 5: ("long", 499 / 500),
        6: ("", 0.0), 7: ("", 0.0), 8: ("", 0.0),
    }


def test_sql_takes_chains_in_pieces_too(spark):
    import duckdb
    import pandas as pd

    words = next(text for label, text in license.NOTICES if label == "mit" and len(text.split()) > 100).split()
    rng = random.Random(3)
    lists = ["CC BY, CC BY-SA, CC BY-NC, CC BY-ND", "cc by nc " * 40, "CC BY-NC, CC BY, CC BY, CC BY, CC BY"]
    rows = list(enumerate(lists))
    for d in range(len(rows), 60):
        kept = [w for w in words if rng.random() > 0.04 * (d % 4)]
        noise = [rng.choice(["of this software", "the software", "x", "cc by", "nc", "gnu gpl v3"]) for _ in range(40)]
        rows.append((d, " ".join(noise[: d % 40] + kept + noise)))
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    expected = duckdb.sql(license.SCANNED_SQL).fetchall()
    assert sorted(map(tuple, scan(spark, rows))) == sorted(expected)


def test_tables(spark):
    rows = [(1, "the MIT License " * 5_000), (2, None), (3, ""), (4, "cc by"), (4, "cc by"), (4, "gnu"), (None, "MIT license.")]
    found = sorted(scan(spark, rows), key=lambda r: (r.doc_id or 0, r.n_words))
    assert [(r.doc_id, r.n_words, r.n_base, r.last_word, r.base_labels) for r in found] == [
        (None, 2, 1, 0, "mit"), (1, 15_000, 5_000, 14_998, "mit"), (2, 0, 0, None, ""), (3, 0, 0, None, ""),
        (4, 1, 0, None, ""), (4, 2, 1, 0, "cc-by"), (4, 2, 1, 0, "cc-by"),
    ]
    assert license.scanned(spark.createDataFrame([], SCHEMA)).count() == 0


def test_templates_in_several_tables(spark, monkeypatch):
    monkeypatch.setattr(license, "MOST_GRAMS", 7)
    rows = [(1, "gnu general public license, version 3"), (2, "MIT license and cc by-nc")]
    found = {r.doc_id: r.labels for r in scan(spark, rows)}
    assert found == {1: "gpl,gpl-3", 2: "cc-by,cc-by-nc,mit"}
