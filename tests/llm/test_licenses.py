"""Licence notices against plain loops: base places word by word, notices by edit distance over the whole text."""

import random
import re

import pytest
from text_fixtures import awkward, docs_of, empty, words  # noqa: F401
from pyspark.sql import functions as F

from tabwright.llm import licenses

BASE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return "".join(chr(ord(char) + 32) if "A" <= char <= "Z" else char for char in text or "")


def plain_base(text):
    found, tokens = [], re.findall(BASE_WORD, lowered(text))
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        found += [(at, label) for at in range(len(tokens) - len(parts) + 1) if tokens[at : at + len(parts)] == parts]
    return len(tokens), found


def least_edits(notice, flat):
    """Fewest edits between the notice and any part of the text (dynamic programming over the whole text)."""
    row = list(range(len(notice) + 1))
    best = row[-1]
    for char in flat:
        diagonal, row[0] = row[0], 0
        for at, own in enumerate(notice, start=1):
            diagonal, row[at] = row[at], min(row[at] + 1, row[at - 1] + 1, diagonal + (char != own))
        best = min(best, row[-1])
    return best


def damaged(notice, edits, pick):
    chars = list(notice)
    for _ in range(edits):
        at = pick.randrange(len(chars))
        kind = pick.choice("ids")
        if kind == "i":
            chars.insert(at, pick.choice("qxz"))
        elif kind == "d":
            del chars[at]
        else:
            chars[at] = pick.choice("qxz")
    return "".join(chars)


@pytest.fixture
def noticed(words):
    pick, texts = random.Random(5), []
    for place, (_, notice) in enumerate(licenses.NOTICES):
        for edits in range(5):
            texts.append(f"{words(9, place)} {damaged(notice, edits, pick).title()}. {words(7, place + 50)}")
    return texts


def test_each_text_finds_what_the_edit_distance_finds(noticed):
    scanner = licenses.Scanner(licenses.NOTICES, licenses.BASE)
    caught = 0
    for text in noticed:
        flat, _ = licenses.folded(text)
        want = {notice: least_edits(notice, flat) for _, notice in licenses.NOTICES}
        want = {notice: edits for notice, edits in want.items() if edits <= licenses.edits_of(notice)}
        places, starts = scanner.hits(flat)
        raw = {}
        for place in starts:
            match = scanner.matches(flat, {place: starts[place]})
            if match:
                raw[licenses.NOTICES[place][1]] = min(edits for *_, edits in match)
        assert raw == want
        caught += bool(want)
        # Of overlapping notices the one that covers most stays.
        _, _, kept = scanner.scan(text)
        if want:
            cover = max(len(notice) - licenses.EDIT_COST * edits for notice, edits in want.items())
            assert cover in [len(one["notice"]) - licenses.EDIT_COST * one["edits"] for one in kept]
        else:
            assert kept == []
    assert caught > 50


def test_spans_point_into_the_given_text():
    text = "Intro:\nCafé — Licensed under the\n\tAPACHE licence, Version 2.0!\nThis is under CC-BY  (Mozilla Pubic License)."
    scanner = licenses.Scanner(licenses.NOTICES, licenses.BASE)
    n_words, base, notices = scanner.scan(text)
    assert n_words == len(re.findall(BASE_WORD, lowered(text)))
    assert [(one["label"], text[one["start"] : one["end"]]) for one in base] == [("cc-by", "CC-BY")]
    assert [(one["label"], one["edits"], one["text"]) for one in notices] == [
        ("apache", 1, "Licensed under the\n\tAPACHE licence, Version 2.0"), ("mpl", 1, "Mozilla Pubic License"),
    ]
    tokens = re.findall(BASE_WORD, lowered(text))
    assert tokens[notices[0]["first_word"] : notices[0]["last_word"] + 1] == "licensed under the apache licence version 2 0".split()


def test_digest_against_plain_loops(docs_of, awkward, words, noticed):
    texts = ["CC BY, cc-by. CC-BY", "The MIT License\nMIT  license", "x" * 300 + " GNU General\tPublic License é", "mit licenses", *noticed[:20]]
    for docs in (docs_of(texts), awkward):
        given = [(row["doc_id"], row["text"]) for row in docs.collect()]
        got = licenses.notice_digest(licenses.find_notices(docs.select("doc_id", "text"))).collect()
        assert len(got) == len(given)
        by_text = {}
        for doc_id, text in given:
            by_text.setdefault(doc_id, []).append(plain_base(text))
        for row in got:
            n_words, places = next(one for one in by_text[row["doc_id"]] if one[0] == row["n_words"] and len(one[1]) == row["n_base"])
            assert (row["first_word"], row["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
            assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
            assert set(row["base_labels"].split(",")) <= {*row["labels"].split(","), ""}
            assert row["score"] == 1.0 if places else 0 <= row["score"] <= 1
            assert (row["score"] > 0) == (row["labels"] != "")


def test_odd_input(docs_of, empty, words):
    assert licenses.find_notices(empty).collect() == []
    clash = docs_of(["MIT License"]).withColumns({"n_words": F.lit("mine"), "_base": F.lit(1), "notices": F.lit(2)})
    found = licenses.find_notices(clash)
    assert found.columns.count("n_words") == 1 and found.first()["n_words"] == 2 and found.first()["_base"] == 1
    long = (words(2000, 3) + " licensed under the licence public license ") * 400
    text = long + "Permission is hereby grunted, free of charge, to any person obtaining a copy of this software"
    _, base, notices = licenses.Scanner(licenses.NOTICES, licenses.BASE).scan(text)
    assert base == [] and len(text) > 4_000_000
    assert [(one["label"], one["edits"]) for one in notices][-1] == ("mit", 1)
