"""Phrase mining against plain counting, and the walk through proposals, border and failures."""

import random
import re
from collections import Counter

import numpy as np
from text_fixtures import awkward, docs_of, empty, words  # noqa: F401
from pyspark.sql import functions as F

from tabwright.llm import collocations, phrase_counts


def lowered(text):
    return "".join(chr(ord(char) + 32) if "A" <= char <= "Z" else char for char in text or "")


def plain_counts(rows, most=5):
    counts = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            found = re.findall(r"[^\x20\x09]+", piece)
            counts[lang or "und", 0, ""] += len(found)
            for k in range(1, most + 1):
                for at in range(len(found) - k + 1):
                    counts[lang or "und", k, " ".join(found[at : at + k])] += 1
    return counts


def plain_mining(rows, least, first):
    counts = plain_counts(rows)
    kept = {(lang, phrase): n for (lang, k, phrase), n in counts.items() if k and n >= least}
    out = {}
    for (lang, phrase), a in kept.items():
        parts, n = phrase.split(" "), counts[lang, 0, ""]
        if len(parts) == 1:
            continue
        inside = any(f" {phrase} " in f" {longer} " and longer != phrase and f >= a for (other, longer), f in kept.items() if other == lang)
        if inside:
            continue
        cuts = []
        for cut in range(1, len(parts)):
            left, right = kept[lang, " ".join(parts[:cut])], kept[lang, " ".join(parts[cut:])]
            cuts.append((1000 * a * n // (left * right), cut, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right, n))
    return {
        (lang, rank, phrase.decode(), -a, left, right, n, -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(found)[:first], start=1)
    }


def spoken(seed, texts=260):
    """Texts with phrases that repeat, some of them in few documents only."""
    pick = random.Random(seed)
    vocabulary = [f"w{place}" for place in range(40)] + ["É", "Zebra", "a'b"]
    out = []
    for place in range(texts):
        parts = pick.choices(vocabulary, [1 / (1 + rank) for rank in range(len(vocabulary))], k=pick.randint(0, 60))
        for at in range(0, len(parts), 7):
            parts[at] += pick.choice([".", "!", "", "", "\n", " \t"])
        if place % 90 == 5:
            parts += ["rare phrase of five words,"] * 12
        out.append((pick.choice(["en", "de", None]), " ".join(parts)))
    return out


def docs(spark, rows):
    return spark.createDataFrame([(place, lang, text) for place, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string")


def test_against_plain_mining(spark):
    rows = [*spoken(1), (None, None), ("en", ""), ("de", " \t"), ("en", "w0 w1"), ("en", "w0 w1")]
    for least, first, sample in ((6, 2000, 100), (20, 7, 300)):
        got = collocations.collocations(docs(spark, rows), least=least, first=first, key="doc_id", sample=sample)
        want = plain_mining(rows, least, first)
        assert {tuple(row) for row in got.collect()} == want and len(want) > 10


def test_failures_of_the_sample_are_mended(spark, monkeypatch):
    rows = spoken(2)
    passes = []
    real = collocations.counted

    def watched(*args, **named):
        passes.append(named.get("before"))
        return real(*args, **named)

    monkeypatch.setattr(collocations, "counted", watched)
    # An empty sample proposes nothing: longer phrases come in by the expansion pass alone.
    for sample in (0, 20):
        passes.clear()
        got = {(row["lang"], row["k"], row["phrase"]): row["n"] for row in collocations.frequent_phrases(docs(spark, rows), 8, sample=sample).collect()}
        assert got == {key: n for key, n in plain_counts(rows).items() if n >= 8 or key[1] == 0}
        assert [before is not None for before in passes] == [False, False, False, True]


def test_a_filter_that_says_yes_too_often_loses_nothing(spark, monkeypatch):
    rows = spoken(3)
    monkeypatch.setattr(collocations, "MOST_BITS", 128)
    monkeypatch.setattr(collocations, "LEAST_BITS", 64)
    got = {(row["lang"], row["k"], row["phrase"]): row["n"] for row in collocations.frequent_phrases(docs(spark, rows), 8, sample=30).collect()}
    assert got == {key: n for key, n in plain_counts(rows).items() if n >= 8 or key[1] == 0}


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    rows = spoken(4, 40)
    long = [("en", "".join(text + ". " for _, text in rows) + "x" * 500 + " end. w0 w1 w2"), *rows]
    monkeypatch.setattr(phrase_counts, "CHUNK_BYTES", 200)
    counts = Counter()
    for texts in phrase_counts.chunks((lang or "und", text) for lang, text in long):
        chunk = phrase_counts.Words(texts)
        langs = list(chunk.langs)
        for k, lang_of, found, n, _ in chunk.phrases(5):
            for place, phrase, one in zip(lang_of, chunk.spelled(found).to_pylist(), n):
                counts[langs[place], k, phrase] += int(one)
    assert counts == Counter({key: n for key, n in plain_counts(long).items() if key[1]})


def test_five_megabytes(spark):
    text = "alpha beta gamma delta, " * 220_000
    found = collocations.collocations(docs(spark, [("en", text)]), least=100)
    assert len(text) > 5_000_000
    assert [tuple(row) for row in found.collect()] == [("en", 1, "alpha beta gamma delta", 220_000, 220_000, 220_000, 880_000, 4000)]


def test_scores_beyond_64_bits(spark):
    big = 10**13
    phrases = spark.createDataFrame([("en", 0, "", big), ("en", 1, "a", big // 10), ("en", 1, "b", big // 10 + 7), ("en", 2, "a b", big // 11)], "lang string, k int, phrase string, n long")
    row = collocations.cut_scores(phrases).first()
    assert row["score"] == 1000 * (big // 11) * big // ((big // 10) * (big // 10 + 7))


def test_odd_input(awkward, empty, spark):
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(awkward).collect() == []
    clash = awkward.withColumns({"phrase": F.lit("x"), "_dealt": F.lit(1), "n": F.lit(2), "k": F.create_map(F.lit(1), F.lit(2))})
    found = collocations.collocations(clash, least=4)
    assert {tuple(row) for row in found.collect()} == plain_mining([(row["lang"], row["text"]) for row in awkward.collect()], 4, 2000)


def test_filter_has_what_was_put_in(spark):
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63, 3000)
    words = collocations.filter_words(spark.createDataFrame([(int(one),) for one in hashes], "hash long"), 1 << 16)
    held = phrase_counts.Filter(words)
    assert held.has(hashes.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 2**63, 3000).view(np.uint64)
    assert held.has(others).mean() < 0.05
