"""Quality rules, syncmer fingerprints and mixing."""

import hashlib
import os
import re
import struct

import duckdb
import pytest
import xxhash
from text_fixtures import awkward, docs_of, empty, rows_of, WORD, words  # noqa: F401
from pyspark.sql import functions as F

from tabwright.llm import mixing, quality_rules, syncmers
from tabwright.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_sql(spark, name):
    base = duckdb.connect()
    for table in ("documents", "embeddings"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = QUERIES[name](spark, SF)
    cursor = base.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["op2_quality_rules", "op8_syncmer_fingerprints", "op9_curriculum_mixing"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan


def plain_repeats(text):
    words = re.findall(WORD, text or "")
    windows = [tuple(words[at : at + 8]) for at in range(len(words) - 7)]
    return len({at + step for at, one in enumerate(windows) if windows.count(one) > 1 for step in range(8)})


def test_base_counts_against_plain_loops(docs_of, awkward, words):
    passage = words(12, 9)
    texts = [f"{words(5)} {passage} {words(3, 2)} {passage} {passage[:40]}", "x " * 9, "a\nb\na \n\na\n \n", "# * $ %% ü" + "é" * 4]
    for docs in (docs_of(texts), awkward):
        for row in quality_rules.judge(docs, carry=["doc_id", "text"]).collect():
            text = row["text"] or ""
            found = re.findall(WORD, text)
            lines = [line for line in text.split("\n") if re.search(WORD, line)]
            assert row["n_words"] == len(found)
            assert row["word_chars"] == sum(map(len, found))
            assert row["n_symbols"] == sum(text.count(mark) for mark in "#*$%&|<>")
            assert row["n_dup_lines"] == len(lines) - len(set(lines))
            assert row["n_repeat_words"] == plain_repeats(text)
            assert row["base_failed"] == (len(found) < 20 or 100 * plain_repeats(text) > 30 * len(found))


def test_host_verdicts(docs_of, words):
    rows = [(place, words(30, place) if place % 10 else "few", "good") for place in range(60)]
    rows += [(100 + place, "few words" if place % 10 else words(30, place), "bad") for place in range(60)]
    found = {row["doc_id"]: row for row in quality_rules.judge(docs_of(rows)).collect()}
    assert found[1]["kept"] and not found[10]["kept"]
    assert found[110]["base_failed"] is False and not found[110]["kept"]
    # One failure in a host of one document is shrunk towards the others.
    alone = quality_rules.judge(docs_of([*rows[:60], (500, words(30), "tiny"), (501, "x", "single")])).collect()
    rates = {row["doc_id"]: row["host_rate"] for row in alone}
    assert rates[1] < rates[501] < 1.0


def test_quality_rules_on_odd_input(awkward, empty, words):
    kept = quality_rules.kept_rows(awkward)
    assert kept.columns == awkward.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == [5, 5, 6, 7, 8, 10]
    assert quality_rules.kept_rows(empty).collect() == [] and quality_rules.judge(empty).collect() == []
    clash = awkward.withColumns({"kept": F.lit("mine"), "_host": F.lit(1), "n_words": F.lit(2.5), "docs": F.lit(3)})
    assert quality_rules.kept_rows(clash).columns == clash.columns
    assert quality_rules.judge(clash).columns.count("kept") == 1


def plain_anchors(text, hash_of):
    found = re.findall(WORD, text)
    if len(found) < syncmers.K:
        return None
    return [at for at in range(len(found) - syncmers.K + 1)
            if (runs := [hash_of[tuple(found[at + step : at + step + syncmers.S])] for step in range(syncmers.K - syncmers.S + 1)])
            and min(runs) in (runs[0], runs[-1])]


def test_anchors_are_closed_syncmers(spark, docs_of, words):
    text = words(80, 4) + " " + "same " * 10
    found = re.findall(WORD, text)
    pairs = {tuple(found[at : at + 2]) for at in range(len(found) - 1)}
    table = spark.createDataFrame(list(pairs), "a string, b string")
    hashes = {(row["a"], row["b"]): row["h"] for row in table.select("a", "b", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h")).collect()}
    row = docs_of([text]).select(syncmers.anchors(F.col("text")).alias("found")).first()
    assert [anchor["place"] for anchor in row["found"]] == plain_anchors(text, hashes)


def test_anchors_do_not_depend_on_context(docs_of, words):
    passage = words(40, 5)
    first, second = docs_of([passage, f"{words(7, 6)} {passage} {words(9, 7)}"]).select(
        "doc_id", syncmers.anchors(F.col("text")).alias("found")).orderBy("doc_id").collect()
    assert {one["hash"] for one in first["found"]} <= {one["hash"] for one in second["found"]}
    shifted = docs_of([passage]).crossJoin(docs_of([f"{words(7, 6)} {passage}"]).select(F.col("text").alias("other"))).select(
        syncmers.shared_runs(syncmers.anchors(F.col("text")), syncmers.anchors(F.col("other"))).alias("m")).first()["m"]
    assert len(shifted) == len(first["found"]) and {match["shift"] for match in shifted} == {7}


@pytest.mark.parametrize("runs", [1, 3, 50])
def test_edited_neighbours(docs_of, words, runs):
    texts = {place * 3: words(place * 7 % 60, place) for place in range(40)} | {200: None, 201: "", 202: "é" * 9, 203: words(30, 1), 204: words(30, 1)}
    found = {row["doc_id"]: row for row in syncmers.edited_neighbours(docs_of([(key, text, "s") for key, text in texts.items()]), runs=runs).collect()}
    order = sorted(texts, reverse=True)
    for place, key in enumerate(order):
        text, following = texts[key] or "", texts[order[(place + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[key]["n_chars"] == len(text)
        assert found[key]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[key]["near_next"] <= 1 and 0 <= found[key]["near_edited"] <= 1
    assert found[203]["fingerprint"] == found[204]["fingerprint"] and found[204]["near_next"] == 1.0
    assert found[57]["near_next"] == 0.0


def plain_anchor_hashes(text):
    """Set of the closed syncmers' hashes (signed), by loops over words."""
    signed = lambda value: value - (1 << 64) if value >> 63 else value

    def chained(parts):
        value = 42
        for part in parts:
            value = xxhash.xxh64_intdigest(part, value)
        return value

    packed = lambda value: struct.pack("<Q", value)
    found = [word.encode() for word in re.findall(WORD, text)]
    if len(found) < syncmers.K:
        return {chained(found)} if found else set()
    hashes = [chained([word]) for word in found]
    runs = [chained(map(packed, hashes[at : at + syncmers.S])) for at in range(len(hashes) - syncmers.S + 1)]
    last, chosen = syncmers.K - syncmers.S, set()
    for at in range(len(runs) - last):
        own = [signed(run) for run in runs[at : at + last + 1]]
        if min(own) in (own[0], own[-1]):
            # The runs at words 0, 2 and 3 cover the five words.
            chosen.add(chained(map(packed, (runs[at], runs[at + 2], runs[at + 3]))))
    return chosen


def test_likeness_against_plain_sets(docs_of, words):
    texts = {key: words(20 + 9 * key, key % 7) + (" the same end of " + words(12, 3) if key % 2 else "") for key in range(24)}
    texts |= {30: "", 31: "only four words here", 32: "only four words here", 33: texts[5], 34: "\u00e4 \u00f6 " * 9}
    found = {row["doc_id"]: row for row in syncmers.edited_neighbours(docs_of([(key, text, "s") for key, text in texts.items()]), runs=3).collect()}
    order = sorted(texts, reverse=True)

    def dice(one, other):
        one, other = plain_anchor_hashes(one), plain_anchor_hashes(other)
        return 2 * len(one & other) / (len(one) + len(other)) if one or other else 1.0

    for place, key in enumerate(order):
        text, after = texts[key], texts[order[(place + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert found[key]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[key]["near_edited"] == pytest.approx(dice(text, edited))
        assert found[key]["near_next"] == pytest.approx(dice(text, after))
    assert any(0 < row["near_edited"] < 1 for row in found.values())


def test_fingerprints_on_odd_input(awkward, empty):
    assert syncmers.edited_neighbours(empty, runs=4).collect() == []
    found = syncmers.edited_neighbours(awkward, runs=4).collect()
    assert len(found) == awkward.count()
    alone = syncmers.edited_neighbours(awkward.where("doc_id = 4"), runs=4).first()
    assert alone["near_next"] == 1.0


def plain_mix(rows):
    sizes = [len(re.findall(WORD, text or "")) for _, text, _ in rows]
    names = sorted({source for _, _, source in rows if source is not None}) + ([None] if any(row[2] is None for row in rows) else [])
    weight = {name: 1 + place % 3 for place, name in enumerate(names)}
    size = {name: sum(n for n, row in zip(sizes, rows) if row[2] == name) for name in names}
    target, full, left = {}, set(), float(sum(sizes))
    while True:
        level = left / max(1e-12, sum(weight[name] for name in names if name not in full))
        over = [name for name in names if name not in full and level * weight[name] > 3 * size[name]]
        if not over:
            return sizes, size, {name: 3.0 * size[name] if name in full else level * weight[name] for name in names}
        full |= set(over)
        left = sum(sizes) - sum(3 * size[name] for name in full)
        if len(full) == len(names):
            return sizes, size, {name: 3.0 * size[name] for name in names}


def test_mix_against_plain_water_filling(docs_of, words):
    rows = [(place, words(5 + place % 11, place), f"s{min(place % 9, 4)}") for place in range(200)] + [(900, words(3), "tiny"), (901, words(4), None)]
    sizes, size, target = plain_mix(rows)
    found = {row["doc_id"]: row for row in mixing.mix(docs_of(rows)).collect()}
    for (key, _, source), n in zip(rows, sizes):
        assert (found[key]["size"], found[key]["source_size"]) == (n, size[source])
        assert found[key]["target"] == pytest.approx(target[source])
        assert 0 <= found[key]["taken"] <= 3 * n and 0 <= found[key]["position"] <= 1
    for source in size:
        taken = sum(found[key]["taken"] for key, _, own in rows if own == source)
        assert abs(taken - target[source]) <= 20
    again = {row["doc_id"]: row["taken"] for row in mixing.mix(docs_of(rows[::-1]).repartition(7)).collect()}
    assert again == {key: row["taken"] for key, row in found.items()}


def test_curriculum_positions(docs_of, words):
    rows = [(place, words(20, place), f"s{place % 3}") for place in range(300)]
    order = [row["source"] for row in mixing.mixed_rows(docs_of(rows)).collect()]
    early, late = order[: len(order) // 2], order[len(order) // 2 :]
    # Slopes -0.5, 0, 0.5: the first source comes early, the third late.
    assert early.count("s0") > late.count("s0") and early.count("s2") < late.count("s2")
    positions = [row["position"] for row in mixing.mix(docs_of(rows)).collect()]
    assert positions == sorted(positions)


def test_mix_on_odd_input(awkward, empty):
    assert mixing.mix(empty).collect() == [] and mixing.mixed_rows(empty).collect() == []
    found = mixing.mix(awkward)
    assert found.count() == awkward.count()
    clash = awkward.withColumns({"size": F.lit("x"), "_hash": F.lit(1), "_copy": F.lit(2), "target": F.lit(None).cast("string")})
    assert mixing.mixed_rows(clash).columns == clash.columns
    assert mixing.mix(clash).count() == awkward.count()
    no_words = mixing.mix(awkward.where("text is null or trim(text) = ''"))
    assert {row["taken"] for row in no_words.collect()} == {0}
