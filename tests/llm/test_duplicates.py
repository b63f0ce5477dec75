"""SimHash groups and exact repeats."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from text_fixtures import awkward, docs_of, empty, WORD, words  # noqa: F401
from pyspark.sql import functions as F

from tabwright.llm import repeats, simhash
from tabwright.llm.common import components
from tabwright.llm.suffix_sort import common_prefixes, suffix_array


def plain_fingerprint(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda letter: letter[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[at : at + 3]).encode(), 42) for at in range(max(1, len(words) - 2))]
    return sum(1 << bit for bit in range(64) if 2 * sum(one >> bit & 1 for one in hashes) > len(hashes))


def plain_groups(values):
    label = list(range(len(values)))

    def top(at):
        while label[at] != at:
            at = label[at]
        return at

    for at, one in enumerate(values):
        for other in np.flatnonzero(np.bitwise_count(values[at + 1 :] ^ one) <= 3) + at + 1:
            low, high = sorted((top(at), top(int(other))))
            label[high] = low
    return [top(at) for at in range(len(values))]


def test_fingerprints_against_plain_loops(words):
    for text in (None, "", " \n", "One", "two Words", "A b C", "Ünï Côdé ÀÉ x", words(500, 3), "same " * 200):
        assert simhash.text_fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_golay_words_within_two_bits_share_an_index():
    code = simhash.GolayCode()
    random.seed(5)
    for _ in range(300):
        word = random.getrandbits(23)
        for bits in range(3):
            other = word
            for bit in random.sample(range(23), bits):
                other ^= 1 << bit
            one, two = (set(code.indices(np.array([value]))[0].tolist()) - {-1} for value in (word, other))
            assert one & two
    sizes = {len(set(row.tolist()) - {-1}) for row in code.indices(np.arange(1 << 12))}
    assert sizes == {1, 6}


def test_any_three_bits_share_a_key():
    code = simhash.GolayCode()
    random.seed(6)
    for _ in range(400):
        value = random.getrandbits(64)
        other = value
        for bit in random.sample(range(64), random.randint(0, 3)):
            other ^= 1 << bit
        keys, place = simhash.fuzzy_keys(np.array([value, other], np.uint64).view(np.int64), code)
        assert set(keys[place == 0].tolist()) & set(keys[place == 1].tolist())


def clustered(count, seed):
    """Fingerprints in chains and clusters, some far from all."""
    pick = random.Random(seed)
    values = {pick.getrandbits(64) for _ in range(count // 4)}
    while len(values) < count:
        value = pick.choice(sorted(values))
        for bit in pick.sample(range(64), pick.choice((1, 2, 3, 3, 4, 5))):
            value ^= 1 << bit
        values.add(value)
    return np.array(sorted(values), np.uint64)


def test_groups_against_all_pairs(spark):
    values = clustered(1500, 7)
    frame = spark.createDataFrame([(int(value),) for value in values.view(np.int64)], "_print long")
    roots = {row["node"]: row["root"] for row in components(simhash.links(frame)).collect()}
    want = plain_groups(values)
    got = [roots.get(int(value), int(value)) for value in values.view(np.int64)]
    pairs = set(zip(want, got))
    assert len(pairs) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("bits", [6, 12])
def test_a_long_run_is_grouped_like_all_pairs(bits):
    pick = random.Random(bits)
    places = pick.sample(range(64), bits + 20)
    values = {sum(1 << place for place in places[:bits] if pick.random() < 0.5) for _ in range(400)}
    values |= {sum(1 << place for place in pick.sample(places, 10)) for _ in range(60)}
    values = np.array(sorted(values), np.uint64)
    label, want = simhash.link_run(values.view(np.int64)), plain_groups(values)
    assert len(set(zip(label.tolist(), want))) == len(set(want)) == len(set(label.tolist()))


def test_near_duplicates_of_documents(docs_of, awkward, empty, words):
    base = words(300, 1)
    edited = base.replace(base.split()[150], "other", 1)
    rows = [(9, base, "s"), (4, edited, "s"), (7, base, "t"), (1, words(300, 2), "s"), (2, "", "s"), (3, None, "s"), (5, " ", "s")]
    found = {row["doc_id"]: row for row in simhash.near_duplicates(docs_of(rows)).collect()}
    assert {key: found[key]["fingerprint"] for key in found} == {key: format(plain_fingerprint(text), "016x") for key, text, _ in rows}
    values = np.array([plain_fingerprint(text) for _, text, _ in rows], np.uint64)
    for at, (key, _, _) in enumerate(rows):
        group = plain_groups(values)
        assert found[key]["component_id"] == min(rows[other][0] for other in range(len(rows)) if group[other] == group[at])
    assert simhash.near_duplicates(empty).collect() == [] and simhash.one_per_group(empty).collect() == []
    assert simhash.near_duplicates(awkward).count() == awkward.count()


def test_one_document_of_each_group_stays(docs_of, awkward, words):
    kept = simhash.one_per_group(awkward)
    assert kept.columns == awkward.columns
    # No words: ids 1, 2, 3 and two without id are one group; 5 twice and 6 another; 7 and 8 a third.
    assert sorted(row["doc_id"] for row in kept.collect()) == [1, 4, 5, 7, 9, 10]
    nameless = docs_of([(None, words(50, 1), "a"), (None, words(50, 1), "b"), (None, words(50, 2), "c")])
    assert sorted(row["text"] for row in simhash.one_per_group(nameless).collect()) == sorted([words(50, 1), words(50, 2)])
    clash = awkward.withColumns({"_key": F.lit(1), "component_id": F.lit("x"), "_print": F.lit(2), "root": F.lit(3)})
    assert simhash.one_per_group(clash).columns == clash.columns
    assert simhash.near_duplicates(clash).columns.count("component_id") == 1


def test_suffix_array_against_sorting():
    pick = random.Random(3)
    for turn in range(200):
        text = bytes(pick.choice(b"ab" if turn % 2 else b"abcde") for _ in range(pick.randint(0, 60)))
        order = suffix_array(text, 100).tolist()
        assert order == sorted(range(len(text)), key=lambda at: text[at:])
        prefixes = common_prefixes(text, np.array(order, np.int64), 100).tolist()
        for one, two, common in zip(order, order[1:], prefixes):
            assert text[one : one + common] == text[two : two + common]
            assert text[one + common : one + common + 1] != text[two + common : two + common + 1]


def plain_repeats(texts, length=repeats.LENGTH):
    starts = {}
    for number, text in enumerate(texts):
        for at in range(len(text) - length + 1):
            starts.setdefault(text[at : at + length], []).append((number, at))
    gone = [bytearray(len(text)) for text in texts]
    for places in starts.values():
        if len(places) > 1:
            for number, at in places:
                gone[number][at : at + length] = b"\1" * length
    result = []
    for text, mark in zip(texts, gone):
        kept = bytes(value for value, out in zip(text, mark) if not out)
        result.append((len(text), sum(mark), len(re.findall(b"\1+", mark)), hashlib.sha256(kept).hexdigest()))
    return result


def digest(docs):
    found = repeats.without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return {row[0]: tuple(row[1:]) for row in found.collect()}


def test_repeats_against_all_strings(docs_of, words, monkeypatch):
    passage, other = words(60, 1), words(70, 2)
    texts = [
        f"{words(40, 3)} {passage} {words(30, 4)}", f"{words(10, 5)} {passage}é {words(30, 6)}", f"{other} {words(20, 7)} {other}",
        words(100, 8), words(100, 8), "ab " * 300, "é" * 150, "é" * 101, passage[:199], passage[:200], passage[5:230], "", None,
        f"{passage[:150]}X{passage[150:]}", f"{words(3, 9)}{passage[100:400]}{words(3, 10)}{other[50:300]}",
    ]
    want = plain_repeats([(text or "").encode() for text in texts])
    assert digest(docs_of(texts)) == dict(enumerate(want))


def test_an_anchor_with_many_contexts_is_spread(docs_of, words, monkeypatch):
    line, passage = words(25, 1)[:120], words(60, 2)[:260]
    texts = [f"{words(60, 100 + place)} {line} {words(60, 300 + place)}" for place in range(40)]
    texts += [f"{words(40, 500 + place)} {passage[:70]} {line} {passage[70:]} {words(40, 600 + place)}" for place in range(4)]
    texts += [texts[0], texts[1][50:], line * 5]
    docs = docs_of(texts)
    monkeypatch.setattr(repeats, "GROUP_BYTES", 1000)
    assert digest(docs) == dict(enumerate(plain_repeats([text.encode() for text in texts])))
    rows = docs.select("doc_id", "text")
    meeting = repeats._meeting(rows, repeats._stored(docs, "doc_id", "text", ["doc_id"]))
    assert meeting.where("first >= 0").count() > 1000
    assert all(row["size"] <= 1000 for row in meeting.where("first < 0").groupBy("meet").agg(F.sum(F.octet_length("content")).alias("size")).collect())


def test_blocks_of_a_long_text_join_without_a_seam(words, monkeypatch):
    text = (words(400, 1) + " " + words(200, 2) + " " + words(400, 1)).encode()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text.decode()])], ["id", "text"])
    covered = []
    for block in (1 << 20, 700):
        monkeypatch.setattr(repeats, "BLOCK", block)
        strings = set()
        for _, _, _, place in repeats._occurrences(batch, repeats.Anchors()):
            for value in place.tolist():
                start, count = value >> 8 & 0xFFFFFFFF, value & 0xFF
                assert not strings & set(range(start, start + count))
                strings |= set(range(start, start + count))
        covered.append(strings)
    assert covered[0] == covered[1] == set(range(len(text) - repeats.LENGTH + 1))


def test_repeats_on_odd_input(awkward, empty, words):
    assert repeats.without_repeats(empty).collect() == []
    found = repeats.without_repeats(awkward.withColumns({"key": F.lit(1), "spans": F.lit("x"), "hash": F.lit(2)}))
    rows = found.collect()
    assert len(rows) == awkward.count()
    by_id = {row["doc_id"]: row for row in rows}
    assert by_id[7]["n_removed"] == by_id[7]["n_bytes"] and by_id[1]["n_bytes"] == 0
    assert by_id[8]["n_removed"] == by_id[7]["n_bytes"] and bytes(by_id[8]["kept"]) == b" end"
