"""Pieces, token files, personal data, toxicity and LM scores."""

import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from text_fixtures import awkward, docs_of, empty, WORD, words  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabwright.llm import attention, boosting, lm_scoring, pii, sentencepiece_viterbi, token_files, toxicity
from tabwright.llm.id_coder import Image, write_image

ODD_TEXTS = ["", " ", "  two  blanks ", "a▁b ▁", "tab\tline\n\nbreaks\n", "日本語" * 30 + "𝄞", "a" * 300, "x=1;" * 50,
             "a\u00a0b c  d", "x\u3000y\nz  ", "word$$$ two!? (three) ²³ a1. Ⅷ, naïve. e\u0301. _x_. it's. 'll",
             "Hello World. It's a test, isn't it?", "IllegalArgumentException" * 9, "\0\x7f é ﬁ", " lead", "trail "]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_viterbi.PieceModel(sentencepiece_viterbi.MODEL)


def test_pieces_are_the_librarys(pieces, words):
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_viterbi.MODEL)
    for text in [*ODD_TEXTS, words(400, 1), words(50, 2).title()]:
        ids = np.frombuffer(pieces.ids_of(text), "<u4").tolist()
        assert pieces.text_of(pieces.ids_of(text)) == text
        if "▁" not in text:
            assert ids == library.encode(text)
    assert pieces.ids_of(None) == b""


def test_search_commits_early_and_keeps_a_short_window(pieces, words):
    text = "▁" + words(300, 3).replace(" ", "▁")
    search, out, longest = pieces.search(), [], 0
    for char in text:
        out += search.feed(char)
        longest = max(longest, len(search.window))
    assert len(out) > 500 and longest <= 5 * pieces.longest
    assert [*out, *search.finish()] == pieces.merged_ids(text)


def best_path(model, text):
    """Unigram Viterbi over the whole text at once."""
    best = [(0.0, None, None)] + [(-math.inf, None, None)] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            number = model.ids.get(text[start:end])
            score = model.scores[number] if number is not None else model.lowest if end == start + 1 else None
            if score is not None and best[start][0] + score > best[end][0]:
                best[end] = (best[start][0] + score, start, number)
    return best[len(text)][0]


def test_unigram_search_finds_the_best_sum(words):
    model = sentencepiece_viterbi.PieceModel(sentencepiece_viterbi.MODEL, "unigram")
    for text in ("▁" + words(12, 4).replace(" ", "▁"), "▁the▁thing", "zzzzzzzzzzzzzzzzzzzzzzzz", "▁𝄞x"):
        ids = [*(search := model.search()).feed(text), *search.finish()]
        known = [number for number in ids if number in model.pieces]
        unknown = sum(char not in model.ids for char in text)
        assert sum(model.scores[number] for number in known) + unknown * model.lowest == pytest.approx(best_path(model, text))


def test_encode_and_decode_tables(docs_of, awkward, empty):
    coded = sentencepiece_viterbi.encode(docs_of(ODD_TEXTS))
    assert "text" not in coded.columns
    back = {row["doc_id"]: row["text"] for row in sentencepiece_viterbi.decode(coded).collect()}
    assert back == dict(enumerate(ODD_TEXTS))
    assert sentencepiece_viterbi.encode(empty).collect() == [] and sentencepiece_viterbi.digest(empty).collect() == []
    rows = sentencepiece_viterbi.digest(awkward).collect()
    assert len(rows) == awkward.count() and all(row["round_trip"] for row in rows)
    clash = awkward.withColumns({"ids": F.lit("x"), "_ids": F.lit(1), "_in0": F.lit(2)})
    assert sorted(sentencepiece_viterbi.encode(clash).columns) == sorted({*clash.columns} - {"text"})


@pytest.mark.parametrize("size", [0, 1, 100, 1000, 5000])
def test_id_coder_round_trip(size):
    random_ids = np.random.default_rng(size)
    for ids in (random_ids.integers(0, 50257, size), random_ids.zipf(1.3, size) % 900, np.tile([5, 9, 5, 2], size)[:size]):
        ids = ids.astype(np.int32)
        image = Image(write_image(["1", None, "a\nb\\n"], [size, 0, 0], ids, block=700))
        assert (image.ids() == ids).all() and image.names == ["1", None, "a\nb\\n"]
        if size == 5000:
            assert (image.blocks([3])[0] == ids[2100:2800]).all()


def test_id_coder_learns_and_notices_damage():
    ids = np.tile(np.random.default_rng(1).integers(0, 50000, 60), 100).astype(np.int32)
    data = write_image(["x"], [len(ids)], ids)
    assert len(data) < len(ids)
    for place in (3, 40, len(data) - 100):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises(ValueError):
            Image(bytes(broken)).ids()


def test_text_encoder_is_the_tokenizer(words):
    plain = Tokenizer.from_file(token_files.TOKENIZER)
    encoder = token_files.TextEncoder(token_files.TOKENIZER)
    for text in [*ODD_TEXTS, words(200, 1), words(20, 2) + "\n" + words(20, 3) + ".\n'Tis 12,5 of it x 　y"]:
        assert np.frombuffer(encoder.ids_of(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_token_files(docs_of, awkward, empty, words, tmp_path):
    plain = Tokenizer.from_file(token_files.TOKENIZER)
    rows = [(place * 5 % 83, words(place % 30, place), "s") for place in range(83)] + [(90, None, "s"), (91, "", "s")]
    found = {row["doc_id"]: row for row in token_files.token_rows(docs_of(rows).repartition(3), folder=str(tmp_path / "ids"), image_ids=400).collect()}
    start = 0
    for key, text, _ in sorted(rows, key=lambda row: row[0]):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        assert (found[key]["start"], found[key]["n_tokens"]) == (start, len(ids))
        assert found[key]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert token_files.token_rows(empty).collect() == []
    odd = token_files.token_rows(awkward).collect()
    assert len(odd) == awkward.count() and sorted(row["start"] for row in odd)[0] == 0


def plain_base(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            valid = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
            if least <= len(digits) <= most and (valid or kind == "phone"):
                found.append((kind, *m.span()))
    return found


PRIVATE = [
    "mail a.b@x-y.co.uk, c@d or e@f.gg now", "at 10.0.0.1 and 300.1.1.1 or 1.2.3.4.5.6", "card 4111 1111 1111 1111 and 4111 1111 1111 1112",
    "call +1 (738) 555-4493 or +1", "+49 30 123456789012345", "4732500337014340 x 47-3250", "é ü me@ex.org é", "no data here at all", "1.2.3", "+12 34",
]


def test_base_spans_against_plain_patterns(words):
    for text in PRIVATE:
        assert pii.base_spans(text) == plain_base(text)


def test_added_spans():
    models = pii.trained()
    kinds = lambda text: [(one[0], text[one[1] : one[2]]) for one in pii.spans_of(text, models) if not one[3]]
    assert kinds("please write to jane.doe (at) mailbox [dot] org today") == [("email", "jane.doe (at) mailbox [dot] org")]
    assert ("phone", "(738) 555-4493") in kinds("call me on (738) 555-4493 please")
    for clean in ("licensed under version 2.0.1 of the text", "published 2024-10-11, page 1234567", "we met at the dot com fair",
                  "Creative Commons BY-NC 4.0 and 3.0", "order 12345678 of 2019"):
        assert pii.spans_of(clean, models) == []
    for text in PRIVATE:
        spans = pii.spans_of(text, models)
        assert [one[:3] for one in spans if one[3]] == plain_base(text)
        added = [one for one in spans if not one[3]]
        assert all(a[2] <= b[1] or b[2] <= a[1] for a in added for b in spans if a is not b)


def test_models_hold_on_fresh_examples():
    models = pii.trained()
    right = wrong = 0
    for text, kind, start, end in pii._examples(1200, seed=99):
        found = [one for one in pii.spans_of(text, models)]
        hit = any(one[0] == kind and min(one[2], end) - max(one[1], start) >= 0.8 * (end - start) for one in found)
        right += bool(kind) and hit
        wrong += kind is None and bool([one for one in found if not one[3]])
    assert right > 480 and wrong < 20


def test_boosted_trees_learn_a_band():
    rows = np.random.default_rng(2).random((2000, 3))
    labels = ((rows[:, 0] > 0.3) & (rows[:, 1] < 0.6)).astype(float)
    model = boosting.fit(rows[:1500], labels[:1500])
    held = model.probability(rows[1500:])
    assert ((held > 0.5) == labels[1500:]).mean() > 0.95
    edge = boosting.threshold_for(held, labels[1500:], 0.99)
    assert labels[1500:][held >= edge].mean() >= 0.99


def test_spans_and_redaction_of_tables(docs_of, awkward, empty):
    found = {row["doc_id"]: row for row in pii.span_digest(pii.find_spans(docs_of(PRIVATE))).collect()}
    assert (found[0]["n_email"], found[1]["n_ip"], found[2]["n_card"], found[3]["n_phone"]) == (2, 2, 1, 1)
    clean = {row["doc_id"]: row["text"] for row in pii.redact(docs_of(PRIVATE)).collect()}
    assert clean[6] == "é ü [EMAIL] é" and clean[7] == PRIVATE[7]
    assert pii.redact(empty).collect() == [] and pii.find_spans(empty).collect() == []
    odd = pii.redact(awkward.withColumns({"spans": F.lit(1), "_null": F.lit(2), "_spans": F.lit("x")}))
    rows = {row["doc_id"]: row["text"] for row in odd.collect()}
    assert rows[1] is None and rows[10].endswith("mail [EMAIL] now")
    assert pii.redacted("abcdef", [("ip", 1, 4, True, 1.0), ("card", 3, 5, True, 1.0)]) == "a[IP]f"


def toxic_rows(words, count=400):
    pick = random.Random(8)
    bad = ("scum", "idiot", "trash", "moron")
    rows = []
    for place in range(count):
        toxic = place % 4 == 0
        text = words(40, place) + (" " + " ".join(pick.sample(bad, 2)) if toxic else "") + " " + words(20, place + 9000)
        rows.append((place, text, "s", int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark, docs_of, words, empty):
    rows = toxic_rows(words)
    docs = docs_of([row[:3] for row in rows])
    labels = spark.createDataFrame([(row[0], row[3]) for row in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    found = {row["doc_id"]: row for row in toxicity.score(docs, model).collect()}
    for key, _, _, toxic in rows:
        assert found[key]["held_out"] == (zlib.crc32(str(key).encode()) % 3 == 1)
        assert found[key]["predicted"] == toxic and 0 <= found[key]["score"] <= 1
    train_ids = {str(key) for key, *_ in rows if zlib.crc32(str(key).encode()) % 3 != 1}
    assert all(one["example"] in train_ids for row in found.values() for one in row["evidence"])
    none = toxicity.train(docs, labels.limit(0))
    assert {row["score"] for row in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty, model).collect() == []
    assert toxicity.train(empty, labels).index is None


def test_toxicity_against_plain_cosines(spark, docs_of, words):
    rows = toxic_rows(words, 160)
    texts, labels = {key: text for key, text, *_ in rows}, {key: toxic for key, _, _, toxic in rows}
    model = toxicity.train(docs_of([row[:3] for row in rows]), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    found = {row["doc_id"]: row for row in toxicity.score(docs_of([row[:3] for row in rows]), model).collect()}
    counts = {key: toxicity.terms_of(text) for key, text in texts.items()}
    sample = [key for key in texts if zlib.crc32(str(key).encode()) % 3 != 1]
    bad = sum(labels[key] for key in sample)
    clean, weight = len(sample) - bad, {}
    for term in {term for key in sample for term in counts[key]}:
        a = sum(term in counts[key] for key in sample if labels[key])
        b = sum(term in counts[key] for key in sample if not labels[key])
        chi2 = len(sample) * (a * (clean - b) - b * (bad - a)) ** 2 / (clean * bad * max((a + b) * (len(sample) - a - b), 1))
        weight[term] = (math.log((1 + len(texts)) / (1 + sum(term in one for one in counts.values()))) + 1) * math.sqrt(1 + chi2)
    vectors = {}
    for key, own in counts.items():
        vector = {term: (1 + math.log(n)) * weight[term] for term, n in own.items() if term in weight}
        length = math.sqrt(sum(value * value for value in vector.values()))
        vectors[key] = {term: value / length for term, value in vector.items()}
    votes = []
    for key, own in vectors.items():
        cosines = {other: sum(value * vectors[other].get(term, 0.0) for term, value in own.items()) for other in sample}
        near = sorted((value for value in cosines.values() if value > 1e-12), reverse=True)[: toxicity.NEIGHBOURS]
        assert [one["cosine"] for one in found[key]["evidence"]] == pytest.approx(near)
        assert all(cosines[int(one["example"])] == pytest.approx(one["cosine"]) for one in found[key]["evidence"])
        pulls = [(1 / (1.1 - min(one["cosine"], 1.0)), labels[int(one["example"])]) for one in found[key]["evidence"]]
        votes.append((sum(pull for pull, toxic in pulls if toxic) / sum(pull for pull, _ in pulls), found[key]["score"]))
    votes.sort()
    assert all(first[1] <= second[1] + 1e-9 for first, second in zip(votes, votes[1:]) if second[0] > first[0] + 1e-9)


def test_block_max_search_is_exact():
    pick = np.random.default_rng(4)
    idf = 1 + pick.random(40)
    rows = [(place, place % 2, {int(term): int(pick.integers(1, 4)) for term in pick.choice(40, pick.integers(0, 8), False)}) for place in range(700)]
    index = toxicity.BlockMaxIndex.build([f"t{n}" for n in range(40)], idf, rows)
    dense = np.zeros((700, 40))
    for place, (_, _, counts) in enumerate(rows):
        numbers, weights = toxicity.unit_vector(counts, idf)
        dense[place, numbers] = weights
    for _ in range(60):
        numbers, weights = toxicity.unit_vector({int(term): 1 for term in pick.choice(40, pick.integers(1, 6), False)}, idf)
        cosines = dense[:, numbers] @ weights
        want = [int(place) for place in np.lexsort((np.arange(700), -np.round(cosines, 12)))[:10] if cosines[place] > 0]
        places, got = index.nearest(numbers, weights, 10)
        assert places.tolist() == want and np.allclose(got, cosines[want])


def test_toxicity_on_odd_input(spark, awkward):
    labels = spark.createDataFrame([(key, key % 2) for key in (1, 2, 4, 5, 7, 8, 9, 10)] * 2, "doc_id long, toxic int")
    clash = awkward.withColumns({"score": F.lit("x"), "evidence": F.lit(1), "key": F.lit(2), "held_out": F.lit(3)})
    rows = toxicity.score(clash, toxicity.train(clash, labels)).collect()
    assert len(rows) == awkward.count() and all(0 <= row["score"] <= 1 for row in rows)


def plain_lm(rows):
    split = {key: re.findall(WORD, re.sub("[A-Z]", lambda letter: letter[0].lower(), text or "")) + [None] for key, text, _ in rows}
    held = {key: zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1 for key in split}
    counts = Counter(word for key, found in split.items() if not held[key] for word in found)
    total = sum(counts.values())
    log = lambda word: math.log10((counts[word] + 0.5) / (total + 0.5 * (len(counts) + 1)))
    return {key: (held[key], len(found), sum(counts[word] > 0 for word in found), total, sum(map(log, found))) for key, found in split.items()}


@pytest.mark.parametrize("frequent", [100_000, 5])
def test_lm_base_against_plain_counts(docs_of, words, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "BROADCAST_WORDS", frequent)
    rows = [(place, f"The cat {words(place % 25, place % 7)} sat.\nThe Cat É", "s") for place in range(60)] + [(70, None, "s"), (71, "", "s"), (72, words(900, 5), "s")]
    found = {row["doc_id"]: row for row in lm_scoring.lm_scores(docs_of(rows)).collect()}
    for key, (held, tokens, known, total, base) in plain_lm(rows).items():
        row = found[key]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (held, tokens, known, total)
        assert row["base_score"] == pytest.approx(base) and row["score"] < 0
    assert found[70]["score"] == pytest.approx(found[71]["score"])


def test_lm_on_odd_input(awkward, empty):
    assert lm_scoring.lm_scores(empty).collect() == []
    clash = awkward.withColumns({"score": F.lit("x"), "_row": F.lit(1), "word": F.lit(2), "_held": F.lit(3)})
    assert lm_scoring.lm_scores(clash).count() == awkward.count()
    held = lm_scoring.lm_scores(awkward.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")).collect()
    assert all(row["train_tokens"] == 0 for row in held)


def test_every_place_is_scored_once():
    sizes = np.array([0, 1, 31, 32, 33, 56, 57, 200, 7])
    text, start, scored = attention.window_plan(sizes)
    seen = [Counter() for _ in sizes]
    for own, first, since in zip(text, start, scored):
        end = min(first + attention.WINDOW, sizes[own])
        seen[own].update(range(since, end))
        assert since == 0 or since - first == attention.WINDOW - attention.STRIDE
    assert [sorted(one.elements()) for one in seen] == [list(range(size)) for size in sizes]


def test_attention_gradients_and_causality():
    pick = np.random.default_rng(0)
    counts = np.zeros(lm_scoring.IDS)
    counts[:3000] = 1 / np.arange(1, 3001)
    vocabulary = attention.Vocabulary.from_counts(counts * 1e6)
    weights = {name: value.astype(np.float64) for name, value in attention.fresh(vocabulary).items()}
    inputs, targets = pick.integers(0, attention.INPUTS, (3, attention.WINDOW)), pick.integers(0, attention.CLASSES, (3, attention.WINDOW))

    def loss():
        hidden, _ = attention._forward(weights, inputs)
        return -attention._class_log(weights, hidden.reshape(-1, attention.WIDTH), targets.reshape(-1)).mean()

    slopes = attention._gradients(weights, inputs, targets)
    for name, value in weights.items():
        place = (inputs[0, 3], 2) if name == "embed" else tuple(pick.integers(0, size) for size in value.shape)
        kept = value[place]
        value[place] = kept + 1e-5
        high = loss()
        value[place] = kept - 1e-5
        assert slopes[name][place] == pytest.approx((high - loss()) / 2e-5, rel=1e-4, abs=1e-9)
        value[place] = kept
    before, _ = attention._forward(weights, inputs)
    inputs[:, 20:] = 1
    after, _ = attention._forward(weights, inputs)
    assert np.allclose(before[:, :20], after[:, :20])
    # Chances of all ids add up to one.
    share = 10.0 ** vocabulary.log_share.astype(float)
    assert np.bincount(vocabulary.class_of, share, attention.CLASSES)[np.unique(vocabulary.class_of)] == pytest.approx(1.0, abs=1e-4)


def test_scores_are_those_of_the_plain_model(words):
    pick = np.random.default_rng(5)
    counts = np.zeros(lm_scoring.IDS)
    counts[:3000] = 1e6 / np.arange(1, 3001)
    vocabulary = attention.Vocabulary.from_counts(counts)
    weights = attention.fresh(vocabulary)
    sizes = np.array([1, 0, 5, 32, 33, 140, 32 + 26, 7])
    ids = pick.integers(0, lm_scoring.IDS, sizes.sum()).astype(np.int32)
    found = attention.score_texts(attention.Scorer(weights), vocabulary, ids, sizes, lm_scoring.END_ID)
    begins = np.cumsum(sizes) - sizes
    want = np.zeros(len(sizes))
    for text, start, scored in zip(*attention.window_plan(sizes)):
        own = ids[begins[text] : begins[text] + sizes[text]]
        before = np.concatenate(([lm_scoring.END_ID], own[:-1]))[start : start + attention.WINDOW]
        hidden, _ = attention._forward(weights, vocabulary.input_of[before][None])
        targets = own[start : start + attention.WINDOW]
        logs = attention._class_log(weights, hidden[0], vocabulary.class_of[targets]) / np.log(10) + vocabulary.log_share[targets]
        want[text] += logs[scored - start :].sum()
    assert found == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_word_ids_are_the_tokenizers(words):
    plain, known = Tokenizer.from_file(token_files.TOKENIZER), lm_scoring.word_ids(lm_scoring.TOKENIZER)
    for word in [*words(200, 3).split(), "é,", "it's", "日本", "x=1;", "\u00a0", "<|endoftext|>"]:
        if word != "<|endoftext|>":
            assert np.frombuffer(known[word.encode()], "<u4").tolist() == plain.encode(" " + word, add_special_tokens=False).ids


def test_training_beats_id_frequencies_on_held_out_text():
    pick = random.Random(3)
    follow = {n: [pick.randrange(60) for _ in range(3)] for n in range(60)}

    def text(size):
        ids = [pick.randrange(60)]
        while len(ids) < size:
            ids.append(pick.choice(follow[ids[-1]]))
        return np.array(ids, np.int32)

    train, held = text(33 * 1500), text(4000)
    counts = np.bincount(train, minlength=lm_scoring.IDS).astype(float)
    vocabulary = attention.Vocabulary.from_counts(counts)
    weights = attention.fresh(vocabulary)
    for _ in range(3):
        weights = attention.train(weights, vocabulary, train.reshape(-1, 33))
    score = attention.score_texts(attention.Scorer(weights), vocabulary, held, np.array([len(held)]), lm_scoring.END_ID)[0]
    frequency = np.log10((counts + 0.5) / (counts + 0.5).sum())[held].sum()
    assert score > 0.75 * frequency


def test_every_id_is_trained_on_once(words, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HELD_WINDOWS", 7)
    texts = [words(3000, 4), "", None, words(32, 5), words(5, 6)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(lm_scoring.training_windows(iter([batch]), lm_scoring.TOKENIZER))
    assert max(map(len, parts)) <= 7
    found = Counter(np.concatenate(parts)[:, 1:].reshape(-1).tolist())
    want = Counter(one for text in texts for one in lm_scoring.ids_in(lm_scoring.words_in(text), lm_scoring.TOKENIZER).tolist())
    del found[lm_scoring.END_ID], want[lm_scoring.END_ID]       # also fills up windows
    assert found == want


def test_least_context_and_rare_ids():
    sizes = np.array([500])
    _, start, scored = attention.window_plan(sizes)
    assert (scored - start)[1:].min() >= attention.WINDOW // 2
    vocabulary = attention.Vocabulary.from_counts(1e6 / np.arange(1, lm_scoring.IDS + 1))
    assert len(set(vocabulary.input_of[:8000].tolist())) == 8000
    assert len(set(vocabulary.class_of.tolist())) == attention.CLASSES and attention.CLASSES > 128


def test_evidence_is_json_friendly(spark, docs_of, words):
    docs = docs_of([row[:3] for row in toxic_rows(words, 120)])
    labels = spark.createDataFrame([(row[0], row[3]) for row in toxic_rows(words, 120)], "doc_id long, toxic int")
    row = toxicity.score(docs, toxicity.train(docs, labels)).select(F.to_json("evidence").alias("j")).where("j <> '[]'").first()
    assert json.loads(row["j"])[0]["cosine"] <= 1.0000001
