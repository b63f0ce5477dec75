"""Words cut out of many texts at once, and what op10 makes of them."""

import numpy as np
import pyarrow as pa

from tokenizers import Tokenizer

from tabwright.llm import attention, lm_scoring, token_files, word_arrays

TEXTS = ["The  Cat\tsat", None, "", " \n", "É ÀB x y\u0085z", "a\x0bb\x0cc\r\nd\x1ce", "one", "Two one ", " lead two", "日本 語 𝄞Z", ""]


def test_words_are_those_of_each_text():
    for texts in (pa.array(TEXTS), pa.array(["zz y", *TEXTS, "end"]).slice(1, len(TEXTS)), pa.array([None, ""], pa.string())):
        numbers, words, sizes = word_arrays.lower_words(texts)
        found = np.split(np.array([words[number] for number in numbers], object), np.cumsum(sizes)[:-1])
        assert [one.tolist() for one in found] == [lm_scoring.words_in(text) for text in texts.to_pylist()]
        assert len(set(words)) == len(words)


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(word_arrays, "SLICE_BYTES", 9)
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS), pa.array(range(len(TEXTS)))], ["text", "n"])
    parts = list(word_arrays.slices(batch, "text"))
    assert len(parts) > 4 and sum((part.column(1).to_pylist() for part in parts), []) == list(range(len(TEXTS)))
    assert sum((part.column(0).to_pylist() for part in parts), []) == TEXTS


def test_staged_ids_give_the_windows_of_their_texts():
    texts = pa.RecordBatch.from_arrays([pa.array(TEXTS)], ["text"])
    ids = [lm_scoring.ids_in(lm_scoring.words_in(text), lm_scoring.TOKENIZER).astype("<u2").tobytes() for text in TEXTS]
    from_texts, from_ids = (np.concatenate(list(lm_scoring.training_windows(iter([batch]), lm_scoring.TOKENIZER)))
                            for batch in (texts, pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])))
    assert np.array_equal(from_texts, from_ids)


def test_classes_by_groups_add_up_to_one():
    pick = np.random.default_rng(2)
    vocabulary = attention.Vocabulary.from_counts(1e6 / np.arange(1, lm_scoring.IDS + 1))
    weights = attention.fresh(vocabulary)
    assert attention.CLASSES >= 512 and attention.GROUPS + attention.MEMBERS < 64
    for hidden in (pick.standard_normal((1, attention.WIDTH)), np.full((1, attention.WIDTH), 300.0)):
        chances = np.exp(attention._class_log(weights, np.repeat(hidden, attention.CLASSES, axis=0).astype(np.float32), np.arange(attention.CLASSES)))
        assert abs(chances.sum() - 1) < 1e-3


def test_ids_of_many_texts_look_each_unit_up_once():
    plain, encoder = Tokenizer.from_file(token_files.TOKENIZER), token_files.TextEncoder(token_files.TOKENIZER)
    texts = [*TEXTS, "two  blanks", " a", "a ", "\nb", "b\n", "a\n b", "a\tb c", "a\u3000b\u00a0 c", "ü ü é\u0085x", "it's 12 (three), x1.", "\n", " ", "\n\n"]
    ids, sizes = encoder.ids_of_all(pa.array(texts), 0)
    found = [one.tolist() for one in np.split(ids, np.cumsum(sizes)[:-1])]
    assert found == [[*plain.encode(text or "", add_special_tokens=False).ids, 0] for text in texts]
    asked = []
    encoder.units.tokenizer = type("Counting", (), {"encode": lambda _, text, **more: asked.append(text) or plain.encode(text, **more)})()
    encoder.ids_of_all(pa.array(["q1 q1 q1", "z q1"] * 20), 0)
    assert sorted(asked) == [" q1", "q1"]
