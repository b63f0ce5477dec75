"""Long runs, long secrets and many spans in the search for personal data."""

import random
import time

from test_text_models import plain_base

from tabwright.llm import pii


def test_base_spans_against_plain_patterns_on_random_text():
    pick = random.Random(3)
    for _ in range(3000):
        text = "".join(pick.choices("ab1234@@..-+_% ()é", k=pick.randint(0, 40)))
        assert pii.base_spans(text) == plain_base(text), text


def test_taken_against_a_plain_list():
    pick = random.Random(4)
    for _ in range(300):
        spans = [(start, start + pick.randint(1, 6)) for start in (pick.randrange(60) for _ in range(pick.randint(0, 8)))]
        taken = pii.Taken(spans)
        for _ in range(40):
            start = pick.randrange(60)
            end = start + pick.randint(1, 5)
            free = all(end <= a or b <= start for a, b in spans)
            assert taken.free(start, end) == free
            if free and pick.random() < 0.3:
                taken.add(start, end)
                spans.append((start, end))


def test_long_secrets_are_redacted_whole():
    models, pick = pii.trained(), random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for size in (40, 480, 5000):
        token = "".join(pick.choices(letters, k=size))
        for lead in ("token=", "the api_key: "):
            text = f"plain words here {lead}{token} and more words"
            spans = pii.spans_of(text, models)
            assert [(one[0], one[1], one[2]) for one in spans] == [("secret", text.index(token), text.index(token) + size)]
            assert pii.redacted(text, spans) == f"plain words here {lead}[SECRET] and more words"


def test_long_runs_and_many_spans_take_linear_time():
    models, pick = pii.trained(), random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    run = "".join(pick.choices(letters, k=1_000_000))
    many = " ".join(f"user{place}@host{place}.example.org 10.0.{place % 256}.7 call +1 738 555 {1000 + place % 9000}" for place in range(10_000))
    for text in (f"{run} me@ex.org {run}", "7" * 1_000_000 + " me@ex.org", many):
        started = time.perf_counter()
        assert pii.spans_of(text, models)
        assert time.perf_counter() - started < 60
