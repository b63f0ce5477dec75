"""Personal data: fixed patterns, and further spans that boosted trees pick from wide candidate generators.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always
stay.  The generators also propose what the patterns miss or refuse: written-out
mail addresses, numbers of many formats, dotted quads with marks, keys and
passwords.  A boosted model per kind scores each candidate by its format and its
context; thresholds fitted on held-out examples select what is added.  Added
spans overlap neither base spans nor each other.

The models are trained on examples made here from public formats (a bounded
number, seeded); nothing is learned from the documents.

Defined cases: a null text is empty and has no spans; an empty table gives an
empty result; repeated rows have equal spans.  Output columns replace input
columns of the same name.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.boosting import Boosted, fit, threshold_for
from tabwright.llm.common import mapped, sheltered

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
EXAMPLES = 6000
PRECISION = 0.995

# The base patterns.  An e-mail is looked for from its @, an address from the
# beginning of its first number: the leftmost match begins there, and long runs stay linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WRITTEN_MAIL = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?(?:[\[({<] ?(?:at|AT) ?[\])}>]| at |@) ?[A-Za-z0-9-]{1,63}"
    r"(?:(?: ?[\[({<] ?(?:dot|DOT) ?[\])}>] ?| dot |\.)[A-Za-z0-9-]{1,63}){1,4}")
MARKED_IP = re.compile(r"[0-9]{1,4}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,4}){3}")
NUMBER = re.compile(r"(?:\+|\(|00)?[0-9](?:[ ().\-/]{0,2}[0-9]){6,21}")
ASSIGNED = re.compile(r"(?i:passw(?:or)?d|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?([^\s\"',;]{6,})")
KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9_-]{16,}+(?![A-Za-z0-9+/_=-])")
ANY_HINT = re.compile(r"[0-9@]|[\[({<] ?(?:at|AT) ?[\])}>]| dot |(?i:passw|pwd|secret|token)")

CONTEXT = 40
# A longer candidate is judged by so many of its first characters; its span is always whole.
JUDGED = 200
CUES = {
    "phone": ("tel", "phone", "call", "mobile", "fax", "whatsapp", "cell", "ring", "sms"),
    "email": ("mail", "contact", "write", "reach", "send"),
    "card": ("card", "visa", "credit", "payment", "mastercard", "amex", "paid"),
    "ip": ("ip", "host", "server", "addr", "client", "login", "ping"),
    "secret": ("password", "passwd", "pwd", "token", "secret", "key", "credential"),
    "other": ("version", "license", "licence", "section", "page", "isbn", "date", "year", "invoice", "order", "price", "id", "no.", "sha", "commit", "table"),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses: what stands before each @, and a domain behind it."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


class Taken:
    """Spans in use, as a sorted list of their unions."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start)
        return (not at or self.ends[at - 1] <= start) and (at == len(self.starts) or self.starts[at] >= end)

    def add(self, start: int, end: int) -> None:
        at = bisect_right(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind, then start."""
    found = []
    found += [("email", *span) for span in emails(text)]
    if not re.search("[0-9]", text):
        return found
    found += [("ip", *match.span()) for match in IP.finditer(text)
              if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split("."))]
    for match in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", match[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        found += [("phone", *match.span()) for match in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", match[0])) <= 15]
    return found


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Proposed spans, overlapping ones included; a number is proposed as phone and as card."""
    if not ANY_HINT.search(text):
        return []
    found = [("email", *match.span()) for match in WRITTEN_MAIL.finditer(text)]
    found += [("ip", *match.span()) for match in MARKED_IP.finditer(text)]
    for match in NUMBER.finditer(text):
        found += [("phone", *match.span()), ("card", *match.span())]
    found += [("secret", *match.span(1)) for match in ASSIGNED.finditer(text)]
    found += [("secret", *match.span()) for match in KEY.finditer(text) if any(c.isdigit() for c in match[0])]
    return list(dict.fromkeys(found))


def features(text: str, start: int, end: int) -> list[float]:
    """Format of the span and cues in the text around it."""
    span = text[start : min(end, start + JUDGED)]
    before, after = text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    size = len(span)
    digits = "".join(c for c in span if c.isdigit() and c.isascii())
    upper, lower = sum(c.isupper() for c in span), sum(c.islower() for c in span)
    groups = [len(run) for run in re.findall("[0-9]+", span)]
    changes = sum((a.isdigit() != b.isdigit()) for a, b in zip(span, span[1:]))
    values = [
        size, len(digits), len(digits) / size, upper / size, lower / size, changes / size, len(set(span)) / size,
        span.count("."), span.count("-"), span.count(" "), span.count("/"), span.count("@"), span.count("("),
        float(span.startswith("+")), float(span.startswith(("(", "00"))),
        len(groups), max(groups, default=0), min(groups, default=0), float(bool(digits) and luhn(digits)),
        float(bool(groups) and all(int(run) <= 255 for run in re.findall("[0-9]{1,9}", span))),
        float(all(c in "0123456789abcdefABCDEF" for c in span)), float(span[:1].isupper()),
        float(bool(re.search(r"(?i)\bat\b|@", span))), float(bool(re.search(r"(?i)\bdot\b|\.", span))),
        float(bool(re.search(r"[\[({<] ?(?:at|AT) ?[\])}>]", span))),
        float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(bool(re.search(r"[=:]\s?[\"']?$", before))), float(before.rstrip()[-1:] in "$€£#"),
    ]
    for words in CUES.values():
        spots = [before.rfind(word) for word in words]
        values.append(float(CONTEXT - max(spots)) if max(spots) >= 0 else 99.0)
        values.append(float(any(word in after for word in words)))
    return values


def _examples(count: int, seed: int) -> list[tuple[str, str | None, int, int]]:
    """(text, kind or None, start, end): personal data and look-alikes among plain words."""
    pick = Random(seed)
    letters, alnum = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda least=2, most=10: "".join(pick.choice(letters) for _ in range(pick.randint(least, most)))
    number = lambda size: "".join(pick.choice("0123456789") for _ in range(size))
    cue = lambda kind: pick.choice(CUES[kind])

    def card_number(valid: bool) -> str:
        body = pick.choice("3456") + number(pick.choice((14, 14, 14, 15, 17)))
        check = next(d for d in "0123456789" if luhn(body + d) == valid)
        return body + check

    def spaced(digits: str, mark: str) -> str:
        return mark.join(digits[at : at + 4] for at in range(0, len(digits), 4))

    def positive(kind: str) -> tuple[str, str]:
        if kind == "email":
            at = pick.choice(("@", "@", " (at) ", " [at] ", "(at)", " at ", " @ ", " {at} "))
            dot = pick.choice((" dot ", " (dot) ", " [dot] ")) if at == " at " else pick.choice((".", ".", " [dot] ", "(dot)"))
            return word() + pick.choice(("", ".", "_")) + word() + at + word(3) + dot + pick.choice(("com", "org", "net", "de", "co.uk")), ""
        if kind == "ip":
            mark = pick.choice((".", "[.]", "(.)"))
            return mark.join(str(pick.randint(0, 255)) for _ in range(4)), pick.choice(("", cue("ip") + " "))
        if kind == "card":
            digits = card_number(True)
            shape = pick.choice((digits, spaced(digits, " "), spaced(digits, "-"), spaced(digits, ".")))
            return shape, pick.choice(("", cue("card") + " ", cue("card") + ": "))
        if kind == "phone":
            a, b, c = number(3), number(3), number(4)
            shape = pick.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{pick.randint(1, 99)} {a} {b} {c}", f"{a}.{b}.{c}", f"00{pick.randint(1, 99)} {a} {b}{c}", f"0{a} {b}{c}", f"+1 ({a}) {b}-{c}"))
            sure = shape.startswith(("+", "(")) or pick.random() < 0.1
            return shape, "" if sure else cue("phone") + pick.choice((" ", ": ", " me on ", " at "))
        key = pick.choice((
            "AKIA" + "".join(pick.choice(alnum[:26] + alnum[52:]) for _ in range(16)),
            "".join(pick.choice("0123456789abcdef") for _ in range(pick.choice((18, 32, 40, 64)))),
            "".join(pick.choice(alnum) for _ in range(pick.randint(16, 40))),
        ))
        lead = "" if key.startswith("AKIA") else cue("secret") + pick.choice(("=", " = \"", ": ", "='", "="))
        return key, lead

    def look_alike() -> tuple[str, str]:
        return pick.choice((
            lambda: (f"{number(1)}.{number(1)}.{number(2)}.{number(4)}", "version "),
            lambda: (".".join(str(pick.randint(256, 999)) for _ in range(4)), ""),
            lambda: (f"20{number(2)}-{pick.randint(10, 12)}-{pick.randint(10, 28)}", pick.choice(("", "date "))),
            lambda: (f"{pick.randint(10, 28)}/{pick.randint(10, 12)}/20{number(2)} {pick.randint(10, 23)}", ""),
            lambda: (number(pick.randint(7, 22)), pick.choice(("", "order ", "invoice ", "id ", "no. "))),
            lambda: (card_number(False), pick.choice(("", "order ", "invoice ", "card "))),
            lambda: (spaced(card_number(False), " "), ""),
            lambda: (f"{number(3)} {number(3)} {number(3)}", pick.choice(("", "price ", "page "))),
            lambda: (f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", "isbn "),
            lambda: (f"19{number(2)}-20{number(2)} 20{number(2)}", ""),
            lambda: ("".join(pick.choice("0123456789abcdef") for _ in range(40)), pick.choice(("commit ", "sha "))),
            lambda: (word(6) + "-" + word(6) + "-" + number(3), ""),
            lambda: (word(8) + "_" + word(8) + number(1), ""),
            lambda: (word(12, 24) + number(2), ""),
            lambda: (f"{word()} at {word()}. {word()}", ""),
            lambda: (f"{word()} at {word()} dot {word()} {word()}"[:18], ""),
            lambda: (" ".join(number(1) for _ in range(pick.randint(7, 12))), "table "),
            lambda: (word() + "@" + word(), ""),
        ))()

    found = []
    for place in range(count):
        kind = pick.choice(KINDS) if place % 2 else None
        span, lead = positive(kind) if kind else look_alike()
        text = " ".join(word() for _ in range(pick.randint(0, 8))) + " " + lead
        start = len(text)
        quote = '"' if lead.endswith('"') else "'" if lead.endswith("'") else ""
        text += span + quote + pick.choice((" ", " ", ".", ", ")) + " ".join(word() for _ in range(pick.randint(0, 8)))
        found.append((text, kind, start, start + len(span)))
    return found


@lru_cache(maxsize=1)
def trained(examples: int = EXAMPLES, precision: float = PRECISION) -> dict[str, tuple[Boosted, float]]:
    """Per kind the model and its threshold.  Even examples train, odd pairs calibrate."""
    rows = {kind: ([], [], []) for kind in KINDS}
    for number, (text, kind, start, end) in enumerate(_examples(examples, seed=7)):
        for proposed, begin, stop in candidates(text):
            hit = proposed == kind and min(stop, end) - max(begin, start) >= 0.8 * max(end - start, stop - begin)
            for column, value in zip(rows[proposed], (features(text, begin, stop), float(hit), number % 4 >= 2)):
                column.append(value)
    models = {}
    for kind, (values, labels, held) in rows.items():
        values, labels, held = np.array(values), np.array(labels), np.array(held)
        model = fit(values[~held], labels[~held])
        models[kind] = (model, threshold_for(model.probability(values[held]), labels[held], precision))
    return models


def spans_of(text: str, models: dict[str, tuple[Boosted, float]]) -> list[tuple[str, int, int, bool, float]]:
    """(kind, start, end, base, score) by kind as listed, then start."""
    if not ANY_HINT.search(text):
        return []
    base = base_spans(text)
    taken = Taken([(start, end) for _, start, end in base])
    chosen = [(kind, start, end, True, 1.0) for kind, start, end in base]
    scored = []
    proposed = [one for one in candidates(text) if taken.free(*one[1:])]
    for kind in KINDS:
        own = [one for one in proposed if one[0] == kind]
        if own:
            model, threshold = models[kind]
            scores = model.probability(np.array([features(text, start, end) for _, start, end in own]))
            scored += [(-score, start, end, kind) for (_, start, end), score in zip(own, scores) if score >= threshold]
    for score, start, end, kind in sorted(scored):
        if taken.free(start, end):
            taken.add(start, end)
            chosen.append((kind, start, end, False, float(-score)))
    return sorted(chosen, key=lambda one: (KINDS.index(one[0]), one[1]))


def redacted(text: str, spans: list[tuple[str, int, int, bool, float]]) -> str:
    """The text with each span, or union of overlapping spans, replaced by its kind in brackets."""
    out, at, until = [], 0, 0
    for kind, start, end, *_ in sorted(spans, key=lambda one: (one[1], -one[2])):
        if start >= until:
            out += [text[at:start], f"[{kind.upper()}]"]
        until = max(until, end)
        at = until
    return "".join([*out, text[at:]])


SPANS_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("base", T.BooleanType()), T.StructField("score", T.DoubleType()),
]))
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))


def _mapped(docs: DataFrame, text: str, redact: bool) -> DataFrame:
    """Sheltered rows without the text, with ``_spans`` and, if asked for, ``_redacted``."""
    models = trained()
    keep = [name for name in docs.columns if name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or "" for value in batch.column(text).to_pylist()]
            spans = [spans_of(value, models) for value in texts]
            arrays = [batch.column(name) for name in keep]
            arrays.append(pa.array([[dict(zip(("kind", "start", "end", "base", "score"), one)) for one in own] for own in spans], _SPANS_ARROW))
            if redact:
                arrays.append(pa.array([redacted(value, own) for value, own in zip(texts, spans)], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "_spans", *(["_redacted"] if redact else [])])

    schema = docs.select(*keep).schema.add("_spans", SPANS_TYPE)
    return mapped(docs.select(*keep, text), run, schema.add("_redacted", "string") if redact else schema)


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Input rows without their text, with ``spans``: array of (kind, start, end, base, score), ends exclusive, in code points."""
    inner, given = sheltered(docs)
    found = _mapped(inner, f"_in{docs.columns.index(text)}", redact=False)
    return found.select(*[given[name] for name in docs.columns if name not in (text, "spans")], F.col("_spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Input rows with every span of the text replaced by its kind; a null text stays null."""
    inner, given = sheltered(docs)
    inside = f"_in{docs.columns.index(text)}"
    found = _mapped(inner.withColumn("_null", F.col(inside).isNull()), inside, redact=True)
    cleaned = F.when(~F.col("_null"), F.col("_redacted")).alias(text)
    return found.select(*[cleaned if name == text else column for name, column in given.items()])


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"])), ",")


def span_digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, the hash of their list, and the list of all spans."""
    base = F.filter("spans", lambda one: one["base"])
    count = lambda kind: F.size(F.filter("spans", lambda one: one["base"] & (one["kind"] == kind))).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"),
    )
