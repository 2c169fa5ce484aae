"""Personal data by candidate gradient boosting.

Four base patterns with their checks find e-mail addresses, IP addresses, card and phone numbers; their spans always stay.
Generators of high recall then propose further spans in the rest of the text, overlapping ones too: chains of digits with any
separators, whole and cut at blanks, addresses spelled with "at" and "dot", and groups of hex numbers. For each kind,
boosted trees judge the format of a proposal and the words around it. Above the kind's threshold the likeliest proposals are
taken, none overlapping a base span or each other.

The trees are fitted to at most ``fit_rows`` different texts with digits, drawn by hash, none of ``text_chars`` or more: base spans as they stand and rewritten in other
formats are examples of their kind; other chains of digits, numbers that fail their check, dates, prices, versions and serial
numbers put in the same places are not. Each threshold is the lowest at which ``precision`` of a held-out third is right.

Places are counted in code points. All patterns run in time proportional to the text.

Defined results: null and empty texts have no spans; texts are read whole; equal rows get equal spans; without any example in
the table the trees are fitted to rewritten examples alone; of equally likely proposals the longest, then the first, is
taken; an empty table gives an empty result; other columns are carried along, one with the result's name is replaced by it.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.boosting import Trees, fit_trees
from shelfcast.llm.store import arrow_rows

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NO_DIGITS = re.compile(r"[^0-9]+")
Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = end + len(text[end:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
        end = m.end() if m else at + 1
        at = text.find("@", end)
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by start and then kind."""
    spans = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = NO_DIGITS.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append((m.start(), 2, m.end()))
        if "+" in text:
            spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(NO_DIGITS.sub("", m[0])) <= 15]
    return sorted(spans)


# Proposals

CHAIN = re.compile(r"[(+]?[0-9](?:[ ().\-/]{0,3}+[0-9])++")
SPELLED = re.compile(
    r"(?<![\w.+-])[\w.+-]{1,64}+(?: ?[\[({]at[\])}] ?| at )[A-Za-z0-9-]{1,63}+(?:(?: ?[\[({]dot[\])}] ?| dot |\.)[A-Za-z0-9-]{1,63}+)++", re.I
)
HEX_GROUPS = re.compile(r"(?<![\w:])[0-9A-Fa-f]{0,4}+(?::[0-9A-Fa-f]{0,4}+){3,7}+(?![\w:])")
MOST_IN_CHAIN = 40


def proposals(text: str) -> list[tuple[int, int]]:
    """Spans that might be personal data."""
    found: set[tuple[int, int]] = set()
    if DIGIT.search(text):
        for m in CHAIN.finditer(text):
            if m.end() - m.start() < 7:
                continue
            parts = [(p.start() + m.start(), p.end() + m.start()) for p in re.finditer(r"[^ ]+", m[0])]
            if len(parts) <= MOST_IN_CHAIN:  # beyond, no number has that many groups: parts of up to six groups are proposed
                found.add((m.start(), m.end()))
            for i in range(len(parts)):
                for j in range(i, min(i + 6, len(parts))):
                    if 7 <= parts[j][1] - parts[i][0] <= 40:
                        found.add((parts[i][0], parts[j][1]))
        if "::" in text or ":" in text:
            found |= {m.span() for m in HEX_GROUPS.finditer(text) if m.end() - m.start() >= 9 and DIGIT.search(m[0])}
    lowered = text.lower()
    if "at)" in lowered or "at]" in lowered or " at " in lowered and " dot " in lowered:
        found |= {m.span() for m in SPELLED.finditer(text)}
    return sorted(found)


#: Words near a number that tell what it is.
HINTS = {
    "phone": "phone tel telephone telefon teléfono téléphone call mobile cell fax handy whatsapp sms móvil",
    "card": "card visa mastercard amex credit debit karte carte tarjeta payment cvv",
    "email": "email mail e-mail contact courriel correo write",
    "ip": "ip address host server from addr client",
    "other": "version isbn order invoice no nr id serial item page total price date year eur usd chapter section sku model part ref",
}
HINT_OF = {w: i for i, words in enumerate(HINTS.values()) for w in words.split()}
WIDTH = 26 + 2 * len(HINTS)


def describe(text: str, start: int, end: int) -> list[float]:
    """Format and context features of a span."""
    span = text[start:end]
    digits = NO_DIGITS.sub("", span)
    groups = re.findall(r"[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    before, after = text[max(0, start - 40) : start], text[end : end + 24]
    row = [
        len(span), len(digits), len(groups), len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0,
        max(map(len, groups), default=0), min(map(len, groups), default=0), span.count(" "), span.count("."), span.count("-"), span.count("/"),
        span.count("(") + span.count(")"), span.count(":"), span[0] == "+", span[0] == "(", letters, span.count("@") + span.lower().count("at") * (letters > 0),
        luhn(digits) if 12 <= len(digits) <= 19 else 0, all(len(g) < 4 and int(g) <= 255 for g in groups) if len(groups) == 4 else 0,
        int(groups[0]) if groups and len(groups[0]) < 5 else -1, digits[:2] == "00", digits[:1] == "0", len(set(digits)),
        bool(before) and not before[-1].isspace(), bool(after) and not after[0].isspace() and after[0] not in ".,;:!?)", sum(c.isdigit() for c in before[-8:] + after[:8]),
    ]
    for words in (re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?", before.lower())[-4:], re.findall(r"[^\W\d_]+", after.lower())[:2]):
        flags = [0.0] * len(HINTS)
        for w in words:
            if w in HINT_OF:
                flags[HINT_OF[w]] = 1.0
        row += flags
    return [float(v) for v in row]


@dataclass
class Finder:
    """A kind's trees and threshold, by kind."""

    trees: list[Trees]
    thresholds: list[float]

    def more_spans(self, text: str, base: list[Span]) -> list[Span]:
        taken = [(s, e) for s, _, e in base]
        free = [(s, e) for s, e in proposals(text) if all(e <= a or s >= b for a, b in taken)]
        if not free:
            return []
        x = np.array([describe(text, s, e) for s, e in free])
        chances = np.stack([t.probability(x) for t in self.trees], 1)
        wins = [(chances[i, k], e - s, s, k, e) for i, (s, e) in enumerate(free) for k in [int(chances[i].argmax())] if chances[i, k] >= self.thresholds[k]]
        out: list[Span] = []
        for _, _, s, k, e in sorted(wins, key=lambda w: (-w[0], -w[1], w[2])):
            if all(e <= a or s >= b for a, _, b in out):
                out.append((s, k, e))
        return sorted(out)


# Training examples


def _as_phone(draw: random.Random, digits: str) -> str:
    d = digits[-10:].rjust(10, "5")
    return draw.choice([
        f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"001 {d[:3]} {d[3:6]} {d[6:]}", f"0{d[:2]} {d[2:5]} {d[5:]}",
        f"0{d[:3]}/{d[3:]}", f"00{d[:2]} {d[2:4]} {d[4:7]} {d[7:]}", f"{d[:3]} {d[3:6]} {d[6:]}", f"0{d[0]} {d[1:3]} {d[3:5]} {d[5:7]} {d[7:9]}",
    ])


def _as_card(draw: random.Random, digits: str) -> str:
    cut = [digits[i : i + 4] for i in range(0, len(digits), 4)]
    return draw.choice([".", "/", " - ", ". "]).join(cut)


def _as_email(draw: random.Random, address: str) -> str:
    name, _, host = address.partition("@")
    at, dot = draw.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "."), (" [at] ", "."), (" at ", " dot ")])
    return name + at + host.replace(".", dot)


def _as_ip(draw: random.Random, _: str) -> str:
    return ":".join(f"{draw.randrange(1 << 16):x}" for _ in range(8))


REWRITE: list[Callable[[random.Random, str], str]] = [_as_email, _as_ip, _as_card, _as_phone]


def _nothing(draw: random.Random) -> str:
    """A number that is nobody's."""
    n = lambda k: "".join(draw.choice("0123456789") for _ in range(k))
    while luhn(wrong := draw.choice("123456789") + n(draw.choice([13, 14, 15, 15, 15, 17]))):
        pass
    return draw.choice([
        f"{draw.randint(1900, 2030)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}", f"{draw.randint(1, 28):02}.{draw.randint(1, 12):02}.{draw.randint(1900, 2030)}",
        f"{draw.randint(1, 12)}/{draw.randint(1, 28)}/{draw.randint(1900, 2030)}", f"{draw.randint(1900, 2020)}-{draw.randint(1900, 2030)}", wrong, wrong[:12], n(8), n(7), n(10), n(9), n(13), n(24),
        f"978-{n(1)}-{n(4)}-{n(4)}-{n(1)}", f"{n(1)}.{n(2)}.{n(1)}.{n(5)}", f"{n(3)}.{n(3)}.{n(3)}", f"{n(2)} {n(3)} {n(3)}", f"{n(1)}.{n(7)}", f"{n(5)}.{n(2)}", f"{n(4)} {n(4)} {n(2)}",
        f"{n(2)}:{n(2)}:{n(2)}:{n(2)}", f"{n(3)}-{n(2)}", f"{n(5)}-{n(4)}", " ".join(n(draw.randint(1, 3)) for _ in range(draw.randint(3, 12))),
        f"{draw.randint(1900, 2030)} {draw.randint(1900, 2030)} {draw.randint(1900, 2030)}",
    ])


def _examples(texts: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of features and their kind (-1: none)."""
    draw = random.Random(seed)
    spans = [(t, s) for t in texts for s in base_spans(t)]
    starters = ["name.surname@mail.example.org", "10.20.30.40", "4111111111111111", "+1 202 555 0143"]
    places = [(t, draw.randrange(len(t) + 1)) for t in texts if t] or [("See the note below. ", 8)]
    rows: list[list[float]] = []
    kinds: list[int] = []

    def put(number: str, kind: int, hint: str = "") -> None:
        text, at = draw.choice(places)
        at = text.find(" ", at) + 1 or len(text)
        text = text[max(0, at - 60) : at] + hint + number + " " + text[at : at + 40]
        start = text.index(number, min(at, 60))
        for s, e in {(start, start + len(number)), *proposals(text)}:
            if s < start + len(number) and e > start:
                rows.append(describe(text, s, e))
                kinds.append(kind if (s, e) == (start, start + len(number)) else -1)

    for text, (s, kind, e) in spans[:4000]:
        rows.append(describe(text, s, e))
        kinds.append(kind)
    for kind, starter in enumerate(starters):
        mine = [t[s:e] for t, (s, k, e) in spans if k == kind] or [starter]
        hints = [w + draw.choice([" ", ": "]) for w in HINTS[KINDS[kind]].split()]
        for _ in range(500):
            one = draw.choice(mine)
            hint = draw.choice(hints) if draw.random() < 0.5 else ""
            put(REWRITE[kind](draw, one if kind == 0 else NO_DIGITS.sub("", one)), kind, hint)
    others = [w + " " for w in HINTS["other"].split()]
    for _ in range(6000):
        put(_nothing(draw), -1, draw.choice(others) if draw.random() < 0.4 else "")
    for t in texts[:2000]:
        known = [(s, e) for s, _, e in base_spans(t)]
        for s, e in proposals(t)[:50]:
            if (s, e) not in known:
                rows.append(describe(t, s, e))
                kinds.append(-1)
    return np.array(rows), np.array(kinds)


def fit_finder(texts: list[str], *, precision: float = 0.995, seed: int = 9) -> Finder:
    x, kinds = _examples(texts, seed)
    held = np.random.Generator(np.random.PCG64(seed)).random(len(x)) < 1 / 3
    trees, thresholds = [], []
    for kind in range(len(KINDS)):
        y = (kinds == kind).astype(float)
        model = fit_trees(x[~held], y[~held], rounds=40, depth=4)
        chance, right = model.probability(x[held]), y[held]
        order = np.argsort(-chance, kind="stable")
        share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share >= precision)
        thresholds.append(max(0.9, float(chance[order][good[-1]])) if len(good) else 1.1)
        trees.append(model)
    return Finder(trees, thresholds)


def learn_finder(docs: DataFrame, *, fit_rows: int = 2000, text_chars: int = 50_000, precision: float = 0.995) -> Finder:
    """Fit on at most ``fit_rows`` different texts of less than ``text_chars`` characters with digits, drawn by hash, equal ones once.

    Longer texts are searched like any other.
    """
    drawn = F.pmod(F.xxhash64(F.lit(13), "text"), F.lit(1 << 20))
    dated = docs.where((F.length("text") < text_chars) & F.col("text").rlike("[0-9]")).select("text", drawn.alias("drawn"))
    n = dated.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]
    if n > 2 * fit_rows:
        dated = dated.where(F.col("drawn") < int((1 << 20) * 2 * fit_rows / n))
    texts = dated.distinct().orderBy("drawn", "text").limit(fit_rows).collect()
    return fit_finder(sorted(r["text"] for r in texts), precision=precision)


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


RESULT = "n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint, base_sha256: string, spans: string"


def find_personal_data(docs: DataFrame, *, fit_rows: int = 2000, precision: float = 0.995, to: str = "personal") -> DataFrame:
    """``docs`` with a struct: base spans counted by kind and hashed, and all spans as ``kind:start:end``."""
    finder = learn_finder(docs, fit_rows=fit_rows, precision=precision)
    arrow_rows(docs.sparkSession, 500)

    @F.arrow_udf(f"struct<{RESULT}>")
    def find(texts: pa.Array) -> pa.Array:
        counts, hashes, spans = np.zeros((len(KINDS), len(texts)), np.int64), [], []
        for i, t in enumerate(texts):
            text = t.as_py() or ""
            base = base_spans(text)
            for _, kind, _ in base:
                counts[kind, i] += 1
            hashes.append(hashlib.sha256(spelled(base).encode()).hexdigest())
            spans.append(spelled(sorted(base + finder.more_spans(text, base))))
        names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        return pa.StructArray.from_arrays([*(pa.array(c) for c in counts), pa.array(hashes, pa.string()), pa.array(spans, pa.string())], names)

    return docs.withColumn(to, find(F.col("text")))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for s, k, e in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k]}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])
