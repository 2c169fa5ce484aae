from __future__ import annotations

import hashlib
import random
import re

import pytest

from llm.invented import prose
from shelfcast.llm.pii import KINDS, base_spans, find_personal_data, fit_finder, luhn, redacted, spelled

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = [True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15][kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112") and luhn("79927398713")


def test_base():
    texts = ["a@b.c@d.e", "x@@y.z", "@a.b", "a@b", "a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.001", "0000000000300.1.1.1", "4111 1111-1111 1111", "4111  1111 1111 1111", "+1 (202) 555-0143.", "+1", "+1 2+1 202 555 0143", "é+49 30 1234567é", ""]
    draw = random.Random(3)
    texts += ["".join(draw.choice("ab1234567890.@+- ()é\n") for _ in range(120)) for _ in range(3000)]
    for t in texts:
        assert base_spans(t) == plain(t)


def test_long_runs_take_no_time():
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000, "1 " * 100_000, "((" * 100_000, ":" * 200_000, "at) " * 50_000):
        base_spans(text)


@pytest.fixture(scope="module")
def finder():
    places = ["mail {} today", "server {} is up", "paid by {} again", "call {} now"]
    numbers = ["ann.lee{}@mail{}.example.com", "10.{}.7.{}", "4111 1111 1111 1111", "+1 (202) 555-01{:02}"]
    return fit_finder([prose(i, 30) + " " + places[i % 4].format(numbers[i % 4].format(i % 90 + 10, i % 90)) + " " + prose(-i, 20) for i in range(400)])


def test_more_than_the_base(finder):
    more = {"call (269) 555-3296 now": ("phone", "(269) 555-3296"), "card 4111.1111.1111.1111 was used": ("card", "4111.1111.1111.1111")}
    for text, (kind, span) in more.items():
        assert [(KINDS[k], text[s:e]) for s, k, e in finder.more_spans(text, [])] == [(kind, span)]
    for text in ("on 2024-05-06 we met", "it is 12345678 wide", "isbn 978-3-16-148410-0", "section 1.2.3", "3.14159265", "pages 1990-2010", "a b c", ""):
        assert finder.more_spans(text, []) == []


def test_redacted():
    text = "write to a@b.cd or +1 202 555 0143."
    assert redacted(text, base_spans(text)) == "write to [email] or [phone]."


def test_odd_rows(odd_docs, no_docs):
    for r in find_personal_data(odd_docs).collect():
        base = plain(r["text"] or "")
        assert r["personal"]["base_sha256"] == hashlib.sha256(spelled(base).encode()).hexdigest()
        assert r["personal"]["n_email"] == sum(k == 0 for _, k, _ in base)
    assert find_personal_data(no_docs).count() == 0
