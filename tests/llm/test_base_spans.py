"""The base spans against the patterns as they are stated, on random texts."""

import random
import re

from metermill.llm.personal_data import base_spans

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        digit = int(digit) * (1 + at % 2)
        total += digit - 9 * (digit > 9)
    return total % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(part) <= 255 for part in text.split("."))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != 3 or 9 <= len(digits) <= 15


def literal(text):
    return [(kind, found.start(), found.end()) for kind, pattern in enumerate(PATTERNS) for found in re.finditer(pattern, text)
            if holds(kind, found.group())]


def test_random_texts():
    choose = random.Random(6)
    parts = ["a.b@c.de", "x@y", "@", ".", "10.0.0.255", "1.2.3", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "5500 0000 0000 0004", "+1 (202) 555-0123", "+", "(", ") ", "-", " ", "é", "日", "12", "0", "00", "%", "\n", "a", "B_"]
    found = 0
    for _ in range(20_000):
        text = "".join(choose.choice(parts) for _ in range(choose.randrange(9)))
        assert sorted(base_spans(text)) == sorted(literal(text)), text
        found += len(literal(text))
    for _ in range(20_000):
        text = "".join(choose.choices("0129.+-@ ()ab", k=choose.randrange(30)))
        assert sorted(base_spans(text)) == sorted(literal(text)), text
    assert found > 5000
