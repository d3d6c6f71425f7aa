"""Pseudonyms against a plain Python version of the keyed permutations."""

from __future__ import annotations

import datetime
import hashlib
import random
import re
import string

from terrafold.llm import pii

KEY = "a key of the test"
ALPHABETS = (string.ascii_lowercase, string.ascii_uppercase, string.digits)


def draw(kind, *parts):
    return int(hashlib.sha256("|".join([KEY, kind, *map(str, parts)]).encode()).hexdigest()[:15], 16)


def pair(kind, a, b, size_a, size_b):
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            a = (a + draw(kind, r, b)) % size_a
        else:
            b = (b + draw(kind, r, a)) % size_b
    return a, b


def moved(kind, text, by, r):
    out = ""
    for i, char in enumerate(text, 1):
        for alphabet in ALPHABETS:
            if char in alphabet:
                char = alphabet[(alphabet.index(char) + draw(kind, r, i, by)) % len(alphabet)]
                break
        out += char
    return out


def whole(kind, text):
    left, right = text[: len(text) // 2], text[len(text) // 2 :]
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            left = moved(kind, left, right, r)
        else:
            right = moved(kind, right, left, r)
    return left + right


def check_digit(digits):
    twice = [int(d) * 2 if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits))]
    return str(-sum(t - 9 if t > 9 else t for t in twice) % 10)


def email(text):
    name, top = text.rsplit(".", 1)
    return f"{whole('email', name)}.{top}"


def phone(text):
    code = re.match(r"(?:\+\d{1,3}(?=[ .\-(]))?", text).group()
    return code + whole("phone", text[len(code) :])


def card(text):
    digits = re.sub(r"\D", "", text)
    new = whole("card", digits[:-1])
    new = iter(new + check_digit(new))
    return "".join(next(new) if c.isdigit() else c for c in text)


def address(text):
    a, b, c, d = map(int, text.split("."))
    x, y = pair("ipv4", a * 256 + b, c * 256 + d, 1 << 16, 1 << 16)
    return ".".join(map(str, (x // 256, x % 256, y // 256, y % 256)))


def social(text):
    area, group, serial = map(int, text.split("-"))
    area -= 1 + (area > 666)
    x, y = pair("social", area * 99 + group - 1, serial - 1, 898 * 99, 9999)
    area = x // 99 + 1
    return f"{area + (area >= 666):03d}-{x % 99 + 1:02d}-{y + 1:04d}"


def date(text):
    day = datetime.date.fromisoformat(text)
    if (day.month, day.day) == (2, 29):
        n = (day.year - 1904) // 4
        a, b = pair("leap day", n // 7, n % 7, 7, 7)
        return f"{1904 + 28 * a + 4 * b}-02-29"
    plain = (day.replace(year=2001) - datetime.date(2001, 1, 1)).days
    a, b = pair("date", day.year - 1900, plain, 200, 365)
    return f"{1900 + a}-{datetime.date(2001, 1, 1) + datetime.timedelta(b):%m-%d}"


def test_pseudonyms_equal_plain_python(spark):
    d = random.Random(11)
    digits = lambda n: "".join(d.choices(string.digits, k=n))
    values = []
    for _ in range(25):
        name = "".join(d.choices(string.ascii_letters + string.digits, k=d.randint(1, 12)))
        values.append((f"{name}.x@{name.lower()}.example.com", email))
        values.append((f"+{d.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}", phone))
        values.append((f"{digits(3)}-{digits(3)}-{digits(4)}", phone))
        number = "4" + digits(14)
        number += check_digit(number)
        values += [(number, card), ("-".join(number[i : i + 4] for i in range(0, 16, 4)), card)]
        values.append((".".join(str(d.randint(0, 255)) for _ in range(4)), address))
        values.append((f"{d.choice([*range(1, 666), *range(667, 900)]):03d}-{d.randint(1, 99):02d}-{d.randint(1, 9999):04d}", social))
        values.append((str(datetime.date(1900, 1, 1) + datetime.timedelta(d.randint(0, 73_000))), date))
        values.append((f"{4 * d.randint(476, 524)}-02-29", date))
    df = spark.createDataFrame([(i, f"see {v}, please") for i, (v, _) in enumerate(values)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.protect(df, KEY).collect()}
    for i, (value, plain) in enumerate(values):
        assert got[i] == f"see {plain(value)}, please", value
