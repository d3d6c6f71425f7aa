"""Personal data replaced by keyed, format-preserving pseudonyms; SQL expressions only.

E-mail addresses, telephone, card and social security numbers, IPv4 addresses and dates are
found by one pattern and checked (card numbers by their check digit, dates by the calendar,
octets by range). A Feistel network keyed with SHA-256 permutes each value within its format:
letters stay letters of their case, digits digits, cards keep a right check digit, dates stay
dates. Equal values get equal pseudonyms in every document; different ones stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import unused

ROUNDS = 8
#: A key for tests and samples; pass a secret one.
KEY = "terrafold"

# The part before the sign has 64 characters at most, so no start reads far.
EMAIL = r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}+"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ISO_DATE = r"(?:19|20)\d\d([\-/.])(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])(?![\d])"
DAY_DATE = r"(?:0[1-9]|[12]\d|3[01])([\-.])(?:0[1-9]|1[0-2])\2(?:19|20)\d\d(?!\d)"
MONTH_DATE = r"(?:0[1-9]|1[0-2])/(?:0[1-9]|[12]\d|3[01])/(?:19|20)\d\d(?!\d)"
#: Day first where the month cannot be: both readings are possible up to 12, and then it is the month.
SLASH_DATE = r"(?:1[3-9]|2\d|3[01])/(?:0[1-9]|1[0-2])/(?:19|20)\d\d(?!\d)"
ADDRESS = rf"{OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)"
#: Stands in the templates for the cards of a text, which no pattern can tell by their check digit.
CARDS, OTHERS = "<cards>", "<others>"
PHONE = rf"(?:\+\d{{1,3}}[ .\-]?)?(?:\(\d{{2,4}}\)[ .\-]?|\d{{2,4}}[ .\-])\d{{3}}[ .\-](?!{CARDS})\d{{4}}(?!\d)"
PLAIN_PHONE = r"\+\d{8,15}(?!\d)"
#: Country code and groups of any length, 8 to 15 digits in all, as many groups as fit.
GROUPED_PHONE = (
    rf"\+[1-9]\d{{0,2}}(?:[ .\-]?\(\d{{1,5}}\)[ .\-]?|[ .\-])(?!{CARDS})\d{{1,12}}(?:[ .\-](?!{CARDS})\d{{2,12}}){{0,6}}(?!\d)"
    # Written out, as Java looks back over no repeated group.
    + r"(?<=\+" + r"[ .()\-]{0,3}\d" * 8 + r"(?:[ .()\-]{0,3}\d)?" * 7 + ")"
)
SOCIAL = r"\d{3}-\d{2}-\d{4}(?!\d)"
CARD = r"\d(?:[ \-]?\d){12,18}(?!\d)"
#: Lengths of the groups that issuers print; unbroken digits are a layout too.
LAYOUTS = ["4-4-4-4-3", "6-13", "4-4-4-4", "4-6-5", "4-5-6", "4-6-4", "4-4-5", "4-3-3-3"]
LAYOUT = [r"\d{13,19}", *[r"[ \-]".join(rf"\d{{{n}}}" for n in layout.split("-")) for layout in LAYOUTS]]
#: The longest possible card from each group of digits on, whatever stands before.
WINDOW = rf"(?<![\w+])(?<!\d\.)(?=({CARD}))\d+"
#: The same where no other group of digits stands before, or none after.
FIRST_WINDOW = rf"(?<![\w+])(?<!\d[ .\-])(?=({CARD}))\d+"
LAST_WINDOW = rf"(?<![\w+])(?<!\d[.\-])(?=({CARD}(?![ \-]\d)))\d+"
#: Tried in this order at every place that does not stand inside a number.
TEMPLATE = rf"{EMAIL}|(?<![\w+])(?<!\d\.){CARDS}|(?<![\w+])(?<!\d[.\-])(?=[+(\d])(?:{ISO_DATE}|{DAY_DATE}|{MONTH_DATE}|{SLASH_DATE}|{ADDRESS}|{SOCIAL}|{PHONE}|{PLAIN_PHONE}|{GROUPED_PHONE}|{OTHERS})"
#: The pattern of a text without cards.
PATTERN = TEMPLATE.replace(CARDS, "(?!)").replace(OTHERS, "(?!)")

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Days before each month of a year without 29 February.
MONTH_STARTS = [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334]


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` mentions it."""
    return F.transform(F.array(value), body)[0]


def prf(key: str, kind: str, *parts: Column) -> Column:
    """A number of 60 bits by SHA-256 of the key and the parts."""
    joined = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, size_a: int, size_b: int, key: str, kind: str) -> Column:
    """Permute pairs from 0..size_a-1 and 0..size_b-1; a struct of ``a`` and ``b``."""

    def step(acc: Column, r: Column) -> Column:
        even = r % 2 == 0
        new_a = F.pmod(acc["a"] + F.pmod(prf(key, kind, r, acc["b"]), F.lit(size_a)), F.lit(size_a))
        new_b = F.pmod(acc["b"] + F.pmod(prf(key, kind, r, acc["a"]), F.lit(size_b)), F.lit(size_b))
        return F.struct(F.when(even, new_a).otherwise(acc["a"]).alias("a"), F.when(even, acc["b"]).otherwise(new_b).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def shifted(text: Column, by: Column, r: Column, key: str, kind: str) -> Column:
    """Each letter or digit moved within its alphabet by a number drawn from ``by``."""

    def move(i: Column) -> Column:
        char, amount = F.substr(text, i, F.lit(1)), prf(key, kind, r, i, by)
        out = char
        for alphabet in (LOWER, UPPER, DIGITS):
            at = F.instr(F.lit(alphabet), char) - 1
            new = F.substr(F.lit(alphabet), (F.pmod(at + F.pmod(amount, F.lit(len(alphabet))), F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))
            out = F.when(at >= 0, new).otherwise(out)
        return out

    return F.array_join(F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), move)).otherwise(F.array().cast("array<string>")), "")


def permuted(text: Column, key: str, kind: str) -> Column:
    """A permutation of all strings with the same alphabets in the same places."""
    return let(text, lambda t: _permuted(t, key, kind))


def _permuted(text: Column, key: str, kind: str) -> Column:
    half = F.floor(F.length(text) / 2).cast("int")

    def step(acc: Column, r: Column) -> Column:
        even = r % 2 == 0
        left = F.when(even, shifted(acc["left"], acc["right"], r, key, kind)).otherwise(acc["left"])
        right = F.when(even, acc["right"]).otherwise(shifted(acc["right"], acc["left"], r, key, kind))
        return F.struct(left.alias("left"), right.alias("right"))

    start = F.struct(F.substr(text, F.lit(1), half).alias("left"), F.substr(text, half + 1, F.length(text)).alias("right"))
    # A single character has an empty left half, which moves the right one all the same.
    end = lambda done: F.concat(done["left"], done["right"])
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, end)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``digits``."""

    def fill(i: Column) -> Column:
        char = F.substr(shape, i, F.lit(1))
        nth = F.length(digits_of(F.substr(shape, F.lit(1), i)))
        return F.when(char.between("0", "9"), F.substr(digits, nth, F.lit(1))).otherwise(char)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), fill), "")


def luhn_sum(digits: Column, shift: int) -> Column:
    """Luhn sum; ``shift`` 0 if the last digit is the check digit, 1 if that is missing."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when((n - i + shift) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def is_card(text: Column) -> Column:
    return let(digits_of(text), lambda digits: luhn_sum(digits, 0) % 10 == 0)


def one_of(cards: Column) -> Column:
    """A pattern for exactly these strings of digits, blanks and hyphens; longer ones first."""
    ordered = F.sort_array(F.transform(F.array_distinct(cards), lambda c: F.struct(F.length(c).alias("n"), c.alias("c"))), asc=False)
    listed = F.array_join(F.transform(ordered, lambda x: x["c"]), "|")
    return F.when(F.size(cards) > 0, F.concat(F.lit("(?:"), listed, F.lit(r")(?!\d)"))).otherwise("(?!)")


def pattern_of(text: Column) -> Column:
    """``TEMPLATE`` with the strings of ``text`` that pass the check of a card.

    Cards in a usual layout count wherever they stand, so that other numbers beside them
    neither hide them nor are swallowed. Digits in other groups count if nothing stands
    before them or, in groups of three and more, nothing after them.
    """
    windows = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    heads = lambda w: F.array(*[F.regexp_extract(w, rf"^(?:{layout})(?!\d)", 0) for layout in LAYOUT])
    usual = F.filter(F.flatten(F.transform(windows(WINDOW), heads)), lambda c: (F.length(c) > 0) & is_card(c))
    last = F.filter(windows(LAST_WINDOW), lambda c: ~c.rlike(r"(?<!\d)\d{1,2}(?!\d)"))
    other = F.filter(F.concat(windows(FIRST_WINDOW), last), is_card)
    whole = F.replace(F.replace(F.lit(TEMPLATE), F.lit(CARDS), one_of(usual)), F.lit(OTHERS), one_of(other))
    return F.when(text.rlike(r"\d(?:[ \-]?\d){12}"), whole).otherwise(PATTERN)


def card(text: Column, key: str) -> Column:
    def checked(payload: Column) -> Column:
        check = F.pmod(10 - luhn_sum(payload, 1) % 10, F.lit(10)).cast("string")
        return let(F.concat(payload, check), lambda new: refilled(text, new))

    def of_digits(digits: Column) -> Column:
        payload = permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
        return F.when(luhn_sum(digits, 0) % 10 == 0, let(payload, checked)).otherwise(text)

    return let(digits_of(text), of_digits)


def address(text: Column, key: str) -> Column:
    octet = [F.split_part(text, F.lit("."), F.lit(i)).cast("long") for i in (1, 2, 3, 4)]
    new = feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 1 << 16, 1 << 16, key, "ipv4")

    def spelled(new: Column) -> Column:
        parts = (F.floor(new["a"] / 256), new["a"] % 256, F.floor(new["b"] / 256), new["b"] % 256)
        return F.concat_ws(".", *[x.cast("string") for x in parts])

    return let(new, spelled)


def social(text: Column, key: str) -> Column:
    """Areas 1-899 but 666, groups 1-99, serials 1-9999; others are not valid numbers."""
    area, group, serial = (F.substring(text, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    index = area - F.when(area > 666, 2).otherwise(1)

    def spelled(new: Column) -> Column:
        at = F.floor(new["a"] / 99)
        parts = [at + F.when(at >= 665, 2).otherwise(1), new["a"] % 99 + 1, new["b"] + 1]
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4), strict=True)])

    out = let(feistel(index * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "social"), spelled)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, out).otherwise(text)


def date(text: Column, key: str) -> Column:
    """Years 1900-2099; 29 February goes to 29 February of a leap year."""
    iso = F.substring(text, 3, 1).between("0", "9")
    slash = F.substring(text, 3, 1) == "/"
    sign = F.when(iso, F.substring(text, 5, 1)).otherwise(F.substring(text, 3, 1))
    first, second = F.substring(text, 1, 2), F.substring(text, 4, 2)
    year = F.when(iso, F.substring(text, 1, 4)).otherwise(F.substring(text, 7, 4)).cast("long")
    month = F.when(iso, F.substring(text, 6, 2)).when(slash, first).otherwise(second).cast("long")
    day = F.when(iso, F.substring(text, 9, 2)).when(slash, second).otherwise(first).cast("long")
    leap = (month == 2) & (day == 29)
    starts = F.array(*[F.lit(x) for x in MONTH_STARTS])
    new = feistel(year - 1900, F.element_at(starts, month.cast("int")) + day - 1, 200, 365, key, "date")
    rare = feistel(F.floor((year - 1904) / 28), F.floor((year - 1904) / 4) % 7, 7, 7, key, "leap day")

    def spelled(y: Column, m: Column, d: Column) -> Column:
        y, m, d = y.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")
        return F.when(iso, F.concat(y, sign, m, sign, d)).when(slash, F.concat(m, sign, d, sign, y)).otherwise(F.concat(d, sign, m, sign, y))

    def usual(new: Column) -> Column:
        month_of = F.size(F.filter(starts, lambda x: x <= new["b"]))
        return let(month_of, lambda m: spelled(1900 + new["a"], m, new["b"] - F.element_at(starts, m) + 1))

    leap_day = let(rare, lambda r: spelled(1904 + 28 * r["a"] + 4 * r["b"], F.lit(2), F.lit(29)))
    out = F.when(leap, leap_day).otherwise(let(new, usual))
    exists = F.try_to_date(F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")))
    return F.when(exists.isNotNull(), out).otherwise(text)


def slash_date(text: Column, key: str) -> Column:
    """Dates of ``SLASH_DATE``, from day 13 on; they stay such, so none becomes a month-first date."""
    day, month, year = (F.substring(text, a, n).cast("long") for a, n in ((1, 2), (4, 2), (7, 4)))
    leap = (month == 2) & (day == 29)
    starts = F.array(*[F.lit(x - 12 * i) for i, x in enumerate(MONTH_STARTS)])
    new = feistel(year - 1900, F.element_at(starts, month.cast("int")) + day - 13, 200, 365 - 144, key, "day-first date")
    rare = feistel(F.floor((year - 1904) / 28), F.floor((year - 1904) / 4) % 7, 7, 7, key, "leap day")

    def spelled(d: Column, m: Column, y: Column) -> Column:
        return F.concat_ws("/", F.lpad(d.cast("string"), 2, "0"), F.lpad(m.cast("string"), 2, "0"), y.cast("string"))

    def usual(new: Column) -> Column:
        month_of = F.size(F.filter(starts, lambda x: x <= new["b"]))
        return let(month_of, lambda m: spelled(new["b"] - F.element_at(starts, m) + 13, m, 1900 + new["a"]))

    out = F.when(leap, let(rare, lambda r: spelled(F.lit(29), F.lit(2), 1904 + 28 * r["a"] + 4 * r["b"]))).otherwise(let(new, usual))
    exists = F.try_to_date(F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)))
    return F.when(exists.isNotNull(), out).otherwise(text)


def email(text: Column, key: str) -> Column:
    """All but the top-level domain, within the places of letters and digits."""
    whole = lambda name: F.concat(permuted(name, key, "email"), F.substr(text, F.length(name) + 1, F.length(text)))
    return let(F.regexp_replace(text, r"\.[A-Za-z]+$", ""), whole)


def phone(text: Column, key: str) -> Column:
    """All digits but the country code that a plus sign marks."""
    whole = lambda code: F.concat(code, permuted(F.substr(text, F.length(code) + 1, F.length(text)), key, "phone"))
    return let(F.regexp_extract(text, r"^\+\d{1,3}(?=[ .\-(])", 0), whole)


def pseudonym(text: Column, key: str = KEY) -> Column:
    """The pseudonym of one match of ``PATTERN``; a value that fails its check is kept."""
    return (
        F.when(F.contains(text, F.lit("@")), email(text, key))
        .when(text.rlike(rf"^(?:{ISO_DATE}|{DAY_DATE}|{MONTH_DATE})$"), date(text, key))
        .when(text.rlike(rf"^{SLASH_DATE}$"), slash_date(text, key))
        .when(text.rlike(rf"^{ADDRESS}$"), address(text, key))
        .when(text.rlike(rf"^{SOCIAL}$"), social(text, key))
        .when(text.rlike(rf"^{CARD}$"), card(text, key))
        .otherwise(phone(text, key))
    )


def protect(docs: DataFrame, key: str = KEY, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all other columns as they are.

    Null text stays null, text without personal data stays as it is. Rows are independent of
    each other: repeated rows get equal results, a text of any length is read whole, an
    empty table stays empty. ``count`` names a column for the number of values replaced; a
    column of that name is overwritten.
    """
    # Only texts with an at sign or two digits in a row, or a card of single ones, can hold any.
    some = F.col(text).rlike(r"@|[0-9][0-9]|[0-9](?:[ \-][0-9]){12}")
    pattern, old, new = unused(docs, "_pattern", "_hits", "_new")
    found = docs.withColumn(pattern, F.when(some, pattern_of(F.col(text))).otherwise(PATTERN))
    hits = F.regexp_extract_all(F.col(text), F.col(pattern), F.lit(0))
    found = found.withColumn(old, F.when(some, hits).otherwise(F.array().cast("array<string>")))
    found = found.withColumn(new, F.transform(old, lambda h: pseudonym(h, key)))
    parts = F.split(F.col(text), F.col(pattern), -1)
    joined = F.array_join(F.flatten(F.zip_with(parts, new, lambda p, h: F.array(p, F.coalesce(h, F.lit(""))))), "")
    out = F.when(F.size(old) > 0, joined).otherwise(F.col(text))
    columns = [out.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != count]
    if count:
        changed = F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x))
        columns.append(F.coalesce(changed, F.lit(0)).alias(count))
    return found.select(*columns)


def protected(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Every document with pseudonyms, how many, and whether it held personal data."""
    done = protect(docs.select("doc_id", "text"), key, count="n_values")
    return done.select("doc_id", "text", "n_values", (F.col("n_values") > 0).alias("private"))
