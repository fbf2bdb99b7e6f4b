"""Personal data under format-preserving Feistel pseudonyms.  Only DataFrame functions.

Method.  One pattern finds what may be personal; each hit is validated, and a valid one is replaced by a keyed
permutation of its value within its format.  Equal values become equal pseudonyms in every document, and
different values of a format different ones.

| kind | valid if | pseudonym |
|-|-|-|
| card number, 13 to 19 digits, plain or grouped | Luhn sum | all digits but the last are permuted, the last is the new check digit |
| IBAN, plain or in groups of four | length of its country, check number (mod 97) | its digits are permuted, letters stay, the check number is the new one |
| phone: +country number in any grouping, area-number, (0area) number, 0area/number, or groups parted by blanks (3-3-4, 3-3-3 from a 6 or 7, 3-2-2-2 from an 8 or 9, or from a 0) | 8 to 15 digits, no thousands (000 at the end of 3-3-3) | the last 10 digits, or all of fewer, are permuted |
| social security number ddd-dd-dddd | area, group and serial in range | permuted among the valid numbers |
| IPv4 address | four numbers up to 255 | permuted among 2**32 |
| date Y-M-D, Y/M/D or D.M.Y | a day of the years 1800 to 2199 | permuted among these 146,097 days, in the same format |
| date M/D/Y or D/M/Y | the same | if both numbers are at most 12, permuted among the 57,600 such pairs and years; else among the 88,497 days from the 13th, in the same order |
| e-mail address | its syntax | the part before the @ becomes a keyed hash |
| secret in ``token = "..."`` and the like, the whole run with its dots | 16 characters at least, or 6 with a digit or in quotes | a keyed hash of the same length |

A value x below A * B is split into x div B and x mod B; ROUNDS rounds add a keyed SHA-256 of one part and the round to the other,
modulo its range: a Feistel network over mixed radices, a permutation for every key.  (E-mail names and secrets
have no such range; their keyed hashes keep equal values linked.)  What 3/4/1999 means is not known, so such dates are
permuted as written and are linked with dates written alike, not with 1999-03-04.

Cases.  A null text stays null, with 0 replacements; an empty one stays empty.  Numbers that do not validate stay as they
are.  Repeated rows are treated alike.  Other columns pass through; ``n_chars``, if there, is set to the new length.  Very
long texts are whole, and so are long e-mail names and secrets: their runs are read once.  Column names beginning with
``__pii_`` are used inside.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_NAMED = r"""(?i:\b(?:token|secret|password|passwd|api[_-]?key)\b["']?\s{0,4}[=:]\s{0,4}["']?)"""
_RUN = r"[A-Za-z0-9+/_.\-]"
SECRET = rf"""{_NAMED}(?:{_RUN}{{16,}}+|(?=[A-Za-z+/_.\-]{{0,15}}\d){_RUN}{{6,15}}+|(?<=["']){_RUN}{{6,15}}+(?=["']))"""
EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[A-Za-z0-9\-]{1,63}+(?:\.[A-Za-z0-9\-]{1,63}+){1,8}+"
PHONE = r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .\-]?\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}|\(\d{3}\) ?\d{3}-\d{4}|(?:\+\d{1,3}[ .\-])?\d{3}[.\-]\d{3}[.\-]\d{4}|\+\d(?:[ .\-()]{0,2}\d){7,14}|\d{3} \d{3} \d{4}|(?<!\d )(?:[67]\d\d \d{3} (?!000)\d{3}|[89]\d\d(?: \d\d){3})(?! ?\d)|(?=\(0\d{1,4}\)(?: ?\d){6,10}(?! ?\d))\(0\d{1,4}\)(?: ?\d{2,8}){1,4}|0\d{2,4}/\d{5,8}|(?=\d(?: ?\d){7,14}(?! ?\d))0\d{0,4}(?: \d{2,4}){2,6})(?!\d)"
SSN = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
CARD = r"(?<!\d)(?:\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5}|\d{13,19})(?!\d)"
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
DATE = r"(?<!\d)(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?!\d)"
# How many characters an IBAN has in each country.
IBAN_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GI": 23, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}


def _iban(length: int) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{'|'.join(c for c, n in IBAN_LENGTHS.items() if n == length)})\d\d(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


IBAN = rf"(?<![\p{{L}}\p{{N}}])(?=[A-Z]{{2}}\d)(?:{'|'.join(map(_iban, sorted(set(IBAN_LENGTHS.values()))))})(?![\p{{L}}\p{{N}}])"
ANY = "|".join((SECRET, EMAIL, IBAN, CARD, PHONE, SSN, IP, DATE))
#: The ranges of dates: 400 Gregorian years, pairs of numbers up to 12 in so many years, days from the 13th in them.
DAYS, PAIRS, LATE = (189, 773), (240, 240), (9, 9833)


def _long(x: Column) -> Column:
    return x.cast("long")


def _keyed(key: str, *what: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(w.cast("string") for w in what)), 256)


def _halves(left: Column, right: Column, a: Column, b: Column, key: str, tag: str | Column) -> Column:
    """(l, r): a keyed permutation of the pairs 0 <= left < a, 0 <= right < b."""

    def turn(pair: Column, i: Column) -> Column:
        even = i % 2 == 0
        word = _long(F.conv(F.substring(_keyed(key, F.lit(tag), a, b, i, F.when(even, pair["r"]).otherwise(pair["l"])), 1, 15), 16, 10))
        return F.struct(F.when(even, (pair["l"] + word % a) % a).otherwise(pair["l"]).alias("l"), F.when(even, pair["r"]).otherwise((pair["r"] + word % b) % b).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(_long(left).alias("l"), _long(right).alias("r")), turn)


def feistel(x: Column, a: Column, b: Column, key: str, tag: str | Column) -> Column:
    """A keyed permutation of 0 <= x < a * b; ``tag`` names the format, so that formats are permuted apart."""
    return _with(_halves(F.call_function("div", x, b), x % b, a, b, key, tag), lambda p: p["l"] * b + p["r"])


def _power(n: Column) -> Column:
    """10 ** n as a long, n from 0 to 18."""
    return _long(F.rpad(F.lit("1"), n + 1, "0"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _permuted(digits: Column, key: str, tag: str) -> Column:
    """Up to 18 digits under a permutation of all strings of so many digits."""
    n = F.length(digits)
    half = _long(F.floor(n / 2)).cast("int")
    return F.lpad(feistel(_long(digits), _power(half), _power(n - half), key, tag).cast("string"), n, "0")


def _filled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, one by one, by ``digits``."""

    def put(state: Column, c: Column) -> Column:
        is_digit = c.rlike(r"^\d$")
        return F.struct(F.concat(state["s"], F.when(is_digit, F.substr(digits, state["k"], F.lit(1))).otherwise(c)).alias("s"), (state["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"))

    return F.aggregate(F.split(form, ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("k")), put, lambda p: p["s"])


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a number whose last digit is its check digit."""
    def add(state: Column, c: Column) -> Column:
        d = c.cast("int") * (1 + state["k"] % 2)
        return F.struct((state["s"] + F.when(d > 9, d - 9).otherwise(d)).alias("s"), (state["k"] + 1).alias("k"))

    return F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("s"), F.lit(0).alias("k")), add, lambda p: p["s"])


def _with(x: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``x`` with ``x`` computed once."""
    return F.element_at(F.transform(F.array(x), then), 1)


def card(m: Column, key: str) -> Column:
    def replace(d: Column) -> Column:
        body = _permuted(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
        whole = _with(body, lambda y: F.concat(y, ((10 - luhn_sum(F.concat(y, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(luhn_sum(d) % 10 == 0, _with(whole, lambda y: _filled(m, y))).otherwise(m)

    return _with(_digits(m), replace)


def phone(m: Column, key: str) -> Column:
    return _with(_digits(m), lambda d: _with(F.concat(F.substr(d, F.lit(1), F.length(d) - 10), _permuted(F.right(d, F.lit(10)), key, "phone")), lambda y: _filled(m, y)))


def ssn(m: Column, key: str) -> Column:
    area, group, serial = (_long(F.substring(m, at, n)) for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)  # of 898 areas
    x = (place * 99 + group - 1) * 9999 + serial - 1

    def form(y: Column) -> Column:
        first = _long(F.call_function("div", y, F.lit(99 * 9999).cast("long")))
        parts = (F.when(first >= 665, first + 2).otherwise(first + 1), F.call_function("div", y, F.lit(9999).cast("long")) % 99 + 1, y % 9999 + 1)
        return F.concat_ws("-", *(F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4), strict=True)))

    return F.when(valid, _with(feistel(x, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, "ssn"), form)).otherwise(m)


def ip(m: Column, key: str) -> Column:
    def replace(p: Column) -> Column:
        part = [_long(F.element_at(p, k)) for k in (1, 2, 3, 4)]
        x = ((part[0] * 256 + part[1]) * 256 + part[2]) * 256 + part[3]
        side = F.lit(65536).cast("long")
        new = _with(feistel(x, side, side, key, "ip"), lambda y: F.concat_ws(".", *((F.shiftright(y, s).bitwiseAND(F.lit(255).cast("long"))).cast("string") for s in (24, 16, 8, 0))))
        return F.when(F.forall(p, lambda q: q.cast("int") <= 255), new).otherwise(m)

    return _with(F.split(m, r"\."), replace)


def _late_month(z: Column, first: Column) -> Column:
    """(month, day) of the ``z``-th day from the 13th of its month on, months counted from ``first``.  Months have 16 to 19 such
    days, 88,497 in 4,800 months, so the mean month is off by one at most."""
    guess = F.call_function("div", z * 4800, F.lit(LATE[0] * LATE[1]).cast("long"))
    of = lambda k: F.struct((_long(F.datediff(F.add_months(first, k.cast("int")), first)) - 12 * k).alias("before"), k.alias("month"))
    found = F.array_max(F.filter(F.transform(F.sequence(guess - 1, guess + 1), of), lambda p: p["before"] <= z))
    return _with(found, lambda p: F.struct(p["month"].alias("month"), (z - p["before"] + 13).alias("day")))


def date(m: Column, key: str) -> Column:
    first = F.lit("1800-01-01").cast("date")
    year_first, slash = m.rlike(r"^\d{4}"), m.rlike(r"^\d\d?/")

    def replace(p: Column) -> Column:
        one, two = (F.when(year_first, F.element_at(p, k + 1)).otherwise(F.element_at(p, k)) for k in (1, 2))  # as written, year aside
        year = F.when(year_first, F.element_at(p, 1)).otherwise(F.element_at(p, 3))
        month_first = year_first | slash & (_long(one) <= 12)
        month, day = F.when(month_first, one).otherwise(two), F.when(month_first, two).otherwise(one)
        when = F.to_date(F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-M-d")))
        days = _long(F.datediff(when, first))
        months = (_long(year) - 1800) * 12 + _long(month) - 1
        pair, late = slash & (_long(day) <= 12), slash & (_long(day) > 12)
        x = F.when(pair, (_long(year) - 1800) * 144 + _long(one) * 12 + _long(two) - 13).when(late, days - 12 * (months + 1)).otherwise(days)
        of = lambda k: F.when(pair, PAIRS[k]).when(late, LATE[k]).otherwise(DAYS[k]).cast("long")
        z = feistel(x, of(0), of(1), key, F.when(pair, "pair").when(late, "late").otherwise("date"))

        def form(z: Column) -> Column:
            plain = F.date_add(first, z.cast("int"))
            put = lambda y, a, b: F.struct(*(_long(c).alias(n) for n, c in zip(("y", "a", "b"), (y, a, b), strict=True)))
            div = lambda v, n: F.call_function("div", v, F.lit(n).cast("long"))
            of_late = _with(_late_month(z, first), lambda q: F.when(month_first, put(1800 + div(q["month"], 12), q["month"] % 12 + 1, q["day"])).otherwise(put(1800 + div(q["month"], 12), q["day"], q["month"] % 12 + 1)))
            of_plain = F.when(month_first, put(F.year(plain), F.month(plain), F.day(plain))).otherwise(put(F.year(plain), F.day(plain), F.month(plain)))
            return F.when(pair, put(1800 + div(z, 144), div(z % 144, 12) + 1, z % 12 + 1)).when(late, of_late).otherwise(of_plain)

        def write(q: Column) -> Column:
            wide = (F.length(one) == 2) & (F.length(two) == 2)
            a, b = (F.when(wide, F.lpad(q[n].cast("string"), 2, "0")).otherwise(q[n].cast("string")) for n in ("a", "b"))
            sign = F.regexp_extract(m, r"\D", 0)
            return F.when(year_first, F.concat(q["y"], sign, a, sign, b)).otherwise(F.concat(a, sign, b, sign, q["y"]))

        return F.when(days.between(0, DAYS[0] * DAYS[1] - 1), _with(_with(z, form), write)).otherwise(m)

    return _with(F.split(m, r"[-/.]"), replace)


def mod97(text: Column) -> Column:
    """What is left of the number that ``text`` stands for (A is 10, ... Z is 35) divided by 97."""
    def add(state: Column, c: Column) -> Column:
        digit = c.rlike(r"^\d$")
        return F.when(digit, (state * 10 + F.ascii(c) - 48) % 97).otherwise((state * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def iban(m: Column, key: str) -> Column:
    """All digits after the check number in two halves of at most 14 digits, permuted apart for each country."""

    def replace(t: Column) -> Column:
        land, body = F.left(t, F.lit(2)), F.substring(t, 5, 30)

        def new(d: Column) -> Column:
            half = F.call_function("div", F.length(d), F.lit(2)).cast("int")
            left, right = F.substr(d, F.lit(1), half), F.substr(d, half + 1, F.length(d) - half)
            turned = _halves(left, right, _power(half), _power(F.length(d) - half), key, F.concat(F.lit("iban"), land))
            whole = _with(turned, lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), F.length(d) - half, "0")))
            return _with(_with(whole, lambda w: _filled(body, w)), lambda b: F.concat(F.lpad((98 - mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), F.regexp_replace(b, r"\D", "")))

        check = F.substring(t, 3, 2).cast("int")
        fine = check.between(2, 98) & (mod97(F.concat(body, F.left(t, F.lit(4)))) == 1) & body.rlike(r"\d.*\d")
        return F.when(fine, _with(new(_digits(body)), lambda d: _filled(m, d))).otherwise(m)

    return _with(F.replace(m, F.lit(" "), F.lit("")), replace)


def email(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(_keyed(key, F.lit("email"), F.lower(m)), 1, 12), F.lit("@"), F.substring_index(m, "@", -1))


def secret(m: Column, key: str) -> Column:
    """The run without the dots that end a sentence."""
    end = F.regexp_extract(m, r"\.*$", 0)
    body = F.substr(m, F.lit(1), F.length(m) - F.length(end))
    value = F.regexp_extract(body, rf"{_RUN}*$", 0)

    def put(v: Column) -> Column:
        times = F.ceil(F.length(v) / 64).cast("int")
        return F.concat(F.substr(body, F.lit(1), F.length(body) - F.length(v)), F.substr(F.repeat(_keyed(key, F.lit("secret"), v), times), F.lit(1), F.length(v)), end)

    return _with(value, put)


def pseudonym(m: Column, key: str) -> Column:
    """What stands for the hit ``m``; ``m`` itself if it does not validate."""
    return (
        F.when(m.rlike(rf"^{_NAMED}"), secret(m, key)).when(F.instr(m, "@") > 0, email(m, key))
        .when(m.rlike(r"^[A-Z]"), iban(m, key)).when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), ssn(m, key)).when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), ip(m, key))
        .when(m.rlike(rf"^{DATE}$"), date(m, key))
        .when(m.rlike(rf"^{CARD}$"), card(m, key)).otherwise(phone(m, key))
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced; ``count_col``, if given, gets the number of replacements."""
    text, found, new = F.col(text_col).cast("string"), F.col("__pii_found"), F.col("__pii_new")
    rows = docs.withColumn("__pii_found", F.coalesce(F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(0)), F.array().cast("array<string>")))
    some = F.size(found) > 0
    rows = rows.withColumn("__pii_new", F.when(some, F.transform(found, lambda m: pseudonym(m, key))).otherwise(found))
    between = F.split(text, ANY, -1)
    joined = F.array_join(F.transform(F.arrays_zip(between.alias("a"), new.alias("b")), lambda z: F.concat(z["a"], F.coalesce(z["b"], F.lit("")))), "")
    rows = rows.withColumn(text_col, F.when(some, joined).otherwise(text))
    if count_col:
        rows = rows.withColumn(count_col, F.size(F.filter(F.arrays_zip(found.alias("a"), new.alias("b")), lambda z: z["a"] != z["b"])))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return rows.drop("__pii_found", "__pii_new")
