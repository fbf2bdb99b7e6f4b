"""The native pseudonyms against a plain Python version of the same permutations."""

import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from levain.llm import op10_pseudonyms as o

KEY = "k1"


def feistel(x, a, b, tag, key=KEY):
    left, right = divmod(x, b)
    for i in range(o.ROUNDS):
        word = int(hashlib.sha256(f"{key}|{tag}|{a}|{b}|{i}|{right if i % 2 == 0 else left}".encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            left = (left + word % a) % a
        else:
            right = (right + word % b) % b
    return left * b + right


def permuted(d, tag):
    h = len(d) // 2
    return str(feistel(int(d), 10**h, 10**(len(d) - h), tag)).zfill(len(d))


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10


def filled(form, d):
    it = iter(d)
    return re.sub(r"\d", lambda _: next(it), form)


def card(m):
    d = re.sub(r"\D", "", m)
    if luhn(d):
        return m
    body = permuted(d[:-1], "card")
    return filled(m, body + str(-luhn(body + "0") % 10))


def phone(m):
    d = re.sub(r"\D", "", m)
    return filled(m, d[:-10] + permuted(d[-10:], "phone"))


def ssn(m):
    a, g, s = map(int, m.split("-"))
    if not (1 <= a <= 899 and a != 666 and g and s):
        return m
    y = feistel(((a - 2 if a > 666 else a - 1) * 99 + g - 1) * 9999 + s - 1, 898 * 99, 9999, "ssn")
    p, s = divmod(y, 9999)
    a, g = divmod(p, 99)
    return f"{a + 2 if a >= 665 else a + 1:03}-{g + 1:02}-{s + 1:04}"


def ip(m):
    p = [int(x) for x in m.split(".")]
    if max(p) > 255:
        return m
    y = feistel(int.from_bytes(bytes(p), "big"), 65536, 65536, "ip")
    return ".".join(map(str, y.to_bytes(4, "big")))


FIRST = datetime.date(1800, 1, 1)
LATE_DAYS = [d for d in (FIRST + datetime.timedelta(n) for n in range(146097)) if d.day > 12]
LATE_PLACE = {d: n for n, d in enumerate(LATE_DAYS)}


def date(m, form=None):
    """``form`` only says what the test reads the date as; month and day go first as the text says."""
    p = re.split(r"[-/.]", m)
    year_first, sign = len(p[0]) == 4, re.search(r"\D", m).group(0)
    year, one, two = (p[0], p[1], p[2]) if year_first else (p[2], p[0], p[1])
    month_first = year_first or sign == "/" and int(one) <= 12
    month, day = (one, two) if month_first else (two, one)
    try:
        when = datetime.date(int(year), int(month), int(day))
    except ValueError:
        return m
    if not 1800 <= when.year < 2200:
        return m
    if sign == "/" and not year_first and when.day <= 12:
        y, rest = divmod(feistel((when.year - 1800) * 144 + (int(one) - 1) * 12 + int(two) - 1, 240, 240, "pair"), 144)
        y, a, b = y + 1800, rest // 12 + 1, rest % 12 + 1
    else:
        if sign == "/" and not year_first:
            new = LATE_DAYS[feistel(LATE_PLACE[when], 9, 9833, "late")]
        else:
            new = FIRST + datetime.timedelta(feistel((when - FIRST).days, 189, 773, "date"))
        y, a, b = (new.year, new.month, new.day) if month_first else (new.year, new.day, new.month)
    a, b = (f"{x:02}" if len(one) == len(two) == 2 else str(x) for x in (a, b))
    return sign.join((str(y), a, b) if year_first else (a, b, str(y)))


def iban(m):
    t = m.replace(" ", "")
    number = lambda x: int("".join(str(int(c, 36)) for c in x))
    if number(t[4:] + t[:4]) % 97 != 1 or not 2 <= int(t[2:4]) <= 98:
        return m
    d = re.sub(r"\D", "", t[4:])
    h = len(d) // 2
    a, b = 10**h, 10**(len(d) - h)
    y = feistel(int(d), a, b, f"iban{t[:2]}")
    body = filled(t[4:], str(y).zfill(len(d)))
    return filled(m, f"{98 - number(body + t[:2] + '00') % 97:02}" + re.sub(r"\D", "", body))


def email(m):
    return "u" + hashlib.sha256(f"{KEY}|email|{m.lower()}".encode()).hexdigest()[:12] + m[m.rindex("@"):]


def secret(v):
    return (hashlib.sha256(f"{KEY}|secret|{v}".encode()).hexdigest() * 8)[:len(v)]


HEX = "747e8edd6430861f24c6911d38d6f174e76a63b3"
CASES = [
    ("4952935900253052", card("4952935900253052")),
    ("4952935900253053", "4952935900253053"),  # no Luhn sum
    ("4952 9359 0025 3052", card("4952 9359 0025 3052")),
    ("4952-9359-0025-3052", card("4952-9359-0025-3052")),
    ("378282246310005", card("378282246310005")),
    ("4222222222222", card("4222222222222")),
    ("0000000000000000000", card("0000000000000000000")),
    ("12345678901234567890", "12345678901234567890"),  # too long
    ("+1 (017) 555-7713", phone("+1 (017) 555-7713")),
    ("(212) 555-0100", phone("(212) 555-0100")),
    ("212-555-0100", phone("212-555-0100")),
    ("+44 212.555.0100", phone("+44 212.555.0100")),
    ("123-45-6789", ssn("123-45-6789")), ("899-99-9999", ssn("899-99-9999")), ("667-01-0001", ssn("667-01-0001")),
    ("666-45-6789", "666-45-6789"), ("000-45-6789", "000-45-6789"), ("900-45-6789", "900-45-6789"),
    ("97.51.17.173", ip("97.51.17.173")), ("0.0.0.0", ip("0.0.0.0")), ("256.1.1.1", "256.1.1.1"), ("1.2.3.4.5", "1.2.3.4.5"),
    ("2024-02-29", date("2024-02-29", "%Y-%m-%d")), ("2023-02-29", "2023-02-29"), ("1799-12-31", "1799-12-31"),
    ("2199/12/31", date("2199/12/31", "%Y/%m/%d")), ("31.12.1999", date("31.12.1999", "%d.%m.%Y")),
    ("12/31/1999", date("12/31/1999", "%m/%d/%Y")), ("31/12/1999", date("31/12/1999", "%d/%m/%Y")), ("99/99/1999", "99/99/1999"),
    ("the.55@mail4.example.com", email("the.55@mail4.example.com")), ("ciónrr.1@a.example", email("ciónrr.1@a.example")), ("a@b", "a@b"),
    (f'token = "{HEX}"', f'token = "{secret(HEX)}"'), ("password=short", "password=short"),
    ("16 digits, 3.5 and 555-7713", "16 digits, 3.5 and 555-7713"),
]


def replaced(spark, rows, **kw):
    return o.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), KEY, count_col="n", **kw).orderBy("doc_id").collect()


def test_each_kind_alone_and_in_a_sentence(spark):
    rows = [(2 * k + j, f"Für {t}{t2}, ende." if j else t) for k, (t, _) in enumerate(CASES) for j, t2 in enumerate(("", "%%%"))]
    got = replaced(spark, rows)
    want = [f"Für {w}%%%, ende." if j else w for _, w in CASES for j in (0, 1)]
    assert [r["text"] for r in got] == want
    assert [r["n"] for r in got] == [int(w != t) for t, w in CASES for _ in (0, 1)]


def test_several_in_one_text_and_equal_values_stay_linked(spark):
    a, b = "7536784127813050 4845168114407329", "x 7536784127813050 +1 (017) 555-7713 12.3.4.5\n2020-01-02."
    got = replaced(spark, [(1, a), (2, b)])
    assert got[0]["text"] == f"{card('7536784127813050')} {card('4845168114407329')}"
    assert got[1]["text"] == f"x {card('7536784127813050')} {phone('+1 (017) 555-7713')} {ip('12.3.4.5')}\n{date('2020-01-02', '%Y-%m-%d')}."
    assert [r["n"] for r in got] == [2, 4]


def test_whole_secrets_names_phones_and_short_dates(spark):
    long, jwt = "aB3" * 500, "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9"
    hexes = hashlib.sha256(f"{KEY}|secret|{long}".encode()).hexdigest() * 30
    cases = [(f"token={long}.", f"token={hexes[:len(long)]}."), (f'token: "{jwt}"', f'token: "{secret(jwt)}"'), ("password=hunter2!", f"password={secret('hunter2')}!"),
             ("password = 'letmein'", f"password = '{secret('letmein')}'"), ("token: string", "token: string"), ("n" * 400 + "@a.example", email("n" * 400 + "@a.example"))]
    cases += [(x, phone(x)) for x in ("+15551234567", "+1 555 123 4567", "+44 20 7946 0958", "+33 1 42 68 53 00", "01 42 68 53 00", "020 7946 0958", "555 123 4567", "+12345678", "+123456789012345")]
    cases += [(x, x) for x in ("+1234567", "+1234567890123456", "10 000 000", "12 of 345 678 901")]

    cases += [(x, date(x)) for x in ("3.5.2021", "7/4/1999", "7/14/1999", "2021-5-3", "31/1/1999", "12.5.2021")]
    got = replaced(spark, [(k, f"See {x} here") for k, (x, _) in enumerate(cases)])
    assert [r["text"] for r in got] == [f"See {w} here" for _, w in cases]


def test_edge_rows_and_other_columns(spark):
    schema = "doc_id long, text string, n_chars long, a string, b string, found string"
    rows = [(None, None, None, "p", "q", "r"), (1, "", 9, None, None, None), (2, "1.2.3.4", 7, "", "", ""), (2, "1.2.3.4", 7, "", "", "")]
    got = o.pseudonymise(spark.createDataFrame(rows, schema), KEY)
    assert got.columns == schema.replace(" long", "").replace(" string", "").split(", ")
    found = sorted(map(tuple, got.collect()), key=str)
    assert (None, None, None, "p", "q", "r") in found and (1, "", 0, None, None, None) in found
    assert found.count((2, ip("1.2.3.4"), len(ip("1.2.3.4")), "", "", "")) == 2
    assert o.pseudonymise(spark.createDataFrame([], schema), KEY).count() == 0


@pytest.mark.parametrize(("a", "b"), [(1, 10), (7, 3), (10, 100)])
def test_feistel_is_a_permutation(spark, a, b):
    got = spark.range(a * b).select(o.feistel(F.col("id"), F.lit(a).cast("long"), F.lit(b).cast("long"), KEY, "t").alias("y"))
    found = [r["y"] for r in got.collect()]
    assert sorted(found) == list(range(a * b)) and found == [feistel(x, a, b, "t") for x in range(a * b)]


def test_very_long_text(spark):
    text = "a" * 300_000 + " 1.2.3.4 " + "9" * 300_000 + " x@" * 50_000
    assert replaced(spark, [(1, text)])[0]["text"] == text.replace(" 1.2.3.4 ", f" {ip('1.2.3.4')} ")


def test_plan_has_no_python(spark):
    plan = o.pseudonymise(spark.createDataFrame([(1, "x")], "doc_id long, text string"), KEY)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ibans_and_national_phones(spark):
    ibans = ("DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606", "ES91 2100 0418 4502 0005 1332", "NO93 8601 1117 947",
             "AT61 1904 3002 3457 3201", "MT84 MALT 0110 0001 2345 MTLC AST0 01S")
    cases = [(x, iban(x)) for x in ibans] + [("DE88 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00"), ("ID42 4952935900253052", f"ID42 {card('4952935900253052')}")]
    cases += [(x, phone(x)) for x in ("612 345 678", "912 34 56 78", "(030) 123456", "(030) 12 34 56", "030/123456")]
    cases += [(x, x) for x in ("612 345 000", "01/2024", "9 612 345 678 x", "100 200 300", "(030) 12", "AB12 words")]
    assert all(w != x for x, w in cases[:8])
    got = replaced(spark, [(k, f"See {x} BIC 12 here") for k, (x, _) in enumerate(cases)])
    assert [r["text"] for r in got] == [f"See {w} BIC 12 here" for _, w in cases]


def test_dates_as_written_have_pseudonyms_of_their_own(spark):
    """Every slash date of eight years, both ways round, among the images of all 400 years' dates: none meet, all are dates."""
    days = spark.sql("SELECT explode(sequence(DATE'1996-01-01', DATE'2003-12-31')) AS d")
    texts = days.select(F.explode(F.array(F.date_format("d", "MM/dd/yyyy"), F.date_format("d", "dd/MM/yyyy"))).alias("t")).distinct()
    got = {r["t"]: r["p"] for r in texts.select("t", o.date(F.col("t"), KEY).alias("p")).collect()}
    assert len(set(got.values())) == len(got) and got == {t: date(t) for t in got}


def test_every_late_day_is_found_again(spark):
    first = F.lit("1800-01-01").cast("date")
    got = spark.range(len(LATE_DAYS)).select("id", o._late_month(F.col("id"), first).alias("p")).collect()
    assert all((1800 + r["p"]["month"] // 12, r["p"]["month"] % 12 + 1, r["p"]["day"]) == (d.year, d.month, d.day) for r in got for d in [LATE_DAYS[r["id"]]])
