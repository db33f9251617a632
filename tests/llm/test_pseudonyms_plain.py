"""Pseudonyms against a plain Python version, on whole documents."""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import re

import pyarrow.parquet as pq
from conftest import SMALL

from envspark.llm import pseudonyms
from envspark.llm.queries import KEY, queries

FIRST = dt.date(1800, 1, 1)
ONE_OR_TWO = {"1", "7", "20", "27", *"30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58".split(),
              *"60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}


def hexes(key, use, *parts):
    own = hmac.new(key.encode(), use.encode(), hashlib.sha256).hexdigest()
    return hashlib.sha256("|".join([own, *map(str, parts)]).encode()).hexdigest()


def feistel(a, b, sizes, key, use):
    for i in range(10):
        moved = int(hexes(key, use, i, b if i % 2 == 0 else a)[:15], 16)
        a, b = ((a + moved) % sizes[0], b) if i % 2 == 0 else (a, (b + moved) % sizes[1])
    return a, b


def digits_moved(digits, key, use):
    left = len(digits) // 2
    right = len(digits) - left
    a, b = feistel(int(digits[:left] or 0), int(digits[left:] or 0), (10 ** left, 10 ** right), key, use)
    return (str(a).zfill(left) if left else "") + str(b).zfill(right)


def refill(template, digits):
    left = iter(digits)
    return "".join(next(left) if c in "0123456789" else c for c in template)


def only(text):
    return re.sub("[^0-9]", "", text)


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))


def card_valid(value):
    return len(only(value)) >= 13 and luhn(only(value)) % 10 == 0


def card(value, key):
    body = digits_moved(only(value)[:-1], key, "card")
    return refill(value, next(body + c for c in "0123456789" if luhn(body + c) % 10 == 0))


def remainder(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban_valid(value):
    plain = value.replace(" ", "")
    return len(plain) >= 12 and remainder(plain[4:] + plain[:4]) == 1


def iban(value, key):
    plain = value.replace(" ", "")
    account = plain[4:]
    if len(only(account)) > 1:
        account = refill(account, digits_moved(only(account), key, "iban"))
    return refill(value, only(plain[:2] + str(98 - remainder(account + plain[:2] + "00")).zfill(2) + account))


def phone(value, key):
    digits = only(value)
    if not 8 <= len(digits) <= 15:
        return value
    code = next((digits[:n] for n in (1, 2) if digits[:n] in ONE_OR_TWO), digits[:3])
    return refill(value, code + digits_moved(digits[len(code):], key, "phone"))


def host(value, key):
    parts = list(map(int, value.split(".")))
    if max(parts) > 255:
        return value
    a, b = feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], (65536, 65536), key, "host")
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def ssn(value, key):
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return value
    places = [n for n in range(1, 900) if n != 666]
    a, b = feistel(places.index(area) * 99 + group - 1, serial - 1, (898 * 99, 9999), key, "ssn")
    return f"{places[a // 99]:03d}-{a % 99 + 1:02d}-{b + 1:04d}"


def date(mark, order):
    def made(value, key):
        part = dict(zip(order, value.split(mark)))
        try:
            offset = (dt.date(*(int(part[n]) for n in "ymd")) - FIRST).days
        except ValueError:
            return value
        if not 0 <= offset < 146_097:
            return value
        a, b = feistel(offset // 773, offset % 773, (189, 773), key, "date")
        day = FIRST + dt.timedelta(a * 773 + b)
        number = {"y": str(day.year), "m": str(day.month), "d": str(day.day)}
        return mark.join(number[n].zfill(len(part[n])) for n in order)
    return made


def email(value, key):
    return f"user-{hexes(key, 'email', value.lower())[:16]}@example.invalid"


def secret(value, key):
    found = re.search("[0-9A-Fa-f]{32,64}$", value)[0]
    return value[:-len(found)] + hexes(key, "secret", found)[:len(found)]


MAKE = {"secret": secret, "email": email, "phone": phone, "date_iso": date("-", "ymd"), "date_dotted": date(".", "dmy"),
        "date_slashed": date("/", "mdy"), "ssn": ssn, "host": host}
RUNS = {"iban": (iban, iban_valid, "[0-9A-Za-z]", 12), "card": (card, card_valid, "[0-9]", 13)}


def runs(text, kind, key):
    """(piece, whether it is a pseudonym): of overlapping valid values the longer one counts, of equal ones the first."""
    make, valid, inner, least = RUNS[kind]
    pattern = re.compile(pseudonyms.PATTERNS[kind])
    cases = []
    for at in range(len(text)):
        run = pattern.match(text, at)
        if run:
            run = run[0]
            ends = [n for n in range(len(run), least - 1, -1) if re.match(inner, run[n - 1])
                    and not re.match(inner, run[n:n + 1] or " ") and valid(run[:n])]
            cases.append((at, ends[0] if ends else 0))
    out, done = [], 0
    for at, size in cases:
        if at < done or not size or any(at < other < at + size and length > size for other, length in cases):
            continue
        out += [(text[done:at], False), (make(text[at:at + size], key), True)]
        done = at + size
    return [*out, (text[done:], False)]


def plain(text, key):
    if text is None:
        return None, 0
    whole = re.compile("|".join(f"(?:{p})" for kind, p in pseudonyms.PATTERNS.items() if kind not in RUNS))
    out, count, low = [], 0, 0

    def gap(part):
        found = []
        for piece, done in runs(part, "iban", key):
            found += [(piece, True)] if done else runs(piece, "card", key)
        return "".join(p for p, _ in found), sum(d for _, d in found)

    for match in whole.finditer(text):
        value = match[0]
        kind = next(k for k, p in pseudonyms.PATTERNS.items() if k not in RUNS and re.fullmatch(p, value))
        made = MAKE[kind](value, key)
        between, n = gap(text[low:match.start()])
        out += [between, made]
        count += n + (made != value)
        low = match.end()
    between, n = gap(text[low:])
    return "".join([*out, between]), count + n


def test_query_equals_the_plain_version(spark):
    got = {r.doc_id: (r.text, r.n_replaced) for r in queries()["op8_pii_pseudonyms"](spark, SMALL).collect()}
    rows = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(rows) == len(got) and sum(n for _, n in got.values()) > 10
    for r in rows:
        assert got[r["doc_id"]] == plain(r["text"], KEY), r["doc_id"]


def test_each_kind_equals_the_plain_version(spark):
    texts = ["+49 30 123456789, +4930123456789 or +49 (30) 12345-6789", "+1 (437) 555-0689 +14375550689 +1.437.555.0689",
             "+358 9 1234567 +3589 1234567 +0 12345678", "4111 1111 1111 1111 and 4539578763621486 12/25", "192.168.0.1 256.0.0.1 8.8.8.8",
             "DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 IBAN", "2024-02-29 31.12.1999 1.2.2003 02/28/2000 2/8/2000 1700-01-01",
             "078-05-1120 899-99-9999 666-01-0001", "A.b@Mail.example.com a.b@mail.EXAMPLE.com",
             'token = "1eb9c654e721b4f812088970e66a6345cee33dd6 api_key:' + "a1" * 16, "1234 5678 " * 30, "", " ", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out, count = pseudonyms.pseudonymized(docs, "k")
    got = {r.doc_id: (r.text, r[count]) for r in out.collect()}
    for i, text in enumerate(texts):
        assert got[i] == plain(text, "k")
    # all notations of a phone number keep their digits equal
    for i, pattern in ((0, r"\+49[ ()0-9-]{9,16}"), (1, r"\+1[ ().0-9-]{10,16}"), (2, r"\+358[ 0-9]{8,10}")):
        assert len({only(v) for v in re.findall(pattern, got[i][0])}) == 1, got[i]


def test_the_key_does_not_show_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "+49 30 123456789")], "doc_id long, text string")
    plan = pseudonyms.pseudonymized(docs, "a very private key")[0]._jdf.queryExecution().toString()
    assert "a very private key" not in plan
