"""Format-preserving pseudonyms for personal data, in SQL functions only.

Candidates are found by one pattern, account and card numbers by their own in what is left, and validated: card numbers by their check digit,
account numbers (IBAN) by their remainder, dates by the calendar, addresses of hosts by
their octets, social-security numbers by their unused ranges, phone numbers by their
length. A valid value is permuted within its format by a keyed Feistel network with SHA-256
rounds, so that its length, separators and check digits stay right, two values never get one
pseudonym, and equal values get equal ones in every document. Mail addresses and
secrets have no such format: a mail address gets a keyed hash as name at a reserved
domain, and the hexadecimal digits of a secret are replaced by as many of a keyed hash.

Other numbers and words may stand beside an account or card number with one separator between. Each start and
end at a separator is tried; of two valid values that overlap the longer one counts, of equal ones the first.

Dates are permuted over the 400 years from 1800 to 2199, a full cycle of the calendar; others and
invalid values stay as they are, as do texts without any candidate.

A phone number is one with a `+`: its country code is told by its digits, so that all notations of a number get
pseudonyms of the same digits. Not looked for: national phone numbers without `+`, dates whose order is
day/month/year with slashes, secrets that are not hexadecimal, IPv6 addresses.

Cases: a null text stays null and an empty one empty; repeated rows are treated each, ties among overlapping
values as above; a very long text is searched whole; an empty table gives no rows; other columns pass through,
whatever their names.
"""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envspark.llm.common import fresh
from envspark.llm.fingerprints import let

ROUNDS = 10
#: fixed values: patterns by kind; the first that fits a candidate decides
PATTERNS = {
    "secret": r"(?i:token|secret|password|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])",
    "email": r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "phone": r"\+[0-9](?:[ ().-]{0,2}[0-9]){7,14}(?![0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "date_iso": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    "date_dotted": r"(?<![0-9.])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9]|\.[0-9])",
    "date_slashed": r"(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9]|/[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "host": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
#: kinds whose candidates may hold a shorter valid value; a candidate here is the longest from its start. Least length, and what goes on in it
RUNS = {"iban": (12, "[0-9A-Za-z]"), "card": (13, "[0-9]")}
ANY = "|".join(f"(?:{p})" for kind, p in PATTERNS.items() if kind not in RUNS)
# every candidate has one of these
HINT = "[0-9@]"

#: fixed values: country calling codes of one and two digits; all others have three
COUNTRY_CODE = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

FIRST_DAY, DAYS = "1800-01-01", 146_097
#: 146,097 = 189 * 773
DAY_FACTORS = (189, 773)
SSN_AREAS, SSN_GROUPS, SSN_SERIALS = 898, 99, 9999


def use_key(key: str, use: str) -> str:
    """The key of one kind of values. Plans, and so the logs of a session, show these and never the key itself."""
    return hmac.new(key.encode(), use.encode(), hashlib.sha256).hexdigest()


def keyed(key: str, use: str, *parts: Column) -> Column:
    """Hexadecimal SHA-256 of the key of this use and the parts."""
    return F.sha2(F.concat_ws("|", F.lit(use_key(key, use)), *[p.cast("string") for p in parts]).cast("binary"), 256)


def feistel(a: Column, b: Column, sizes: tuple[Column, Column], key: str, use: str) -> Column:
    """Permute the pairs (a, b) with 0 <= a < sizes[0], 0 <= b < sizes[1]; a struct of a and b."""
    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        other = F.when(even, s["b"]).otherwise(s["a"])
        moved = F.conv(F.substring(keyed(key, use, i, other), 1, 15), 16, 10).cast("long")
        return F.struct(F.when(even, (s["a"] + moved) % sizes[0]).otherwise(s["a"]).alias("a"),
                        F.when(even, s["b"]).otherwise((s["b"] + moved) % sizes[1]).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _padded(number: Column, width: Column) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _part(text: Column, start: Column, length: Column) -> Column:
    return F.substring(text, start, length)


def permuted_digits(digits: Column, key: str, use: str) -> Column:
    """A permutation of the digit strings of one length (2 to 36)."""
    def split(n: Column) -> Column:
        left = F.floor(n / 2).cast("int")
        right = n - left
        size = lambda w: F.rpad(F.lit("1"), w + 1, "0").cast("long")
        mixed = feistel(_part(digits, F.lit(1), left), _part(digits, left + 1, right), (size(left), size(right)),
                        key, use)
        return let(mixed, lambda s: F.concat(_padded(s["a"], left), _padded(s["b"], right)))

    return let(F.length(digits), split)


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def refilled(template: Column, digits: Column) -> Column:
    """`template` with its digits replaced in turn by those of `digits`."""
    def step(s: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(F.concat(s["out"], F.when(is_digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
                        F.when(is_digit, s["at"] + 1).otherwise(s["at"]).alias("at"))

    return F.aggregate(F.split(template, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step)["out"]


def luhn_sum(digits: Column, last_doubled: bool) -> Column:
    """Sum of the digits, every other one doubled from the last or the last but one on."""
    turned = F.reverse(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == (1 if last_doubled else 0), double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)


def _card_valid(value: Column) -> Column:
    return let(only_digits(value), lambda d: (F.length(d) >= 13) & (luhn_sum(d, False) % 10 == 0))


def _card(value: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        checked = let(body, lambda b: F.concat(b, ((10 - luhn_sum(b, True) % 10) % 10).cast("string")))
        return F.when(luhn_sum(digits, False) % 10 == 0, refilled(value, checked)).otherwise(value)

    return let(only_digits(value), of)


def _remainder(text: Column) -> Column:
    """Modulo 97 of a string of digits and capitals, which stand for 10 to 35."""
    def step(r: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban_valid(value: Column) -> Column:
    def of(plain: Column) -> Column:
        return (F.length(plain) >= 12) & (_remainder(F.concat(F.substring(plain, F.lit(5), F.length(plain)),
                                                             F.substring(plain, 1, 4))) == 1)

    return let(F.regexp_replace(value, " ", ""), of)


def _iban(value: Column, key: str) -> Column:
    def of(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
        digits = only_digits(account)
        moved = F.when(F.length(digits) > 1, refilled(account, permuted_digits(digits, key, "iban"))).otherwise(account)
        whole = let(moved, lambda m: F.concat(
            country, _padded(98 - _remainder(F.concat(m, country, F.lit("00"))), F.lit(2)), m))
        valid = _remainder(F.concat(account, F.substring(plain, 1, 4))) == 1
        return F.when(valid, let(whole, lambda w: refilled(value, only_digits(w)))).otherwise(value)

    return let(F.regexp_replace(value, " ", ""), of)


def _phone(value: Column, key: str) -> Column:
    """The country code stays, whatever separators follow it; the other digits are permuted."""
    def of(digits: Column) -> Column:
        code = F.regexp_extract(digits, COUNTRY_CODE, 0)
        moved = let(code, lambda c: F.concat(c, permuted_digits(F.substring(digits, F.length(c) + 1, F.length(digits)), key, "phone")))
        return F.when(F.length(digits).between(8, 15), refilled(value, moved)).otherwise(value)

    return let(only_digits(value), of)


def _host(value: Column, key: str) -> Column:
    def of(o: Column) -> Column:
        n = [F.get(o, i).cast("int") for i in range(4)]
        valid = (n[0] < 256) & (n[1] < 256) & (n[2] < 256) & (n[3] < 256)
        mixed = feistel(n[0] * 256 + n[1], n[2] * 256 + n[3], (F.lit(65536), F.lit(65536)), key, "host")
        byte = lambda x, high: (F.floor(x / 256) if high else x % 256).cast("string")
        return F.when(valid, let(mixed, lambda s: F.concat_ws(
            ".", byte(s["a"], True), byte(s["a"], False), byte(s["b"], True), byte(s["b"], False)))).otherwise(value)

    return let(F.split(value, r"\."), of)


def _ssn(value: Column, key: str) -> Column:
    def of(p: Column) -> Column:
        area, group, serial = (F.get(p, i).cast("int") for i in range(3))
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        rank = F.when(area > 666, area - 2).otherwise(area - 1)
        mixed = feistel(rank * SSN_GROUPS + group - 1, serial - 1,
                        (F.lit(SSN_AREAS * SSN_GROUPS), F.lit(SSN_SERIALS)), key, "ssn")

        def shown(s: Column) -> Column:
            place = F.floor(s["a"] / SSN_GROUPS) + 1
            number = F.when(place >= 666, place + 1).otherwise(place)
            return F.concat_ws("-", _padded(number, F.lit(3)), _padded(s["a"] % SSN_GROUPS + 1, F.lit(2)),
                               _padded(s["b"] + 1, F.lit(4)))
        return F.when(valid, let(mixed, shown)).otherwise(value)

    return let(F.split(value, "-"), of)


def _date(value: Column, key: str, mark: str, order: str) -> Column:
    """Dates whose parts stand in `order` (of y, m, d) between marks."""
    def of(p: Column) -> Column:
        part = {name: F.get(p, i) for i, name in enumerate(order)}
        day = F.try_to_date(F.concat_ws("-", part["y"], F.lpad(part["m"], 2, "0"), F.lpad(part["d"], 2, "0")), "yyyy-MM-dd")

        def moved(offset: Column) -> Column:
            mixed = feistel(F.floor(offset / DAY_FACTORS[1]), offset % DAY_FACTORS[1],
                            (F.lit(DAY_FACTORS[0]), F.lit(DAY_FACTORS[1])), key, "date")
            new = let(mixed, lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"),
                                                 (s["a"] * DAY_FACTORS[1] + s["b"]).cast("int")))

            def shown(d: Column) -> Column:
                number = {"y": F.year(d), "m": F.month(d), "d": F.dayofmonth(d)}
                text = [F.when(F.length(part[n]) > F.length(number[n].cast("string")), _padded(number[n], F.length(part[n])))
                        .otherwise(number[n].cast("string")) for n in order]
                return F.concat_ws(mark, *text)
            return F.when(offset.between(0, DAYS - 1), let(new, shown)).otherwise(value)

        return F.coalesce(let(F.datediff(day, F.lit(FIRST_DAY).cast("date")), moved), value)

    return let(F.split(value, "\\" + mark), of)


def _email(value: Column, key: str) -> Column:
    return F.concat(F.lit("user-"), F.substring(keyed(key, "email", F.lower(value)), 1, 16), F.lit("@example.invalid"))


def _secret(value: Column, key: str) -> Column:
    hexes = F.regexp_extract(value, "([0-9A-Fa-f]{32,64})$", 1)
    return let(hexes, lambda h: F.concat(F.substring(value, F.lit(1), F.length(value) - F.length(h)),
                                         F.substring(keyed(key, "secret", h), F.lit(1), F.length(h))))


MAKERS: dict[str, Callable[[Column, str], Column]] = {
    "secret": _secret, "email": _email, "phone": _phone, "iban": _iban,
    "date_iso": lambda v, k: _date(v, k, "-", "ymd"), "date_dotted": lambda v, k: _date(v, k, ".", "dmy"),
    "date_slashed": lambda v, k: _date(v, k, "/", "mdy"), "ssn": _ssn, "host": _host, "card": _card,
}


VALID: dict[str, Callable[[Column], Column]] = {"iban": _iban_valid, "card": _card_valid}


def pseudonym(value: Column, key: str) -> Column:
    """What a candidate becomes; an invalid one stays."""
    out = value
    for kind in reversed([k for k in PATTERNS if k not in RUNS]):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), MAKERS[kind](value, key)).otherwise(out)
    return out


def valid_length(run: Column, kind: str) -> Column:
    """Length of the longest valid value at the start of a candidate that ends where nothing goes on; 0 without one."""
    least, inner = RUNS[kind]

    def ends(n: Column) -> Column:
        last, following = F.substring(run, n, F.lit(1)), F.substring(run, n + 1, F.lit(1))
        return last.rlike(inner) & ~following.rlike(inner) & VALID[kind](F.substring(run, F.lit(1), n))

    lengths = F.filter(F.sequence(F.length(run), F.lit(least), F.lit(-1)), ends)
    return F.when(F.length(run) >= least, F.coalesce(F.get(lengths, 0), F.lit(0))).otherwise(0)


def segments(text: Column, kind: str, key: str) -> Column:
    """The text in segments: an array of structs of text and whether it is a pseudonym of this kind."""
    pattern = PATTERNS[kind]
    behind, rest = pattern[:pattern.index(")") + 1], pattern[pattern.index(")") + 1:]
    starts = f"{behind}(?={rest})"
    segment = lambda t, done: F.struct(t.alias("t"), F.lit(done).alias("done"))
    none = F.array().cast("array<struct<t:string,done:boolean>>")
    # a blank before keeps a match at the beginning from being left out by split
    parts = F.split(F.concat(F.lit(" "), text), starts, -1)
    runs = F.regexp_extract_all(text, F.lit(f"{behind}(?=({rest}))"), F.lit(1))

    def found(part: Column, run: Column) -> Column:
        size = valid_length(run, kind)
        return F.struct(part.alias("part"), F.length(part).alias("length"), size.alias("size"),
                        F.when(size > 0, F.substring(run, F.lit(1), size)).alias("value"))

    def scan(cases: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            c = F.get(cases, i)

            # a longer valid value that starts within this one goes first
            def look(t: Column, d: Column) -> Column:
                begins = t["at"]
                return F.struct((begins + d["length"]).alias("at"),
                                (t["longer"] | ((begins < c["size"]) & (d["size"] > c["size"]))).alias("longer"))

            # starts are two characters apart at least
            nearby = F.slice(cases, i + 2, F.greatest(F.lit(1), F.ceil(c["size"] / 2).cast("int")))
            longer = F.aggregate(nearby, F.struct(c["length"].alias("at"), F.lit(False).alias("longer")), look)["longer"]
            plain = F.struct(F.concat(s["out"], F.array(segment(F.substring(c["part"], s["skip"] + 1, c["length"]), False))).alias("out"),
                             F.greatest(F.lit(0), s["skip"] - c["length"]).alias("skip"))
            after = F.substring(c["part"], c["size"] + 1, c["length"])
            taken = F.struct(F.concat(s["out"], F.array(segment(MAKERS[kind](c["value"], key), True), segment(after, False))).alias("out"),
                             F.greatest(F.lit(0), c["size"] - c["length"]).alias("skip"))
            return F.when((s["skip"] > 0) | (c["size"] == 0), plain).when(longer, plain).otherwise(taken)

        state = F.struct(none.alias("out"), F.lit(0).alias("skip"))
        return F.aggregate(F.sequence(F.lit(0), F.size(cases) - 1), state, step)["out"]

    def cut(p: Column) -> Column:
        first = F.array(segment(F.substring(F.get(p, 0), F.lit(2), F.length(F.get(p, 0))), False))
        return F.concat(first, let(F.zip_with(F.slice(p, F.lit(2), F.size(p) - 1), runs, found), scan))

    whole = F.array(segment(text, False))
    return F.when(text.rlike(starts), let(parts, cut)).otherwise(whole)


def replaced_runs(gap: Column, key: str) -> Column:
    """A text between other candidates as segments, account and card numbers replaced."""
    def cards(s: Column) -> Column:
        return F.when(s["done"], F.array(s)).otherwise(segments(s["t"], "card", key))

    return F.flatten(F.transform(segments(gap, "iban", key), cards))


def pseudonymized(docs: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, str]:
    """The documents with their text replaced, and the name of an added column: how many values were replaced."""
    body = F.col(f"`{text}`")
    found, made, gaps, count = (fresh(docs, name) for name in ("_found", "_made", "_gaps", "n_replaced"))
    none = F.array().cast("array<string>")
    hinted = body.rlike(HINT)
    candidates = F.regexp_extract_all(body, F.lit(f"({ANY})"), F.lit(1))
    searched = docs.withColumn(found, F.when(hinted, candidates).otherwise(none))
    between = F.transform(F.split(body, ANY, -1), lambda g: replaced_runs(g, key))
    replaced = (searched.withColumn(made, F.when(F.size(found) > 0, F.transform(found, lambda v: pseudonym(v, key))).otherwise(none))
                .withColumn(gaps, F.when(hinted, between)))
    joined = lambda g: F.array_join(F.transform(g, lambda s: s["t"]), "")
    woven = F.concat(joined(F.get(gaps, 0)), F.array_join(F.transform(
        F.col(made), lambda v, i: F.concat(v, joined(F.get(gaps, i + 1)))), ""))
    changed = F.when(hinted, woven).otherwise(body)
    number = F.size(F.filter(F.zip_with(found, made, lambda a, b: a != b), lambda x: x))
    runs = F.aggregate(gaps, F.lit(0), lambda n, g: n + F.size(F.filter(g, lambda s: s["done"])))
    out = replaced.withColumn(count, (F.coalesce(number, F.lit(0)) + F.coalesce(runs, F.lit(0))).cast("long"))
    return out.withColumn(text, changed).drop(found, made, gaps), count
