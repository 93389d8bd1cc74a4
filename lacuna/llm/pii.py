"""Format-preserving pseudonyms by keyed Feistel permutations, in SQL expressions only.

Values found in a text are replaced within their format, so that equal values stay linked
across documents and different values of a kind stay different:

* card: 13-19 digits that pass the Luhn check, bare or in groups. All digits but the last are permuted; the last becomes the
  new check digit, so that valid numbers stay valid.
* phone: +country code stays, the other digits are permuted. national: 3-3-4 digits in groups. ssn: 3-2-4 digits.
* ip: four numbers to 255 are permuted as 32 bits. iban: where mod 97 is 1, the digits behind the
  check digits are permuted, letters stay, and the check digits are made anew.
* date: a valid year-month-day or day/month/year of 1800-2199 is permuted among the 146097 days of these years.
* email: the local part and the host become a keyed digest at example.invalid.
* secret: a key, token, password or secret with an assigned value of 16 hexadecimal digits or more, permuted as hexadecimal digits.

The permutation is an alternating Feistel network on (left, right) of Z_a x Z_b: each round adds a
keyed SHA-256 of one half to the other, modulo its size. It is a permutation for any a and b,
so that there is nothing to walk around. Candidates that fail validation (a date such as 2023-02-31, an
address such as 300.1.1.1, a number that fails Luhn or mod 97) stay as they are, also where they
overlap another value, which is then not looked for.

Edge cases: a null text stays null with 0 values; an empty one stays empty; repeated rows get equal results; an empty table stays empty;
other columns pass through, but those named like the results (pii_count, pii_kinds) are replaced by them.
"""

from __future__ import annotations

import hashlib
import hmac
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
#: The forms that are looked for, in order of precedence.
FORMS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": r"(?i:(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|key))\s*[=:]\s*[\"']?[0-9a-fA-F]{16,128}(?![0-9a-fA-F])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){3,7}(?: ?[0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{N}+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])",
    "national": r"(?<![\p{L}\p{N}+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\p{L}\p{N}])",
    "date": r"(?<![\p{N}/.-])(?:(?:1[89]|2[01])[0-9]{2}-[01][0-9]-[0-3][0-9]|[0-3]?[0-9][/.][0-3]?[0-9][/.](?:1[89]|2[01])[0-9]{2})(?![\p{N}/-])",
    "ip": r"(?<![\p{N}.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\p{N}]|\.[0-9])",
    "ssn": r"(?<![\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])",
    "card": r"(?<![\p{L}\p{N}])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})(?![\p{L}\p{N}])",
}
ANY = "|".join(f"(?:{p})" for p in FORMS.values())
#: A text without these holds no value; a cheap test that spares most texts the rest.
HINT = r"@|[0-9][0-9./ ()+-]{5}|[0-9a-fA-F]{16}"
DAYS, DAYS_A, DAYS_B = 146097, 627, 233
RESULTS = ("pii_count", "pii_kinds")


def subkey(key: str) -> str:
    """A digest that stands for the key in plans, event logs and the user interface, which show literals; the key can't be told from it, nor
    other subkeys. Whoever sees it can still link pseudonyms, so plans are for those who may."""
    return hmac.new(key.encode("utf-8"), b"lacuna pseudonyms 1", hashlib.sha256).hexdigest()


def permuted(left: Column, right: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """struct(l, r): the image of (left, right) in Z_a x Z_b under the key and tweak."""

    def added(to, other, size, i):
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), other.cast("string")), 256)
        return F.pmod(to + F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size, size)

    def turn(s, i):
        even = i % 2 == 0
        return F.struct(F.when(even, added(s["l"], s["r"], a, i)).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(added(s["r"], s["l"], b, i)).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def power(base: int, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(base**k) for k in range(16 if base == 10 else 13)]), n + 1)


def digits_permuted(digits: Column, key: str, kind: str) -> Column:
    """A string of up to 30 decimal digits, permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = (n - u).cast("int")
    out = permuted(F.coalesce(F.substr(digits, F.lit(1), u).try_cast("long"), F.lit(0)), F.substr(digits, u + 1, v).cast("long"), power(10, u), power(10, v), key, F.concat(F.lit(kind), n.cast("string")))
    return F.transform(F.array(out), lambda s: F.concat(F.when(u > 0, F.lpad(s["l"].cast("string"), u, "0")).otherwise(""), F.lpad(s["r"].cast("string"), v, "0")))[0]


def refilled(value: Column, digits: Column) -> Column:
    """value with its decimal digits replaced one by one by those of digits."""
    step = lambda s, c: F.when(c.between("0", "9"), F.struct(F.concat(s["out"], F.substr(digits, s["k"], F.lit(1))).alias("out"), (s["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k")))
    return F.aggregate(F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step, lambda s: s["out"])


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(body: Column) -> Column:
    """The check digit that belongs behind body."""
    n = F.length(body)

    def step(s, i):
        d = F.substr(body, n - i + 1, F.lit(1)).cast("int")
        return s + F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return (10 - F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10) % 10


def _with(x: Column, f) -> Column:
    """f(x) with x evaluated once."""
    return F.transform(F.array(x), f)[0]


def card(value: Column, key: str) -> Column:
    def new(d):
        body, last = F.substr(d, F.lit(1), F.length(d) - 1), F.right(d, F.lit(1))
        made = lambda: _with(digits_permuted(body, key, "card"), lambda b: _with(F.concat(b, luhn(b).cast("string")), lambda r: refilled(value, r)))
        return F.when(luhn(body).cast("string") == last, made()).otherwise(value)

    return _with(only_digits(value), new)


def mod97(text: Column) -> Column:
    """The number that digits and capital letters (A is 10, Z is 35) stand for, modulo 97."""

    def step(s, c):
        return F.when(c.between("0", "9"), s * 10 + c.try_cast("int")).otherwise(s * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def iban(value: Column, key: str) -> Column:
    """The form's country and check digits go behind the rest, and then the number modulo 97 is 1."""

    def new(v):
        country, body = F.substr(v, F.lit(1), F.lit(2)), F.substr(v, F.lit(5))
        check = lambda b: F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
        made = _with(digits_permuted(body, key, "iban"), lambda b: _with(F.concat(check(b), b), lambda r: refilled(value, r)))
        return F.when((F.length(v) <= 34) & (mod97(F.concat(body, F.substr(v, F.lit(1), F.lit(4)))) == 1), made).otherwise(value)

    return _with(F.regexp_replace(value, " ", ""), new)


def phone(value: Column, key: str) -> Column:
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}", 0)
    split = F.when(F.regexp_like(value, F.lit(r"^\+[0-9]{1,3}[^0-9]")), code).otherwise(F.substr(value, F.lit(1), F.lit(3)))
    return _with(split, lambda c: F.concat(c, _with(F.substr(value, F.length(c) + 1), lambda rest: plain(rest, key, "phone"))))


def plain(value: Column, key: str, kind: str) -> Column:
    return _with(digits_permuted(only_digits(value), key, kind), lambda d: refilled(value, d))


def ip(value: Column, key: str) -> Column:
    def new(p):
        out = permuted(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), key, F.lit("ip"))
        return _with(out, lambda s: F.concat_ws(".", *[x.cast("long").cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)]))

    return _with(F.transform(F.split(value, r"\."), lambda x: x.cast("int")), lambda p: F.when(F.array_max(p) <= 255, new(p)).otherwise(value))


def date(value: Column, key: str) -> Column:
    """ISO dates keep their form; d/m/y where that is a date, else m/d/y, keep theirs with two-digit days and months."""
    sign = F.regexp_extract(value, "[/.]", 0)
    parts = F.split(value, "[/.-]")
    number = lambda s: F.unix_date(F.try_to_date(s, "yyyy-M-d"))
    join = lambda p, *order: F.concat_ws("-", *[p[k] for k in order])

    def new(day, form):
        n = day - F.unix_date(F.lit("1800-01-01").cast("date"))
        out = permuted(F.floor(n / DAYS_B), n % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B), key, F.lit("date"))
        return _with(F.date_add(F.lit("1800-01-01").cast("date"), _with(out, lambda s: s["l"] * DAYS_B + s["r"]).cast("int")), lambda d: F.when(sign == "", F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat(F.date_format(d, form[:2]), sign, F.date_format(d, form[2:]), sign, F.date_format(d, "yyyy"))))

    def pick(p):
        iso, dmy, mdy = number(join(p, 0, 1, 2)), number(join(p, 2, 1, 0)), number(join(p, 2, 0, 1))
        return F.when((sign == "") & iso.isNotNull(), new(iso, "ddMM")).when((sign != "") & dmy.isNotNull(), new(dmy, "ddMM")).when((sign != "") & mdy.isNotNull(), new(mdy, "MMdd")).otherwise(value)

    return _with(parts, pick)


def secret(value: Column, key: str) -> Column:
    """The assigned hexadecimal digits in blocks of 12, each permuted with the block before as its tweak; case stays."""
    old = F.regexp_extract(value, "[0-9a-fA-F]{16,128}$", 0)

    def block(done, i, h):
        b = F.substr(h, i * 12 + 1, F.lit(12))
        n = F.length(b)
        u = F.floor(n / 2).cast("int")
        at = lambda s: F.coalesce(F.conv(s, 16, 10).cast("long"), F.lit(0))
        out = permuted(at(F.substr(b, F.lit(1), u)), at(F.substr(b, u + 1)), power(16, u), power(16, (n - u).cast("int")), key, F.concat(F.lit("hex"), F.length(h).cast("string"), F.substr(h, F.lit(1), i * 12)))
        return F.concat(done, _with(out, lambda s: F.concat(F.when(u > 0, F.lpad(F.lower(F.hex(s["l"])), u, "0")).otherwise(""), F.lpad(F.lower(F.hex(s["r"])), (n - u).cast("int"), "0"))))

    new = _with(F.lower(old), lambda h: F.aggregate(F.sequence(F.lit(0), F.ceil(F.length(h) / 12).cast("int") - 1), F.lit(""), lambda done, i: block(done, i, h)))
    return F.concat(F.substr(value, F.lit(1), F.length(value) - F.length(old)), F.when(old == F.upper(old), F.upper(new)).otherwise(new))


def email(value: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat(F.lit(key), F.lit("|email|"), F.lower(value)), 256), 1, 20), F.lit("@example.invalid"))


def kind_of(value: Column) -> Column:
    """The first form that the whole value has."""
    return F.coalesce(*[F.when(F.regexp_like(value, F.lit(f"^(?:{p})$")), k) for k, p in FORMS.items()])


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    made = {"email": email, "secret": secret, "phone": phone, "ip": ip, "date": date, "card": card, "iban": iban}
    return reduce(lambda c, k: c.when(kind == k, made[k](value, key) if k in made else plain(value, key, k)), FORMS, F.when(F.lit(False), value)).otherwise(value)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with replaced values in text_col, and the columns RESULTS: how many, and their kinds in order."""
    text, key = F.col(text_col), subkey(key)
    docs = docs.drop(*RESULTS, "__pii")
    found = F.when(F.regexp_like(text, F.lit(HINT)), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    kinds = F.transform(found, lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))
    values = F.transform(kinds, lambda x: F.struct(x["kind"].alias("kind"), x["value"].alias("old"), pseudonym(x["value"], x["kind"], key).alias("new")))
    rows = docs.withColumn("__pii", F.coalesce(values, F.array().cast("array<struct<kind:string,old:string,new:string>>")))
    new = F.concat(F.transform("__pii", lambda x: x["new"]), F.array(F.lit("")))
    spliced = F.array_join(F.zip_with(F.split(text, ANY, -1), new, lambda a, b: F.concat(a, b)), "")
    valid = F.filter("__pii", lambda x: x["new"] != x["old"])
    return rows.withColumns({text_col: F.when(F.size("__pii") > 0, spliced).otherwise(text), "pii_count": F.size(valid), "pii_kinds": F.transform(valid, lambda x: x["kind"])}).drop("__pii")
