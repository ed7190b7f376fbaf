"""Format-preserving pseudonyms for personal data. DataFrame functions only.

Values are found by pattern and validated, then permuted within their own format by a keyed Feistel network: equal values get equal
pseudonyms in every document, and different values different ones. Each half of a value is shifted, character by character and
modulo its class (digit, lower case, upper case), by a key stream from SHA-256 of the other half; addresses and dates are shifted
as numbers. Check digits are carried over, so a valid number stays valid and an invalid one stays invalid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylake.llm.shared import col, free_name

ROUNDS = 8
# Fixed value: 64 characters before the sign and 255 after it.
LONGEST_EMAIL = 320
# Formats, tried in this order at each place.
FORMATS = {
    # From the first character of a run only: a long run without @ is tried once.
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "date": r"(?<![\d.])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?!\d|[./]\d)",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
    "phone": r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
}
PATTERN = "|".join(f"(?:{p})" for p in FORMATS.values())
# 1901-01-01 to 2099-12-31 are 72,684 days, exactly 108 times 673.
DAY_ROWS, DAY_COLUMNS, FIRST_DAY = 108, 673, "1901-01-01"


def key_hex(key: str, turn: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), turn.cast("string"), other.cast("string")), 256)


def hex_number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def shifted(half: Column, stream: Column) -> Column:
    """Each letter or digit moved inside its class by one byte of the stream; all else stays."""
    def move(i: Column) -> Column:
        c = F.substring(half, i + 1, F.lit(1))
        by = hex_number(F.substring(stream, 2 * F.pmod(i, F.lit(32)) + 1, F.lit(2)))
        code = F.ascii(c)
        turned = lambda low, n: F.char(low + F.pmod(code - low + by, F.lit(n)))
        return (
            F.when(code.between(48, 57), turned(48, 10)).when(code.between(97, 122), turned(97, 26)).when(code.between(65, 90), turned(65, 26)).otherwise(c)
        )

    return F.when(F.length(half) == 0, half).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.length(half) - 1), move), ""))


def feistel_text(value: Column, key: str) -> Column:
    """A permutation of the texts that have the value's length and classes."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), half).alias("a"), F.substring(value, half + 1, F.length(value)).alias("b"))
    turn = lambda s, r: F.struct(s["b"].alias("a"), shifted(s["a"], key_hex(key, r, s["b"])).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def feistel_number(value: Column, rows: int, columns: int, key: str) -> Column:
    """A permutation of 0 to rows * columns - 1; each turn shifts the row by the column's stream and the column by the row's."""
    start = F.struct(F.floor(value / columns).cast("long").alias("a"), F.pmod(value, F.lit(columns)).cast("long").alias("b"))
    word = lambda r, x: hex_number(F.substring(key_hex(key, r, x), 1, 12))

    def turn(s: Column, r: Column) -> Column:
        even = F.pmod(r, F.lit(2)) == 0
        return F.struct(
            F.when(even, s["a"]).otherwise(F.pmod(s["a"] + word(r, s["b"]), F.lit(rows))).alias("a"),
            F.when(even, F.pmod(s["b"] + word(r, s["a"]), F.lit(columns))).otherwise(s["b"]).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: s["a"] * columns + s["b"])


def characters(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))


def digit_array(digits: Column) -> Column:
    return F.transform(characters(digits), lambda c: c.cast("int"))


def luhn_digit(body: Column) -> Column:
    """The check digit of a number without it."""
    turned = F.reverse(digit_array(body))
    weighed = F.transform(turned, lambda d, i: F.when(F.pmod(i, F.lit(2)) == 0, F.pmod(2 * d, F.lit(10)) + F.floor(2 * d / 10)).otherwise(d).cast("int"))
    total = F.aggregate(weighed, F.lit(0), lambda s, d: s + d)
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10))


def with_digits(form: Column, digits: Column) -> Column:
    """The form with its digits replaced in order; separators stay."""
    parts = characters(form)
    step = lambda s, c: F.when(
        c.between("0", "9"), F.struct((s["n"] + 1).alias("n"), F.concat(s["out"], F.substring(digits, s["n"] + 1, F.lit(1))).alias("out"))
    ).otherwise(F.struct(s["n"].alias("n"), F.concat(s["out"], c).alias("out")))
    return F.aggregate(parts, F.struct(F.lit(0).alias("n"), F.lit("").alias("out")), step, lambda s: s["out"])


def card(value: Column, key: str) -> Column:
    """Digits before the last are permuted; the last keeps its distance from the check digit."""
    digits = F.regexp_replace(value, r"\D", "")
    body, last = F.substring(digits, F.lit(1), F.length(digits) - 1), F.substring(digits, F.length(digits), F.lit(1)).cast("int")
    new = feistel_text(body, key + ":card")
    whole = F.concat(new, F.pmod(luhn_digit(new) + last - luhn_digit(body), F.lit(10)).cast("string"))
    return with_digits(value, whole)


def ip(value: Column, key: str) -> Column:
    part = lambda k: F.element_at(F.split(value, r"\."), k).cast("long")
    n = feistel_number(((part(1) * 256 + part(2)) * 256 + part(3)) * 256 + part(4), 65536, 65536, key + ":ip")
    octet = lambda n, d: F.pmod(F.floor(n / d), F.lit(256)).cast("string")
    return F.transform(F.array(n), lambda n: F.concat_ws(".", *[octet(n, d) for d in (1 << 24, 1 << 16, 1 << 8, 1)]))[0]


def day_of(value: Column) -> Column:
    """The date in year-month-day, day.month.year or month/day/year form; null if there is none."""
    return F.when(value.contains("-"), F.try_to_date(value, "yyyy-MM-dd")).when(value.contains("."), F.try_to_date(value, "dd.MM.yyyy")).otherwise(
        F.try_to_date(value, "MM/dd/yyyy")
    )


def date(value: Column, key: str) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    n = feistel_number(F.datediff(day_of(value), first), DAY_ROWS, DAY_COLUMNS, key + ":date")
    new = F.date_add(first, n.cast("int"))
    return F.when(value.contains("-"), F.date_format(new, "yyyy-MM-dd")).when(value.contains("."), F.date_format(new, "dd.MM.yyyy")).otherwise(F.date_format(new, "MM/dd/yyyy"))


def iban_rest(country: Column, body: Column) -> Column:
    """The check digits of country and account: 98 less the rest by 97, letters as 10 to 35."""
    codes = F.transform(characters(F.concat(body, country, F.lit("00"))), lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(codes, F.lit(0), lambda s, d: F.pmod(s * F.when(d > 9, 100).otherwise(10) + d, F.lit(97)))
    return 98 - rest


def iban(value: Column, key: str) -> Column:
    """Account characters are permuted, the check digits keep their distance from the right ones (modulo 97)."""
    plain = F.regexp_replace(value, " ", "")
    country, check, body = F.substring(plain, 1, 2), F.substring(plain, 3, 2).cast("int"), F.substring(plain, F.lit(5), F.length(plain))
    new = feistel_text(body, key + ":iban")
    whole = F.concat(country, F.lpad(F.pmod(iban_rest(country, new) + check - iban_rest(country, body), F.lit(100)).cast("string"), 2, "0"), new)
    grouped = F.rtrim(F.regexp_replace(whole, "(.{4})", "$1 "))
    return F.when(value.contains(" "), grouped).otherwise(whole)


def email(value: Column, key: str) -> Column:
    """User and host names are permuted; the last label (the top domain) stays."""
    top = F.regexp_extract(value, r"\.[^.@]*$", 0)
    return F.concat(feistel_text(F.substring(value, F.lit(1), F.length(value) - F.length(top)), key + ":email"), top)


def phone(value: Column, key: str) -> Column:
    """All digits but those of a country code are permuted."""
    head = F.regexp_extract(value, r"^\+\d{1,3}[ .-]?", 0)
    rest = F.substring(value, F.length(head) + 1, F.length(value))
    return F.concat(head, with_digits(rest, feistel_text(F.regexp_replace(rest, r"\D", ""), key + ":phone")))


def kind_of(value: Column) -> Column:
    """Format of a find, or null if it isn't valid in any: octets to 255 without leading zeros, dates of the calendar from 1901 to 2099,
    cards and account numbers with right check digits, e-mail addresses of the length the standard allows."""
    whole = lambda name: value.rlike(f"^(?:{FORMATS[name]})$")
    octets = F.forall(F.split(value, r"\."), lambda x: (x.cast("int") <= 255) & ~x.rlike("^0."))
    digits, plain = F.regexp_replace(value, r"\D", ""), F.regexp_replace(value, " ", "")
    luhn = luhn_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.substring(digits, F.length(digits), F.lit(1)).cast("int")
    checked = iban_rest(F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))) == F.substring(plain, 3, 2).cast("int")
    in_range = F.coalesce(day_of(value).between(F.lit(FIRST_DAY).cast("date"), F.lit("2099-12-31").cast("date")), F.lit(False))
    return (
        F.when(whole("email"), F.when(F.length(value) <= LONGEST_EMAIL, "email")).when(whole("date"), F.when(in_range, "date")).when(whole("ip"), F.when(octets, "ip"))
        .when(whole("iban"), F.when(checked, "iban")).when(whole("card"), F.when(luhn, "card")).when(whole("phone"), "phone").when(whole("ssn"), "ssn")
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    return (
        F.when(kind == "email", email(value, key)).when(kind == "date", date(value, key)).when(kind == "ip", ip(value, key)).when(kind == "iban", iban(value, key))
        .when(kind == "card", card(value, key)).when(kind == "phone", phone(value, key)).when(kind == "ssn", with_digits(value, feistel_text(F.regexp_replace(value, r"\D", ""), key + ":ssn")))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All rows and columns, the text with pseudonyms in place of personal data, and n_values: how many were replaced.

    Found are e-mail addresses, IPv4 addresses, dates, account numbers (IBAN), numbers of 13 to 19 digits (cards), telephone and social security
    numbers. A find that isn't valid (an octet over 255, a day that no calendar has, a wrong check digit) stays. Null stays null with 0 values; an empty text
    stays empty; equal rows get equal results. An input column n_values is replaced. The key is a secret of the caller.
    """
    held = F.coalesce(col(text), F.lit(""))
    found = F.transform(
        F.regexp_extract_all(held, F.lit(PATTERN), F.lit(0)),
        lambda v: F.transform(F.array(kind_of(v)), lambda k: F.struct(k.alias("kind"), pseudonym(v, k, key).alias("new")))[0],
    )
    parts = F.split(held, PATTERN, -1)
    spot = free_name(docs, "pii_found")
    kept = docs.drop(*[c for c in docs.columns if c.lower() == "n_values" and c != text])
    # The one-element explode keeps the finds from being worked out again for every use.
    rows = kept.withColumn(spot, F.explode(F.array(F.when(held.rlike(PATTERN), found))))
    woven = F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(col(spot), i)["new"], F.lit("")))), "")
    count = F.coalesce(F.size(F.filter(col(spot), lambda x: x["kind"].isNotNull())), F.lit(0))
    return rows.withColumns({text: F.when(col(spot).isNotNull(), woven).otherwise(col(text)), "n_values": F.when(col(spot).isNull(), 0).otherwise(count)}).drop(spot)
