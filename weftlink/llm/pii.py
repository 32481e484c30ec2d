"""Format-preserving pseudonyms of personal data, with DataFrame operations only.

A text is cut by patterns, one after the other; each match is validated and its value permuted by a
keyed Feistel network on its own domain. What isn't valid goes on to the next pattern, and in the
end stays as it is:

    email     the letters and digits of the address in lower case, each among its like; the result
              lies under the reserved domain ``example``
    iban      valid by its remainder modulo 97: the digits behind the check digits are permuted, letters
              stay, and the check digits are set so that it is valid again
    ip        four octets, unless a version mark stands before them: as one 32-bit number
    date      ISO dates, d/m/y, m/d/y and d.m.y that exist, of the years 1800 to 2199; days 1 to 12,
              13 to 28 and 29 to 31 each among their like, so that m/d/y can't turn into d/m/y
    ssn       area, group and serial are permuted among the valid ones
    card      13 to 19 digits with a valid Luhn sum, in one piece or in groups: all digits but the last
              are permuted, the last is set so that the sum holds again. The groups of a number that
              fails as a whole are tried without those at its end
    phone     three, three and four digits, with a country code, with brackets or with an area code that
              begins with 2 to 9: the ten digits are permuted, area codes from 2 on and below among
              their like; the country code stays

Separators, brackets, leading zeros and the order of day, month and year stay as they are, and a value
has the same pseudonym in every format and document. The permutations are one to one, so different
values stay different. The key is a string or a column; a string is part of the query's plan and so of
event logs, a column such as ``keys.select("key").scalar()`` over a protected table is not.

Defined results: a null text stays null, an empty one empty; rows are independent of each other, so
repeated rows have equal results; an empty table has no rows; the other columns are kept, those named
n_<kind> being replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of a network, and of a walk through days that don't exist: one in five doesn't, so none is left after so many.
ROUNDS, WALK = 10, 48
KINDS = ["email", "iban", "ip", "date", "phone", "ssn", "card"]
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
IP = r"(?<![\d.])(?<!\b[vV](?:er|er\.|ersion)? ?)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_AFTER = r"(?!\d|[.-]\d)"
#: Card numbers of groups, the longest first, and in one piece; then of any groups.
LONG_CARD = rf"(?<![\d.-])(?:\d{{4}} \d{{4}} \d{{4}} \d{{4}} \d{{1,3}}|\d{{4}}-\d{{4}}-\d{{4}}-\d{{4}}-\d{{1,3}}){_AFTER}"
CARD = rf"(?<![\d.-])(?:\d{{4}} \d{{4}} \d{{4}} \d{{4}}|\d{{4}}-\d{{4}}-\d{{4}}-\d{{4}}|\d{{4}}[ -]\d{{6}}[ -]\d{{4,5}}|\d{{13,19}}){_AFTER}"
ANY_CARD = rf"(?<![\d.-])\d(?:[ -]?\d){{12,18}}{_AFTER}"
_LOCAL = r"\d{3}[ .-]?\d{4}"
PHONE = rf"(?<![\d(+-])(?:\+\d{{1,3}}[ .-]?(?:\(\d{{3}}\)|\d{{3}})[ .-]?{_LOCAL}|(?:1[ .-]?)?\(\d{{3}}\)[ .-]?{_LOCAL}|(?:1[ .-])?[2-9]\d{{2}}[ .-]{_LOCAL})(?!\d|-\d)"
#: One pass for each: pattern by kind.
PASSES = [{"email": EMAIL, "iban": IBAN, "ip": IP, "date": DATE, "ssn": SSN, "card": LONG_CARD}, {"card": CARD}, {"phone": PHONE}, {"card": ANY_CARD}]


def _draw(key: Column, kind: str, i: Column, value: Column) -> Column:
    """60 keyed bits of a round's half."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", key, F.lit(kind), i.cast("string"), value.cast("string")), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, size_left, size_right, key: Column, kind: str) -> Column:
    """struct(l, r): a keyed permutation of pairs below (size_left, size_right), both up to 10^10."""
    size_left, size_right = (x.cast("long") if isinstance(x, Column) else F.lit(x).cast("long") for x in (size_left, size_right))
    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def step(s, i):
        return F.when(
            i % 2 == 0,
            F.struct(F.pmod(s["l"] + F.pmod(_draw(key, kind, i, s["r"]), size_left), size_left).alias("l"), s["r"].alias("r")),
        ).otherwise(F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(_draw(key, kind, i, s["l"]), size_right), size_right).alias("r")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, step)


def permuted_digits(digits: Column, key: Column, kind: str) -> Column:
    """A string of 2 to 30 digits, permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    power = lambda e: F.pow(F.lit(10.0), e).cast("long")  # noqa: E731  exact up to 10^15
    s = feistel(digits.substr(F.lit(1), u), digits.substr(u + 1, v), power(u), power(v), key, kind)
    return F.aggregate(F.array(s), F.lit(""), lambda _, x: F.concat(F.lpad(x["l"].cast("string"), u, F.lit("0")), F.lpad(x["r"].cast("string"), v, F.lit("0"))))


def luhn_sum(digits: Column, shift: int = 0) -> Column:
    """The Luhn sum of all digits; with ``shift`` 1 that of digits to which one more will be added."""
    at = F.sequence(F.lit(1), F.length(digits))

    def value(i):
        d = digits.substr(i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i + shift) % 2 == 1
        return F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(at, value), F.lit(0), lambda a, b: a + b)


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refilled(m: Column, digits: Column) -> Column:
    """The match with its digits replaced in order."""

    def char(i):
        c = m.substr(i, F.lit(1))
        return F.when(c.rlike("[0-9]"), digits.substr(F.length(_only_digits(m.substr(F.lit(1), i))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), char), "")


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _card(m: Column, key: Column) -> Column:
    def use(d):
        head = permuted_digits(d.substr(F.lit(1), F.length(d) - 1), key, "card")
        return _bound(head, lambda h: F.concat(h, F.pmod(-luhn_sum(h, 1), F.lit(10)).cast("string")))

    return _refilled(m, _bound(_only_digits(m), use))


def _phone(m: Column, key: Column) -> Column:
    def use(d):
        n = F.length(d)
        area, rest = d.substr(n - 9, F.lit(5)).cast("long"), d.substr(n - 4, F.lit(5))
        low = F.when(area < 20_000, 0).otherwise(20_000)
        size = F.when(area < 20_000, 20_000).otherwise(80_000)
        text = lambda s: F.concat(d.substr(F.lit(1), n - 10), F.lpad((s["l"] + low).cast("string"), 5, "0"), F.lpad(s["r"].cast("string"), 5, "0"))
        return _bound(feistel(area - low, rest, size, 100_000, key, "phone"), text)

    return _refilled(m, _bound(_only_digits(m), use))


def _mod97(text: Column) -> Column:
    """The remainder of an account number, letters read as 10 to 35."""
    chars = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.ascii(text.substr(i, F.lit(1))))
    return F.aggregate(chars, F.lit(0), lambda s, c: F.when(c < 58, (s * 10 + c - 48) % 97).otherwise((s * 100 + c - 55) % 97))


def _iban_valid(m: Column) -> Column:
    d = F.replace(m, F.lit(" "), F.lit(""))
    body = d.substr(F.lit(5), F.length(d))
    return (_mod97(F.concat(body, F.substring(d, 1, 4))) == 1) & (F.length(_only_digits(body)) >= 2)


def _iban(m: Column, key: Column) -> Column:
    """Country, check digits and body without blanks, then put back between the blanks."""

    def use(d):
        body = d.substr(F.lit(5), F.length(d))
        new = _refilled(body, permuted_digits(_only_digits(body), key, "iban"))
        return _bound(new, lambda b: F.concat(F.substring(d, 1, 2), F.lpad((98 - _mod97(F.concat(b, F.substring(d, 1, 2), F.lit("00")))).cast("string"), 2, "0"), b))

    plain = F.replace(m, F.lit(" "), F.lit(""))

    def spaced(d):
        char = lambda i: F.when(m.substr(i, F.lit(1)) == " ", " ").otherwise(d.substr(F.length(F.replace(m.substr(F.lit(1), i), F.lit(" "), F.lit(""))), F.lit(1)))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), char), "")

    return _bound(_bound(plain, use), spaced)


def _ip(m: Column, key: Column) -> Column:
    def use(p):
        return feistel(p[0].cast("long") * 256 + p[1].cast("long"), p[2].cast("long") * 256 + p[3].cast("long"), 65536, 65536, key, "ip")

    s = _bound(F.split(m, "\\."), use)
    return _bound(s, lambda s: F.concat_ws(".", *(F.floor(h / 256) if i == 0 else h % 256 for h in (s["l"], s["r"]) for i in (0, 1))))


def _ssn_valid(m: Column) -> Column:
    return m.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$")


def _ssn(m: Column, key: Column) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    area, group, serial = m.substr(1, 3).cast("long"), m.substr(5, 2).cast("long"), m.substr(8, 4).cast("long")
    s = feistel(F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")

    def text(s):
        a = F.when(s["l"] >= 665, s["l"] + 2).otherwise(s["l"] + 1)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((F.floor(s["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((s["r"] % 9999 + 1).cast("string"), 4, "0"))

    return _bound(s, text)


def _day(m: Column) -> Column:
    """The date that a match names, or null."""
    p = F.split(m, "[-/.]")
    made = lambda y, mo, d: F.try_to_date(F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    day = F.when(m.contains("-"), made(p[0], p[1], p[2])).when(m.contains("/"), F.coalesce(made(p[2], p[1], p[0]), made(p[2], p[0], p[1]))).otherwise(made(p[2], p[1], p[0]))
    return F.when(F.year(day).between(1800, 2199), day)


def _date(m: Column, key: Column) -> Column:
    """The day among those of its class: the months of 400 years are numbered, and the days in them."""
    start = F.lit("1800-01-01").cast("date")

    def use(day):
        month, d = (F.year(day) - 1800) * 12 + F.month(day) - 1, F.dayofmonth(day)
        one = lambda first, size: _bound(feistel(month, d - first, 4800, size, key, f"date {first}"), lambda s: F.date_add(F.add_months(start, s["l"].cast("int")), (s["r"] + first - 1).cast("int")))

        def step(s, _):
            """Goes on until the day exists: a permutation of all pairs walks through the pairs that don't."""
            go = ~s["done"]
            pair = lambda p: F.struct(p["l"].alias("l"), p["r"].alias("r"), (F.dayofmonth(F.last_day(F.add_months(start, p["l"].cast("int")))) >= p["r"] + 29).alias("done"))
            return F.when(go, _bound(feistel(s["l"], s["r"], 4800, 3, key, "date 29"), pair)).otherwise(s)

        walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(month.cast("long").alias("l"), (d - 29).cast("long").alias("r"), F.lit(False).alias("done")), step)
        late = _bound(walk, lambda s: F.date_add(F.add_months(start, s["l"].cast("int")), (s["r"] + 28).cast("int")))
        return F.when(d <= 12, one(1, 12)).when(d <= 28, one(13, 16)).otherwise(late)

    p = F.split(m, "[-/.]")
    month_first = m.contains("/") & (p[1].cast("int") > 12)
    short = ~m.contains("-") & (m.rlike(r"^\d[/.]|[/.]\d[/.]"))  # without leading zeros

    def text(d):
        parts = lambda a, b, sep: F.date_format(d, f"{a}{sep}{b}{sep}yyyy")
        styled = lambda sep: F.when(short & month_first, parts("M", "d", sep)).when(short, parts("d", "M", sep)).when(month_first, parts("MM", "dd", sep)).otherwise(parts("dd", "MM", sep))
        return F.when(m.contains("-"), F.date_format(d, "yyyy-MM-dd")).when(m.contains("."), styled(".")).otherwise(styled("/"))

    return _bound(_bound(_day(m), use), text)


def _email(m: Column, key: Column) -> Column:
    """Letters and digits are shifted among their like, one half by a draw from the other in turn; further signs stay."""
    address = F.lower(m)
    n = F.length(address)
    half = F.floor(n / 2).cast("int")

    def shifted(part: Column, other: Column, i: Column) -> Column:
        draw = F.concat(*(F.sha2(F.concat_ws("|", key, F.lit("email"), i.cast("string"), F.lit(str(k)), other), 512) for k in range(3)))  # 192 pairs of hex digits

        def char(at, draws):
            c = F.ascii(part.substr(at, F.lit(1)))
            d = F.conv(draws.substr((at % 192) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            return F.when(c.between(97, 122), F.char(97 + (c - 97 + d) % 26)).when(c.between(48, 57), F.char(48 + (c - 48 + d) % 10)).otherwise(part.substr(at, F.lit(1)))

        return _bound(draw, lambda draws: F.array_join(F.transform(F.sequence(F.lit(1), F.length(part)), lambda at: char(at, draws)), ""))

    def step(s, i):
        return F.when(i % 2 == 0, F.struct(shifted(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), shifted(s["r"], s["l"], i).alias("r")))

    state = F.struct(address.substr(F.lit(1), half).alias("l"), address.substr(half + 1, n).alias("r"))
    return _bound(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, step), lambda s: F.concat(s["l"], s["r"], F.lit(".example")))


VALID = {
    "email": lambda m: F.lit(True), "ip": lambda m: F.lit(True), "iban": _iban_valid, "date": lambda m: _day(m).isNotNull(), "ssn": _ssn_valid,
    "card": lambda m: luhn_sum(_only_digits(m)) % 10 == 0, "phone": lambda m: F.lit(True),
}
NEW = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}
NOTHING = "cast(array() as array<struct<text:string,kind:string>>)"


def _chosen(m: Column, patterns: dict[str, str]) -> Column:
    """The kind of a match, null if it isn't valid."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(patterns.items()):
        out = F.when(m.rlike(f"^(?:{pattern})$"), F.when(VALID[kind](m), kind)).otherwise(out)
    return out


def _parted(pieces: Column, patterns: dict[str, str]) -> Column:
    """Pieces (text, kind) without a kind cut at every match."""
    whole = "|".join(patterns.values())
    piece = lambda text, kind: F.struct(F.coalesce(text, F.lit("")).alias("text"), kind.alias("kind"))

    def cut(p):
        found = F.transform(F.regexp_extract_all(p["text"], F.lit(whole), F.lit(0)), lambda m: piece(m, _chosen(m, patterns)))
        between = F.transform(F.split(p["text"], whole, -1), lambda t: piece(t, F.lit(None).cast("string")))
        both = F.flatten(F.zip_with(between, found, lambda a, b: F.array(a, b)))
        return F.filter(both, lambda x: x.isNotNull() & (x["text"] != ""))

    return F.flatten(F.transform(pieces, lambda p: F.when(p["kind"].isNull() & p["text"].rlike(whole), cut(p)).otherwise(F.array(p))))


def pseudonymize(docs: DataFrame, key: str | Column, text_col: str = "text") -> DataFrame:
    """``docs`` with the text's personal data replaced, and counts n_<kind>."""

    def pseudonym(p):
        out = p["text"]
        for kind, new in NEW.items():
            out = F.when(p["kind"] == kind, new(p["text"], F.col("__key"))).otherwise(out)
        return out

    text = F.col(text_col)
    pieces = F.array(F.struct(text.alias("text"), F.lit(None).cast("string").alias("kind")))
    marked = docs.withColumn("__key", key if isinstance(key, Column) else F.lit(key))
    marked = marked.withColumn("__pieces", F.when(text.rlike(r"@|\d[^A-Za-z]*\d"), pieces).otherwise(F.expr(NOTHING)))
    for patterns in PASSES:
        marked = marked.withColumn("__pieces", _parted(F.col("__pieces"), patterns))
    of = lambda k: F.filter("__pieces", lambda x: x["kind"].eqNullSafe(F.lit(k)))
    own = {f"n_{k}": F.size(of(k)) for k in KINDS}
    new = F.when(F.exists("__pieces", lambda p: p["kind"].isNotNull()), F.array_join(F.transform("__pieces", pseudonym), "")).otherwise(text)
    return marked.withColumns({text_col: new, **own}).drop("__pieces", "__key")
