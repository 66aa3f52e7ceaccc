"""Format-preserving pseudonyms for personal data (native).

Candidates are found by patterns, validated by the rules of their kind
(Luhn sum, number plan, octets, calendar), mapped to a pair of numbers (a, b)
with a < A and b < B, and permuted by a keyed Feistel network on Z_A x Z_B
(each round adds a keyed hash of one half to the other, modulo its size, which
is a bijection).  The result is written back in the candidate's own format, so
a card number stays a card number with a right check digit, a date stays a
real date in the same notation, and equal values stay linked over all
documents whatever their notation.  Mail addresses keep their domain; their
local part goes through the same network letter by letter and digit by digit.
What fails validation stays as it is.

A text is cut into pieces kind by kind: mail addresses, network addresses,
dates and SSNs first, then cards in a usual grouping, phones, and cards in any
other grouping; each kind sees what the earlier ones left.  A card may be any
part of a run of numbers that begins and ends at a space (a card number, its
expiry date and code, another card): the first beginning with a part of 13 to
19 digits that passes Luhn counts, with its longest such part.

Kinds: ``email``, ``ipv4``, ``date`` (year-month-day with - or /, day and month
before the year with . or /, years 1900 to 2099, alone or before T and a time),
``ssn``, ``card`` (13 to 19 digits, in groups by space or hyphen or not),
``phone`` (North American number plan, area code optional; its parts joined by
hyphen, dot, space or nothing, without area code or +1 by hyphen or dot only;
an area code in brackets may be any three digits).

Defined results: a null text stays null with no replacements; empty and very
long texts are handled whole; other columns pass through, and a column that
has the name of an added one is replaced; an empty table stays empty.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicrate.llm.labelled import unused

ROUNDS = 10
#: The formats of the kinds.  The class of what may not touch a number keeps parts of longer numbers out.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ipv4": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}(?:-[0-9]{1,2}-|/[0-9]{1,2}/)[0-9]{1,2}|[0-9]{1,2}(?:\.[0-9]{1,2}\.|/[0-9]{1,2}/)[0-9]{4})(?:(?=[Tt][0-9]{1,2}:?[0-9]{2})|(?![./-]?[0-9A-Za-z]))",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.-])(?:(?:\+?1[-. ]?)?(?:\([0-9]{3}\)[-. ]?|[2-9][0-9]{2}[-. ]?)[2-9][0-9]{2}[-. ]?[0-9]{4}"
             r"|\+1[-. ]?[2-9][0-9]{2}[-. ]?[0-9]{4}|(?:1[-. ]?)?[2-9][0-9]{2}[-.][0-9]{4})(?!-?[0-9A-Za-z])",
}
FIRST = "|".join(PATTERNS[k] for k in ("email", "ipv4", "date", "ssn"))
#: Numbers joined by hyphens, and runs of them with one space between that have digits enough for a card.
NUMBER = r"[0-9]++(?:-[0-9]++)*+"
RUN = rf"(?<![0-9A-Za-z.-])(?=[0-9](?:[ -]?[0-9]){{12}}){NUMBER}(?!-?[0-9A-Za-z])(?: {NUMBER}(?!-?[0-9A-Za-z]))*+"
#: Usual groupings: none, 4-4-4-4, 4-4-4-4-3, 4-6-5, 4-6-4, 4-4-4-1, 4-3-3-3, 6-13.
USUAL = "^(?:[0-9]{13,19}|" + "|".join("[ -]".join(f"[0-9]{{{n}}}" for n in g) for g in (
    (4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4), (4, 4, 4, 1), (4, 3, 3, 3), (6, 13))) + ")$"
SHORTEST, LONGEST = 13, 19
#: Stands, with a letter that counts its numbers (a is 1), before a number that begins a card; with z it is a character of the text.
MARK = "\ue000"
LETTERS = "abcdefghijklmnopqrs"
MARKED = "|".join(f"{MARK}{c}{NUMBER}(?: (?:{MARK}[a-s])?{NUMBER}){{{i}}}" for i, c in enumerate(LETTERS))
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
DAYS = (LAST_DAY - FIRST_DAY).days + 1
#: The larger half of the days' domain: the least divisor pair, so that the halves multiply to DAYS.
DAY_B = min(DAYS // d for d in range(1, int(DAYS ** 0.5) + 1) if DAYS % d == 0)


def _hash(key: Column, kind: str, i: Column, half: Column) -> Column:
    """60 keyed hash bits of a round and a half."""
    text = F.concat_ws("|", key, F.lit(kind), i.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: Column, kind: str) -> Column:
    """struct(a, b): the keyed permutation of Z_size_a x Z_size_b."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def turn(s, i):
        x = F.pmod(s["a"] + F.pmod(_hash(key, kind, i, s["b"]), size_a), size_a).cast("long")
        return F.struct(F.when(i % 2 == 0, x).otherwise(s["a"]).alias("a"),
                        F.when(i % 2 == 0, s["b"]).otherwise(F.pmod(s["b"] + F.pmod(_hash(key, kind, i, s["a"]), size_b), size_b).cast("long")).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, digits: Column) -> Column:
    """The candidate with its digits, in turn, replaced by ``digits``."""
    chars = F.filter(F.split(m, ""), lambda c: c != "")

    def put(s, c):
        num = c.rlike("^[0-9]$")
        return F.struct(F.concat(s["t"], F.when(num, F.substr(digits, s["n"], F.lit(1))).otherwise(c)).alias("t"),
                        (s["n"] + F.when(num, 1).otherwise(0)).alias("n"))

    return F.aggregate(chars, F.struct(F.lit("").alias("t"), F.lit(1).alias("n")), put, lambda s: s["t"])


def _int(text: Column, at: Column | int, n: Column | int) -> Column:
    at, n = (x if isinstance(x, Column) else F.lit(x) for x in (at, n))
    return F.substr(text, at, n).try_cast("long")


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _pad(x: Column, n: Column | int) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def luhn_sum(digits: Column) -> Column:
    """Sum with every second digit, from the last but one, doubled."""
    def add(s, c):
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.struct((s["t"] + F.when(s["i"] % 2 == 1, twice).otherwise(d)).alias("t"), (s["i"] + 1).alias("i"))
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit(0).alias("t"), F.lit(0).alias("i")), add, lambda s: s["t"])


def card(m: Column, key: Column) -> Column:
    d = _digits(m)
    n = F.length(d) - 1
    left = F.floor(n / 2).cast("int")
    out = feistel(_int(d, 1, left), F.substr(d, left + 1, n - left).try_cast("long"), _power(left), _power(n - left), key, "card")
    body = F.transform(F.array(F.struct(out.alias("o"), left.alias("l"), n.alias("n"))),
                       lambda s: F.concat(_pad(s["o"]["a"], s["l"]), _pad(s["o"]["b"], s["n"] - s["l"])))[0]
    whole = F.transform(F.array(body), lambda b: F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")))[0]
    return F.when(is_card(d), _refill(m, whole))


def is_card(digits: Column) -> Column:
    return F.length(digits).between(SHORTEST, LONGEST) & (luhn_sum(digits) % 10 == 0) & ~digits.rlike("^0+$")


def _mark_cards(run: Column, usual: bool) -> Column:
    """The run with a mark before each number that begins a card."""
    def longest(window):
        parts = F.array(*[F.regexp_extract(window, rf"^[0-9](?:[ -]?[0-9]){{{n - 1}}}(?= |$)", 0) for n in range(LONGEST, SHORTEST - 1, -1)])
        return F.get(F.filter(parts, lambda p: (p.rlike(USUAL) if usual else (p != "")) & is_card(_digits(p))), F.lit(0))

    def mark(words, i):
        part = F.transform(F.array(F.array_join(F.slice(words, i, F.lit(LONGEST)), " ")), longest)[0]
        letter = F.substr(F.lit(LETTERS), F.size(F.split(part, " ")), F.lit(1))
        return F.concat(F.when(part.isNotNull(), F.concat(F.lit(MARK), letter)).otherwise(""), F.element_at(words, i))

    words = F.array(F.split(run, " "))
    return F.transform(words, lambda w: F.array_join(F.transform(F.sequence(F.lit(1), F.size(w)), lambda i: mark(w, i)), " "))[0]


def ipv4(m: Column, key: Column) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.try_cast("long"))
    out = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(1 << 16), F.lit(1 << 16), key, "ipv4")
    text = F.transform(F.array(out), lambda s: F.concat_ws(".", F.floor(s["a"] / 256).cast("string"), (s["a"] % 256).cast("string"),
                                                           F.floor(s["b"] / 256).cast("string"), (s["b"] % 256).cast("string")))[0]
    return F.when(F.forall(o, lambda x: x < 256), text)


def calendar(m: Column, key: Column) -> Column:
    parts = F.split(m, "[-./]")
    year_first = m.rlike("^[0-9]{4}")
    number = lambda i: parts[i].try_cast("int")
    month_first = ~year_first & m.contains("/") & (number(0) <= 12)  # 3/4/2001 is read as March 4
    y = F.when(year_first, number(0)).otherwise(number(2))
    mo = F.when(year_first | ~month_first, number(1)).otherwise(number(0))
    d = F.when(year_first, number(2)).when(month_first, number(1)).otherwise(number(0))
    day = F.when((mo >= 1) & (mo <= 12) & (d >= 1) & (d <= 31) & (y >= FIRST_DAY.year) & (y <= LAST_DAY.year),
                 F.try_to_timestamp(F.concat_ws("-", _pad(y, 4), _pad(mo, 2), _pad(d, 2)), F.lit("yyyy-MM-dd")).cast("date"))
    at = F.datediff(day, F.lit(FIRST_DAY.isoformat()).cast("date"))
    out = feistel(F.floor(at / DAY_B), at % DAY_B, F.lit(DAYS // DAY_B), F.lit(DAY_B), key, "date")
    new = F.transform(F.array(out), lambda s: F.date_add(F.lit(FIRST_DAY.isoformat()).cast("date"), (s["a"] * DAY_B + s["b"]).cast("int")))
    mark = F.regexp_extract(m, "[-./]", 0)
    # a part written with a leading zero or two digits gets two digits, so the notation stays readable in the same way
    width = lambda i: F.when(F.length(parts[i]) == 1, 1).otherwise(2)
    two = lambda x, i: F.when(width(i) == 2, _pad(x, 2)).otherwise(x.cast("string"))
    # with slashes and the year last, the pseudonym is written month first, as it is read
    text = F.transform(new, lambda t: F.when(year_first, F.concat(F.year(t).cast("string"), mark, two(F.month(t), 1), mark, two(F.day(t), 2)))
                       .when(m.contains("/"), F.concat(two(F.month(t), 0), mark, two(F.day(t), 1), mark, F.year(t).cast("string")))
                       .otherwise(F.concat(two(F.day(t), 0), mark, two(F.month(t), 1), mark, F.year(t).cast("string"))))[0]
    return F.when(day.isNotNull(), text)


def ssn(m: Column, key: Column) -> Column:
    area, group, serial = _int(m, 1, 3), _int(m, 5, 2), _int(m, 8, 4)
    index = F.when(area > 666, area - 2).otherwise(area - 1)  # 1..899 without 666
    out = feistel(index, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
    text = F.transform(F.array(out), lambda s: F.concat_ws("-", _pad(F.when(s["a"] >= 665, s["a"] + 2).otherwise(s["a"] + 1), 3),
                                                           _pad(F.floor(s["b"] / 9999) + 1, 2), _pad(s["b"] % 9999 + 1, 4)))[0]
    return F.when((area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0), text)


def phone(m: Column, key: Column) -> Column:
    d = _digits(m)
    n = F.length(d)
    code = F.when(n.isin(8, 11), F.substr(d, F.lit(1), F.lit(1))).otherwise(F.lit(""))  # the country's 1 stays
    rest = F.substr(d, F.length(code) + 1, F.lit(10))
    has_area = F.length(rest) == 10
    # areas from 200 and those below it, only written in brackets, are permuted apart: no notation gets an area that it cannot hold
    low = has_area & (_int(rest, 1, 3) < 200)
    first = F.when(has_area & ~low, 200).otherwise(0)
    area = F.when(has_area, _int(rest, 1, 3) - first).otherwise(0)
    exchange = _int(rest, F.when(has_area, 4).otherwise(1), 3) - 200
    line = _int(rest, F.when(has_area, 7).otherwise(4), 4)
    size = F.when(low, F.lit(160000)).when(has_area, F.lit(640000)).otherwise(F.lit(800))
    out = feistel(area * 800 + exchange, line, size, F.lit(10000), key, "phone")
    new = F.transform(F.array(F.struct(out.alias("o"), first.alias("f"))), lambda s: F.concat(
        code, F.when(has_area, _pad(F.floor(s["o"]["a"] / 800) + s["f"], 3)).otherwise(F.lit("")), (s["o"]["a"] % 800 + 200).cast("string"), _pad(s["o"]["b"], 4)))[0]
    return F.when(F.length(rest).isin(7, 10) & (area >= 0) & (exchange >= 0), _refill(m, new))


def email(m: Column, key: Column) -> Column:
    """The local part in two halves of characters; letters and digits move
    within their kind by a keyed hash of the other half."""
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    half = F.floor(F.length(local) / 2).cast("int")

    def shift(chars, other, i):
        hexes = F.sha2(F.concat_ws("|", key, F.lit("email"), i.cast("string"), other), 256)
        def one(c, k):
            by = F.conv(F.substr(hexes, (k % 16 * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")
            turn = lambda first, n: F.chr(F.lit(ord(first)) + F.pmod(F.ascii(c) - ord(first) + by, F.lit(n)))
            return F.when(c.rlike("^[a-z]$"), turn("a", 26)).when(c.rlike("^[A-Z]$"), turn("A", 26)).when(c.rlike("^[0-9]$"), turn("0", 10)).otherwise(c)
        return F.array_join(F.transform(F.filter(F.split(chars, ""), lambda c: c != ""), one), "")

    def turn(s, i):
        return F.struct(F.when(i % 2 == 0, shift(s["l"], s["r"], i)).otherwise(s["l"]).alias("l"),
                        F.when(i % 2 == 1, shift(s["r"], s["l"], i)).otherwise(s["r"]).alias("r"))

    start = F.struct(F.substr(local, F.lit(1), half).alias("l"), F.substr(local, half + 1, F.length(local) - half).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"], F.lit("@"), domain))


KINDS = {"email": email, "ipv4": ipv4, "date": calendar, "ssn": ssn, "card": card, "phone": phone}


def pseudonym(m: Column, key: Column, kinds: tuple[str, ...]) -> Column:
    """struct(kind, text) of a candidate of one of ``kinds``; kind is null if no rule accepts it."""
    new, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in reversed(kinds):
        fits = m.rlike("^(?:" + PATTERNS[name] + ")$") if name in PATTERNS else F.lit(True)
        value = F.when(fits, KINDS[name](m, key))
        kind = F.when(fits & value.isNotNull(), F.lit(name)).otherwise(kind)
        new = F.coalesce(value, new)
    return F.struct(kind.alias("kind"), F.coalesce(new, m).alias("text"))


def _clear(text: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("kind"), text.alias("text"))


def _pieces(between: Column, new: Column) -> Column:
    both = F.flatten(F.zip_with(between, new, lambda b, f: F.array(_clear(b), f)))
    return F.filter(both, lambda p: p["text"] != "")


def _cut(text: Column, pattern: str, key: Column, kinds: tuple[str, ...]) -> Column:
    """The pieces of a text: candidates of ``kinds``, replaced if valid, and what lies between."""
    return _pieces(F.split(text, pattern, -1), F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: pseudonym(m, key, kinds)))


def _cut_cards(text: Column, key: Column, usual: bool) -> Column:
    safe = F.replace(text, F.lit(MARK), F.lit(MARK + "z"))
    runs = F.transform(F.regexp_extract_all(safe, F.lit(RUN), F.lit(0)), lambda r: _mark_cards(r, usual))
    marked = F.array_join(F.zip_with(F.split(safe, RUN, -1), runs, lambda b, r: F.concat(b, F.coalesce(r, F.lit("")))), "")
    bare = lambda x: F.regexp_replace(x, MARK + "[a-s]", "")
    return F.transform(F.array(marked), lambda t: _pieces(
        F.transform(F.split(t, MARKED, -1), lambda b: F.replace(bare(b), F.lit(MARK + "z"), F.lit(MARK))),
        F.transform(F.transform(F.regexp_extract_all(t, F.lit(MARKED), F.lit(0)), bare), lambda m: pseudonym(m, key, ("card",)))))[0]


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced, and the added
    columns ``n_replaced`` (long) and ``kinds`` (the kinds of what was replaced, in order)."""
    text, key = F.col(text_col), F.lit(key)
    new = F.when(text.rlike("[0-9@]"), F.array(_clear(text))).otherwise(F.array().cast("array<struct<kind:string,text:string>>"))

    def sweep(pieces, pattern, cut):
        return F.flatten(F.transform(pieces, lambda p: F.when(p["kind"].isNull() & p["text"].rlike(pattern), cut(p["text"])).otherwise(F.array(p))))

    new = sweep(new, FIRST, lambda t: _cut(t, FIRST, key, ("email", "ipv4", "date", "ssn")))
    new = sweep(new, RUN, lambda t: _cut_cards(t, key, True))
    new = sweep(new, PATTERNS["phone"], lambda t: _cut(t, PATTERNS["phone"], key, ("phone",)))
    new = sweep(new, RUN, lambda t: _cut_cards(t, key, False))
    held = unused("_new", docs.columns)
    out = docs.withColumn(held, new)
    kinds = F.filter(F.transform(held, lambda s: s["kind"]), lambda k: k.isNotNull())
    return (out.withColumns({text_col: F.when(F.size(held) > 0, F.array_join(F.transform(held, lambda s: s["text"]), "")).otherwise(text),
                             "kinds": F.coalesce(kinds, F.array().cast("array<string>"))})
            .withColumn("n_replaced", F.size("kinds").cast("long")).drop(held))
