"""Format-preserving pseudonyms for personal numbers and dates, in SQL expressions only.

Found are card numbers that pass the Luhn test, IBANs whose check digits fit, IPv4 addresses, real
calendar dates, social security numbers in use, telephone numbers, mail addresses and keys written
after words such as "token". Each is read as a row of symbols with a radix each, and permuted by a
Feistel network of keyed SHA-256 rounds: half of the symbols is shifted by a hash of the other half, in
turns. So a pseudonym has the format of its value and passes the same test (check digits are made
anew), equal values stay equal in all documents, also when they are written with other separators, and
different values of one format stay different. Who has the key can undo it.

Values are found in whole runs of numbers: at each word the longest number that begins there and passes
its test is taken (of IBANs first the one of its country's length), and the search goes on behind it.
Where other numbers touch a value, they can pass the test together with it by chance, before or after;
then undoing may take other borders than were replaced.

Everything happens in one projection per document: the text is cut at the matches and joined again
with the pseudonyms in their places. Nothing is shuffled, and texts without a digit or "@" are only
tested for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Beginnings are tied to a place where no such character stands before, so that a long word is
# looked at once.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
KEY = (
    r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]{24})"
    r"(?<=(?i:token|key|secret|password|passwd)['\"]{0,1}\s{0,3}[=:]{1,2}\s{0,3}['\"]{0,1})"
    r"[0-9a-fA-F]{24,}+(?![0-9A-Za-z])"
)
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
DATES = (
    r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}",
    r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}",
    r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}",
    r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}",
    r"[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}",
)
DATE = rf"(?<![0-9./-])(?:{'|'.join(DATES)})(?![0-9]|[./-][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (
    r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|(?<![0-9+])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
    r"|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])"
)
# Card numbers, IBANs and international telephone numbers are found in whole runs of words, so that a
# number beside a value neither hides it nor is cut in two. Possessive loops need no stack.
NO_MAIL = r"(?![A-Za-z0-9._%+-]{1,64}@)"
MORE = rf"(?:[ ./-]{NO_MAIL}[0-9]++)*+"
IBAN_RUN = (
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9]{4} ?[A-Z0-9]{4})[A-Z0-9]*+"
    rf"(?:[ ./-]{NO_MAIL}[A-Z0-9]++)*+"
)
CARD_RUN = rf"(?<![0-9])(?![0-9]{{20}})(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++{MORE}"
PATTERN = "|".join((MAIL, KEY, IBAN_RUN, IPV4, DATE, SSN, rf"(?:{PHONE}){MORE}", CARD_RUN))
# What may stand in a run, tried in this order at the beginning of each word.
IBAN_SHAPES = [
    rf"[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{f' ?[A-Z0-9]{{{rest}}}' if rest else ''}(?![A-Za-z0-9])"
    for fours in range(7, 1, -1)
    for rest in (3, 2, 1, 0)
]
SHAPES = [
    ("ipv4", IPV4),
    ("date", DATE),
    ("ssn", SSN),
    ("phone", PHONE),
    *[("phone", PHONE.replace("){2,4}(?![0-9])", f"){{2,{most}}}(?![0-9])")) for most in (3, 2)],
    *[("card", rf"[0-9](?:[ -]?[0-9]){{{digits - 1}}}(?![0-9])") for digits in range(19, 12, -1)],
]
LONGEST = 60  # characters of a value in a run; no shape above takes more
WORDS_HELD = 256  # of a run whose values are gathered together
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 "
    "ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 "
    "QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split()

FIRST_DAY = "1800-01-01"
DAYS = (189, 773)  # 400 years of the calendar have 189 * 773 days
AREAS, GROUPS, SERIALS = 898, 99, 9999  # of social security numbers: 001-899 but for 666


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Permutation:
    """Keyed permutations of rows of symbols, forwards or back."""

    def __init__(self, key: str, undo: bool = False) -> None:
        self.key = key
        self.undo = undo

    def __call__(self, kind: str, symbols: Column, radices: Column) -> Column:
        rounds = [F.lit(r) for r in range(ROUNDS)]
        order = F.array(*(rounds[::-1] if self.undo else rounds))
        sign = -1 if self.undo else 1

        def network(radices: Column) -> Column:
            half = F.floor(F.size(radices) / 2)

            def step(state: Column, r: Column) -> Column:
                moves_left = r % 2 == 0
                rest = F.filter(state, lambda _, k: (k < half) != moves_left)
                # Its digest, so that a round over a long key takes linear time.
                rest = F.sha2(F.array_join(rest.cast("array<string>"), ",").cast("binary"), 256)

                def moved(symbol: Column, k: Column, rest: Column) -> Column:
                    text = F.concat_ws("|", F.lit(self.key), F.lit(kind), r, k, rest)
                    digest = F.sha2(text.cast("binary"), 256)
                    number = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
                    radix = F.get(radices, k)
                    other = F.pmod(symbol + sign * F.pmod(number, radix), radix)
                    return F.when((k < half) == moves_left, other).otherwise(symbol)

                return let(rest, lambda x: F.transform(state, lambda s, k: moved(s, k, x)))

            return F.aggregate(order, symbols.cast("array<bigint>"), step)

        return let(radices.cast("array<bigint>"), network)


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _zero(char: Column) -> Column:
    """The code of the first character of a digit's or letter's class."""
    return F.when(char <= "9", 48).when(char <= "Z", 65).otherwise(97)


def _is_symbol(char: Column) -> Column:
    return char.rlike("[0-9A-Za-z]")


def _symbols(text: Column) -> Column:
    """Digits and letters as numbers from zero within their class."""
    return F.transform(F.filter(_chars(text), _is_symbol), lambda c: F.ascii(c) - _zero(c))


def _radices(text: Column) -> Column:
    return F.transform(
        F.filter(_chars(text), _is_symbol), lambda c: F.when(c <= "9", 10).otherwise(26)
    )


def _rendered(text: Column, symbols: Column) -> Column:
    """The text with other symbols in the places of its own."""

    def char(c: Column, i: Column, found: Column) -> Column:
        at = F.length(F.regexp_replace(F.substring(text, F.lit(1), i + 1), "[^0-9A-Za-z]", "")) - 1
        return F.when(_is_symbol(c), F.chr(_zero(c) + F.get(found, at))).otherwise(c)

    return let(
        symbols,
        lambda found: F.array_join(F.transform(_chars(text), lambda c, i: char(c, i, found)), ""),
    )


def _luhn(digits: Column) -> Column:
    """The Luhn sum with every second digit from the last but one on doubled."""

    def worth(digit: Column, i: Column, size: Column) -> Column:
        doubled = 2 * digit
        return F.when((size - i) % 2 == 1, digit).otherwise(
            F.when(doubled > 9, doubled - 9).otherwise(doubled)
        )

    def total(found: Column) -> Column:
        worths = F.transform(found, lambda d, i: worth(d, i, F.size(found)))
        return F.aggregate(worths, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return let(digits.cast("array<bigint>"), total)


def _card(m: Column, permute: Permutation) -> Column:
    def other(digits: Column) -> Column:
        payload = F.slice(digits, F.lit(1), F.size(digits) - 1)
        moved = permute("card", payload, F.transform(payload, lambda _: F.lit(10)))
        return let(moved, checked)

    def checked(moved: Column) -> Column:
        total = _luhn(F.concat(moved, F.array(F.lit(0).cast("bigint"))))
        check = F.pmod(10 - total % 10, F.lit(10)).cast("bigint")
        return _rendered(m, F.concat(moved, F.array(check)))

    return let(_symbols(m), lambda d: F.when(_luhn(d) % 10 == 0, other(d)))


def _mod97(text: Column) -> Column:
    """What remains of an IBAN's number: the first four characters go last, letters count from 10."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))
    return F.aggregate(
        _chars(turned),
        F.lit(0).cast("bigint"),
        lambda a, c: F.when(c <= "9", a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55)
        % 97,
    )


def _iban(m: Column, permute: Permutation) -> Column:
    zero = F.lit(0).cast("bigint")

    def other(symbols: Column) -> Column:
        rest = F.size(symbols) - 4
        radices = F.slice(_radices(m), F.lit(5), rest)
        account = permute("iban", F.slice(symbols, F.lit(5), rest), radices)
        begin = F.slice(symbols, 1, 2)
        return let(account, lambda x: let(checked(begin, x), lambda c: written(begin, c, x)))

    def checked(begin: Column, account: Column) -> Column:
        return 98 - _mod97(_rendered(m, F.concat(begin, F.array(zero, zero), account)))

    def written(begin: Column, check: Column, account: Column) -> Column:
        digits = F.array(F.floor(check / 10), check % 10).cast("array<bigint>")
        return _rendered(m, F.concat(begin, digits, account))

    return F.when(_mod97(m) == 1, let(_symbols(m).cast("array<bigint>"), other))


def _ipv4(m: Column, permute: Permutation) -> Column:
    def other(octets: Column) -> Column:
        moved = permute("ipv4", octets, F.array(*[F.lit(256)] * 4))
        # 0.1.2.03 is no address as addresses are written.
        usual = F.array_join(octets.cast("array<string>"), ".") == m
        return F.when(
            usual & F.forall(octets, lambda x: x < 256), F.array_join(moved.cast("array<string>"), ".")
        )

    return let(F.split(m, r"\.").cast("array<int>"), other)


def _date(m: Column, permute: Permutation) -> Column:
    """Years, months and days keep their order; day and month stand as in 31/12/1999 unless only
    12/31/1999 is a date."""
    first = F.lit(FIRST_DAY).cast("date")
    mark = F.regexp_extract(m, "([./-])", 1)
    high, low = DAYS

    def in_order(parts: Column) -> Column:
        a, b, c = (F.get(parts, F.lit(i)) for i in range(3))
        year_first = F.length(a) == 4
        month_first = ~year_first & (b.cast("int") > 12)
        return F.struct(
            F.when(year_first, a).otherwise(c).alias("year"),
            F.when(month_first, a).otherwise(b).alias("month"),
            F.when(year_first, c).when(month_first, b).otherwise(a).alias("day"),
            F.when(year_first, "year").when(month_first, "month").otherwise("day").alias("order"),
        )

    def real(p: Column) -> Column:
        year, month, day = (p[name].cast("int") for name in ("year", "month", "day"))
        bounded = F.greatest(F.least(month, F.lit(12)), F.lit(1))
        start = F.make_date(F.greatest(year, F.lit(1)), bounded, F.lit(1))
        fits = (
            year.between(1800, 2199) & month.between(1, 12) & day.between(1, F.dayofmonth(F.last_day(start)))
        )
        return F.when(fits, F.date_diff(start, first) + day - 1)

    def moved(p: Column, at: Column) -> Column:
        symbols = permute("date", F.array(F.floor(at / low), at % low), F.array(F.lit(high), F.lit(low)))
        day = let(symbols, lambda s: F.get(s, F.lit(0)) * low + F.get(s, F.lit(1)))
        return let(F.date_add(first, day.cast("int")), lambda other: written(p, other))

    def written(p: Column, other: Column) -> Column:
        def two(number: Column, like: Column) -> Column:
            text = number.cast("string")
            return F.when(F.length(like) > 1, F.lpad(text, 2, "0")).otherwise(text)

        year = F.year(other).cast("string")
        month, day = two(F.month(other), p["month"]), two(F.dayofmonth(other), p["day"])
        return (
            F.when(p["order"] == "year", F.concat(year, mark, month, mark, day))
            .when(p["order"] == "month", F.concat(month, mark, day, mark, year))
            .otherwise(F.concat(day, mark, month, mark, year))
        )

    return let(
        in_order(F.split(m, "[./-]")),
        lambda p: let(real(p), lambda at: F.when(at.isNotNull(), moved(p, at))),
    )


def _ssn(m: Column, permute: Permutation) -> Column:
    radices = F.array(F.lit(AREAS), F.lit(GROUPS), F.lit(SERIALS))

    def other(parts: Column) -> Column:
        area, group, serial = (F.get(parts, F.lit(i)) for i in range(3))
        used = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        place = area - 1 - F.when(area > 666, 1).otherwise(0)
        return F.when(used, let(permute("ssn", F.array(place, group - 1, serial - 1), radices), written))

    def written(moved: Column) -> Column:
        area, group, serial = (F.get(moved, F.lit(i)) + 1 for i in range(3))
        numbers = [(area + F.when(area >= 666, 1).otherwise(0), 3), (group, 2), (serial, 4)]
        return F.concat_ws("-", *[F.lpad(n.cast("string"), width, "0") for n, width in numbers])

    return let(F.split(m, "-").cast("array<int>"), other)


def _phone(m: Column, permute: Permutation) -> Column:
    """The country code stays: the digits after "+" up to a separator, or the first one."""
    code = F.regexp_extract(m, r"^\+([0-9]{1,3})(?![0-9])", 1)
    kept = F.when(~m.startswith("+"), 0).when(code == "", 1).otherwise(F.length(code))

    def other(digits: Column) -> Column:
        number = F.slice(digits, kept + 1, F.size(digits))
        moved = permute("phone", number, F.transform(number, lambda _: F.lit(10)))
        begin = F.slice(digits, F.lit(1), kept)
        return F.when(F.size(digits).between(8, 15), _rendered(m, F.concat(begin, moved)))

    return let(_symbols(m).cast("array<bigint>"), other)


def _mail(m: Column, permute: Permutation) -> Column:
    name, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    moved = permute("mail", _symbols(name), _radices(name))
    return F.concat(_rendered(name, moved), F.lit("@"), domain)


def _key(m: Column, permute: Permutation) -> Column:
    digits = F.transform(
        _chars(F.lower(m)), lambda c: F.ascii(c) - F.when(c <= "9", 48).otherwise(87)
    )
    moved = let(
        digits, lambda x: permute("key", x, F.transform(x, lambda _: F.lit(16)))
    )
    text = F.array_join(F.transform(moved, lambda x: F.hex(x)), "")
    return F.when(m == F.lower(m), F.lower(text)).otherwise(text)


def _kind(m: Column) -> Column:
    """Which pattern a match is one of. The tests exclude each other by their characters."""
    return (
        F.when(m.contains("@"), "mail")
        .when(m.rlike("^[0-9a-fA-F]{24,}$"), "key")
        .when(m.rlike("^[A-Z]"), "iban")
        .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ipv4")
        .when(m.rlike(f"^(?:{'|'.join(DATES)})$"), "date")
        .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(m.rlike(r"^[+(]|^[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])"), "phone")
        .otherwise("card")
    )


KINDS: dict[str, Callable[[Column, Permutation], Column]] = {
    "mail": _mail,
    "key": _key,
    "iban": _iban,
    "ipv4": _ipv4,
    "date": _date,
    "ssn": _ssn,
    "phone": _phone,
    "card": _card,
}


def _pseudonym(m: Column, kind: Column, permute: Permutation) -> Column:
    """The value's pseudonym; null when the value fails its test."""
    found = F.lit(None).cast("string")
    for name, rule in reversed(KINDS.items()):
        found = F.when(kind == name, rule(m, permute)).otherwise(found)
    return found


def _part(value: Column, kind: Column, pseudonym: Column) -> Column:
    return F.struct(value.alias("value"), kind.alias("kind"), pseudonym.alias("pseudonym"))


def _plain(value: Column) -> Column:
    nothing = F.lit(None).cast("string")
    return F.array(_part(value, nothing, nothing))


def _first_valid(tail: Column, permute: Permutation) -> Column:
    """The value that begins at the second character of ``tail``, or null."""

    def shaped(kind: str, shape: str) -> Column:
        value = F.regexp_extract(tail, f"^[\\s\\S]({shape})", 1)
        return F.struct(value.alias("value"), F.lit(kind).alias("kind"))

    def usual(x: Column) -> Column:
        plain = F.regexp_replace(x["value"], " ", "")
        name = F.concat(F.substring(plain, 1, 2), F.length(plain).cast("string"))
        return name.isin(IBAN_LENGTHS)

    def ibans(found: Column) -> Column:
        return F.concat(F.filter(found, usual), F.filter(found, lambda x: ~usual(x)))

    of_ibans = let(F.array(*[shaped("iban", shape) for shape in IBAN_SHAPES]), ibans)
    others = F.array(*[shaped(kind, shape) for kind, shape in SHAPES])
    shapes = F.when(tail.rlike(r"^[\s\S][A-Z]{2}[0-9]{2}"), of_ibans).otherwise(others)
    tried = F.transform(
        F.filter(shapes, lambda x: x["value"] != ""),
        lambda x: _part(x["value"], x["kind"], _pseudonym(x["value"], x["kind"], permute)),
    )
    return F.get(F.filter(tried, lambda x: x["pseudonym"].isNotNull()), F.lit(0))


def _parts(run: Column, permute: Permutation) -> Column:
    """The run cut into values that pass their tests, the longest from the first word that begins one,
    and what stands between them.

    The run is split into characters once, since a position in a text is found by counting from its
    beginning, and what is found is gathered in blocks of words; a long run takes linear time.
    """
    part = "struct<value:string,kind:string,pseudonym:string>"

    def text_of(chars: Column, first: Column, count: Column) -> Column:
        return F.array_join(F.slice(chars, first, count), "")

    def cut(chars: Column) -> Column:  # a blank and the run
        size = F.size(chars)
        begins = F.filter(
            F.sequence(F.lit(1), size - 1),
            lambda i: F.get(chars, i).rlike("[0-9A-Z+(]") & ~F.get(chars, i - 1).rlike("[0-9A-Za-z]"),
        )

        def step(state: Column, i: Column) -> Column:
            def taken(hit: Column) -> Column:
                before = _plain(text_of(chars, state["next"] + 1, i - state["next"]))
                after = F.struct(
                    (i + F.length(hit["value"])).alias("next"),
                    F.concat(state["parts"], before, F.array(hit)).alias("parts"),
                )
                return F.when(hit.isNotNull(), after).otherwise(state)

            # A value and the characters around it.
            found = let(text_of(chars, i, F.lit(LONGEST + 4)), lambda tail: _first_valid(tail, permute))
            return F.when(i < state["next"], state).otherwise(let(found, taken))

        def block(state: Column, words: Column) -> Column:
            start = F.struct(state["next"].alias("next"), F.array().cast(f"array<{part}>").alias("parts"))

            def gathered(found: Column) -> Column:
                return F.struct(
                    found["next"].alias("next"),
                    F.concat(state["parts"], F.array(found["parts"])).alias("parts"),
                )

            return let(F.aggregate(words, start, step), gathered)

        def ended(state: Column) -> Column:
            rest = _plain(text_of(chars, state["next"] + 1, size))
            return F.concat(F.flatten(state["parts"]), rest)

        def in_blocks(begins: Column) -> Column:
            first = F.sequence(F.lit(0), F.floor(F.size(begins) / WORDS_HELD).cast("int"))
            return F.transform(first, lambda b: F.slice(begins, b * WORDS_HELD + 1, F.lit(WORDS_HELD)))

        none = F.struct(
            F.lit(1).alias("next"), F.array().cast(f"array<array<{part}>>").alias("parts")
        )
        return F.aggregate(let(begins, in_blocks), none, block, ended)

    return let(_chars(F.concat(F.lit(" "), run)), cut)


def found_in(text: Column, key: str, undo: bool = False) -> Column:
    """Matches of a text in order, each as the parts it is cut into: structs of ``value``, ``kind`` and
    ``pseudonym``, which is null for what stays."""
    permute = Permutation(key, undo)
    matches = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    named = F.transform(matches, lambda m: F.struct(m.alias("value"), _kind(m).alias("kind")))
    return F.transform(
        named,
        lambda m: F.when(
            m["kind"].isin("iban", "phone", "card"), _parts(m["value"], permute)
        ).otherwise(F.array(_part(m["value"], m["kind"], _pseudonym(m["value"], m["kind"], permute)))),
    )


def pseudonymised(
    documents: DataFrame, key: str, text_column: str = "text", undo: bool = False
) -> DataFrame:
    """The documents with pseudonyms in their texts, and ``pii_found``: what was replaced, as structs
    of ``value``'s ``kind`` and ``pseudonym``.

    All other columns stay as they are (a column named ``pii_found`` is replaced). A null text stays
    null with nothing found; rows, ties and repeated rows are treated each alone. Values that fail
    their test stay in the text.
    """
    text = F.col(text_column)
    may = text.rlike("[0-9@]")
    nothing = F.array().cast("array<array<struct<value:string,kind:string,pseudonym:string>>>")
    matched = documents.withColumn(
        "pii_found", F.when(may, found_in(text, key, undo)).otherwise(nothing)
    )
    gaps = F.split(text, PATTERN, -1)
    written = F.transform(
        "pii_found",
        lambda parts: F.array_join(F.transform(parts, lambda x: F.coalesce(x["pseudonym"], x["value"])), ""),
    )
    joined = F.array_join(
        F.transform(
            gaps,
            lambda gap, i: F.concat(
                gap,
                F.coalesce(F.get(written, i), F.lit("")),
            ),
        ),
        "",
    )
    replaced = F.filter(F.flatten("pii_found"), lambda x: x["pseudonym"].isNotNull())
    return matched.withColumn(
        text_column, F.when(F.size(replaced) > 0, joined).otherwise(text)
    ).withColumn(
        "pii_found",
        F.transform(replaced, lambda x: F.struct(x["kind"].alias("kind"), x["pseudonym"].alias("pseudonym"))),
    )
