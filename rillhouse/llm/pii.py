"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Each kind of value is a vector of small numbers: the digits of a card, the octets of an address,
day number of a date. A keyed Feistel network permutes the vectors: in each round every second
number is shifted, within its range, by a keyed hash of all the others, so the map is one to one
within the format and the same value gets the same pseudonym in every document. A lone number
takes its place among all of its range, sorted by a keyed hash. Validated kinds
stay valid: a card number gets the check digit of its new digits, a social security number only
takes areas, groups and serials that exist, a date is a date between 1900 and 2099.

Card numbers may stand next to other digits: in a run of digit groups, one space or hyphen apart,
every span of 13 to 19 digits from the start of a group to the end of one is tried. One group, or
groups as printed on cards, goes before any other span; after that the first in the text, then the
longest. Where spans that cross are both valid only the one tried first is replaced, and if such a
span turns valid by the pseudonym of another it is not revealed.

Null text stays null, text without such values stays as it is. Values that fail validation (a
16-digit number with a wrong check digit, the 31st of February) are not personal data and stay.
Extra columns and repeated rows are kept. ``reveal=True`` turns pseudonyms back, given the key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# What each kind looks like.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"
ADDRESS = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"
SOCIAL = r"(?<![\d-])(?!000|666|9\d\d)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])"
DATE = r"(?<![\d-])(?:19|20)\d{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d-])"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])"
# A whole run of digit groups, up to a group that begins a value of another kind.
_DOTTED = r"\d{3}(?:\.\d{3}[ .-]|[ -]\d{3}\.)\d{4}(?![\d-])"
CARD = rf"(?<!\d)\d(?:(?:[ -](?!{EMAIL}|{ADDRESS}|{SOCIAL}|{DATE}|{_DOTTED}))?\d){{12,}}+"
PRINTED = ("4-4-4-4", "4-6-5", "4-6-4")
SECRET = (r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
          r"|(?<![A-Za-z])(?i:password|passwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}\"?[^\s\"]{8,}")
ANY = "|".join((SECRET, EMAIL, ADDRESS, SOCIAL, DATE, PHONE, CARD))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Name a value that an expression needs several times, so it is computed once."""
    return F.transform(F.array(value), use)[0]


def feistel(vector: Column, ranges: Column, key: str, label: str, reveal: bool = False) -> Column:
    """Permute an array of numbers, the i-th in 0 .. ranges[i] - 1, under the key."""
    def shift(others: Column, turn: Column, i: Column) -> Column:
        text = F.concat_ws("|", F.lit(f"{key}|{label}"), turn.cast("string"), i.cast("string"), others)
        return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")

    def one(state: Column, turn: Column) -> Column:
        mine = lambda i: i % 2 == turn % 2
        others = F.concat_ws(",", F.filter(state, lambda x, i: ~mine(i)).cast("array<string>"))
        sign = -1 if reveal else 1
        return let(others, lambda o: F.transform(state, lambda x, i: F.when(
            mine(i), F.pmod(x + sign * shift(o, turn, i), F.get(ranges, i))).otherwise(x)))

    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if reveal else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, vector, one)


def _numbers(parts: Column) -> Column:
    return F.transform(parts, lambda x: x.cast("long"))


def _letters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _range(c: Column) -> Column:
    return F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1).cast("long")


def _start(c: Column) -> Column:
    """Code of the first of a character's kind; any other character is a kind of its own."""
    return (F.when(c.rlike("[0-9]"), 48).when(c.rlike("[A-Z]"), 65).when(c.rlike("[a-z]"), 97)
            .otherwise(F.ascii(c)).cast("long"))


def single(number: Column, size: Column, key: str, label: str, reveal: bool = False) -> Column:
    """Permute one number in 0 .. size - 1: its place when all are sorted by a keyed hash. A lone
    number has no others to be shifted by, and a fixed shift would be no pseudonym."""
    keyed = F.transform(F.sequence(F.lit(0).cast("long"), size - 1), lambda x: F.struct(
        F.sha2(F.concat(F.lit(f"{key}|{label}|single|"), x.cast("string")), 256).alias("h"), x.alias("x")))
    order = F.transform(F.array_sort(keyed), lambda s: s["x"])
    return F.get(order, number) if reveal else F.array_position(order, number) - 1


def characters(text: Column, key: str, label: str, reveal: bool = False) -> Column:
    """Permute digits among digits and letters among letters; the other characters stay."""
    def used(letters: Column) -> Column:
        moved = F.filter(letters, lambda c: _range(c) > 1)

        def made(own: Column) -> Column:
            vector = F.transform(own, lambda c: F.ascii(c).cast("long") - _start(c))
            ranges = F.transform(own, _range)
            lone = F.array(single(F.get(vector, 0), F.get(ranges, 0), key, label, reveal))
            return F.when(F.size(own) == 0, vector).when(F.size(own) == 1, lone).otherwise(
                feistel(vector, ranges, key, label, reveal))

        def put(numbers: Column) -> Column:
            start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"))

            def step(a: Column, c: Column) -> Column:
                moves = _range(c) > 1
                new = F.when(moves, F.chr(_start(c) + F.get(numbers, a["n"]))).otherwise(c)
                return F.struct(F.concat(a["text"], new).alias("text"),
                                (a["n"] + moves.cast("int")).alias("n"))
            return F.aggregate(letters, start, step, lambda a: a["text"])
        return let(let(moved, made), put)
    return let(_letters(text), used)


def _luhn_digit(digits: Column) -> Column:
    """Check digit after these digits (an array of numbers)."""
    doubled = F.transform(F.reverse(digits), lambda x, i: F.when(
        i % 2 == 0, 2 * x - F.when(x > 4, 9).otherwise(0)).otherwise(x))
    total = F.aggregate(doubled, F.lit(0).cast("long"), lambda a, x: a + x)
    return (10 - total % 10) % 10


def _digits(text: Column) -> Column:
    return _numbers(_letters(F.regexp_replace(text, "[^0-9]", "")))


def _refill(shape: Column, digits: Column) -> Column:
    """Put new digits where the shape has digits."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"))

    def put(a: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(F.concat(a["text"], F.when(digit, F.get(digits, a["n"]).cast("string"))
                                 .otherwise(c)).alias("text"),
                        (a["n"] + digit.cast("int")).alias("n"))
    return F.aggregate(_letters(shape), start, put, lambda a: a["text"])


def _valid(digits: Column) -> Column:
    return F.element_at(digits, -1) == _luhn_digit(F.slice(digits, 1, F.size(digits) - 1))


def _card(value: Column, key: str, reveal: bool) -> Column:
    """A valid card number; what is no digit stays."""
    def used(digits: Column) -> Column:
        body = F.slice(digits, 1, F.size(digits) - 1)
        tens = F.transform(body, lambda x: F.lit(10).cast("long"))
        return let(feistel(body, tens, key, "card", reveal),
                   lambda m: _refill(value, F.concat(m, F.array(_luhn_digit(m)))))
    return let(_digits(value), used)


def _spans(groups: Column) -> Column:
    """Valid spans of groups as an array of (start, stop, printed), by start and falling length."""
    n = F.size(groups)

    def at(start: Column) -> Column:
        def one(stop: Column) -> Column:
            part = F.slice(groups, start + 1, stop - start)
            shape = F.array_join(F.transform(part, lambda g: F.length(g).cast("string")), "-")
            return F.struct(start.alias("start"), stop.alias("stop"),
                            ((stop - start == 1) | shape.isin(*PRINTED)).alias("printed"),
                            F.array_join(part, "").alias("digits"))
        stops = F.sequence(F.least(start + 19, n), start + 1, F.lit(-1))
        fits = F.filter(F.transform(stops, one), lambda s: F.length(s["digits"]).between(13, 19))
        return F.filter(fits, lambda s: _valid(_digits(s["digits"])))
    found = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), at))
    return F.transform(found, lambda s: F.struct(s["start"], s["stop"], s["printed"]))


def _apart(spans: Column) -> Column:
    """Of spans in order of start, those that begin after the last one taken has ended."""
    none = F.filter(spans, lambda s: F.lit(False))

    def take(taken: Column, s: Column) -> Column:
        free = (F.size(taken) == 0) | (F.get(taken, F.size(taken) - 1)["stop"] <= s["start"])
        return F.when(free, F.concat(taken, F.array(s))).otherwise(taken)
    return F.aggregate(spans, none, take)


def _cards(run: Column, key: str, reveal: bool) -> Column:
    """A run of digit groups with its card numbers replaced, and the values between them."""
    between = "|".join((SOCIAL, DATE, PHONE))

    def other(v: Column) -> Column:
        whole = lambda pattern: v.rlike(f"^(?:{pattern})$")
        return (F.when(whole(SOCIAL), _social(v, key, reveal)).when(whole(DATE), _date(v, key, reveal))
                .otherwise(_phone(v, key, reveal)))

    def rest(tokens: Column) -> Column:
        text = F.array_join(tokens, "")
        end = F.regexp_extract(text, "[ -]$", 0)   # stands before the next card
        return F.concat(_replaced(F.regexp_replace(text, "[ -]$", ""), between, other), end)

    def rebuilt(tokens: Column, taken: Column) -> Column:
        start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

        def put(a: Column, s: Column) -> Column:
            card = F.array_join(F.slice(tokens, s["start"] + 1, s["stop"] - s["start"]), "")
            return F.struct(F.concat(a["text"], rest(F.slice(tokens, a["at"] + 1, s["start"] - a["at"])),
                                     _card(card, key, reveal)).alias("text"), s["stop"].alias("at"))
        return F.aggregate(taken, start, put, lambda a: F.concat(a["text"], rest(
            F.slice(tokens, a["at"] + 1, F.size(tokens) - a["at"]))))

    def chosen(spans: Column) -> Column:
        def both(first: Column) -> Column:
            clear = F.filter(spans, lambda s: ~F.exists(
                first, lambda t: (t["start"] < s["stop"]) & (s["start"] < t["stop"])))
            return F.array_sort(F.concat(first, _apart(clear)))
        return let(_apart(F.filter(spans, lambda s: s["printed"])), both)

    tokens = F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), F.lit(0))
    return let(tokens, lambda t: let(chosen(_spans(F.split(run, "[ -]"))), lambda c: rebuilt(t, c)))


def _phone(value: Column, key: str, reveal: bool) -> Column:
    """The country code stays, the last ten digits are permuted."""
    def used(digits: Column) -> Column:
        fixed = F.slice(digits, 1, F.size(digits) - 10)
        own = F.slice(digits, F.size(digits) - 9, F.lit(10))
        tens = F.transform(own, lambda x: F.lit(10).cast("long"))
        return _refill(value, F.concat(fixed, feistel(own, tens, key, "phone", reveal)))
    return let(_digits(value), used)


def _address(value: Column, key: str, reveal: bool) -> Column:
    octets = _numbers(F.split(value, r"\."))
    ranges = F.array(*[F.lit(256).cast("long")] * 4)
    return F.array_join(feistel(octets, ranges, key, "address", reveal).cast("array<string>"), ".")


def _social(value: Column, key: str, reveal: bool) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    vector = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)
    ranges = F.array(*[F.lit(n).cast("long") for n in (898, 99, 9999)])

    def shown(m: Column) -> Column:
        new = m[0] + F.when(m[0] >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(new.cast("string"), 3, "0"),
                           F.lpad((m[1] + 1).cast("string"), 2, "0"),
                           F.lpad((m[2] + 1).cast("string"), 4, "0"))
    return let(feistel(vector, ranges, key, "social", reveal), shown)


def _date(value: Column, key: str, reveal: bool) -> Column:
    """1900 to 2099 has 73,049 days, which is 17 times 4,297."""
    day = F.datediff(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).cast("date"),
                     F.lit("1900-01-01").cast("date")).cast("long")

    def used(n: Column) -> Column:
        vector = F.array(F.floor(n / 4297), n % 4297)
        ranges = F.array(F.lit(17).cast("long"), F.lit(4297).cast("long"))
        made = feistel(vector, ranges, key, "date", reveal)
        return F.when(n.isNull(), value).otherwise(let(made, lambda m: F.date_format(
            F.date_add(F.lit("1900-01-01").cast("date"), (m[0] * 4297 + m[1]).cast("int")),
            "yyyy-MM-dd")))
    return let(day, used)


def _email(value: Column, key: str, reveal: bool) -> Column:
    """The part before the @ and the first label of a longer domain change."""
    local, domain = F.split_part(value, F.lit("@"), F.lit(1)), F.split_part(value, F.lit("@"), F.lit(2))
    label = F.split_part(domain, F.lit("."), F.lit(1))
    longer = F.size(F.split(domain, r"\.")) > 2
    head = F.when(longer, F.concat(local, F.lit("@"), label)).otherwise(local)
    return F.concat(characters(head, key, "email", reveal),
                    F.substring(value, F.length(head) + 1, F.length(value)))


def _secret(value: Column, key: str, reveal: bool) -> Column:
    """What follows the name of a password or key, or a whole access key, keeps its letter kinds."""
    head = F.regexp_extract(value, "^[^=:]*[=:]\\s*\"?|^AKIA", 0)
    return F.concat(head, characters(F.substring(value, F.length(head) + 1, F.length(value)), key,
                                     "secret", reveal))


def pseudonym(value: Column, key: str, reveal: bool = False) -> Column:
    """The pseudonym of one value found by ``ANY``."""
    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    return (F.when(whole(SECRET), _secret(value, key, reveal))
            .when(value.contains("@"), _email(value, key, reveal))
            .when(whole(ADDRESS), _address(value, key, reveal))
            .when(whole(SOCIAL), _social(value, key, reveal))
            .when(whole(DATE), _date(value, key, reveal))
            .when(whole(PHONE), _phone(value, key, reveal))
            .otherwise(_cards(value, key, reveal)))


def _replaced(text: Column, pattern: str, each: Callable[[Column], Column]) -> Column:
    """The text with what the pattern finds replaced."""
    between = F.split(text, pattern, -1)
    made = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), each)
    return F.concat_ws("", F.zip_with(between, made, lambda a, b: F.concat(
        a, F.coalesce(b, F.lit("")))))


def masked(text: Column, key: str, reveal: bool = False) -> Column:
    """The text with every value replaced."""
    joined = _replaced(text, ANY, lambda v: pseudonym(v, key, reveal))
    return F.when(text.rlike(ANY), joined).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, columns: Sequence[str] = ("text",),
                 reveal: bool = False) -> DataFrame:
    """``docs`` with the values in the named text columns replaced; no shuffle."""
    return docs.withColumns({c: masked(F.col(f"`{c}`").cast("string"), key, reveal) for c in columns})
