"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Numbers and dates that pass their validation are replaced by a keyed
permutation of their own format, so a pseudonym is again a valid value of
that format, and equal values get equal pseudonyms in all documents.

The permutation is a Feistel network on pairs (l, r), l < a and r < b: each
round adds a keyed hash of r to l modulo a, then one of the new l to r modulo
b.  Every step can be undone with the key, so no two values share a
pseudonym; a * b is exactly the number of a format's values, so nothing
falls outside it.  The local part of a mail address is permuted alike,
character by character within its class (digit, lower, upper case).

Cards are looked for in runs of digit groups: from each group on, the longest
13 to 19 digits in whole groups that pass the Luhn check are one.  Phones are
those with a leading "+" and the ten-digit North American form without it;
other national forms (030 1234567) are out of scope, as are digits without
separators that are no card.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualis.llm.common import table, text_of

ROUNDS = 5
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Days from 1900-01-01 to 2099-12-31: 17 * 4297.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)


def _keyed(modulus: Column, *parts: Column) -> Column:
    """A keyed number below the modulus, from 60 bits of SHA-256."""
    digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % modulus


def permute(left: Column, right: Column, a: Column, b: Column, key: Column, tweak: str) -> Column:
    """The keyed permutation of pairs left < a, right < b: struct<l, r>."""
    def turn(s: Column, i: Column) -> Column:
        new_left = (s["l"] + _keyed(a, key, F.lit(tweak), i, F.lit("l"), s["r"], a, b)) % a
        new_right = (s["r"] + _keyed(b, key, F.lit(tweak), i, F.lit("r"), new_left, a, b)) % b
        return F.struct(new_left.alias("l"), new_right.alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _permute_digits(digits: Column, key: Column, tweak: str) -> Column:
    """A digit string of 2 to 18 digits to another of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    power = [F.element_at(F.array(*[_long(10**k) for k in range(10)]), k + 1) for k in (half, n - half)]
    pair = permute(F.substr(digits, F.lit(1), half), F.substr(digits, half + 1), power[0], power[1], key, tweak)
    return F.concat(F.lpad(pair["l"].cast("string"), half, "0"), F.lpad(pair["r"].cast("string"), n - half, "0"))


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by others, in order; everything else stays."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"))

    def step(s: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.struct(F.concat(s["text"], F.when(digit, F.substr(digits, s["used"] + 1, F.lit(1))).otherwise(c)).alias("text"),
                        F.when(digit, s["used"] + 1).otherwise(s["used"]).alias("used"))

    return F.aggregate(chars, start, step)["text"]


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string."""
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    values = F.transform(reverse, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c >= "5", 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda s, v: s + v)


def _card_valid(value: Column) -> Column:
    return _luhn(_digits(value)) % 10 == 0


def _card(value: Column, key: Column) -> Column:
    digits = _digits(value)
    body = _permute_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    check = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    return _refill(value, F.concat(body, check.cast("string")))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _cards(value: Column, key: Column) -> Column:
    """struct<text, n>: a run of digit groups with its cards replaced, and their number."""
    def join(parts: Column, start: Column, n: Column) -> Column:
        return F.array_join(F.slice(parts, start + 1, n), "")

    def longest(parts: Column, i: Column) -> Column:
        def is_card(n: Column) -> Column:
            return _bound(_digits(join(parts, i, n)), lambda d: F.when(F.length(d).between(13, 19), _card_valid(d)).otherwise(False))
        return F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), F.least(F.size(parts) - i, F.lit(19))), is_card)), F.lit(0))

    def taken(parts: Column) -> Column:
        able = F.filter(F.transform(parts, lambda _, i: F.struct(i.alias("i"), longest(parts, i).alias("n"))), lambda c: c["n"] > 0)
        start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<i:int,n:int>>").alias("cards"))
        return F.aggregate(able, start, lambda s, c: F.when(c["i"] < s["end"], s).otherwise(
            F.struct((c["i"] + c["n"]).alias("end"), F.concat(s["cards"], F.array(c)).alias("cards"))))["cards"]

    def rebuilt(parts: Column, cards: Column) -> Column:
        def end(j: Column) -> Column:
            """Where card j - 1 ends."""
            return F.when(j == 0, 0).otherwise(_bound(F.get(cards, j - 1), lambda c: c["i"] + c["n"]))
        new = F.transform(cards, lambda c, j: F.concat(join(parts, end(j), c["i"] - end(j)), _card(join(parts, c["i"], c["n"]), key)))
        rest = end(F.size(cards))
        return F.struct(F.concat(F.array_join(new, ""), join(parts, rest, F.size(parts) - rest)).alias("text"), F.size(cards).alias("n"))

    return _bound(F.regexp_extract_all(value, F.lit("[ -]?[0-9]+"), F.lit(0)), lambda parts: _bound(taken(parts), lambda cards: rebuilt(parts, cards)))


def _ssn_valid(value: Column) -> Column:
    area, group, serial = (F.substring(value, i, n) for i, n in ((1, 3), (5, 2), (8, 4)))
    return (area != "000") & (area != "666") & (area < "900") & (group != "00") & (serial != "0000")


def _ssn(value: Column, key: Column) -> Column:
    """Areas 001-899 but 666, groups 01-99, serials 0001-9999."""
    area, group, serial = (F.substring(value, i, n).cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = permute(place * 99 + group - 1, serial - 1, _long(898 * 99), _long(9999), key, "ssn")
    new_place = F.floor(pair["l"] / 99)
    new_area = new_place + 1 + F.when(new_place >= 665, 1).otherwise(0)
    return F.concat_ws("-", *[F.lpad(v.cast("string"), n, "0") for v, n in ((new_area, 3), (pair["l"] % 99 + 1, 2), (pair["r"] + 1, 4))])


def _octets(value: Column) -> list[Column]:
    return [F.split(value, r"\.")[i].cast("long") for i in range(4)]


def _ip_valid(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda o: o.cast("long") <= 255)


def _ip(value: Column, key: Column) -> Column:
    o = _octets(value)
    pair = permute(o[0] * 256 + o[1], o[2] * 256 + o[3], _long(65536), _long(65536), key, "ip")
    return F.concat_ws(".", *[v.cast("string") for v in (F.floor(pair["l"] / 256), pair["l"] % 256, F.floor(pair["r"] / 256), pair["r"] % 256)])


def _phone_valid(value: Column) -> Column:
    return F.length(_digits(value)).between(8, 15)


def _phone(value: Column, key: Column) -> Column:
    """All digits but the first two, which hold the country."""
    digits = _digits(value)
    return _refill(value, F.concat(F.substr(digits, F.lit(1), F.lit(2)), _permute_digits(F.substr(digits, F.lit(3)), key, "phone")))


def _phone_national(value: Column, key: Column) -> Column:
    """All digits but the first of ten, as if "+1" stood before, so that both forms of a number get the same digits."""
    digits = _digits(value)
    kept = F.length(digits) - 9
    return _refill(value, F.concat(F.substr(digits, F.lit(1), kept), _permute_digits(F.substr(digits, kept + 1), key, "phone")))


def _date_valid(form: str) -> Callable[[Column], Column]:
    return lambda value: F.try_to_date(value, form).between(F.lit("1900-01-01").cast("date"), F.lit("2099-12-31").cast("date"))


def _date(form: str) -> Callable[[Column, Column], Column]:
    def new(value: Column, key: Column) -> Column:
        first = F.lit(FIRST_DAY).cast("date")
        day = F.datediff(F.try_to_date(value, form), first)
        pair = permute(F.floor(day / DAYS[1]), day % DAYS[1], _long(DAYS[0]), _long(DAYS[1]), key, "date")
        return F.date_format(F.date_add(first, (pair["l"] * DAYS[1] + pair["r"]).cast("int")), form)
    return new


def _shifted(chars: Column, other: Column, key: Column, step: Column) -> Column:
    """Every letter and digit moved within its class by a keyed hash of the other half."""
    seen = F.array_join(other, "")

    def move(c: Column, i: Column) -> Column:
        kind = F.when(c.between("0", "9"), F.lit(DIGITS)).when(c.between("a", "z"), F.lit(LOWER)).when(c.between("A", "Z"), F.lit(UPPER))
        at = (F.instr(kind, c) - 1 + _keyed(F.length(kind).cast("long"), key, F.lit("mail"), step, i, seen)) % F.length(kind)
        return F.coalesce(F.substr(kind, at.cast("int") + 1, F.lit(1)), c)

    return F.transform(chars, move)


def _email(value: Column, key: Column) -> Column:
    chars = F.filter(F.split(F.substring_index(value, "@", 1), ""), lambda c: c != "")
    half = F.floor(F.size(chars) / 2).cast("int")
    start = F.struct(F.slice(chars, 1, half).alias("l"), F.slice(chars, half + 1, F.size(chars) - half).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        left = _shifted(s["l"], s["r"], key, i * 2)
        return F.struct(left.alias("l"), _shifted(s["r"], left, key, i * 2 + 1).alias("r"))

    pair = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)
    return F.concat(F.array_join(F.concat(pair["l"], pair["r"]), ""), F.lit("@"), F.substring_index(value, "@", -1))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    new: Callable[[Column, Column], Column]
    #: For patterns that may hold several values: struct<text, n> of what was found.
    within: Callable[[Column, Column], Column] | None = None


_NOT_BEFORE, _NOT_AFTER = "(?<![0-9A-Za-z_+.@/-])", "(?![0-9A-Za-z_@]|[./-][0-9])"
#: A group of digits does not end in a word or a decimal number.
_GROUP = r"[0-9]++(?![A-Za-z_@]|\.[0-9])"
#: In this order; each kind is looked for in what the earlier ones left.
KINDS = (
    Kind("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", lambda v: F.length(v) > 0, _email),
    Kind("date", _NOT_BEFORE + r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?:(?=[Tt][0-9]{2}(?![0-9A-Za-z_]))|" + _NOT_AFTER + ")", _date_valid("yyyy-MM-dd"), _date("yyyy-MM-dd")),
    Kind("date_dmy", _NOT_BEFORE + r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}" + _NOT_AFTER, _date_valid("dd.MM.yyyy"), _date("dd.MM.yyyy")),
    Kind("date_mdy", _NOT_BEFORE + r"[0-9]{2}/[0-9]{2}/[0-9]{4}" + _NOT_AFTER, _date_valid("MM/dd/yyyy"), _date("MM/dd/yyyy")),
    Kind("ssn", _NOT_BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _NOT_AFTER, _ssn_valid, _ssn),
    Kind("ip", _NOT_BEFORE + r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}" + _NOT_AFTER, _ip_valid, _ip),
    Kind("phone", r"(?<![0-9A-Za-z_+])\+[0-9][0-9 ().-]{5,20}[0-9]" + _NOT_AFTER, _phone_valid, _phone),
    Kind("phone_national", r"(?<![0-9A-Za-z_+.@/-])(?=[0-9(])(?<!\+[0-9 ().-]{1,21})(?:1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + _NOT_AFTER,
         lambda v: F.length(v) > 0, _phone_national),
    Kind("card", r"(?<![0-9A-Za-z_+@])(?=[0-9](?:[ -]?[0-9]){12})(?<![0-9]\.)" + _GROUP + "(?:[ -]" + _GROUP + ")*+", _card_valid, _card, _cards),
)


def replace_kind(text: Column, kind: Kind, key: Column) -> tuple[Column, Column]:
    """(the text with valid values of a kind replaced, how many were)."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    if kind.within:
        done = F.transform(found, lambda v: kind.within(v, key))
        new, count = F.transform(done, lambda d: d["text"]), F.aggregate(done, F.lit(0), lambda s, d: s + d["n"]).cast("long")
    else:
        new = F.transform(found, lambda v: F.when(kind.valid(v), kind.new(v, key)).otherwise(v))
        count = F.size(F.filter(found, lambda v: F.coalesce(kind.valid(v), F.lit(False)))).cast("long")
    pieces = F.flatten(F.zip_with(between, new, lambda gap, v: F.array(gap, F.coalesce(v, F.lit("")))))
    return F.when(F.size(found) > 0, F.array_join(pieces, "")).otherwise(text), count


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with personal data in the text replaced, and n_<kind> counts of what was.

    Values that look like a kind but are not valid stay as they are.  A null
    text becomes an empty one and has none; rows are treated one by one.  A
    column that is named like a count is replaced by it.  An empty table gives
    no rows.  Who knows the key can link and invert pseudonyms; keep it
    outside of the code.
    """
    out = docs.withColumn(text_col, text_of(docs, text_col))
    for kind in kinds:
        text, count = replace_kind(F.col(text_col), kind, F.lit(key))
        # the count is taken before the text changes, in the same projection
        out = out.withColumns({f"n_{kind.name}": count, text_col: text})
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """op6: all documents with pseudonyms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, spark.conf.get("spark.qualis.pseudonym.key", "a key for tests only"))
