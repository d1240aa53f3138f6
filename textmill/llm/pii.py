"""Format-preserving pseudonyms for personal data by keyed Feistel networks, in column expressions only.

Found and validated: card numbers (Luhn), IBANs (modulo 97), US social security numbers, US and international phone numbers, IPv4
addresses, dates from 1900 to 2099, e-mail addresses, and secrets named as such. Each value is permuted within the values of its own
format: a card keeps its first digit and passes Luhn again, an address keeps octets below 256, a date stays a date, an IBAN keeps its country and gets
new check digits, an e-mail address keeps its domain, and digits, letters and punctuation stay in place. The permutation depends on
the key and the value only, so equal values stay linked across documents, and the holder of the key can reverse it with `restored`.

Numbers that fail their validation are left alone, and so is every other character.

Cases: a null text stays null with no values; an empty text stays empty; equal rows give equal rows; an empty table gives an empty result;
`pseudonymised` keeps other columns as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.expressions import let

KEY = "textmill-pseudonyms-1"
ROUNDS = 8
DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
UPPER_HEX = HEX.upper()

# The patterns of the formats.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?<=(?i:token|key|secret|password)[\"']?[ ]{0,2}[=:][ ]{0,2}[\"']?)(?:[0-9a-f]{16,}|[0-9A-F]{16,})(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{13,19})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.](?:19|20)[0-9]{2})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])",
    "abroad": r"(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}(?![0-9])",
}
ANY = "|".join(FORMATS.values())


def _prf(key: str, kind: str, turn: Column, value: Column, bits: int = 512) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), bits)


def _turns(back: bool) -> Column:
    return F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if back else range(ROUNDS))])


def feistel_pair(left: Column, right: Column, a: int, b: int, kind: str, key: str, back: bool) -> Column:
    """A keyed permutation of the pairs in [0, a) x [0, b): the halves are moved in turn by a function of the other."""
    sign = -1 if back else 1

    def turn(pair: Column, i: Column) -> Column:
        held, moved = F.when(i % 2 == 0, pair["r"]).otherwise(pair["l"]), F.when(i % 2 == 0, pair["l"]).otherwise(pair["r"])
        size = F.when(i % 2 == 0, F.lit(a)).otherwise(F.lit(b)).cast("long")
        step = F.conv(F.substring(_prf(key, kind, i, held, 256), 1, 12), 16, 10).cast("long")
        now = F.pmod(moved + sign * (step % size), size)
        return F.struct(
            F.when(i % 2 == 0, now).otherwise(pair["l"]).alias("l"), F.when(i % 2 == 0, pair["r"]).otherwise(now).alias("r")
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(_turns(back), start, turn)


def _moved(text: Column, stream: Column, alphabets: tuple[str, ...], sign: int) -> Column:
    """Every character moved within its alphabet by a byte of the stream."""

    def char(p: Column) -> Column:
        c = F.substr(text, p, F.lit(1))
        step = F.conv(F.substr(stream, (p - 1) % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for alphabet in alphabets:
            place = F.instr(F.lit(alphabet), c)
            to = F.pmod(place - 1 + sign * step, F.lit(len(alphabet))) + 1
            out = F.when(place > 0, F.substr(F.lit(alphabet), to, F.lit(1))).otherwise(out)
        return out

    places = F.filter(F.sequence(F.lit(0), F.length(text)), lambda p: p > 0)
    return F.array_join(F.transform(places, char), "")


def feistel_text(text: Column, alphabets: tuple[str, ...], kind: str, key: str, back: bool) -> Column:
    """A keyed permutation of the texts with the same kinds of characters at the same places."""
    half = F.floor(F.length(text) / 2).cast("int")
    pair = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r"))

    def turn(p: Column, i: Column) -> Column:
        if back:
            moved = _moved(p["r"], _prf(key, kind, i, p["l"]), alphabets, -1)
            return F.struct(moved.alias("l"), p["l"].alias("r"))
        return F.struct(p["r"].alias("l"), _moved(p["l"], _prf(key, kind, i, p["r"]), alphabets, 1).alias("r"))

    return let(F.aggregate(_turns(back), pair, turn), lambda p: F.concat(p["l"], p["r"]))


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _refilled(value: Column, digits: Column) -> Column:
    """The digits of a value replaced in order, everything else in place."""

    def char(p: Column) -> Column:
        c = F.substr(value, p, F.lit(1))
        before = F.length(F.regexp_replace(F.substr(value, F.lit(1), p), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substr(digits, before, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    size = F.length(digits)

    def term(p: Column) -> Column:
        d = F.substr(digits, p, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((size - p) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), size), term), F.lit(0), lambda s, x: s + x) % 10


def iban_rest(moved: Column) -> Column:
    """The remainder modulo 97 of an IBAN whose first four characters stand at the end."""

    def add(rest: Column, p: Column) -> Column:
        c = F.substr(moved, p, F.lit(1))
        letter = F.instr(F.lit(UPPER), c)
        return F.when(letter > 0, (rest * 100 + letter + 9) % 97).otherwise((rest * 10 + c.cast("int")) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def _card(value: Column, key: str, back: bool) -> Column:
    def body(digits: Column) -> Column:
        size = F.length(digits)
        inner = feistel_text(F.substr(digits, F.lit(2), size - 2), (DIGITS,), "card", key, back)
        payload = F.concat(F.substr(digits, F.lit(1), F.lit(1)), inner)
        checked = let(payload, lambda p: F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(luhn_sum(digits) == 0, _refilled(value, checked)).otherwise(value)

    return let(_digits(value), body)


def _iban(value: Column, key: str, back: bool) -> Column:
    country, body = F.substr(value, F.lit(1), F.lit(2)), F.substr(value, F.lit(5), F.length(value))
    moved = feistel_text(body, (DIGITS, UPPER), "iban", key, back)
    checked = let(
        moved, lambda b: F.concat(country, _padded(98 - iban_rest(F.concat(b, country, F.lit("00"))), 2), b)
    )
    valid = iban_rest(F.concat(body, F.substr(value, F.lit(1), F.lit(4)))) == 1
    return F.when(valid, checked).otherwise(value)


def _ssn(value: Column, key: str, back: bool) -> Column:
    area, group, serial = (F.substr(value, F.lit(s), F.lit(n)).cast("int") for s, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    left, right = F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * 9999 + serial - 1

    def out(p: Column) -> Column:
        area = F.when(p["l"] >= 665, p["l"] + 2).otherwise(p["l"] + 1)
        group, serial = F.floor(p["r"] / 9999) + 1, p["r"] % 9999 + 1
        return F.concat_ws("-", _padded(area, 3), _padded(group, 2), _padded(serial, 4))

    return F.when(valid, let(feistel_pair(left, right, 898, 99 * 9999, "ssn", key, back), out)).otherwise(value)


def _phone(value: Column, key: str, back: bool) -> Column:
    def body(digits: Column) -> Column:
        national = F.right(digits, F.lit(10))
        left = F.substr(national, F.lit(1), F.lit(3)).cast("int") - 200
        right = F.substr(national, F.lit(4), F.lit(7)).cast("int") - 2_000_000
        pair = feistel_pair(left, right, 800, 8_000_000, "phone", key, back)
        fresh = let(pair, lambda p: F.concat((p["l"] + 200).cast("string"), (p["r"] + 2_000_000).cast("string")))
        return _refilled(value, F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), fresh))

    return let(_digits(value), body)


def _abroad(value: Column, key: str, back: bool) -> Column:
    """The country code, up to three digits, stays."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}", 0)
    rest = F.substr(value, F.length(code) + 1, F.length(value))
    return F.concat(code, let(_digits(rest), lambda d: _refilled(rest, feistel_text(d, (DIGITS,), "abroad", key, back))))


def _ip(value: Column, key: str, back: bool) -> Column:
    def body(parts: Column) -> Column:
        octet = [F.get(parts, F.lit(i)).cast("long") for i in range(4)]
        pair = feistel_pair(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 65536, 65536, "ip", key, back)
        return let(
            pair,
            lambda p: F.concat_ws(
                ".", *[x.cast("string") for h in ("l", "r") for x in (F.floor(p[h] / 256), p[h] % 256)]
            ),
        )

    return let(F.split(value, r"\."), body)


def _date(value: Column, key: str, back: bool) -> Column:
    """Year and day of the year are permuted; the 29th of February moves among leap years, and day-first dates by years."""
    iso, dotted = value.rlike("^[0-9]{4}-"), value.contains(".")
    first, second = F.substr(value, F.lit(1), F.lit(2)).cast("int"), F.substr(value, F.lit(4), F.lit(2)).cast("int")
    day_first = dotted | (first > 12)
    year = F.when(iso, F.substr(value, F.lit(1), F.lit(4))).otherwise(F.right(value, F.lit(4))).cast("int")
    month = F.when(iso, F.substr(value, F.lit(6), F.lit(2)).cast("int")).when(day_first, second).otherwise(first)
    day = F.when(iso, F.right(value, F.lit(2)).cast("int")).when(day_first, first).otherwise(second)

    def written(d: Column) -> Column:
        form = lambda f: F.date_format(d, f)
        slashed = F.when(first > 12, form("dd/MM/yyyy")).otherwise(form("MM/dd/yyyy"))
        return F.when(iso, form("yyyy-MM-dd")).when(dotted, form("dd.MM.yyyy")).otherwise(slashed)

    def body(d: Column) -> Column:
        leap_day = (F.month(d) == 2) & (F.dayofmonth(d) == 29)
        leaps = 4 * feistel_pair((year - 1904) / 4, F.lit(0), 49, 1, "leap", key, back)["l"] + 1904
        days = F.dayofyear(F.make_date(F.lit(2001), month, F.when(leap_day, F.lit(28)).otherwise(day)))
        plain = let(
            feistel_pair(year - 1900, days - 1, 200, 365, "date", key, back),
            lambda p: let(
                F.date_add(F.lit("2001-01-01").cast("date"), p["r"].cast("int")),
                lambda x: F.make_date((p["l"] + 1900).cast("int"), F.month(x), F.dayofmonth(x)),
            ),
        )
        step = F.conv(F.substring(_prf(key, "year", month, day, 256), 1, 12), 16, 10).cast("long") % 200
        years = F.pmod(year - 1900 + (-1 if back else 1) * step, F.lit(200)) + 1900
        kept = F.coalesce(F.try_to_date(F.concat_ws("-", years, _padded(month, 2), _padded(day, 2))), d)
        swapped = ~iso & ~dotted & (first > 12)
        fresh = F.when(leap_day, F.make_date(leaps.cast("int"), F.lit(2), F.lit(29))).when(swapped, kept).otherwise(plain)
        return written(fresh)

    valid = F.try_to_date(F.concat_ws("-", year, _padded(month, 2), _padded(day, 2)), "yyyy-MM-dd")
    return F.when(valid.isNotNull(), let(valid, body)).otherwise(value)


def _email(value: Column, key: str, back: bool) -> Column:
    local = F.substring_index(value, "@", 1)
    return F.concat(
        feistel_text(local, (DIGITS, LOWER, UPPER), "email", key, back), F.substr(value, F.length(local) + 1, F.length(value))
    )


MAKERS: dict[str, Callable[[Column, str, bool], Column]] = {
    "email": _email,
    "ip": _ip,
    "iban": _iban,
    "card": _card,
    "ssn": _ssn,
    "date": _date,
    "phone": _phone,
    "abroad": _abroad,
}
SHAPES = {k: "^(?:" + FORMATS[k] + r")\z" for k in MAKERS}


def pseudonym(value: Column, key: str = KEY, back: bool = False) -> Column:
    """The pseudonym of one found value; a value that is not valid stays."""
    upper = feistel_text(value, (UPPER_HEX,), "secret", key, back)
    out = F.when(value.rlike("[A-F]"), upper).otherwise(feistel_text(value, (HEX,), "secret", key, back))
    for kind in reversed(MAKERS):
        out = F.when(value.rlike(SHAPES[kind]), MAKERS[kind](value, key, back)).otherwise(out)
    return out


def _pieces(text: Column, key: str, back: bool) -> Column:
    """(text, values): the text with its values replaced, and how many were."""
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    fresh = F.transform(found, lambda v: F.struct(v.alias("old"), pseudonym(v, key, back).alias("new")))

    def body(pairs: Column) -> Column:
        gaps = F.split(text, ANY, -1)
        filled = F.zip_with(gaps, pairs, lambda gap, pair: F.concat(gap, F.coalesce(pair["new"], F.lit(""))))
        changed = F.size(F.filter(pairs, lambda p: p["old"] != p["new"])).cast("long")
        return F.struct(F.array_join(filled, "").alias("text"), changed.alias("values"))

    return let(fresh, body)


def pseudonymised(docs: DataFrame, key: str = KEY, count: str | None = "n_values", back: bool = False) -> DataFrame:
    """The rows with pseudonyms in their texts and, in the column `count`, the number of values replaced. Nothing is shuffled."""
    text = F.col("text")
    plain = F.struct(text.alias("text"), F.lit(0).cast("long").alias("values"))
    made = F.when(text.rlike("[0-9@]|(?i:token|key|secret|password)") & text.rlike(ANY), _pieces(text, key, back)).otherwise(plain)
    names = [c for c in docs.columns if c != count]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), made.alias("made"))
    columns = [F.col("made.text").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in names]
    return rows.select(*columns, *([F.col("made.values").alias(count)] if count else []))


def restored(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The rows before `pseudonymised` with the same key."""
    return pseudonymised(docs, key, None, back=True)
