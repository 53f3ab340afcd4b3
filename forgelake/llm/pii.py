"""Format-preserving pseudonyms for personal data, in column expressions only.

Card numbers, dates, phone numbers, network addresses and e-mail addresses are found by one
pattern and validated: cards by their check digit, dates by the calendar, addresses by the
range of their parts. A valid value is permuted by a keyed Feistel network inside its own
format, so equal values have equal pseudonyms in all documents and different values have
different ones; the check digit of a card is made anew and a date stays a date. Separators and
letter case stay where they are. What fails its validation stays as it is.

A network alternates between two parts of the value, the left one modulo ``a`` and the right
one modulo ``b``; with ``a * b`` equal to the size of the domain every round, and so the
whole, is a permutation.

Kinds and their domains: ``card`` 13 to 19 digits, all but the last, as one or more neighbouring
groups of a run of digits (longest first, each of a run's cards on its own); ``date`` the days of one
400-year cycle (146097 = 189 * 773) of a date written ``2024-01-31`` or ``31.01.2024`` or
``31/01/2024``; ``phone`` the digits after the country code, with or without marks between; ``ip`` the 2**32 addresses;
``email`` the letters and digits before the @, each turned within its own alphabet by a keyed
draw from the characters before it, which is a permutation too; the provider stays readable.

Defined cases. A null text stays null with no finds, an empty one empty. Very long texts are
worked on whole. Repeated rows are treated alike. Every other column passes
through, under any name but that of the finds, which is replaced. An empty table gives no rows. A
card glued to a letter or with dots between its groups is not taken for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.llm.tables import free_names

ROUNDS = 8
KEY = "0f1e2d3c4b5a69788796a5b4c3d2e1f0"  # for tests and examples; pass a secret one
KINDS = ("email", "date", "ip", "phone", "card")
_PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\d/-]|\.\d)",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "phone": r"(?<![\d+])\+(?:\d{1,3}[ -]?(?:\(\d{2,4}\)|\d{2,4})(?:[ -]?\d{2,4}){1,4}|\d{7,15})(?!\d)",
    # A whole run of digit groups, among which cards are sought. It ends before what may begin
    # a date, an address or an e-mail.
    "card": r"(?<![\dA-Za-z])\d(?:(?![ -]\d{4}-\d{2}-\d{2}(?![\d/-]|\.\d))[\d -]){11,}\d(?![\dA-Za-z])"
    r"(?!(?<=[ -]\d{2})[./]\d{2}[./]\d{4})(?!(?<=[ -]\d{1,3})(?:\.\d{1,3}){3})(?!(?<=[ -]\d{1,20})(?:[._%+-][A-Za-z0-9._%+-]{0,63})?@)",
}
# Country codes, for numbers written without a mark after them.
_CODE = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
PATTERN = "|".join(_PATTERNS[k] for k in KINDS)


def _draw(key: str, tweak: Column, round_no: Column, value: Column, size: Column) -> Column:
    """A keyed number in [0, size)."""
    text = F.concat_ws("|", F.lit(key), tweak, round_no.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint") % size


def feistel(value: Column, a: Column, b: Column, key: str, tweak: Column, rounds: int = ROUNDS) -> Column:
    """Keyed permutation of [0, a * b)."""
    a, b = a.cast("bigint"), b.cast("bigint")
    start = F.struct(F.call_function("div", value, b).alias("l"), (value % b).alias("r"))

    def step(s: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, (s["l"] + _draw(key, tweak, i, s["r"], a)) % a).otherwise(s["l"])
        right = F.when(i % 2 == 1, (s["r"] + _draw(key, tweak, i, s["l"], b)) % b).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step, lambda s: s["l"] * b + s["r"])


def _power(n: Column) -> Column:
    """10 ** n as a whole number, n at most 18."""
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("bigint")


def permuted_digits(digits: Column, key: str, tweak: Column) -> Column:
    """Keyed permutation of the strings of as many digits, at most 18; one digit is turned."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    out = feistel(digits.cast("bigint"), _power(n - half), _power(half), key, F.concat_ws("|", tweak, n.cast("string")))
    return F.lpad(out.cast("string"), n, "0")


def _digit_sum(digits: Column, doubled_parity: int) -> Column:
    """Sum of digits for the check digit, counted from the right; the digits at places of
    this parity are doubled."""
    marks = F.split(F.reverse(digits), "")
    marks = F.filter(marks, lambda c: c != "")

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == doubled_parity, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(marks, value), F.lit(0), lambda a, x: a + x)


def check_digit(body: Column) -> Column:
    """The digit that makes ``body`` a valid card number."""
    return ((10 - _digit_sum(body, 0) % 10) % 10).cast("string")


def _only_digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _refilled(x: Column, digits: Column) -> Column:
    """``x`` with its digits replaced in order."""
    marks = F.filter(F.split(x, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        out = F.concat(s["out"], F.when(digit, F.substr(digits, s["used"] + 1, F.lit(1))).otherwise(c))
        return F.struct(out.alias("out"), (s["used"] + digit.cast("int")).alias("used"))

    return F.aggregate(marks, start, step, lambda s: s["out"])


def _valid_card(digits: Column) -> Column:
    return (_digit_sum(digits, 1) % 10 == 0) & (digits.rlike("[1-9]"))


def _card(x: Column, key: str) -> Column:
    digits = _only_digits(x)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    new = permuted_digits(body, key, F.lit("card"))
    return F.when(_valid_card(digits), _refilled(x, F.concat(new, check_digit(new))))


def _cards(x: Column, key: str) -> Column:
    """A run of digit groups with its cards replaced, and their number. A card is one or
    several neighbouring groups; of those that overlap the longest valid one counts."""
    tokens = F.regexp_extract_all(x, F.lit(r"\d+|[ -]+"), F.lit(0))  # groups at even places
    # As an element's variable the tokens are found once, not anew for each use.
    return F.transform(F.array(tokens), lambda t: _cards_among(t, key))[0]


def _cards_among(tokens: Column, key: str) -> Column:
    last = F.call_function("div", F.size(tokens), F.lit(2)).cast("int")

    def joined(a: Column, n: Column) -> Column:
        return F.array_join(F.slice(tokens, a + 1, n), "")

    def parts(i: Column) -> Column:
        ends = F.sequence(i, F.least(i + 18, last))
        texts = F.transform(ends, lambda j: F.struct(j.alias("j"), joined(i * 2, (j - i) * 2 + 1).alias("old")))
        texts = F.filter(texts, lambda c: c["old"].rlike(r"^\d(?:[ -]?\d){12,18}$"))
        texts = F.filter(texts, lambda c: _valid_card(_only_digits(c["old"])))
        return F.transform(texts, lambda c: F.struct((-F.length(_only_digits(c["old"]))).alias("n"), i.alias("i"), c["j"].alias("j")))

    ranked = F.array_sort(F.flatten(F.transform(F.sequence(F.lit(0), last), parts)))
    none = F.array().cast("array<struct<n:int,i:int,j:int>>")
    apart = lambda c, d: (c["j"] < d["i"]) | (d["j"] < c["i"])
    chosen = F.aggregate(ranked, none, lambda s, c: F.when(F.forall(s, lambda d: apart(c, d)), F.concat(s, F.array(c))).otherwise(s))
    placed = F.array_sort(F.transform(chosen, lambda c: F.struct(c["i"].alias("i"), c["j"].alias("j"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("next"), F.lit(0).alias("n"))

    def step(s: Column, c: Column) -> Column:
        before = joined(s["next"], c["i"] * 2 - s["next"])
        new = _card(joined(c["i"] * 2, (c["j"] - c["i"]) * 2 + 1), key)
        return F.struct(F.concat(s["out"], before, new).alias("out"), (c["j"] * 2 + 1).alias("next"), (s["n"] + 1).alias("n"))

    def finish(s: Column) -> Column:
        whole = F.concat(s["out"], joined(s["next"], F.size(tokens) - s["next"]))
        return F.struct(F.when(s["n"] > 0, whole).alias("new"), s["n"].alias("n"))

    return F.aggregate(placed, start, step, finish)


def _date(x: Column, key: str) -> Column:
    iso = x.rlike("^[0-9]{4}-")
    mark = F.substr(x, F.lit(3), F.lit(1))
    day = F.coalesce(
        F.when(iso, F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).cast("date")),
        F.when(~iso, F.try_to_timestamp(F.translate(x, "/", "."), F.lit("dd.MM.yyyy")).cast("date")),
    )
    days = F.datediff(day, F.lit("2000-01-01").cast("date")).cast("bigint")
    cycle = F.floor(days.cast("decimal(20,0)") / 146097).cast("bigint")
    new = feistel(days - cycle * 146097, F.lit(189), F.lit(773), key, F.concat_ws("|", F.lit("date"), cycle.cast("string")))
    moved = F.date_add(F.lit("2000-01-01").cast("date"), (new + cycle * 146097).cast("int"))
    dotted = F.concat_ws(
        "", F.date_format(moved, "dd"), mark, F.date_format(moved, "MM"), mark, F.date_format(moved, "yyyy")
    )
    same_marks = iso | (mark == F.substr(x, F.lit(6), F.lit(1)))
    within = F.year(day).between(1600, 9599)  # whole cycles of four-digit years
    return F.when(day.isNotNull() & same_marks & within, F.when(iso, F.date_format(moved, "yyyy-MM-dd")).otherwise(dotted))


def _ip(x: Column, key: str) -> Column:
    parts = F.transform(F.split(x, r"\."), lambda p: p.cast("int"))
    whole = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a * 256 + p)
    new = feistel(whole, F.lit(65536), F.lit(65536), key, F.lit("ip"))
    octets = [F.shiftright(new, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    plain = ~x.rlike(r"(^|\.)0[0-9]")
    return F.when(plain & F.forall(parts, lambda p: p <= 255), F.concat_ws(".", *octets))


def _phone(x: Column, key: str) -> Column:
    digits = _only_digits(x)
    lead = F.length(F.regexp_extract(x, r"^\+(\d+)", 1))
    lead = F.when(lead > 3, F.length(F.regexp_extract(x, _CODE, 1))).otherwise(lead)
    rest = F.substr(digits, lead + 1, F.length(digits) - lead)
    code = F.substr(digits, F.lit(1), lead)
    valid = F.length(digits).between(7, 15) & (F.length(rest) >= 4)
    return F.when(valid, _refilled(x, F.concat(code, permuted_digits(rest, key, F.concat(F.lit("phone|"), code)))))


def _email(x: Column, key: str) -> Column:
    """Letters stay letters and digits digits. The local part is turned character by
    character; each turn is drawn from the provider, the place and the characters before it,
    so that the whole is a permutation of the local parts of its shape."""
    local, domain = F.substring_index(x, "@", 1), F.substring_index(x, "@", -1)
    marks = F.filter(F.split(local, ""), lambda c: c != "")
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def step(s: Column, c: Column) -> Column:
        n = F.length(s["old"])
        turned = c
        for alphabet in (lower, upper, digits):
            shift = _draw(key, F.concat(F.lit("email|"), F.lower(domain)), n, s["old"], F.lit(len(alphabet)))
            place = (F.instr(F.lit(alphabet), c) - 1 + shift) % len(alphabet)
            turned = F.when(F.instr(F.lit(alphabet), c) > 0, F.substr(F.lit(alphabet), (place + 1).cast("int"), F.lit(1))).otherwise(turned)
        return F.struct(F.concat(s["old"], c).alias("old"), F.concat(s["new"], turned).alias("new"))

    start = F.struct(F.lit("").alias("old"), F.lit("").alias("new"))
    return F.concat(F.aggregate(marks, start, step, lambda s: s["new"]), F.lit("@"), domain)


def kind_of(x: Column) -> Column:
    """Kind of a match by its form; the forms exclude each other."""
    return (
        F.when(F.contains(x, F.lit("@")), F.lit("email"))
        .when(x.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})$"), F.lit("date"))
        .when(x.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.lit("ip"))
        .when(x.startswith("+"), F.lit("phone"))
        .otherwise(F.lit("card"))
    )


def pseudonym(x: Column, kind: Column, key: str) -> Column:
    """The match with its values replaced (``new``), null if none is valid, and their number
    (``n``); only a run of digit groups may hold several."""
    one = (
        F.when(kind == "email", _email(x, key))
        .when(kind == "date", _date(x, key))
        .when(kind == "ip", _ip(x, key))
        .when(kind == "phone", _phone(x, key))
    )
    return F.when(kind == "card", _cards(x, key)).otherwise(F.struct(one.alias("new"), F.lit(1).alias("n")))


def pseudonymise(docs: DataFrame, key: str = KEY, text_col: str = "text", found_col: str = "pii_found") -> DataFrame:
    """``docs`` with pseudonyms in the text and ``found_col``: the kinds of the values
    replaced, in their order."""
    text = F.col(text_col)
    matched, made = free_names(docs.columns, "matched", "made")
    matches = F.transform(
        F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)),
        lambda m: F.struct(m.alias("old"), kind_of(m).alias("kind")),
    )
    named = F.transform(
        F.col(matched),
        lambda m: F.struct(m["old"].alias("old"), m["kind"].alias("kind"), pseudonym(m["old"], m["kind"], key).alias("made")),
    )
    between = F.split(text, PATTERN, -1)
    ends = F.concat(F.transform(F.col(made), lambda m: F.coalesce(m["made"]["new"], m["old"])), F.array(F.lit("")))
    joined = F.array_join(F.flatten(F.transform(F.arrays_zip(between.alias("gap"), ends.alias("value")), lambda p: F.array(p["gap"], p["value"]))), "")
    replaced = F.filter(F.col(made), lambda m: m["made"]["new"].isNotNull())
    found = F.flatten(F.transform(replaced, lambda m: F.array_repeat(m["kind"], m["made"]["n"])))
    columns = [c for c in docs.columns if c != found_col]
    named_rows = docs.select(*columns).withColumn(matched, matches).withColumn(made, named)
    new_text = F.when(F.size(matched) > 0, joined).otherwise(text)
    return named_rows.select(
        *[new_text.alias(c) if c == text_col else F.col(c) for c in columns],
        F.coalesce(found, F.array().cast("array<string>")).alias(found_col),
    )
