"""Personal data replaced by format-preserving pseudonyms.

Validated numbers, dates, addresses of mail and network, and credentials are permuted within their
own format by a keyed Feistel network: a value becomes a rank in a domain of a x b values, and in
alternating rounds either part is shifted by a keyed hash of the other. That is a permutation, so
equal values stay equal across documents, different values stay different, and who holds the key
can go back (:func:`reveal`). Everything is an expression of built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.llm.staging import boxed, with_new_text

DEFAULT_KEY = "set-a-key-of-your-own"
ROUNDS = 10

# The formats that are found, as regular expressions. All of them end at a place
# where no letter, digit or sign of the same kind follows.
CARD = (
    r"(?<![\d.-])(?:\d{13,19}|(?:\d{4} ){3}\d{4}|(?:\d{4}-){3}\d{4}|\d{4} \d{6} \d{5}"
    r"|\d{4}-\d{6}-\d{5})(?!\d|[.-]\d)"
)
PHONE = (
    r"(?<![\w+])(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?![\d-])"
)
WORLD_PHONE = r"(?<![\w+])\+[1-9]\d{0,2}(?:[ .-]\(?\d{1,5}\)?){2,5}(?![\d-])"
IPV4 = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
#: How long the IBANs of a country are; other countries may have any length.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _iban_pattern() -> str:
    kinds = []
    for size, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(size - 4, 4)
        end = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        kinds.append(
            f"(?:{countries.replace(' ', '|')})\\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{end}"
        )
    known = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    kinds.append(rf"(?!{known})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?")
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(kinds)})(?![A-Za-z0-9])"


IBAN = _iban_pattern()
DATE = (
    r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})"
    r"(?![\d]|[./-]\d)"
)
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
PASSWORD = r"(?i:\b(?:password|passwd|pwd)\s{0,2}[=:]\s{0,2})[^\s\"']+"
#: In this order: at one place the first kind that matches is taken.
KINDS = {
    "email": EMAIL,
    "password": PASSWORD,
    "access_key": ACCESS_KEY,
    "iban": IBAN,
    "ip": IPV4,
    "date": DATE,
    "ssn": SSN,
    "phone": PHONE,
    "world_phone": WORLD_PHONE,
    "card": CARD,
}
ANY = "|".join(KINDS.values())
#: Whatever matches ANY matches this as well, which is far cheaper to look for.
TRIGGER = r"[0-9@]|AKIA|[Pp][Aa][Ss][Ss][Ww]|[Pp][Ww][Dd]"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: 400 Gregorian years have so many days, 27 x 5411.
CYCLE_DAYS = 146_097
#: A walk that finds no fitting day within so many steps has probability 0.4 ** 64.
WALK = 64


@dataclass(frozen=True)
class Feistel:
    """A keyed permutation of the numbers below a x b."""

    key: str
    label: str
    a: Column | int
    b: Column | int

    def _shift(self, turn: Column, part: Column, size: Column) -> Column:
        text = F.concat_ws("|", F.lit(self.key), F.lit(self.label), turn, part)
        # 56 bits of the hash: positive, and far above any size, so that the rest is near uniform.
        return F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("long") % size

    def apply(self, rank: Column, back: bool = False) -> Column:
        a, b = (x if isinstance(x, Column) else F.lit(x) for x in (self.a, self.b))
        whole = F.struct(
            a.cast("long").alias("a"), b.cast("long").alias("b"), rank.cast("long").alias("rank")
        )
        turns = F.array(*[F.lit(t) for t in (range(ROUNDS)[::-1] if back else range(ROUNDS))])
        sign = -1 if back else 1

        def run(x: Column) -> Column:
            def step(state: Column, turn: Column) -> Column:
                even = turn % 2 == 0
                own = F.when(even, state["l"]).otherwise(state["r"])
                other = F.when(even, state["r"]).otherwise(state["l"])
                size = F.when(even, x["a"]).otherwise(x["b"])
                moved = F.pmod(own + sign * self._shift(turn, other, size), size)
                return F.struct(
                    F.when(even, moved).otherwise(state["l"]).alias("l"),
                    F.when(even, state["r"]).otherwise(moved).alias("r"),
                )

            start = F.struct(
                _div(x["rank"], x["b"]).alias("l"), (x["rank"] % x["b"]).alias("r")
            )
            return F.aggregate(turns, start, step, lambda s: s["l"] * x["b"] + s["r"])

        return _let(whole, run)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _div(a: Column, b: Column | int) -> Column:
    """Whole division, exact beyond the whole numbers of a double."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def _number(digits: Column) -> Column:
    return digits.cast("long")


def _only(text: Column, what: str) -> Column:
    return F.regexp_replace(text, f"[^{what}]", "")


def _at(text: Column, position: Column) -> Column:
    return F.substring(text, position, 1)


def _refill(text: Column, fresh: Column, kinds: str) -> Column:
    """``text`` with its characters of ``kinds`` replaced one after another by those of ``fresh``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def step(state: Column, c: Column) -> Column:
        hit = c.rlike(f"[{kinds}]")
        return F.struct(
            F.concat(state["out"], F.when(hit, _at(fresh, state["next"])).otherwise(c)).alias("out"),
            (state["next"] + hit.cast("int")).alias("next"),
        )

    return F.aggregate(_chars(text), start, step, lambda s: s["out"])


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def luhn_sum(digits: Column) -> Column:
    """The weighted digit sum of a number without its check digit."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        d = _at(digits, F.length(digits) - i + 1).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda s, x: s + x)


def _check_digit(payload: Column) -> Column:
    return ((F.lit(10) - luhn_sum(payload) % 10) % 10).cast("string")


def is_card(value: Column) -> Column:
    """13 to 19 digits that are not all the same and end in their Luhn digit."""
    return _let(
        _only(value, "0-9"),
        lambda digits: F.length(digits).between(13, 19)
        & (
            _check_digit(F.substring(digits, F.lit(1), F.length(digits) - 1))
            == _at(digits, F.length(digits))
        )
        & ~digits.rlike(r"^(\d)\1+$"),
    )


def _card(value: Column, key: str, back: bool) -> Column:
    """All digits but the last are permuted, and the check digit is set anew."""
    def change(digits: Column) -> Column:
        size = F.length(digits) - 1
        payload = F.substring(digits, F.lit(1), size)
        low = _div(size, 2).cast("int")
        b, a = _power(low), _power(size - low)
        return _padded(Feistel(key, "card", a, b).apply(_number(payload), back), size)

    fresh = _let(_only(value, "0-9"), change)
    return _let(fresh, lambda f: _refill(value, F.concat(f, _check_digit(f)), "0-9"))


def _power(n: Column) -> Column:
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def _padded(number: Column, size: Column | int) -> Column:
    size = size if isinstance(size, Column) else F.lit(size)
    return F.lpad(number.cast("string"), size, F.lit("0"))


def _phone(value: Column, key: str, back: bool) -> Column:
    """Area, exchange and line are permuted among valid ones; a leading 1 stays."""
    digits = _only(value, "0-9")
    country = F.when(F.length(digits) == 11, F.lit("1")).otherwise(F.lit(""))
    own = F.right(digits, F.lit(10))
    area, exchange = F.substring(own, 1, 3).cast("long"), F.substring(own, 4, 3).cast("long")
    rank = ((area - 200) * 800 + exchange - 200) * 10_000 + F.substring(own, 7, 4).cast("long")

    def written(fresh: Column) -> Column:
        new_area = _div(fresh, 8_000_000) + 200
        new_exchange = _div(fresh, 10_000) % 800 + 200
        return F.concat(country, new_area, new_exchange, _padded(fresh % 10_000, 4))

    numbers = _let(Feistel(key, "phone", 80_000, 80_000).apply(rank, back), written)
    return _let(numbers, lambda n: _refill(value, n, "0-9"))


def _world_phone(value: Column, key: str, back: bool) -> Column:
    """The country code stays, the other digits are permuted.

    After +1 come only numbers that PHONE does not take, since their area or exchange starts with 0
    or 1; those first digits stay, so that the pseudonym is no PHONE either.
    """
    code = F.regexp_extract(value, r"^(\+\d+)", 1)
    rest = F.substring(value, F.length(code) + 1, F.length(value))

    def fresh(digits: Column) -> Column:
        ten = (code == "+1") & (F.length(digits) == 10)
        free = F.when(
            ten, F.concat(F.substring(digits, 2, 2), F.substring(digits, 5, 6))
        ).otherwise(digits)
        return _let(
            _characters(free, key, "world", back),
            lambda f: F.when(
                ten,
                F.concat(
                    _at(digits, F.lit(1)),
                    F.substring(f, 1, 2),
                    _at(digits, F.lit(4)),
                    F.substring(f, 3, 6),
                ),
            ).otherwise(f),
        )

    numbers = _let(_only(rest, "0-9"), fresh)
    return F.concat(code, _let(numbers, lambda n: _refill(rest, n, "0-9")))


def is_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: (p.cast("int") <= 255) & ~p.rlike("^0."))


def _ip(value: Column, key: str, back: bool) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    rank = F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s * 256 + p)
    return _let(
        Feistel(key, "ip", 65_536, 65_536).apply(rank, back),
        lambda fresh: F.concat_ws(".", *[_div(fresh, 256**i) % 256 for i in (3, 2, 1, 0)]),
    )


def is_ssn(value: Column) -> Column:
    return value.rlike(r"^(?!000|666|9\d\d)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$")


def _ssn(value: Column, key: str, back: bool) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area = F.substring(value, 1, 3).cast("long")
    area = area - 1 - (area > 666).cast("long")
    group, serial = F.substring(value, 5, 2).cast("long"), F.substring(value, 8, 4).cast("long")
    rank = (area * 99 + group - 1) * 9_999 + serial - 1

    def written(fresh: Column) -> Column:
        first = _div(fresh, 99 * 9_999) + 1
        first = first + (first >= 666).cast("long")
        middle = _div(fresh, 9_999) % 99 + 1
        return F.concat_ws(
            "-", _padded(first, 3), _padded(middle, 2), _padded(fresh % 9_999 + 1, 4)
        )

    return _let(Feistel(key, "ssn", 898 * 99, 9_999).apply(rank, back), written)


def _mod_97(text: Column) -> Column:
    """The rest by 97 of a text of digits and capitals, capitals being 10 to 35."""

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise(
            (rest * 100 + code - 55) % 97
        )

    return F.aggregate(_chars(text), F.lit(0), step)


def is_iban(value: Column) -> Column:
    plain = F.translate(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    return F.length(plain).between(15, 34) & (_mod_97(turned) == 1)


def _iban(value: Column, key: str, back: bool) -> Column:
    """The account is permuted, digits among digits and letters among letters; the check digits
    are set anew and the country stays."""
    plain = F.translate(value, " ", "")
    country, account = F.substring(plain, 1, 2), F.substring(plain, 5, 40)

    def written(fresh: Column) -> Column:
        check = 98 - _mod_97(F.concat(fresh, country, F.lit("00")))
        return F.concat(country, _padded(check, 2), fresh)

    numbers = _let(_characters(account, key, "iban", back), written)
    return _let(numbers, lambda n: _refill(value, n, "A-Z0-9"))


def _characters(text: Column, key: str, label: str, back: bool) -> Column:
    """A text of any length with its letters and digits permuted, each within its own class.

    The text is halved; in alternating rounds the characters of one half are shifted by a keyed
    hash of the other half and of their place.
    """
    half = _div(F.length(text), 2).cast("int")
    turns = F.array(*[F.lit(t) for t in (range(ROUNDS)[::-1] if back else range(ROUNDS))])
    start = F.struct(
        F.substring(text, F.lit(1), half).alias("l"),
        F.substring(text, half + 1, F.length(text)).alias("r"),
    )
    sign = -1 if back else 1

    def shifted(part: Column, other: Column, turn: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            seed = F.concat_ws("|", F.lit(key), F.lit(label), turn, i, other)
            shift = F.conv(F.substring(F.sha2(seed, 256), 1, 12), 16, 10).cast("long")
            alphabet = (
                F.when(c.between("a", "z"), F.lit(LOWER))
                .when(c.between("A", "Z"), F.lit(UPPER))
                .when(c.between("0", "9"), F.lit(DIGITS))
                .otherwise(c)
            )
            return _let(
                alphabet,
                lambda x: _at(
                    x, F.pmod(F.instr(x, c) - 1 + sign * shift, F.length(x)).cast("int") + 1
                ),
            )

        return F.array_join(F.transform(_chars(part), one), "")

    def step(state: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        part = F.when(even, state["l"]).otherwise(state["r"])
        other = F.when(even, state["r"]).otherwise(state["l"])
        return _let(
            shifted(part, other, turn),
            lambda new: F.struct(
                F.when(even, new).otherwise(state["l"]).alias("l"),
                F.when(even, state["r"]).otherwise(new).alias("r"),
            ),
        )

    return F.aggregate(turns, start, step, lambda s: F.concat(s["l"], s["r"]))


def _email(value: Column, key: str, back: bool) -> Column:
    """The local part is permuted with the domain as part of the label; the domain stays."""
    domain = F.substring_index(value, "@", -1)
    local = F.substring_index(value, "@", 1)
    return F.concat(_characters(local, key, "email", back), F.lit("@"), domain)


def _password(value: Column, key: str, back: bool) -> Column:
    name = F.regexp_extract(value, r"^((?i)[a-z]+\s*[=:]\s*)", 1)
    secret = F.substring(value, F.length(name) + 1, F.length(value))
    return F.concat(name, _characters(secret, key, "password", back))


def _access_key(value: Column, key: str, back: bool) -> Column:
    return F.concat(F.lit("AKIA"), _characters(F.substring(value, 5, 16), key, "access", back))


def _date_parts(value: Column) -> tuple[Column, Column]:
    """The day of a written date, or null, and the pattern it is written by."""
    pattern = (
        F.when(value.rlike(r"^\d{4}-"), F.lit("yyyy-MM-dd"))
        .when(value.rlike(r"^\d{4}/"), F.lit("yyyy/MM/dd"))
        .when(value.rlike(r"^\d{2}\."), F.lit("dd.MM.yyyy"))
        .when(F.substring(value, 1, 2).cast("int") > 12, F.lit("dd/MM/yyyy"))
        .otherwise(F.lit("MM/dd/yyyy"))
    )
    digits = F.when(
        value.rlike(r"^\d{4}"), F.translate(value, "-/", "")
    ).otherwise(
        F.concat(
            F.substring(value, 7, 4),
            F.when(pattern == "MM/dd/yyyy", F.substring(value, 1, 2)).otherwise(F.substring(value, 4, 2)),
            F.when(pattern == "MM/dd/yyyy", F.substring(value, 4, 2)).otherwise(F.substring(value, 1, 2)),
        )
    )
    day = F.try_to_date(digits, "yyyyMMdd")
    return F.when(F.year(day).between(1600, 2399), day), pattern


def is_date(value: Column) -> Column:
    return _date_parts(value)[0].isNotNull()


def _date(value: Column, key: str, back: bool) -> Column:
    """A day of 1600 to 2399 becomes another day of the same 400 years, which repeat as a cycle.

    A slashed date is read as month/day unless that is no date. As the pseudonym has to be read the
    same way, day/month dates keep to days after the 12th by walking the cycle until one comes.
    """
    walk = Feistel(key, "date", 27, 5_411)

    def moved(x: Column) -> Column:
        base = F.when(F.year(x["day"]) < 2000, F.lit("1600-01-01")).otherwise(F.lit("2000-01-01"))

        def within(base: Column) -> Column:
            def step(state: Column, _: Column) -> Column:
                day_first = x["pattern"] == "dd/MM/yyyy"
                again = day_first & (F.dayofmonth(F.date_add(base, state)) <= 12)
                return F.when(again, walk.apply(state, back).cast("int")).otherwise(state)

            start = walk.apply(F.datediff(x["day"], base), back).cast("int")
            days = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, step)
            return F.struct(F.date_add(base, days).alias("day"), x["pattern"].alias("pattern"))

        return _let(base.cast("date"), within)

    day, pattern = _date_parts(value)
    return _let(
        _let(F.struct(day.alias("day"), pattern.alias("pattern")), moved),
        lambda x: _written_date(x["day"], x["pattern"]),
    )


def _written_date(day: Column, pattern: Column) -> Column:
    year, month, dom = (F.date_format(day, p) for p in ("yyyy", "MM", "dd"))
    return (
        F.when(pattern == "yyyy-MM-dd", F.concat_ws("-", year, month, dom))
        .when(pattern == "yyyy/MM/dd", F.concat_ws("/", year, month, dom))
        .when(pattern == "dd.MM.yyyy", F.concat_ws(".", dom, month, year))
        .when(pattern == "dd/MM/yyyy", F.concat_ws("/", dom, month, year))
        .otherwise(F.concat_ws("/", month, dom, year))
    )


_VALID = {"iban": is_iban, "ip": is_ip, "date": is_date, "ssn": is_ssn, "card": is_card}
_CHANGE = {
    "email": _email,
    "password": _password,
    "access_key": _access_key,
    "iban": _iban,
    "ip": _ip,
    "date": _date,
    "ssn": _ssn,
    "phone": _phone,
    "world_phone": _world_phone,
    "card": _card,
}


def kind_of(value: Column) -> Column:
    """The first kind whose whole pattern and validation the value meets, or null."""
    result = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        fits = value.rlike(f"^(?:{KINDS[kind]})$")
        if kind in _VALID:
            fits = F.when(fits, _VALID[kind](value)).otherwise(F.lit(False))
        result = F.when(fits, F.lit(kind)).otherwise(result)
    return result


def pseudonym(value: Column, kind: Column, key: str, back: bool = False) -> Column:
    """The value's pseudonym by its kind; a value of no kind stays."""
    result = value
    for name, change in _CHANGE.items():
        result = F.when(kind == name, change(value, key, back)).otherwise(result)
    return result


def replace_text(
    docs: DataFrame, key: str = DEFAULT_KEY, back: bool = False, text: str = "text"
) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and an array column ``pii`` of the kinds replaced.

    Null and empty texts stay as they are and have no kinds.
    """
    hits = F.transform(
        F.regexp_extract_all(F.col(text), F.lit(f"({ANY})"), F.lit(0)),
        lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")),
    )
    df = docs.withColumn("__hits", F.when(F.col(text).rlike(TRIGGER), hits))
    fresh = F.transform("__hits", lambda h: pseudonym(h["value"], h["kind"], key, back))
    between = F.split(F.col(text), ANY, -1)
    woven = F.zip_with(
        between, fresh, lambda part, value: F.concat(part, F.coalesce(value, F.lit("")))
    )
    return (
        df.withColumn(text, F.when(F.size("__hits") > 0, F.array_join(woven, "")).otherwise(F.col(text)))
        .withColumn(
            "pii",
            F.coalesce(
                F.array_compact(F.transform("__hits", lambda h: h["kind"])),
                F.array().cast("array<string>"),
            ),
        )
        .drop("__hits")
    )


def reveal(docs: DataFrame, key: str = DEFAULT_KEY, text: str = "text") -> DataFrame:
    """The inverse of :func:`replace_text` for whoever holds the key."""
    return replace_text(docs, key, True, text).drop("pii")


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): its text with pseudonyms, and the kinds replaced."""
    rows = replace_text(docs.select("doc_id", "text"), key)
    return rows.select("doc_id", "text", F.size("pii").alias("n_pii"), "pii")


def hide(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with pseudonyms in their texts, in their own columns, whatever their names."""
    rows = replace_text(boxed(docs), key)
    return with_new_text(rows, docs.columns, F.col("text"), F.size("pii") > 0)
