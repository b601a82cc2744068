"""Format-preserving pseudonyms for numbers and dates in text.

Card numbers, telephone numbers, social security numbers, IPv4 addresses and calendar dates are
recognised by shape and checked (check digit, valid areas, octets, calendar); each is taken as a
number in its format's own range and permuted there by a keyed Feistel network, so it becomes another
valid value of the same format, equal values become equal pseudonyms everywhere, and only the key
tells which. Separators, prefixes and lengths stay. All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notevalue.llm.rows import let

ROUNDS = 10

# Shapes, in order of preference where two could start at one place; fixed values. None may touch
# a digit on either side.
CARD = r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5}"
DATE = r"\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
PHONE = r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
SHAPE = rf"(?<![\d.])(?:{CARD}|{DATE}|{SSN}|{IP}|{PHONE})(?!\.?\d)"

FIRST_DAY = "1900-01-01"
# Days from 1900-01-01 to 2099-12-31: 17 * 4297.
DAYS = (17, 4297)


def permute(number: Column, left: Column, right: Column, tweak: Column, key: str) -> Column:
    """`number` in 0 to left * right - 1, permuted by a Feistel network over the two factors.

    Each round adds a keyed digest of one half (SHA-256) to the other, modulo that half's factor,
    so it is a permutation for any two factors; `tweak` tells formats apart.
    """

    def digest(i: Column, half: Column) -> Column:
        text = F.concat_ws(":", F.lit(key), tweak, i.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

    start = F.struct(F.floor(number / right).cast("long").alias("a"), (number % right).cast("long").alias("b"))

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        a = F.when(even, (s["a"] + digest(i, s["b"])) % left).otherwise(s["a"])
        b = F.when(even, s["b"]).otherwise((s["b"] + digest(i, s["a"])) % right)
        return F.struct(a.alias("a"), b.alias("b"))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return let(done, lambda s: s["a"] * right + s["b"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _refill(text: Column, digits: Column) -> Column:
    """`text` with its digits replaced, in order, by those of `digits`."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        digit = (c >= "0") & (c <= "9")
        return F.struct(F.concat(s["out"], F.when(digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"), (s["at"] + F.when(digit, 1).otherwise(0)).alias("at"))

    return F.aggregate(F.split(text, ""), start, step)["out"]


def _padded(number: Column, width: Column) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _permuted_digits(digits: Column, tweak: Column, key: str) -> Column:
    """A digit string of 2 to 18 digits as another of the same length."""
    n = F.length(digits)
    half = F.floor(n / 2)
    return _padded(permute(digits.cast("long"), _power(n - half), _power(half), tweak, key), n)


def check_digit(digits: Column) -> Column:
    """The digit that completes `digits` by the rule for card numbers (doubling every other from the right)."""
    turned = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(d.cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: x - F.when(x > 9, 9).otherwise(0)))
    return ((10 - F.aggregate(turned, F.lit(0), lambda s, x: s + x) % 10) % 10).cast("string")


def _card(found: Column, key: str) -> Column:
    """The first digit names the network and stays; the last is the check digit."""
    digits = _digits(found)
    n = F.length(digits)
    body = F.substring(digits, F.lit(2), n - 2)
    valid = check_digit(F.substring(digits, F.lit(1), n - 1)) == F.substring(digits, n, F.lit(1))
    fresh = F.concat(F.substring(digits, 1, 1), _permuted_digits(body, F.lit("card"), key))
    return F.when(valid, let(fresh, lambda f: _refill(found, F.concat(f, check_digit(f)))))


def _date(found: Column, key: str) -> Column:
    iso = F.contains(found, F.lit("-"))
    parts = F.split(found, "/")
    month_first = F.try_to_date(F.concat_ws("-", parts[2], parts[0], parts[1]), "yyyy-MM-dd")
    day_first = F.try_to_date(F.concat_ws("-", parts[2], parts[1], parts[0]), "yyyy-MM-dd")
    day = F.when(iso, F.try_to_date(found, "yyyy-MM-dd")).otherwise(F.coalesce(month_first, day_first))
    zero = F.lit(FIRST_DAY).cast("date")
    number = F.datediff(day, zero)

    def step(n: Column, again: Column) -> Column:
        """A day-first date is one whose day can't be a month: walk on until the pseudonym is one too."""
        return F.when((again == 0) | (F.dayofmonth(F.date_add(zero, n.cast("int"))) <= 12), permute(n, F.lit(DAYS[0]), F.lit(DAYS[1]), F.lit("date"), key)).otherwise(n)

    walks = F.when(iso | month_first.isNotNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(64)))
    fresh = F.date_add(zero, F.aggregate(walks, number.cast("long"), step).cast("int"))
    written = F.when(iso, F.date_format(fresh, "yyyy-MM-dd")).when(month_first.isNotNull(), F.date_format(fresh, "MM/dd/yyyy")).otherwise(F.date_format(fresh, "dd/MM/yyyy"))
    return F.when((number >= 0) & (number < DAYS[0] * DAYS[1]), written)


def _ssn(found: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.split(found, "-")[i].cast("long") for i in range(3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    fresh = permute((place * 99 + group - 1) * 9999 + serial - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key)

    def written(x: Column) -> Column:
        p = F.floor(x / (99 * 9999))
        return F.concat_ws("-", _padded(p + F.when(p >= 665, 2).otherwise(1), F.lit(3)), _padded(F.floor(x / 9999) % 99 + 1, F.lit(2)), _padded(x % 9999 + 1, F.lit(4)))

    return F.when(valid, let(fresh, written))


def _ip(found: Column, key: str) -> Column:
    octets = F.transform(F.split(found, r"\."), lambda o: o.cast("long"))
    valid = F.forall(octets, lambda o: o < 256)
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda s, o: s * 256 + o)
    fresh = permute(number, F.lit(65536), F.lit(65536), F.lit("ip"), key)
    return F.when(valid, let(fresh, lambda x: F.concat_ws(".", *[(F.floor(x / 256**i) % 256).cast("string") for i in (3, 2, 1, 0)])))


def _phone(found: Column, key: str) -> Column:
    """A leading country code (1 to 3 digits after +) stays; 7 to 15 digits in all."""
    digits = _digits(found)
    code = F.when(found.startswith("+"), F.length(F.regexp_extract(found, r"^\+(\d{1,3}?)(?=[ .(-])", 1))).otherwise(0)
    code = F.when(found.startswith("+") & (code == 0), 1).otherwise(code)
    body = F.substring(digits, code + 1, F.length(digits))
    valid = F.length(digits).between(7, 15) & (F.length(body) >= 6)
    return F.when(valid, _refill(found, F.concat(F.substring(digits, F.lit(1), code), _permuted_digits(body, F.lit("phone"), key))))


def _kinds(found: Column, key: str) -> list[tuple[str, Column]]:
    whole = lambda shape: found.rlike(f"^(?:{shape})$")
    return [(n, F.when(whole(shape), make(found, key))) for n, shape, make in (("card", CARD, _card), ("date", DATE, _date), ("ssn", SSN, _ssn), ("ip", IP, _ip), ("phone", PHONE, _phone))]


def pseudonymise(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """`docs` with every validated number and date of `text` replaced, and `replaced`, a list of kinds.

    What has the shape but not a valid value stays. A null text stays null and has no replacements;
    texts without matches are untouched. Columns named `replaced` are overwritten, others carried along.
    """
    body = F.coalesce(F.col(text), F.lit(""))

    def change(found: Column) -> Column:
        kinds = _kinds(found, secret)
        fresh = F.coalesce(*[c for _, c in kinds])
        name = F.coalesce(*[F.when(found.rlike(f"^(?:{shape})$"), F.lit(n)) for n, shape in (("card", CARD), ("date", DATE), ("ssn", SSN), ("ip", IP), ("phone", PHONE))])
        return let(fresh, lambda f: F.struct(F.coalesce(f, found).alias("text"), F.when(f.isNotNull(), name).alias("kind")))

    has = F.regexp_like(body, F.lit(SHAPE))
    changed = F.when(has, F.transform(F.regexp_extract_all(body, F.lit(SHAPE), F.lit(0)), change))
    rows = docs.drop("replaced").withColumn("_changed", changed)
    pieces = F.zip_with(F.split(F.col(text), SHAPE, -1), "_changed", lambda gap, c: F.concat(gap, F.coalesce(c["text"], F.lit(""))))
    fresh = F.when(F.col("_changed").isNotNull(), F.array_join(pieces, "")).otherwise(F.col(text))
    kinds = F.coalesce(F.filter(F.transform("_changed", lambda c: c["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    return rows.withColumns({text: fresh, "replaced": kinds}).drop("_changed")
