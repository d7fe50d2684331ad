"""Format-preserving pseudonyms for personal data (DataFrame functions only).

Numbers that pass their own validation (payment cards by check digit, social
security numbers by range, IPv4 addresses, telephone numbers by layout) and
calendar dates are permuted inside their format by a keyed Feistel network:
the value is split into (left, right), each round adds a keyed hash of one part
to the other modulo that part's range, and the result is written back into the
same layout, with a new check digit for cards.  A permutation is one to one, so
equal values stay equal and different ones different in every document and in
every layout (a day, a card or a North American telephone number is permuted as a value and
written back into its layout), and ``restore=True`` with the same key brings the originals back.  E-mail addresses
and quoted secrets, which have no numeric format, become keyed digests of the
same kind (equal ones stay equal, not reversible).

One regular expression finds all candidates of a text; the text is cut at them,
each is rewritten inside an array function, and the pieces are joined again.
No shuffle, no row leaves its task, and a text without candidates costs one scan.

Layouts: cards are 13 to 19 digits in one piece, or grouped by one kind of space
or hyphen as 4-4-4-n (n up to 7), 4-6-5 and 4-6-4; other numbers may follow.
Telephone numbers are those of North America with brackets or with area code,
exchange and line apart, with or without +1 or 1 before, or in one piece behind
+1; and of other countries behind + and a country code, which stays.

Defined results
  null text stays null; a text without valid data comes back unchanged.
  Numbers that fail validation (a wrong check digit, 31 February) are left as
  they are.  Repeated rows are treated each, alike.  Columns other than the
  text come back unchanged; ``found`` names an optional count column (an equally
  named input column is replaced).  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# Fixed formats.
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){1,8}"
SECRET = r"(?i:(?<=(?:token|secret|password|passwd|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)[0-9a-f]{32,128}(?![0-9a-z]))"
PHONE = (
    r"(?<![\p{L}\d+])(?:\+?1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d+-])(?:\+?1[ .-])?[2-9]\d{2}[ .-][2-9]\d{2}[ .-]\d{4}(?![\d-])"
    r"|(?<![\p{L}\d+])\+1[2-9]\d{2}[2-9]\d{6}(?!\d)"
)
# Between the digits of other countries' numbers; a space does not lead on into a day, an address or a card.
CARD_AHEAD = r"\d{4} \d{4} \d{4} \d{1,7}(?!\d)(?! \d{4}(?!\d))|\d{4}-\d{4}-\d{4}-\d|\d{4} \d{6} \d|\d{4}-\d{6}-\d"
GAP = rf"(?:(?:[.-]|[ ](?!\d{{1,2}}/\d|\d{{4}}-\d\d-|\d{{1,3}}\.\d|\d{{3}}-\d\d-\d{{4}}|{CARD_AHEAD}))(?=\d\d|\d[ .-]\d\d))?"
ABROAD = (
    rf"(?<![\p{{L}}\d+])\+[2-9]\d{{0,2}}(?:[ .-]?\(\d{{1,5}}\)[ .-]?(?:{GAP}\d){{3,10}}|(?:{GAP}\d){{5,12}})(?!\d)"
)
#: Country codes of one or two digits; the others have three.
COUNTRY = r"7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
IPV4 = rf"(?<![\p{{L}}\d])(?<!\d\.)(?:{OCTET}\.){{3}}{OCTET}(?!\d)(?!\.\d)"
DATE = (
    r"(?<![\d-])(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?!\d)(?!-\d)"
    r"|(?<![\d/])(?:0[1-9]|1[0-2])/(?:0[1-9]|[12]\d|3[01])/(?:19|20)\d\d(?![\d/])"
    r"|(?<!\d)(?<!\d\.)(?:0[1-9]|[12]\d|3[01])\.(?:0[1-9]|1[0-2])\.(?:19|20)\d\d(?!\d)(?!\.\d)"
)
SSN = r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])"
CARD = r"(?<!\d)(?<!\d\.)(?:\d{4}([ -])(?:\d{4}\1\d{4}\1\d{1,7}|\d{6}\1\d{4,5})|\d{13,19})(?!\d)"
# What an alternative must begin with is looked at first, so that most places of a
# text fail at once (the look behind a secret is the costly one).
NUMBERS = "|".join((PHONE, ABROAD, IPV4, DATE, SSN, CARD))
CANDIDATES = rf"{EMAIL}|(?=[0-9a-fA-F]{{32}}){SECRET}|(?=[+(\d])(?:{NUMBERS})"

FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # 17 * 4297 days: 1900 to 2099
SSN_AREAS = 898  # 001 to 899 without 666


def _long(digits: Column) -> Column:
    return digits.cast("long")


def permute(left: Column, right: Column, ranges: tuple[Column, Column], kind: str, key: str, restore: bool) -> Column:
    """``struct(l, r)`` of the Feistel network over ``[0, ranges[0]) x [0, ranges[1])``."""
    size_l, size_r = (r.cast("long") for r in ranges)

    def keyed(i: Column, x: Column) -> Column:
        hashed = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), i, x), 256)
        return F.conv(F.substring(hashed, 1, 14), 16, 10).cast("long")

    def step(state: Column, i: Column) -> Column:
        sign = -1 if restore else 1
        l, r = state["l"], state["r"]  # noqa: E741
        new_l = F.pmod(l + sign * F.pmod(keyed(i, r), size_l), size_l)
        new_r = F.pmod(r + sign * F.pmod(keyed(i, l), size_r), size_r)
        odd = i % 2 == 1
        return F.struct(F.when(odd, new_l).otherwise(l).alias("l"), F.when(odd, r).otherwise(new_r).alias("r"))

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if restore else F.sequence(F.lit(1), F.lit(ROUNDS))
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(rounds, start, step)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1).cast("int"), F.lit("0")).cast("long")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def permuted_digits(digits: Column, kind: str, key: str, restore: bool) -> Column:
    """A digit string (2 to 36 digits) permuted among those of its length."""
    half = F.floor(F.length(digits) / 2)
    rest = F.length(digits) - half
    moved = permute(
        _long(F.substr(digits, F.lit(1), half)), _long(F.substr(digits, half + 1, rest)),
        (_power(half), _power(rest)), kind, key, restore,
    )
    return _bind(
        moved,
        lambda s: F.concat(
            F.lpad(s["l"].cast("string"), half.cast("int"), F.lit("0")), F.lpad(s["r"].cast("string"), rest.cast("int"), F.lit("0"))
        ),
    )


def refill(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order, by ``digits``."""

    def step(state: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        put = F.when(digit, F.substr(digits, state["at"], F.lit(1))).otherwise(c)
        return F.struct(F.concat(state["out"], put).alias("out"), (state["at"] + digit.cast("int")).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(F.split(layout, ""), start, step, lambda s: s["out"])


def luhn_sum(payload: Column) -> Column:
    """Luhn sum of digits whose last one is doubled (the check digit is not among them)."""
    turned = F.split(F.reverse(payload), "")
    weights = F.transform(
        turned,
        lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))
        ),
    )
    return F.aggregate(weights, F.lit(0), lambda a, b: a + b)


def check_digit(payload: Column) -> Column:
    return F.pmod(10 - luhn_sum(payload) % 10, F.lit(10)).cast("string")


def card(value: Column, key: str, restore: bool) -> Column:
    """A card number with a right check digit; null for other digit strings."""

    def moved(digits: Column) -> Column:
        payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
        valid = (check_digit(payload) == F.right(digits, F.lit(1))) & F.length(digits).between(13, 19) & (payload.rlike("[1-9]"))
        new = permuted_digits(payload, "card", key, restore)
        return F.when(valid, _bind(new, lambda p: refill(value, F.concat(p, check_digit(p)))))

    return _bind(F.regexp_replace(value, r"\D", ""), moved)


def phone(value: Column, key: str, restore: bool) -> Column:
    """The last ten digits, by their value, in any layout; a country code stays.

    Area codes and exchanges from 200 on are permuted among themselves, and so are numbers with a
    smaller area code, and the others with a smaller exchange (brackets allow both).
    """
    national = F.regexp_extract(value, r"^(?:\+?1[ .-]?)?(.*)$", 1)
    prefix = F.regexp_extract(value, r"^((?:\+?1[ .-]?)?)", 1)

    def moved(digits: Column) -> Column:
        area, rest = _long(F.substring(digits, 1, 3)), _long(F.substring(digits, 4, 7))
        low_area, low_exchange = area < 200, rest < 2_000_000
        first = (F.when(low_area, 0).otherwise(200), F.when(low_area | low_exchange, 0).otherwise(2_000_000))
        sizes = (F.when(low_area, 200).otherwise(800), F.when(low_area, 10_000_000).when(low_exchange, 2_000_000).otherwise(8_000_000))
        new = permute(area - first[0], rest - first[1], sizes, "phone", key, restore)
        pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
        return _bind(new, lambda s: F.concat(pad(s["l"] + first[0], 3), pad(s["r"] + first[1], 7)))

    new = _bind(F.regexp_replace(national, r"\D", ""), moved)
    return F.concat(prefix, _bind(new, lambda d: refill(national, d)))


def phone_abroad(value: Column, key: str, restore: bool) -> Column:
    """All digits behind the country code."""
    prefix = F.regexp_extract(value, rf"^\+(?:{COUNTRY}|)", 0)
    national = F.substr(value, F.length(prefix) + 1, F.length(value))
    new = permuted_digits(F.regexp_replace(national, r"\D", ""), "phone+", key, restore)
    return F.concat(prefix, _bind(new, lambda d: refill(national, d)))


def ssn(value: Column, key: str, restore: bool) -> Column:
    area, group, serial = (_long(F.substring(value, a, n)) for a, n in ((1, 3), (5, 2), (8, 4)))
    left = area - 1 - (area > 666).cast("int")
    moved = permute(left, (group - 1) * 9999 + serial - 1, (F.lit(SSN_AREAS), F.lit(99 * 9999)), "ssn", key, restore)

    def pad(x: Column, n: int) -> Column:
        return F.lpad(x.cast("long").cast("string"), n, "0")

    def layout(s: Column) -> Column:
        new = s["l"] + 1 + (s["l"] >= 665).cast("int")
        return F.concat_ws("-", pad(new, 3), pad(F.floor(s["r"] / 9999) + 1, 2), pad(s["r"] % 9999 + 1, 4))

    return _bind(moved, layout)


def ipv4(value: Column, key: str, restore: bool) -> Column:
    part = F.split(value, r"\.")
    left, right = (_long(part[i]) * 256 + _long(part[i + 1]) for i in (0, 2))
    moved = permute(left, right, (F.lit(65536), F.lit(65536)), "ipv4", key, restore)
    return _bind(
        moved, lambda s: F.concat_ws(".", *[x.cast("long") for h in (s["l"], s["r"]) for x in (F.floor(h / 256), h % 256)])
    )


def _date_in(value: Column, layout: str, key: str, restore: bool) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    day = F.try_to_timestamp(value, F.lit(layout)).cast("date")
    number = F.date_diff(day, first)
    moved = permute(F.floor(number / DAYS[1]), number % DAYS[1], (F.lit(DAYS[0]), F.lit(DAYS[1])), "date", key, restore)
    new = _bind(moved, lambda s: F.date_format(F.date_add(first, (s["l"] * DAYS[1] + s["r"]).cast("int")), layout))
    return F.when(day.isNotNull(), new)


def date(value: Column, key: str, restore: bool) -> Column:
    """A day of 1900 to 2099, by its value, in the same layout; null for days that do not exist."""
    return (
        F.when(value.contains("-"), _date_in(value, "yyyy-MM-dd", key, restore))
        .when(value.contains("/"), _date_in(value, "MM/dd/yyyy", key, restore))
        .otherwise(_date_in(value, "dd.MM.yyyy", key, restore))
    )


def email(value: Column, key: str) -> Column:
    low = F.lower(value)
    person = F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), low), 256), 1, 16)
    host = F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("host"), F.substring_index(low, "@", -1)), 256), 1, 8)
    return F.concat(F.lit("u"), person, F.lit("@h"), host, F.lit(".example"))


def secret(value: Column, key: str) -> Column:
    hashed = F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("secret"), F.lower(value)), 512), 1, F.length(value))
    return F.when(value.rlike("[A-F]"), F.upper(hashed)).otherwise(hashed)


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def pseudonym(value: Column, key: str, restore: bool = False) -> Column:
    """The pseudonym of one candidate, or null if it is not valid data."""
    one_way = (lambda c: F.lit(None).cast("string")) if restore else (lambda c: c)
    return (
        F.when(value.contains("@"), one_way(email(value, key)))
        .when(value.rlike(_whole(IPV4)), ipv4(value, key, restore))
        .when(value.rlike(_whole(DATE)), date(value, key, restore))
        .when(value.rlike(_whole(SSN)), ssn(value, key, restore))
        .when(value.rlike(_whole(PHONE)), phone(value, key, restore))
        .when(value.startswith("+"), phone_abroad(value, key, restore))
        .when(value.rlike(r"^\d[\d -]{12,25}$") & (F.length(F.regexp_replace(value, r"\D", "")) <= 19), card(value, key, restore))
        .otherwise(F.when(value.rlike("^(?i)[0-9a-f]{32,128}$"), one_way(secret(value, key))))
    )


def pseudonymize(
    docs: DataFrame, key: str, text: str = "text", found: str | None = None, restore: bool = False
) -> DataFrame:
    """``docs`` with every valid item of ``text`` replaced; ``found`` adds their number."""
    given = F.col(text)
    gaps = F.split(given, CANDIDATES, -1)
    items = F.transform(F.regexp_extract_all(given, F.lit(CANDIDATES), F.lit(0)), lambda v: F.struct(v.alias("old"), pseudonym(v, key, restore).alias("new")))
    rewritten = _bind(
        items,
        lambda found_items: F.struct(
            F.array_join(
                F.zip_with(gaps, found_items, lambda g, m: F.concat(g, F.coalesce(m["new"], m["old"], F.lit("")))), ""
            ).alias("text"),
            F.size(F.filter(found_items, lambda m: m["new"].isNotNull())).cast("long").alias("n"),
        ),
    )
    plain = F.struct(given.alias("text"), F.lit(0).cast("long").alias("n"))
    rows = docs.select("*", F.when(given.rlike(CANDIDATES), rewritten).otherwise(plain).alias("_pii"))
    columns = [F.col("_pii.text").alias(text) if c == text else F.col(c) for c in docs.columns if c != found]
    return rows.select(*columns, *([F.col("_pii.n").alias(found)] if found else []))
