"""Personal data: format-preserving pseudonyms from a keyed Feistel network, in DataFrame functions only.

Validated numbers and dates are permuted within their own format: a card number with a right check digit becomes
another one, an IPv4 address another address, a date another date, a telephone number another one of the same layout.
The permutation depends on the key alone, so equal values get equal pseudonyms in all documents, and different values
of a format different ones. An e-mail address, which is no number, becomes a keyed name at a reserved domain.

A domain of m1 x m2 values is split into halves; ten rounds add a keyed hash of one half to the other, modulo its size.

What is looked for: e-mail addresses; dates from 1000 to 2999, as yyyy-mm-dd; IPv4 addresses; social security numbers
(those from 900 on are never given out); telephone numbers as 3-3-4 digits, or of 8 to 15 digits after a +; card numbers
with a right check digit in an issuer's range, as one run of 13 to 19 digits or in the layouts that cards have: 4-4-4-4,
4-4-4-4-3, 4-6-5, 4-6-4, with one kind of separator. Other groups may stand beside a card number (an expiry date, a
check value, an order number). A row of more than five groups of four digits is a table, unless all of it is card
numbers. Not looked for: names, postal addresses, dates and cards of other layouts, other telephone numbers without a +.

Defined results: a null text stays null; a text without personal data stays as it is, byte for byte; a number that
fails its check (a card number's check digit, a byte above 255 in an address, a date that no calendar has) isn't
personal data and stays; an empty table gives no rows; rows that repeat get equal results; a very long text is handled whole, in time in proportion to its length and its matches. Other
columns pass through, whatever their names. The key decides the pseudonyms, and who has it can undo them: a deployment
passes its own; the one in this file, KEY, or in the session's setting `spark.tallyloom.key`, is for the queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: The key of the permutations; a deployment passes its own.
KEY = "tallyloom"
ROUNDS = 10

#: What may be personal data, most specific first. Each pattern starts where no other character of its kind stands
#: before it, so a long run of such characters is tried once.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
DATE = r"(?<![0-9-])[12][0-9]{3}-[01][0-9]-[0-3][0-9](?![0-9-])"
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SOCIAL = r"(?<![0-9-])[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])"
WORLD = r"(?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,5}\)?){2,6}(?![0-9])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|(?<=\+[0-9]{1,3}[ .-])[0-9]{3}[ .-]|(?<![0-9+] )[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
#: Digits that are no part of a longer number, in one run or in groups. A group doesn't begin a date.
LONG = r"(?<![0-9])[0-9]{13,19}(?![0-9])"
_END = r"(?![0-9]|-[0-9])"
IN_GROUPS = "|".join(
    f"(?<![0-9])(?:3[0-9]{{3}}{s}[0-9]{{6}}{s}[0-9]{{4,5}}{end}|[0-9]{{4}}(?:{s}[0-9]{{4}}{end}){{3,}}+(?:{s}[0-9]{{3}}{end})?)" for s, end in ((" ", _END), ("-", "(?![0-9])"))
)
CARD = f"{LONG}|{IN_GROUPS}"
#: How card numbers begin, and how many digits they then have.
ISSUERS = (
    ("4", (13, 16, 19)), ("5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720", (16,)), ("3[47]", (15,)), ("30[0-5]|3[689]", (14, 16, 19)),
    ("352[89]|35[3-8]", (16, 17, 18, 19)), ("6011|64[4-9]|65|62|50|5[6-8]|60|6[37]", (16, 17, 18, 19)),
)
ANY = "|".join((EMAIL, DATE, ADDRESS, SOCIAL, PHONE, WORLD, CARD))
KINDS = ("email", "date", "address", "social", "phone", "card")

#: Dates from FIRST_DAY to 2999-12-31, 773 x 945 of them.
FIRST_DAY, YEARS, DAYS = "1000-01-01", 773, 945


def keyed(key: str, kind: str, *parts: Column) -> Column:
    """60 bits of a keyed hash, as a long."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, left: Column, right: Column, m1: Column, m2: Column) -> Column:
    """A struct (l, r): the keyed permutation of (left, right), with left < m1 and right < m2."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        return F.struct(
            F.when(i % 2 == 0, (acc["l"] + keyed(key, kind, i, acc["r"])) % m1).otherwise(acc["l"]).cast("long").alias("l"),
            F.when(i % 2 == 1, (acc["r"] + keyed(key, kind, i, acc["l"])) % m2).otherwise(acc["r"]).cast("long").alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted(key: str, kind: str, digits: Column) -> Column:
    """Another string of as many digits (2 to 36)."""
    a = F.floor(F.length(digits) / 2).cast("int")
    b = (F.length(digits) - a).cast("int")
    out = feistel(key, kind, F.left(digits, a), F.right(digits, b), power(a), power(b))
    return F.concat(F.lpad(out["l"].cast("string"), a, "0"), F.lpad(out["r"].cast("string"), b, "0"))


def characters(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def in_layout(layout: Column, digits: Column) -> Column:
    """layout with its digits replaced, one after the other, by those of digits."""
    chars = characters(layout)
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(acc: Column, c: Column) -> Column:
        is_digit = (c >= "0") & (c <= "9")
        return F.struct(F.concat(acc["out"], F.when(is_digit, F.substr(digits, acc["at"], F.lit(1))).otherwise(c)).alias("out"), (acc["at"] + is_digit.cast("int")).alias("at"))

    return F.aggregate(chars, start, put)["out"]


def check_sum(digits: Column) -> Column:
    """The Luhn sum of digits, of which the last is the check digit."""
    reverse = characters(F.reverse(digits))
    value = F.transform(reverse, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(value, F.lit(0), lambda acc, v: (acc + v).cast("int"))


def once(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def is_card(digits: Column) -> Column:
    """Whether digits are in an issuer's range, as many as its cards have, and right by their check digit."""
    issued = F.lit(False)
    for begins, sizes in ISSUERS:
        issued = issued | (digits.rlike(f"^(?:{begins})") & F.length(digits).isin(*sizes))
    return issued & (check_sum(digits) % 10 == 0)


def card_parts(x: Column) -> Column:
    """x, a match of CARD, in parts (t, card), of which some are card numbers; null if none is."""
    part = lambda t, card: F.struct(t.alias("t"), F.lit(card).alias("card"))
    whole = F.when(is_card(digits_of(x)), F.array(part(x, True)))
    if_valid = lambda t, parts: once(t, lambda t: F.when(is_card(digits_of(t)), parts(t)))
    after = lambda n: F.substr(x, F.lit(n + 1), F.length(x))
    first = if_valid(F.left(x, F.lit(19)), lambda t: F.array(part(t, True), part(after(19), False)))
    last = if_valid(F.substr(x, F.lit(6), F.lit(19)), lambda t: F.array(part(F.left(x, F.lit(5)), False), part(t, True), part(after(24), False)))
    # of more groups either all are card numbers or none
    fours = F.regexp_extract_all(x, F.lit("(?:[0-9]{4}[ -]?){4}"), F.lit(0))
    every = once(fours, lambda f: F.when(F.forall(f, lambda t: is_card(digits_of(t))), F.concat(F.transform(f, lambda t: part(t, True)), F.array(part(F.substr(x, 20 * F.size(f) + 1, F.length(x)), False)))))
    groups = F.floor((F.length(x) + 1) / 5)
    in_fours = F.when(groups == 4, F.coalesce(first, whole)).when(groups == 5, F.coalesce(first, last)).when(groups % 4 == 0, every)
    return F.when(x.rlike("^[0-9]{4}[ -][0-9]{4}[ -]"), in_fours).otherwise(whole)


def has_card(x: Column) -> Column:
    return card_parts(x).isNotNull()


def cards(key: str, x: Column) -> Column:
    """x, a match of CARD, with another number for each card number in it."""
    return F.array_join(F.transform(card_parts(x), lambda p: F.when(p["card"], card(key, p["t"])).otherwise(p["t"])), "")


def card(key: str, x: Column) -> Column:
    """Another number of the same length with a right check digit, in x's layout."""
    check = lambda body: ((10 - check_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    body = once(F.left(digits_of(x), F.length(digits_of(x)) - 1), lambda d: permuted(key, "card", d))
    return once(once(body, lambda b: F.concat(b, check(b))), lambda new: in_layout(x, new))


def address(key: str, x: Column) -> Column:
    byte = F.transform(F.split(x, "\\."), lambda c: c.cast("int"))
    out = feistel(key, "address", byte[0] * 256 + byte[1], byte[2] * 256 + byte[3], F.lit(65536), F.lit(65536))
    part = lambda v: [F.floor(v / 256).cast("int").cast("string"), (v % 256).cast("string")]
    return F.concat_ws(".", *part(out["l"]), *part(out["r"]))


def day_number(x: Column) -> Column:
    return F.datediff(F.try_to_date(x, "yyyy-MM-dd"), F.to_date(F.lit(FIRST_DAY)))


def date(key: str, x: Column) -> Column:
    n = day_number(x)
    out = feistel(key, "date", F.floor(n / DAYS), n % DAYS, F.lit(YEARS), F.lit(DAYS))
    return F.date_format(F.date_add(F.to_date(F.lit(FIRST_DAY)), (out["l"] * DAYS + out["r"]).cast("int")), "yyyy-MM-dd")


def phone(key: str, x: Column) -> Column:
    """The last ten digits change, and a country code before them stays; of numbers of other countries all but the first two change."""
    digits = digits_of(x)
    n = F.when(x.startswith("+") & ~x.startswith("+1"), F.length(digits) - 2).otherwise(F.lit(10))
    return in_layout(x, F.concat(F.left(digits, F.length(digits) - n), permuted(key, "phone", F.right(digits, n))))


def email(key: str, x: Column) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(x)), 256), 1, 16), F.lit("@mail.invalid"))


def kind_of(x: Column) -> Column:
    """Which kind of personal data x, a match of ANY, is; null if it fails its check."""
    only = lambda p: x.rlike(f"^(?:{p})$")
    return (
        F.when(x.contains("@"), "email")
        .when(only("[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.when(day_number(x).between(0, YEARS * DAYS - 1), "date"))
        .when(only(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"), F.when(F.forall(F.split(x, "\\."), lambda c: c.cast("int") <= 255), "address"))
        .when(only("[0-9]{3}-[0-9]{2}-[0-9]{4}"), F.when(~only("(?:000|666).*|.*-00-.*|.*-0000"), "social"))
        .when(only(r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"), "phone")
        .when(x.startswith("+"), F.when(F.length(digits_of(x)).between(8, 15) & (~x.contains(".") | only(r"\+[0-9]{1,3}(?:\.[0-9]{1,5}){2,6}")), "phone"))
        .otherwise(F.when(has_card(x), "card"))
    )


def pseudonym(key: str, kind: Column, x: Column) -> Column:
    return (
        F.when(kind == "email", email(key, x))
        .when(kind == "date", date(key, x))
        .when(kind == "address", address(key, x))
        .when(kind == "social", in_layout(x, permuted(key, "social", digits_of(x))))
        .when(kind == "phone", phone(key, x))
        .when(kind == "card", cards(key, x))
        .otherwise(x)
    )


def pseudonymised(docs: DataFrame, key: str = KEY, counts: bool = False) -> DataFrame:
    """docs with pseudonyms in text; with counts, also n_<kind>, how many of each kind were found."""
    text = F.col("`text`")
    name = next(n for n in (f"found{i}" for i in range(len(docs.columns) + 1)) if n not in {c.lower() for c in docs.columns})
    matches = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = docs.withColumn(name, F.transform(matches, lambda x: F.struct(x.alias("x"), kind_of(x).alias("kind"))))
    any_kind = F.exists(name, lambda m: m["kind"].isNotNull())
    new = F.transform(name, lambda m: pseudonym(key, m["kind"], m["x"]))
    # the pieces between the matches and the pseudonyms, in turn
    joined = F.array_join(F.flatten(F.zip_with(F.split(text, ANY, -1), new, lambda a, b: F.array(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))), "")
    out = found.withColumn("text", F.when(any_kind, joined).otherwise(text))
    is_a = lambda k: lambda m: m["kind"] == k
    for k in KINDS if counts else ():
        out = out.withColumn(f"n_{k}", F.coalesce(F.size(F.filter(name, is_a(k))), F.lit(0)))
    return out.drop(name)


def key_of(spark) -> str:
    return spark.conf.get("spark.tallyloom.key", KEY)


def op7_pseudonyms(spark, sf_dir) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymised(docs, key_of(spark), counts=True)


def stage_pseudonyms(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts; the other columns stay as they are."""
    return pseudonymised(docs, key_of(spark))
