"""Format-preserving pseudonyms by a keyed Feistel permutation.

Card numbers (Luhn-valid), social security numbers, phone numbers, IPv4
addresses, dates and e-mail addresses are replaced by values of the same
format. A value becomes symbols with radices (digits, letters, octets, a day
number); alternating halves are shifted by a keyed SHA-256 of the other half,
modulo each radix. Each round can be undone, so this is a permutation of the
format: equal values get equal pseudonyms in every document, and different
values different ones. Check digits are made anew and dates stay dates. The
digits of card and phone numbers are permuted apart from their separators, so a
number is linked however it is written, a phone number as long as its country
code stands apart. Social security numbers move among those that can be issued.
Of e-mail addresses only letters A-Z and a-z and digits change; other letters
stay as they are.

Phone numbers are those with a plus and a country code in groups of three and
four or of two digits, national numbers of ten digits as 3-3-4, with or without
brackets, and of a trunk 0 and four groups of two. ISO dates also stand before
the T of a timestamp. A national number parted by spaces and beside other digit
groups is not told from them and is left alone.

Digit groups parted by one space or hyphen are read as one span. A span that is
no card number as a whole is read again at its group borders: every run of 13
to 19 digits that passes the Luhn test is a card number. Of runs that overlap,
one of 16 digits goes first, then the longest of the leftmost start; groups
that only the other runs hold are permuted too, but not counted. One run in ten
passes by chance, so tables of numbers parted by single spaces are changed too.

Only built-in functions; no shuffle. A number that fails its validation (a
card number with a wrong check digit, an octet over 255, a day that does not
exist, a social security number of an area never issued) is left alone, as is
all other text. A text without a digit is passed through untouched.

Edge cases: a null text stays null with 0 replacements; an empty text stays
empty; repeated rows are treated alike; doc_id plays no part; an empty table
gives an empty result; whole texts are scanned, whatever their length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import documents

ROUNDS = 10
_HEX = 4  # hexadecimal digits of the round hash for one symbol
_HASH_HEX = 64

# 400 Gregorian years from 1700 are 146,097 days, which is 189 * 773.
FIRST_DAY = "1700-01-01"
DAY_RADICES = (189, 773)
YEARS = (1700, 2099)

# The local part starts where its run of characters starts and is taken whole, so a long word is read once; a host has
# labels of up to 63 characters and 127 of them at most.
EMAIL = (
    r"(?<![\p{L}\p{N}._%+-])[._%+-]*+[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@"
    r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,63}+\.){1,127}[A-Za-z]{2,63}"
)
PHONE = r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}"
# A country code, a trunk digit or area code, and three or more groups of two digits.
PAIRS_PHONE = r"\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d{1,4}(?:[ .-]\d{2,3}){3,5}"
# Ten digits as 3-3-4, with or without brackets, and a trunk 0 with four groups of two digits.
NATIONAL_PHONE = r"(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}|0\d(?:[ .-]\d{2}){4}"
# Ten digits that do not look like card groups parted by spaces.
DASHED_PHONE = r"\d{3}[.-]\d{3}[.-]\d{4}"
IPV4 = r"\d{1,3}(?:\.\d{1,3}){3}"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
SPLIT_DATE = r"\d{2}[./]\d{2}[./]\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
SSN_GAP = 666  # of the areas 001 to 899 the one never issued
SSN_RADICES = (898, 99, 9999)
CARD_DIGITS = (13, 19)
USUAL_CARD_DIGITS = 16
# Numbers stand alone: no letter or digit, nor a further dotted or dashed digit, on either side.
_END = r"(?![\p{L}\p{N}]|[.-]\d)"
_ALONE = r"(?<![\p{L}\p{N}])(?<!\d[.-])(?:%s)" + _END
# All digit groups in a row, up to a value of another kind. Possessive, as Java's stack does not hold a long row else.
_GROUPS = rf"\d++(?:-\d++)*+{_END}"
_OTHER = f"{EMAIL}|(?:{ISO_DATE}|{SPLIT_DATE}|{SSN}|{DASHED_PHONE}){_END}|{ISO_DATE}(?=T\\d)"
CARD = rf"(?=\d(?:[ -]?\d){{12}}){_GROUPS}(?: (?!{_OTHER}){_GROUPS})*+"
_PHONES = "|".join(rf"{p}(?!\d)" for p in (PHONE, PAIRS_PHONE))
VALUE = (
    f"{EMAIL}|(?<![\\p{{L}}\\p{{N}}+])(?:{_PHONES})|(?<![\\p{{L}}\\p{{N}}])(?<!\\d[.-]){ISO_DATE}(?=T\\d)|"
    # Digits that go on after a space, or follow digits, may be part of a card number.
    f"(?<![\\p{{L}}\\p{{N}}])(?<!\\d[ .-])(?:{NATIONAL_PHONE})(?! ?\\d){_END}|"
    + _ALONE % "|".join([IPV4, ISO_DATE, SPLIT_DATE, SSN, DASHED_PHONE, CARD])
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def feistel(symbols: Column, radices: Column, key: str, kind: str) -> Column:
    """Permute an array of symbols, each below its radix."""
    half = F.size(symbols) / 2

    def shifted(now: Column, round_: Column) -> Column:
        left = round_ % 2 == 0  # which half moves; the other one feeds the hash
        other = F.filter(now, lambda _, i: (i < half) != left)
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), F.array_join(other, ",")), 256)

        def move(found: Column) -> Column:
            def step(x: Column, i: Column) -> Column:
                part = F.substring(found, i * _HEX % _HASH_HEX + 1, F.lit(_HEX))
                moved = (x + F.conv(part, 16, 10).cast("int")) % radices[i]
                return F.when((i < half) == left, moved).otherwise(x)

            return F.transform(now, step)

        return _let(digest, move)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, shifted)


def _permute_text(value: Column, key: str, kind: str) -> Column:
    """Permute digits among digits and letters A-Z and a-z among themselves."""
    chars = F.split(value, "")

    def coded(c: Column) -> Column:
        first = F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97).when(c.between("A", "Z"), 65)
        radix = F.when(first == 48, 10).when(first.isNotNull(), 26).otherwise(1)
        return F.struct(
            c.alias("c"), first.alias("first"), radix.alias("radix"), F.coalesce(F.ascii(c) - first, F.lit(0)).alias("symbol")
        )

    def rebuilt(codes: Column) -> Column:
        moved = feistel(F.transform(codes, lambda s: s["symbol"]), F.transform(codes, lambda s: s["radix"]), key, kind)
        return F.array_join(
            F.zip_with(codes, moved, lambda s, m: F.when(s["first"].isNull(), s["c"]).otherwise(F.char(s["first"] + m))), ""
        )

    return _let(F.transform(chars, coded), rebuilt)


def _luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Luhn sum of an array of digits taken from the right."""

    def weighed(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when((i % 2 == 0) == doubled_first, twice - 9 * (twice > 9).cast("int")).otherwise(d.cast("int"))

    return F.aggregate(F.transform(F.reverse(digits), weighed), F.lit(0), lambda a, x: a + x)


def _plain(value: Column) -> Column:
    return F.translate(value, " -", "")


def _digits(value: Column) -> Column:
    return F.split(_plain(value), "")


def _is_card(value: Column) -> Column:
    return F.length(_plain(value)).between(*CARD_DIGITS) & (_luhn_sum(_digits(value), False) % 10 == 0)


def _woven(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order, by ``digits``."""
    before = lambda i: F.length(F.regexp_replace(F.substring(layout, F.lit(1), i + 1), "[^0-9]", ""))
    put = lambda c, i: F.when(c.between("0", "9"), F.substring(digits, before(i), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(layout, ""), put), "")


def _card(value: Column, key: str) -> Column:
    """The digits are permuted apart from their layout, so a number is linked however it is grouped."""
    plain = _plain(value)
    body = _permute_text(F.substring(plain, F.lit(1), F.length(plain) - 1), key, "card")
    check = lambda b: F.concat(b, ((10 - _luhn_sum(_digits(b), True) % 10) % 10).cast("string"))
    return F.when(_is_card(value), _let(_let(body, check), lambda digits: _woven(value, digits)))


def _run(groups: Column, first: Column, last: Column) -> Column:
    return F.array_join(F.slice(groups, first + 1, last - first + 1), "")


def _card_ends(groups: Column) -> Column:
    """For each digit group, the last groups of the valid runs from it."""

    def ends(first: Column) -> Column:
        last = F.sequence(first, F.least(first + CARD_DIGITS[1] - 1, F.size(groups) - 1))
        return F.filter(last, lambda j: _is_card(_run(groups, first, j)))

    return F.transform(F.sequence(F.lit(0), F.size(groups) - 1), ends)


def _choices(groups: Column, ends: Column) -> Column:
    """For each group, the ends of its 16-digit run and of its longest run; null without one."""
    usual = lambda e, i: F.filter(e, lambda j: F.length(_plain(_run(groups, i, j))) == USUAL_CARD_DIGITS)
    return F.transform(
        ends, lambda e, i: F.struct(F.get(usual(e, i), F.lit(0)).alias("usual"), F.array_max(e).alias("longest"))
    )


def _cuts(choices: Column) -> Column:
    """All groups in order as (first, last, loose): a card number, a group of an
    overlapping run, or another group."""
    most = F.lit(CARD_DIGITS[1])

    def cut(now: Column, first: Column) -> Column:
        after = F.slice(choices, first + 2, F.greatest(F.coalesce(now["longest"] - first, F.lit(0)), F.lit(0)))
        before = F.slice(choices, F.greatest(first - most, F.lit(0)) + 1, F.least(first, most) + 1)
        card = F.coalesce(
            now["usual"], F.when(~F.exists(after, lambda c: c["usual"].isNotNull()), now["longest"])
        )
        loose = F.exists(before, lambda c: F.coalesce(c["longest"] >= first, F.lit(False)))
        return F.struct(first.alias("first"), card.alias("card"), loose.alias("loose"))

    return F.transform(choices, cut)


def _taken(cuts: Column) -> Column:
    """The cuts that no earlier card number holds."""
    empty = F.array().cast("array<struct<first:int,last:int,loose:boolean>>")

    def step(acc: Column, cut: Column) -> Column:
        last = F.coalesce(cut["card"], cut["first"])
        loose = cut["card"].isNull() & cut["loose"]
        new = F.struct(cut["first"].alias("first"), last.alias("last"), loose.alias("loose"))
        grown = F.struct(last.alias("last"), F.array_append(acc["cuts"], new).alias("cuts"))
        return F.when(cut["first"] > acc["last"], grown).otherwise(acc)

    start = F.struct(F.lit(-1).alias("last"), empty.alias("cuts"))
    return F.aggregate(cuts, start, step)["cuts"]


def _phone(value: Column, key: str) -> Column:
    """All digits but the country code, or a national number's trunk 0."""
    code = F.regexp_extract(value, r"^(?:\+(?:\d{1,3}(?=[ .(-])|\d)|0)", 0)

    def moved(c: Column) -> Column:
        rest = F.substring(value, F.length(c) + 1, F.length(value))
        digits = _permute_text(F.regexp_replace(rest, "[^0-9]", ""), key, "phone")
        return F.concat(c, _let(digits, lambda d: _woven(rest, d)))

    return _let(code, moved)


def _ipv4(value: Column, key: str) -> Column:
    def moved(octets: Column) -> Column:
        out = F.array_join(feistel(octets, F.transform(octets, lambda _: F.lit(256)), key, "ipv4"), ".")
        return F.when(F.array_max(octets) < 256, out)

    return _let(F.transform(F.split(value, r"\."), lambda x: x.cast("int")), moved)


def _date(value: Column, style: str, key: str) -> Column:
    a, b = DAY_RADICES

    def moved(day: Column) -> Column:
        number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        parts = feistel(F.array(number % a, F.floor(number / a).cast("int")), F.array(F.lit(a), F.lit(b)), key, "date")
        out = _let(parts, lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), p[0] + p[1] * a), style))
        return F.when(F.year(day).between(*YEARS), out)

    return _let(F.try_to_timestamp(value, F.lit(style)).cast("date"), moved)


def _ssn(value: Column, key: str) -> Column:
    """Area 000, 666 and 9xx, group 00 and serial 0000 were never issued; the
    numbers that were are permuted among themselves."""
    part = lambda first, n: F.substring(value, F.lit(first), F.lit(n)).cast("int")
    area = part(1, 3)
    symbols = F.array(area - F.when(area > SSN_GAP, 2).otherwise(1), part(5, 2) - 1, part(8, 4) - 1)

    def made(s: Column) -> Column:
        known = s[0] + F.when(s[0] + 1 >= SSN_GAP, 2).otherwise(1)
        return F.concat_ws(
            "-", F.lpad(known.cast("string"), 3, "0"), F.lpad((s[1] + 1).cast("string"), 2, "0"), F.lpad((s[2] + 1).cast("string"), 4, "0")
        )

    moved = feistel(symbols, F.array(*map(F.lit, SSN_RADICES)), key, "ssn")
    return F.when(~value.rlike(r"^(?:000|666|9)|-00-|-0000$"), _let(moved, made))


def _email(value: Column, key: str) -> Column:
    """All but signs before the address and the last two labels of the host."""
    lead = F.length(F.regexp_extract(value, "^[._%+-]*", 0))
    host = F.regexp_extract(value, r"(?:(?<=@)|\.)[^@.]+\.[^@.]+$", 0)

    def made(h: Column) -> Column:
        own = F.substring(value, lead + 1, F.length(value) - F.length(h) - lead)
        return F.concat(F.substring(value, F.lit(1), lead), _permute_text(own, key, "email"), h)

    return _let(host, made)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; the value itself if it is not valid."""
    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    made = (
        F.when(value.contains("@"), _email(value, key))
        .when(value.startswith("+") | whole(NATIONAL_PHONE), _phone(value, key))
        .when(whole(IPV4), _ipv4(value, key))
        .when(whole(ISO_DATE), _date(value, "yyyy-MM-dd", key))
        .when(whole(r"\d{2}\.\d{2}\.\d{4}"), _date(value, "dd.MM.yyyy", key))
        .when(
            whole(SPLIT_DATE),
            F.coalesce(_date(value, "MM/dd/yyyy", key), _date(value, "dd/MM/yyyy", key)),
        )
        .when(whole(SSN), _ssn(value, key))
        .otherwise(_card(value, key))
    )
    return F.coalesce(made, value)


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, and n_replaced."""
    df = documents(docs, id_col, text_col)
    # A value holds a digit or an at sign; most texts hold neither and skip the long pattern.
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(VALUE), F.lit(0)))
    # The partition id, always 0 or more, keeps a later filter from being pushed below the projection and repeating it.
    once = F.spark_partition_id() >= 0
    each = lambda name, use: F.when(once & (F.size(F.coalesce(name, F.array())) > 0), use)
    df = df.withColumn("found", F.when(once, found))
    df = df.withColumn("between", each("found", F.split("text", VALUE, -1)))
    # Spans that are no card number as a whole are cut at their groups; null for all other values. One column for each
    # step: the planner's time multiplies with the depth of lambdas.
    span = lambda v: ~v.rlike(r"[^0-9 -]") & ~v.rlike(f"^(?:{ISO_DATE}|{SSN}|{NATIONAL_PHONE})$") & ~_is_card(v)
    groups = lambda v: F.when(span(v), F.regexp_extract_all(v, F.lit("[ -]?[0-9]+"), F.lit(0)))
    df = df.withColumn("groups", each("found", F.transform("found", groups)))
    df = df.withColumn("ends", each("found", F.transform("groups", lambda g: F.when(g.isNotNull(), _card_ends(g)))))
    df = df.withColumn("ends", each("found", F.zip_with("groups", "ends", _choices)))
    df = df.withColumn("ends", each("found", F.transform("ends", _cuts)))
    df = df.withColumn("ends", each("found", F.transform("ends", _taken)))

    def pieces(value: Column, i: Column) -> Column:
        """(lead, text, loose) of a value: the lead is the text before it, or the separator of a digit group."""
        before, group = F.col("between")[i], F.col("groups")[i]
        piece = lambda lead, text, loose: F.struct(lead.alias("lead"), text.alias("text"), loose.alias("loose"))

        def cut_piece(c: Column) -> Column:
            text = _run(group, c["first"], c["last"])
            lead = F.when(c["first"] == 0, before).otherwise(F.regexp_extract(text, "^[ -]?", 0))
            return piece(lead, F.regexp_replace(text, "^[ -]", ""), c["loose"])

        return F.when(group.isNotNull(), F.transform(F.col("ends")[i], cut_piece)).otherwise(
            F.array(piece(before, value, F.lit(False)))
        )

    df = df.withColumn("pieces", each("found", F.flatten(F.transform("found", pieces))))
    renamed = lambda p: F.when(p["loose"], _permute_text(p["text"], key, "card")).otherwise(pseudonym(p["text"], key))
    df = df.withColumn("made", each("found", F.transform("pieces", renamed)))
    joined = F.array_join(F.zip_with("pieces", "made", lambda p, m: F.concat(p["lead"], m)), "")
    changed = F.size(F.filter(F.zip_with("pieces", "made", lambda p, m: (p["text"] != m) & ~p["loose"]), lambda x: x))
    return df.select(
        "doc_id",
        F.when(F.col("made").isNull(), F.col("text"))
        .otherwise(F.concat(joined, F.element_at("between", -1)))
        .alias("text"),
        F.when(F.col("made").isNull(), 0).otherwise(changed).cast("long").alias("n_replaced"),
    )
