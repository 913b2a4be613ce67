"""Format-preserving pseudonyms of personal data.

A value that passes the checks of its kind is permuted with a key inside the format of the
kind: a card number stays a number with a valid check digit, a date a date of its century,
an address keeps its length and punctuation. The permutations are alternating Feistel
networks whose round function is SHA-256 over key, kind and half, so equal values get equal
pseudonyms in every document and different values different ones. Everything is a column
expression: one pass over the texts, no shuffle, no Python on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KEY = "cohortix"

# Longest half of a network by radix: radix ** half stays an exact double.
HALF = {10: 15, 16: 13, 26: 11, 36: 10}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
DIGITS_26 = "0123456789abcdefghijklmnop"
CENTURY = {False: (92, 397), True: (75, 487)}  # factors of the days of a century, with leap year 00

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
ISO = r"(?<![0-9./-])[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}(?![0-9/-]|\.[0-9])"
DAY_FIRST = r"(?<![0-9./-])[0-9]{1,2}([-./])[0-9]{1,2}\1(?:[0-9]{4}|[0-9]{2})(?![0-9/-]|\.[0-9])"
# The months in English, short and long, German, French and Spanish.
MONTHS = [row.split() for row in (
    "january february march april may june july august september october november december",
    "jan feb mar apr may jun jul aug sep oct nov dec",
    "jan feb mar apr may jun jul aug sept oct nov dec",
    "januar februar märz april mai juni juli august september oktober november dezember",
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre")]
MONTH_NAMES = [m for row in MONTHS for m in row]
_accents = {"ä": "[äÄ]", "é": "[éÉ]", "û": "[ûÛ]"}
MONTH = "(?i:" + "|".join("".join(_accents.get(c, c) for c in m)
                          for m in sorted({*MONTH_NAMES}, key=lambda m: (-len(m), m))) + ")"
NAMED = (rf"(?<![0-9A-Za-z./-])[0-9]{{1,2}}(?:st|nd|rd|th|er|\.)?(?: of | de |[ -])?{MONTH}"
         r"(?:\.?,? (?:de |del )?|-)(?:[0-9]{4}|[0-9]{2})(?![0-9A-Za-z/-]|[.,:][0-9])"
         rf"|(?<![0-9A-Za-z])(?=[JFMASONDEjfmasonde][^0-9 ]{{2,10}} [0-9]){MONTH}\.? [0-9]{{1,2}}(?:st|nd|rd|th)?,? [0-9]{{4}}(?![0-9A-Za-z/-]|\.[0-9])")
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# The first try ends a number where no mark and further digit follow, the second one anywhere.
ABROAD = r"(?<![0-9+])\+[0-9](?:(?:[ .-]?\(|\)[ .-]?|[ .-])?[0-9]){7,14}"
PHONE = (r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
         rf"|{ABROAD}(?![0-9]|[./-][0-9])|{ABROAD}(?![0-9])"
         r"|(?<![0-9.-])(?:1[-. ])?[0-9]{3}([-. ])[0-9]{3}\1[0-9]{4}(?![0-9-]|\.[0-9])")
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
# Countries by the length of their account numbers, as the registry of ISO 13616 has them.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _account(length: int, countries: str) -> str:
    """An account number of ``length`` characters, in one or in groups of four."""
    fours, rest = divmod(length - 4, 4)
    grouped = f"(?: [A-Z0-9]{{4}}){{{fours}}}" + (f" [A-Z0-9]{{{rest}}}" if rest else "")
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{length - 4}}}|{grouped})"


IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(_account(n, c) for n, c in LENGTHS.items()) +
        r"|[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?))(?![A-Za-z0-9])")
HEX_KEY = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])"
ACCESS_KEY = r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"


def _alternatives(*patterns: str) -> str:
    """One pattern of all; back references are renumbered to their place in it."""
    out, groups = [], 0
    for p in patterns:
        own = p.count("([")
        for g in range(own, 0, -1):
            p = p.replace(rf"\{g}", rf"\{groups + g}")
        out.append(p)
        groups += own
    return "|".join(out)


ANY = _alternatives(EMAIL, IBAN, ISO, DAY_FIRST, NAMED, CARD, ADDRESS, SOCIAL, PHONE, HEX_KEY, ACCESS_KEY)
# Every match holds one of these: an @, two digits together, an address' digit before a dot, the digit behind
# the plus of a spaced number, an access key's prefix, a key's run of hexadecimal digits.
MAYBE = r"[0-9]{2}|@|[0-9]\.[0-9]|\+[0-9]|AKIA|[0-9a-fA-F]{32}"


@dataclass(frozen=True)
class Keyed:
    """The networks of one key."""

    key: str
    rounds: int = ROUNDS

    def pair(self, kind: str, left: Column, right: Column, left_size: Column, right_size: Column,
             tweak: Column | None = None) -> Column:
        """Permute the pairs of ``left`` below ``left_size`` and ``right`` below ``right_size``."""
        extra = F.lit("") if tweak is None else tweak

        def draw(i: Column, half: Column) -> Column:
            text = F.concat_ws(":", F.lit(self.key), F.lit(kind), left_size, right_size, extra, i, half)
            return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

        def turn(s: Column, i: Column) -> Column:
            even = i % 2 == 0
            return F.struct(
                F.when(even, F.pmod(s["l"] + draw(i, s["r"]), left_size)).otherwise(s["l"]).alias("l"),
                F.when(even, s["r"]).otherwise(F.pmod(s["r"] + draw(i, s["l"]), right_size)).alias("r"))

        start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(self.rounds - 1)), start, turn)

    def string(self, kind: str, s: Column, radix: int) -> Column:
        """Permute strings of ``radix`` digits of each length; long ones in chained blocks."""
        half = HALF[radix]

        def block(done: Column, i: Column) -> Column:
            part = F.substring(s, i * (2 * half) + 1, F.lit(2 * half))
            u = F.floor(F.length(part) / 2).cast("int")
            v = F.length(part) - u

            def number(text: Column) -> Column:
                return F.coalesce(F.conv(text, radix, 10).cast("long"), F.lit(0).cast("long"))

            def power(n: Column) -> Column:
                return F.pow(F.lit(float(radix)), n).cast("long")

            def digits(x: Column, n: Column) -> Column:
                return F.lpad(F.lower(F.conv(x.cast("string"), 10, radix)), n, F.lit("0"))

            moved = self.pair(f"{kind}{radix}", number(F.substring(part, F.lit(1), u)),
                              number(F.substring(part, u + 1, v)), power(u), power(v),
                              F.concat_ws("/", F.length(s), done))
            # one element, so that the network runs once
            both = F.transform(F.array(moved), lambda p: F.concat(
                F.when(u > 0, digits(p["l"], u)).otherwise(F.lit("")), digits(p["r"], v)))
            return F.concat(done, both[0])

        blocks = F.ceil(F.length(s) / (2 * half)).cast("int")
        return F.when(F.length(s) == 0, s).otherwise(
            F.aggregate(F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1), F.lit(""), block))


def only(m: Column, kept: str) -> Column:
    return F.regexp_replace(m, f"[^{kept}]", "")


def spliced(m: Column, places: str, new: Column) -> Column:
    """``m`` with its characters of the class ``places`` replaced, in turn, by those of ``new``."""
    def put(c: Column, i: Column) -> Column:
        before = F.length(only(F.substring(m, F.lit(1), i), places))
        return F.when(c.rlike(f"^[{places}]$"), F.substring(new, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(m, ""), put), "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string whose last digit is the check digit, modulo 10."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return (total + F.when(i % 2 == 1, twice).otherwise(d)).cast("int")

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10


def mod_97(text: Column) -> Column:
    """Remainder by 97 of capitals and digits read as in ISO 7064 (A is 10)."""
    def add(rest: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return ((rest * F.when(value > 9, 100).otherwise(10) + value) % 97).cast("int")

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def card(net: Keyed, m: Column) -> Column:
    """13 to 19 digits with a valid check digit; the first digit stays, the check digit is made anew."""
    digits = only(m, "0-9")
    inner = F.substring(digits, F.lit(2), F.length(digits) - 2)
    body = F.concat(F.substring(digits, 1, 1), net.string("card", inner, 10))

    def checked(b: Column) -> Column:
        return F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string"))

    new = F.transform(F.array(body), checked)[0]
    return F.when(luhn_sum(digits) == 0, spliced(m, "0-9", new)).otherwise(m)


def iban(net: Keyed, m: Column) -> Column:
    """Account digits permuted, country and letters kept, check digits made anew; otherwise unchanged.

    If the check fails, words behind the number may have been taken for its groups: then
    groups are left off from the end as long as a number can be left.
    """
    words = F.split(m, " ")
    heads = F.transform(F.sequence(F.size(words), F.least(F.size(words), F.lit(4)), F.lit(-1)),
                        lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))

    def valid(h: Column) -> Column:
        plain = F.regexp_replace(h, " ", "")
        account = F.substring(plain, F.lit(5), F.length(plain) - 4)
        return (F.length(plain) >= 15) & (mod_97(F.concat(account, F.substring(plain, 1, 4))) == 1)

    def renewed(h: Column) -> Column:
        plain = F.regexp_replace(h, " ", "")
        land, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain) - 4)

        def rebuilt(a: Column) -> Column:
            check = F.lpad((98 - mod_97(F.concat(a, land, F.lit("00")))).cast("string"), 2, "0")
            return F.concat(spliced(h, "A-Z0-9", F.concat(land, check, a)), F.substring(m, F.length(h) + 1, F.length(m)))

        moved = spliced(account, "0-9", net.string("iban", only(account, "0-9"), 10))
        return F.transform(F.array(moved), rebuilt)[0]

    return F.coalesce(F.get(F.transform(F.slice(F.filter(heads, valid), 1, 1), renewed), F.lit(0)), m)


def address(net: Keyed, m: Column) -> Column:
    """Four numbers up to 255, permuted together."""
    part = F.transform(F.split(m, r"\."), lambda p: p.cast("int"))
    moved = net.pair("ip", part[0] * 256 + part[1], part[2] * 256 + part[3], F.lit(65536), F.lit(65536))

    def dotted(p: Column) -> Column:
        return F.concat_ws(".", F.shiftright(p["l"], 8), p["l"] % 256, F.shiftright(p["r"], 8), p["r"] % 256)

    return F.when(F.forall(part, lambda p: p <= 255), F.transform(F.array(moved), dotted)[0]).otherwise(m)


def social(net: Keyed, m: Column) -> Column:
    """Area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999."""
    area, group, serial = (F.element_at(F.split(m, "-"), i).cast("int") for i in (1, 2, 3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    moved = net.pair("ssn", place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))

    def written(p: Column) -> Column:
        new_area = F.floor(p["l"] / 99)
        return F.concat_ws(
            "-", F.lpad((new_area + F.when(new_area >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((p["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((p["r"] + 1).cast("string"), 4, "0"))

    return F.when(valid, F.transform(F.array(moved), written)[0]).otherwise(m)


def phone(net: Keyed, m: Column) -> Column:
    """8 to 15 digits, without a plus 10 or 11 with a leading 1; what stands for the country stays."""
    plus = m.startswith("+")
    apart = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    one = F.regexp_extract(m, r"^1[-. ](?=[0-9]{3}[-. ])", 0)
    lead = F.when(~plus, one).when(apart != "", apart).otherwise(F.substring(m, 1, 3))
    rest = F.substring(m, F.length(lead) + 1, F.length(m))
    new = F.concat(lead, spliced(rest, "0-9", net.string("phone", only(rest, "0-9"), 10)))
    n = F.length(only(m, "0-9"))
    local = n == F.when(one != "", 11).otherwise(10)
    return F.when(F.when(plus, (n >= 8) & (n <= 15)).otherwise(local), new).otherwise(m)


def real_day(y: Column, mo: Column, d: Column) -> Column:
    """The day of the calendar, null if there is none; a year of two digits is one after 2000."""
    year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")


def moved_day(net: Keyed, real: Column) -> Column:
    """An array of one day of the same century, so that the network runs once."""
    first = F.make_date(F.floor(F.year(real) / 100).cast("int") * 100, F.lit(1), F.lit(1))
    leap = F.year(first) % 400 == 0
    size_l = F.when(leap, CENTURY[True][0]).otherwise(CENTURY[False][0])
    size_r = F.when(leap, CENTURY[True][1]).otherwise(CENTURY[False][1])
    at = F.datediff(real, first)
    moved = net.pair("date", F.floor(at / size_r), at % size_r, size_l, size_r, F.year(first).cast("string"))
    return F.transform(F.array(moved), lambda p: F.date_add(first, (p["l"] * size_r + p["r"]).cast("int")))


def padded(x: Column, like: Column) -> Column:
    """A number with as many digits, at least, as ``like`` has."""
    return F.when(F.length(like) == 2, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))


def year_of(new: Column, like: Column) -> Column:
    return F.substring(F.lpad(F.year(new).cast("string"), 4, "0"), 5 - F.length(like), F.lit(4))


def date(net: Keyed, m: Column) -> Column:
    """A day of the calendar becomes one of the same century in the same notation.

    Day and month before the year are read as month and day if that is possible, else the
    other way.
    """
    mark = F.regexp_extract(m, "([-./])", 1)
    parts = F.split(m, "[-./]")
    a, b, c = (F.element_at(parts, i) for i in (1, 2, 3))
    year_first = F.length(a) == 4
    month_first = F.when(mark == ".", F.lit(None).cast("date")).otherwise(real_day(c, a, b))
    order = F.when(year_first, F.lit("y")).when(month_first.isNotNull(), F.lit("m")).otherwise(F.lit("d"))
    real = F.when(year_first, real_day(a, b, c)).otherwise(F.coalesce(month_first, real_day(c, b, a)))

    def written(new: Column) -> Column:
        mo, d = F.month(new), F.day(new)
        return (F.when(order == "y", F.concat(year_of(new, a), mark, padded(mo, b), mark, padded(d, c)))
                .when(order == "m", F.concat(padded(mo, a), mark, padded(d, b), mark, year_of(new, c)))
                .otherwise(F.concat(padded(d, a), mark, padded(mo, b), mark, year_of(new, c))))

    return F.when(real.isNull() | (F.year(real) < 1600), m).otherwise(F.transform(moved_day(net, real), written)[0])


def named_date(net: Keyed, m: Column) -> Column:
    """A date with the name of its month, in the same order, language and case."""
    names = F.array(*map(F.lit, MONTH_NAMES))
    name = F.regexp_extract(m, MONTH, 0)
    place = F.array_position(names, F.lower(name)).cast("int") - 1
    numbers = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
    d, y = F.get(numbers, F.lit(0)), F.get(numbers, F.lit(1))
    real = real_day(y, (place % 12 + 1).cast("string"), d)
    before = F.regexp_extract(m, "^[^0-9]*", 0)
    between = F.substring(m, F.length(before) + F.length(d) + 1,
                          F.length(m) - F.length(before) - F.length(d) - F.length(y))

    def written(new: Column) -> Column:
        low = F.get(names, place - place % 12 + F.month(new) - 1)
        called = (F.when(name == F.lower(name), low).when(name == F.upper(name), F.upper(low))
                  .otherwise(F.initcap(low)))
        last = F.day(new) % 10
        ordinal = (F.when(F.day(new).between(11, 13), "th").when(last == 1, "st").when(last == 2, "nd")
                   .when(last == 3, "rd").otherwise("th"))
        own = F.regexp_extract(between, "^(?:st|nd|rd|th)", 0)
        middle = F.concat(F.when(own != "", ordinal).otherwise(F.lit("")),
                          F.substring(between, F.length(own) + 1, F.length(between)))
        return F.concat(F.replace(before, name, called), padded(F.day(new), d), F.replace(middle, name, called),
                        year_of(new, y))

    return F.when(real.isNull() | (F.year(real) < 1600), m).otherwise(F.transform(moved_day(net, real), written)[0])


def email(net: Keyed, m: Column) -> Column:
    """Letters and digits but those of the last label, in lower case."""
    low = F.lower(m)
    body = F.regexp_replace(low, r"\.[a-z]+$", "")
    tail = F.substring(low, F.length(body) + 1, F.length(low))
    letters = F.translate(only(body, "a-z"), LETTERS, DIGITS_26)
    new_letters = F.translate(net.string("mail", letters, 26), DIGITS_26, LETTERS)
    return F.concat(spliced(spliced(body, "a-z", new_letters), "0-9",
                            net.string("mail", only(body, "0-9"), 10)), tail)


def secret(net: Keyed, m: Column) -> Column:
    """Hexadecimal keys in their case, access keys behind their prefix."""
    radix_16 = net.string("hex", F.lower(m), 16)
    access = F.concat(F.lit("AKIA"), F.upper(net.string("access", F.lower(F.substring(m, 5, 16)), 36)))
    return (F.when(m.startswith("AKIA"), access)
            .when(m == F.lower(m), radix_16).otherwise(F.upper(radix_16)))


def pseudonym(net: Keyed, m: Column) -> Column:
    """What stands in for a match; a match that fails the checks of its kind stays."""
    def like(pattern: str) -> Column:
        return m.rlike(f"^(?:{pattern})$")

    return (F.when(m.contains("@"), email(net, m))
            .when(like(_alternatives(HEX_KEY, ACCESS_KEY)), secret(net, m))
            .when(like(IBAN), iban(net, m))
            .when(like(_alternatives(ISO, DAY_FIRST)), date(net, m))
            .when(like(NAMED), named_date(net, m))
            .when(like(ADDRESS), address(net, m))
            .when(like(SOCIAL), social(net, m))
            .when(like(CARD), card(net, m))
            .otherwise(phone(net, m)))


def pseudonymise(docs: DataFrame, *, key: str = KEY, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced; all else is left as it was.

    Covers e-mail addresses, payment cards, IBANs, telephone and social security numbers, IPv4
    addresses, dates, and access keys. Lengths are kept but for unpadded dates, names of months
    and numbers of IP addresses. Missing texts stay missing, empty ones empty; rows are neither dropped nor
    joined. ``count_col`` adds how many values were replaced (0 for missing text). ``key`` is
    the secret: hand it in from a safe place.
    """
    net, text = Keyed(key), F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    between = F.split(text, ANY, -1)

    def rebuilt(new: Column) -> Column:
        return F.array_join(F.flatten(F.zip_with(
            between, new, lambda b, n: F.array(b, F.coalesce(n, F.lit(""))))), "")

    new = F.transform(found, lambda m: pseudonym(net, m))
    some = text.rlike(MAYBE)
    out = docs
    if count_col:
        changed = F.zip_with(found, new, lambda a, b: a != b)
        out = out.withColumn(count_col, F.when(some, F.size(F.filter(changed, lambda c: c))).otherwise(0))
    return out.withColumn(text_col, F.when(some, rebuilt(new)).otherwise(text))
