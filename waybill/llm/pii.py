"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Candidates are found by one pattern and validated: card numbers by their check digit, IBANs by
theirs, social security numbers, IPv4 addresses and dates by their ranges. A valid value is
permuted within its format by a keyed Feistel network: two halves, ``ROUNDS`` rounds, each adding a
keyed hash of one half to the other modulo its domain. So the pseudonym has the same format and
validity, equal values get equal pseudonyms in every document, different values get different
ones, and whoever has the key can go back (``restore``).

* card: the issuer's four digits kept, the middle permuted, the check digit set anew; 13 to 19
  digits that begin with 22-27, 30, 34-39, 4, 5 or 6, in one piece or in groups of 4-4-4-4,
  4-4-4-4 and up to three more, 4-6-4, 4-6-5 or 6-13. Where both the first 16 and all digits of
  4-4-4-4-n meet the check, the first 16 are the card. Other first digits are no card: every
  tenth number of any kind meets the check digit alone
* iban: country and letters kept, digits permuted, check digits set anew; in one piece, or in
  groups of four that end at the country's length, whatever follows
* ssn: area 001-899 without 666, group 01-99, serial 0001-9999, as one number
* date: yyyy-mm-dd, mm/dd/yyyy, dd.mm.yyyy from 1900 to 2099, as a day number; also before the
  T and hour of a timestamp, whose time stays
* ip: 32 bits; phone: ten digits behind +1; email: letters and digits of the local part (at most
  64 characters, as in the standard), case folded; secret: hex strings of 32, 40 or 64 digits, access keys, hex passwords

What fails validation is left as it is. Nothing is shuffled, and Python sees no row. Each kind can
begin only where a run of its characters begins and goes on for a bounded length, or without giving
back, so that time grows with the length of a text, whatever it holds.

Defined cases: null text stays null with no finds; empty texts stay empty. Every row is handled by
itself, whatever its doc_id; further columns pass through ``pseudonymize`` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KEY = "waybill"
DAYS = 73049  # 1900-01-01 to 2099-12-31; 319 * 229
LENGTHS = {  # of IBANs, by country
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
GROUPED = "|".join(
    f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}"
    + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![0-9A-Za-z])"
    for n, names in LENGTHS.items())
ISSUER = "(?:2[2-7]|3[04-9]|[456])"  # first digits of card numbers
TAILED = r"^[0-9]{4}(?:[ \-][0-9]{4}){3}[ \-]"  # 4-4-4-4 and more
WALK = 30
KINDS = {
    # begins where a run of its characters begins, and gives none of them back
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9](?:[A-Za-z0-9\-.]*[A-Za-z0-9])?\.[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}"
              r"|[0-9A-F]{40}|[0-9A-F]{32}|AKIA[0-9A-Z]{16}|[Pp]assword=[0-9a-f]{8,64}"
              r"|PASSWORD=[0-9A-F]{8,64})(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z\-/.])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
            r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?=T[0-9]{2}|(?![0-9A-Za-z]|[\-/.][0-9]))",
    "ssn": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z])\+1[ .\-]?(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}"
             r"(?![0-9A-Za-z])",
    "iban": rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}})(?:{GROUPED}|[A-Z]{{2}}[0-9]{{2}}"
            r"[A-Z0-9]{11,30}|[A-Z]{2}[0-9]{2} [A-Z0-9]{4}(?: (?=[A-Z]*[0-9])[A-Z0-9]{4}){1,6}(?: (?=[A-Z]*[0-9])[A-Z0-9]{1,3})?)"
            r"(?![0-9A-Za-z])",
    # up to three digits behind 4-4-4-4 are not the begin of a date, an address or the like
    "card": rf"(?<![0-9A-Za-z.])(?={ISSUER})(?:[0-9]{{13,19}}|[0-9]{{4}}(?:[ \-][0-9]{{4}}){{3}}"
            r"(?:[ \-][0-9]{1,3}(?![0-9A-Za-z_%+@/\-]|\.[0-9A-Za-z._%+@\-]))?"
            r"|3[0689][0-9]{2}[ \-][0-9]{6}[ \-][0-9]{4}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5}"
            r"|[56][0-9]{5}[ \-][0-9]{13})(?![0-9A-Za-z])",
}
PATTERN = "|".join(KINDS.values())
DIGITS = "0123456789"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tweak: Column,
            back: bool = False) -> Column:
    """A keyed permutation of the pairs (left < a, right < b), as struct (l, r)."""

    def part(turn: Column, x: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), x.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")

    def step(s: Column, turn: Column) -> Column:
        add = (lambda x, y, m: F.pmod(x - F.pmod(y, m), m)) if back else (
            lambda x, y, m: F.pmod(x + F.pmod(y, m), m))
        return F.when(turn % 2 == 0, F.struct(add(s["l"], part(turn, s["r"]), a).alias("l"),
                                              s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), add(s["r"], part(turn, s["l"]), b).alias("r")))

    turns = list(range(ROUNDS))
    return F.aggregate(F.array(*(F.lit(i) for i in (turns[::-1] if back else turns))),
                       F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _power(base: int, n: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(0), n), F.lit(1).cast("long"),
                       lambda p, i: F.when(i == 0, p).otherwise(p * base))


def permute(text: Column, base: int, key: str, tweak: str, back: bool = False) -> Column:
    """Permutes strings of digits of a base (10, 16 or 36) among those of the same length; long
    strings in pieces."""
    size = {10: 18, 16: 24, 36: 22}[base]

    def piece(j: Column) -> Column:
        def halves(s: Column) -> Column:
            n = F.length(s)
            m = (n / 2).cast("int")
            number = lambda x: F.coalesce(F.conv(x, base, 10), F.lit("0")).cast("long")
            text_of = lambda x, k: F.when(k == 0, "").otherwise(
                F.lpad(F.lower(F.conv(x.cast("string"), 10, base)), k, "0"))
            mixed = feistel(number(F.substring(s, F.lit(1), m)),
                            number(F.substring(s, m + 1, n - m)), _power(base, m),
                            _power(base, n - m), key,
                            F.concat_ws("|", F.lit(tweak), j.cast("string"), n.cast("string")),
                            back)
            return _let(mixed, lambda x: F.concat(text_of(x["l"], m), text_of(x["r"], n - m)))

        return _let(F.substring(text, j * size + 1, F.lit(size)), halves)

    count = F.ceil(F.length(text) / size).cast("int")
    return F.when(F.length(text) == 0, "").otherwise(
        F.array_join(F.transform(F.sequence(F.lit(0), count - 1), piece), ""))


def _only(text: Column, chars: str) -> Column:
    return F.regexp_replace(text, f"[^{chars}]", "")


def _refilled(shape: Column, new: Column, chars: str) -> Column:
    """``shape`` with its characters of the class replaced, one by one, by those of ``new``."""
    between = F.split(shape, f"[{chars}]", -1)
    own = F.concat(F.split(new, "", -1), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, F.slice(own, F.lit(1), F.size(between)),
                                   lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check; valid numbers give a multiple of ten."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (n - i) % 2 == 1
        return total + F.when(twice & (d > 4), d * 2 - 9).when(twice, d * 2).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(m: Column, key: str, back: bool) -> Column:
    def once(d: Column) -> Column:
        head = F.concat(F.substring(d, 1, 4),
                        permute(F.substring(d, F.lit(5), F.length(d) - 5), 10, key, "card", back))
        return _let(head, lambda h: F.concat(
            h, F.pmod(10 - _luhn(F.concat(h, F.lit("0"))) % 10, F.lit(10)).cast("string")))

    def first_is_card(d: Column) -> Column:
        return _luhn(F.substring(d, 1, 16)) % 10 == 0

    def use(s: Column) -> Column:
        card, more, d = s["card"], s["more"], _only(s["card"], "0-9")
        # 4-4-4-4-n goes on until its first 16 digits are no card, so that the way back sees it so
        new = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), d, lambda x, i: F.when(
            (i == 1) | (card.rlike(TAILED) & first_is_card(x)), once(x)).otherwise(x))
        valid = d.rlike(f"^{ISSUER}") & (_luhn(d) % 10 == 0)
        return F.when(valid, _let(new, lambda w: F.concat(_refilled(card, w, "0-9"), more)))

    short = m.rlike(TAILED) & first_is_card(_only(m, "0-9"))
    return _let(F.struct(F.when(short, F.substring(m, 1, 19)).otherwise(m).alias("card"),
                         F.when(short, F.substring(m, F.lit(20), F.length(m))).otherwise("")
                         .alias("more")), use)


def _mod97(text: Column) -> Column:
    """Letters count as 10 to 35."""
    def add(r: Column, i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        v = F.conv(c, 36, 10).cast("int")
        return F.when(v > 9, (r * 100 + v) % 97).otherwise((r * 10 + v) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _iban(m: Column, key: str, back: bool) -> Column:
    def use(s: Column) -> Column:
        country, rest = F.substring(s, 1, 2), F.substring(s, F.lit(5), F.length(s))
        valid = _mod97(F.concat(rest, F.substring(s, 1, 4))) == 1
        moved = _let(permute(_only(rest, "0-9"), 10, key, "iban", back),
                     lambda d: _refilled(rest, d, "0-9"))
        whole = _let(moved, lambda r: F.concat(
            country, F.lpad((98 - _mod97(F.concat(r, country, F.lit("00")))).cast("string"), 2,
                            "0"), r))
        return F.when(valid, _let(whole, lambda w: _refilled(m, w, "A-Z0-9")))

    return _let(F.regexp_replace(m, " ", ""), use)


def _ssn(m: Column, key: str, back: bool) -> Column:
    area, group, serial = (F.substring(m, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    mixed = feistel(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key,
                    F.lit("ssn"), back)

    def text(x: Column) -> Column:
        i = F.floor(x["l"] / 99).cast("int")
        return F.concat_ws("-", F.lpad(F.when(i > 664, i + 2).otherwise(i + 1).cast("string"), 3,
                                       "0"),
                           F.lpad((x["l"] % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((x["r"] + 1).cast("string"), 4, "0"))

    return F.when(valid, _let(mixed, text))


def _ip(m: Column, key: str, back: bool) -> Column:
    def use(p: Column) -> Column:
        part = [F.element_at(p, i + 1).cast("int") for i in range(4)]
        plain = ~F.exists(p, lambda x: (F.length(x) > 1) & x.startswith("0"))
        mixed = feistel(part[0] * 256 + part[1], part[2] * 256 + part[3], F.lit(65536),
                        F.lit(65536), key, F.lit("ip"), back)
        valid = plain & (F.greatest(*part) <= 255)
        return F.when(valid, _let(mixed, lambda x: F.concat_ws(
            ".", *(y.cast("int").cast("string") for s in ("l", "r")
                   for y in (F.floor(x[s] / 256), x[s] % 256)))))

    return _let(F.split(m, r"\.", -1), use)


def _date(m: Column, key: str, back: bool) -> Column:
    iso, us = m.contains("-"), m.contains("/")
    number = lambda a, n: F.substring(m, a, n).cast("int")
    year = F.when(iso, number(1, 4)).otherwise(number(7, 4))
    month = F.when(iso, number(6, 2)).when(us, number(1, 2)).otherwise(number(4, 2))
    day = F.when(iso, number(9, 2)).when(us, number(4, 2)).otherwise(number(1, 2))
    start = F.lit("1900-01-01").cast("date")
    fits = year.between(1900, 2099) & month.between(1, 12) & (day >= 1)
    valid = F.when(fits, day <= F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1)))))
    n = F.datediff(F.make_date(year, month, day), start)
    mixed = feistel(F.floor(n / 229), n % 229, F.lit(319), F.lit(229), key, F.lit("date"), back)

    def text(x: Column) -> Column:
        at = F.date_add(start, (x["l"] * 229 + x["r"]).cast("int"))
        return (F.when(iso, F.date_format(at, "yyyy-MM-dd"))
                .when(us, F.date_format(at, "MM/dd/yyyy")).otherwise(
                    F.date_format(at, "dd.MM.yyyy")))

    return F.when(valid, _let(mixed, text))


def _phone(m: Column, key: str, back: bool) -> Column:
    rest = F.substring(m, F.lit(3), F.length(m))
    return F.concat(F.lit("+1"), _let(permute(_only(rest, "0-9"), 10, key, "phone", back),
                                      lambda d: _refilled(rest, d, "0-9")))


def _email(m: Column, key: str, back: bool) -> Column:
    local = F.lower(F.substring_index(m, "@", 1))
    return F.concat(_let(permute(_only(local, "0-9a-z"), 36, key, "email", back),
                         lambda d: _refilled(local, d, "0-9a-z")), F.lit("@"),
                    F.substring_index(m, "@", -1))


def _secret(m: Column, key: str, back: bool) -> Column:
    access = F.concat(F.lit("AKIA"), F.upper(permute(
        F.lower(F.substring(m, F.lit(5), F.length(m))), 36, key, "access", back)))
    digits = F.regexp_extract(m, "[0-9A-Fa-f]+$", 0)
    large = digits.rlike("[A-F]") | m.startswith("PASSWORD")
    new = _let(permute(F.lower(digits), 16, key, "secret", back),
               lambda d: F.when(large, F.upper(d)).otherwise(d))
    return F.when(m.startswith("AKIA"), access).otherwise(
        F.concat(F.regexp_extract(m, "^(?:.*=)?", 0), new))


RULES = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn,
         "phone": _phone, "iban": _iban, "card": _card}


def _named(kind: str, m: Column, text: Column) -> Column:
    return F.struct(F.when(text.isNotNull(), F.lit(kind)).alias("kind"),
                    F.coalesce(text, m).alias("text"))


def _value(m: Column, key: str, back: bool) -> Column:
    """(kind, text) of a candidate; kind is null where validation fails."""
    out = F.lit(None).cast("struct<kind:string,text:string>")
    for kind, rule in reversed(RULES.items()):
        # in the pattern's order; the look-arounds see no neighbours in the match alone
        made = _let(rule(m, key, back), partial(_named, kind, m))
        out = F.when(m.rlike(f"^(?:{KINDS[kind]})$"), made).otherwise(out)
    return F.coalesce(out, F.struct(F.lit(None).cast("string").alias("kind"), m.alias("text")))


def find(docs: DataFrame, key: str = KEY, back: bool = False) -> DataFrame:
    """(row, text, n_found, kinds): ``row`` is a struct of the documents' other columns."""
    maybe = F.col("text").rlike("[0-9@]")
    values = F.when(maybe, F.transform(F.regexp_extract_all("text", F.lit(PATTERN), 0),
                                       lambda m: _value(m, key, back)))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    step = docs.select(row, "text", values.alias("found"))
    pieces = F.split("text", PATTERN, -1)
    joined = F.array_join(F.flatten(F.zip_with(
        pieces, F.col("found.text"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    kinds = F.filter("found.kind", lambda k: k.isNotNull())
    return step.select(
        "row", F.when(F.size("found") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(kinds), F.lit(0)).cast("long").alias("n_found"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(kinds)), ","), F.lit(""))
        .alias("kinds"))


def _documents(found: DataFrame, columns: list[str]) -> DataFrame:
    return found.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in columns))


def pseudonymize(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The documents, all columns, with their text rewritten."""
    return _documents(find(docs, key), docs.columns)


def restore(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The inverse, but for the case of mail addresses."""
    return _documents(find(docs, key, back=True), docs.columns)
