"""Keyed format-preserving pseudonyms for personal numbers, dates, addresses and secrets, in Spark expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Feistel rounds; an even number.
ROUNDS = 8
_WORD = r"A-Za-z0-9_"
#: A value after the name of a secret: letters and digits mixed, so that plain words and numbers stay.
_MIXED = r"(?=[A-Za-z_./+~-]{0,64}[0-9])(?=[0-9_./+~-]{0,64}[A-Za-z])"
_NAMED = rf"(?<=[ :=\"'])(?<![{_WORD}]){_MIXED}(?<=(?i:password|passwd|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|secret[_ -]?key)[\"']? {{0,2}}[:=] {{0,2}}[\"']?)"
#: Words before a number of four parts that isn't an address, and before digits in groups that are a telephone number.
_VERSION = r"(?=[0-9]{1,3}\.[0-9])(?<!(?i:version|release|firmware|build|ver\.|rev\.)[ :=]{1,2})"
_CALL = r"(?=[(0-9])(?<= )(?=\(?[0-9]{3}\)? [0-9]{3})(?<=(?i:phone|telephone|tel|mobile|cell|call|fax|dial)[.:]? {1,2}(?:(?i:us|me|is) )?(?:(?i:at|on) )?)"
_HEX = "[0-9A-Fa-f]{1,4}"
#: What may be personal. Every form has a digit, ``@`` or ``=``; numbers are checked before they count.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "key": rf"(?<![{_WORD}])(?:AKIA|ASIA)[A-Z0-9]{{16}}(?![{_WORD}])",
    "secret": r"(?<=password=)[A-Za-z0-9]{6,}|(?<=token = \")[A-Za-z0-9]{8,}(?=\")|(?<=token=)[A-Za-z0-9]{8,}|(?<=secret=)[A-Za-z0-9]{6,}"
              rf"|{_NAMED}[A-Za-z0-9_./+~-]{{6,}}+(?<![./])|(?<=[Bb]earer ){_MIXED}[A-Za-z0-9_./+~-]{{12,}}+(?<![./])",
    "iban": rf"(?<![{_WORD}])[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_WORD}])",
    "ip6": rf"(?=[0-9A-Fa-f:]{{0,4}}:)(?<![{_WORD}:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[A-Fa-f:]{{0,24}}[0-9])(?:{_HEX}(?::{_HEX}){{0,5}})?::(?:{_HEX}(?::{_HEX}){{0,5}}))(?![{_WORD}:]|\.[0-9])",
    "ip": rf"(?<![{_WORD}.]){_VERSION}[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}(?![{_WORD}]|\.[0-9])",
    "date": rf"(?<![{_WORD}./-])(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}})(?![{_WORD}/-])",
    "ssn": rf"(?<![{_WORD}-])(?!000|666)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)[0-9]{{4}}(?![{_WORD}-])",
    "phone": rf"(?<![{_WORD}+])\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})(?:[ .-]?[0-9]{{2,4}}){{1,4}}(?![{_WORD}])"
             rf"|(?<![{_WORD}])\([0-9]{{3}}\) ?[0-9]{{3}}-[0-9]{{4}}(?![{_WORD}])|(?<![{_WORD}-])[0-9]{{3}}[-.][0-9]{{3}}[-.][0-9]{{4}}(?![{_WORD}-])"
             rf"|{_CALL}(?:\(?[0-9]{{3}}\)? )?[0-9]{{3}} [0-9]{{4}}(?![{_WORD}-]| [0-9])",
    "card": rf"(?<![{_WORD}])[0-9](?:[ -]?[0-9]){{12,18}}(?![{_WORD}])",
}
#: What is looked for in turn: each row's valid account and card numbers join the first step, odd groupings of cards come last.
_STEPS = (("email", "key", "secret"), ("ip6", "ip", "date", "ssn", "phone"), ("card",))
_BEFORE, _AFTER = rf"(?<![{_WORD}+])", rf"(?![{_WORD}])"
#: Card numbers as they are grouped, with one separator, and such of 4-4-4-4 with more; from one place at most one of each matches.
_CARDS = (r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,4}|[0-9]{4}([ -])(?:[0-9]{6}\3[0-9]{4,5}|[0-9]{5}\3[0-9]{6})"
          r"|[0-9]{5}([ -])[0-9]{5}\4[0-9]{5}|[0-9]{8}[ -][0-9]{8}|[0-9]{6}[ -][0-9]{13}",
          r"[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4}\2[0-9]{1,3}")
#: Characters of account numbers by country (ISO 13616).
_LANDS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
          23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
          28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_FIRST_DAY, _DAYS = "1900-01-01", (229, 319)  # 73051 days, to 2100-01-02


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _keyed(key: str, *parts: Column) -> Column:
    """A number of 48 bits that only the key's holder can compute."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts), 256), 1, 12), 16, 10).cast("long")


def _permuted(values: Column, radix: Column, key: str, kind: str) -> Column:
    """A keyed permutation of arrays of numbers, the i-th below the i-th radix: alternating halves shift each other."""
    half = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - half

    def step(acc: Column, i: Column) -> Column:
        held = F.array_join(F.transform(acc["b"], lambda v: v.cast("string")), ",")
        moved = F.transform(acc["a"], lambda v, at: F.pmod(v + _keyed(key, F.lit(kind), i.cast("string"), at.cast("string"), held), F.get(acc["ra"], at)))
        return F.struct(acc["b"].alias("a"), moved.alias("b"), acc["rb"].alias("ra"), acc["ra"].alias("rb"))

    start = F.struct(F.slice(values, F.lit(1), half).alias("a"), F.slice(values, half + 1, rest).alias("b"),
                     F.slice(radix, F.lit(1), half).alias("ra"), F.slice(radix, half + 1, rest).alias("rb"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda acc: F.concat(acc["a"], acc["b"]))


def _in_classes(s: Column, key: str, kind: str, hexadecimal: bool = False) -> Column:
    """Letters become letters of the same case, digits digits (or all hexadecimal digits such); other characters stay."""
    chars = _chars(s)
    if hexadecimal:
        values = F.transform(chars, lambda c: F.conv(c, 16, 10).cast("long"))
        out = _permuted(values, F.transform(chars, lambda c: F.lit(16).cast("long")), key, kind)
        return F.array_join(F.transform(out, lambda v: F.lower(F.hex(v))), "")
    base = lambda c: F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65).otherwise(0)
    size = lambda c: F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1).cast("long")
    values = F.transform(chars, lambda c: F.when(base(c) > 0, F.ascii(c) - base(c)).otherwise(0).cast("long"))
    out = _permuted(values, F.transform(chars, size), key, kind)
    return F.array_join(F.zip_with(chars, out, lambda c, v: F.when(base(c) > 0, F.chr(v + base(c))).otherwise(c)), "")


def _numbers(digits: Column, key: str, kind: str) -> Column:
    """Digits permuted; the first stays within 0-1 or 2-9, as numbering plans ask."""
    chars = _chars(digits)
    low = lambda c, i: F.when((i == 0) & (c >= "2"), 2).otherwise(0)
    radix = F.transform(chars, lambda c, i: F.when(i > 0, 10).when(c >= "2", 8).otherwise(2).cast("long"))
    out = _permuted(F.transform(chars, lambda c, i: c.cast("long") - low(c, i)), radix, key, kind)
    return F.array_join(F.zip_with(F.transform(chars, lambda c, i: F.struct(low(c, i).alias("low"))), out, lambda c, v: (v + c["low"]).cast("string")), "")


def _put_back(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, one by one."""
    return F.array_join(F.transform(_chars(form), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(form, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of digits, the last one counted once."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + F.when(value(i) > 9, value(i) - 9).otherwise(value(i)))


def _mod97(s: Column) -> Column:
    """Remainder of an account number by 97, its first four characters moved to the end and letters taken as 10 to 35."""
    moved = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))
    return F.aggregate(_chars(moved), F.lit(0).cast("long"), lambda acc, c: F.when(
        c.rlike("[0-9]"), (acc * 10 + c.cast("long")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))


def _email(m: Column, key: str) -> Column:
    return F.concat(_in_classes(F.substring_index(m, "@", 1), key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _card(m: Column, key: str) -> Column:
    def moved(digits: Column) -> Column:
        inner = _numbers_plain(F.substring(digits, F.lit(2), F.length(digits) - 2), key, "card")
        return _let(F.concat(F.substring(digits, 1, 1), inner), lambda body: _let(
            F.concat(body, F.pmod(10 - F.pmod(_let(F.concat(body, F.lit("0")), _luhn), F.lit(10)), F.lit(10)).cast("string")), lambda made: _put_back(m, made)))
    return _let(_digits(m), lambda digits: F.when(F.pmod(_luhn(digits), F.lit(10)) == 0, moved(digits)).otherwise(m))


def _numbers_plain(digits: Column, key: str, kind: str) -> Column:
    chars = _chars(digits)
    out = _permuted(F.transform(chars, lambda c: c.cast("long")), F.transform(chars, lambda c: F.lit(10).cast("long")), key, kind)
    return F.array_join(F.transform(out, lambda v: v.cast("string")), "")


def _ip(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("long"))
    out = _permuted(parts, F.transform(parts, lambda p: F.lit(256).cast("long")), key, "ip")
    return F.when(F.forall(parts, lambda p: p < 256), F.array_join(F.transform(out, lambda v: v.cast("string")), ".")).otherwise(m)


def _ip6(m: Column, key: str) -> Column:
    """The digits of all groups permuted; where groups are left out, ``::`` stays."""
    return _let(F.regexp_replace(m, ":", ""), lambda plain: _let(_in_classes(plain, key, "ip6", hexadecimal=True), lambda made: F.array_join(F.transform(
        _chars(m), lambda c, i: F.when(c == ":", c).otherwise(F.substring(made, F.length(F.regexp_replace(F.substring(m, F.lit(1), i + 1), ":", "")), F.lit(1)))), "")))


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 999 without 666, groups from 01, numbers from 0001."""
    number = lambda at, n: F.substring(m, at, n).cast("long")
    parts = F.array(number(1, 3) - F.when(number(1, 3) > 666, 2).otherwise(1), number(5, 2) - 1, number(8, 4) - 1)
    area = lambda v: v + F.when(v >= 665, 2).otherwise(1)
    part = lambda v, n: F.lpad(v.cast("string"), n, "0")
    return _let(_permuted(parts, F.array(*(F.lit(n).cast("long") for n in (998, 99, 9999))), key, "ssn"), lambda p: F.concat_ws(
        "-", part(area(F.get(p, F.lit(0))), 3), part(F.get(p, F.lit(1)) + 1, 2), part(F.get(p, F.lit(2)) + 1, 4)))


def _date(m: Column, key: str) -> Column:
    iso, dots = m.rlike("^[0-9]{4}-"), m.contains(".")
    number = lambda at, n: F.substring(m, at, n).cast("int")
    year = F.when(iso, number(1, 4)).otherwise(number(7, 4))
    # with slashes the month comes first unless only the other order is a date
    month_first = ~iso & ~dots & (number(1, 2) <= 12)
    month = F.when(iso, number(6, 2)).when(month_first, number(1, 2)).otherwise(number(4, 2))
    day = F.when(iso, number(9, 2)).when(month_first, number(4, 2)).otherwise(number(1, 2))
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    longest = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (year >= 1900) & (year < 2100) & (month >= 1) & (month <= 12) & (day >= 1) & (day <= longest)
    at = F.datediff(F.make_date(year, month, day), F.lit(_FIRST_DAY).cast("date")).cast("long")
    pair = F.array(F.floor(at / _DAYS[1]).cast("long"), F.pmod(at, F.lit(_DAYS[1])).cast("long"))
    moved = _let(_permuted(pair, F.array(*(F.lit(d).cast("long") for d in _DAYS)), key, "date"),
                 lambda p: F.date_add(F.lit(_FIRST_DAY).cast("date"), (F.get(p, F.lit(0)) * _DAYS[1] + F.get(p, F.lit(1))).cast("int")))
    form = F.when(iso, "yyyy-MM-dd").when(dots, "dd.MM.yyyy").when(month_first, "MM/dd/yyyy").otherwise("dd/MM/yyyy")
    written = lambda out: F.when(form == "yyyy-MM-dd", F.date_format(out, "yyyy-MM-dd")).when(form == "dd.MM.yyyy", F.date_format(out, "dd.MM.yyyy")).when(
        form == "MM/dd/yyyy", F.date_format(out, "MM/dd/yyyy")).otherwise(F.date_format(out, "dd/MM/yyyy"))
    return F.when(valid, _let(moved, written)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    country = F.regexp_extract(m, r"^\+([0-9]{1,3})", 1)
    rest = F.substring(m, F.when(country != "", F.length(country) + 2).otherwise(1), F.length(m))
    return _let(rest, lambda r: F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(r)), _let(_numbers(_digits(r), key, "phone"), lambda d: _put_back(r, d))))


def _iban(m: Column, key: str) -> Column:
    def spaced(made: Column) -> Column:
        return F.array_join(F.transform(_chars(m), lambda c, i: F.when(c == " ", c).otherwise(
            F.substring(made, F.length(F.replace(F.substring(m, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), "")

    def moved(plain: Column) -> Column:
        land = F.substring(plain, 1, 2)
        return _let(_in_classes(F.substring(plain, F.lit(5), F.length(plain)), key, "iban"), lambda body: _let(
            F.concat(land, F.lpad((98 - _mod97(F.concat(land, F.lit("00"), body))).cast("string"), 2, "0"), body), spaced))

    return _let(F.replace(m, F.lit(" "), F.lit("")), lambda plain: F.when((F.length(plain) >= 15) & (_mod97(plain) == 1), moved(plain)).otherwise(m))


def pseudonym(m: Column, key: str, kinds: tuple[str, ...] = tuple(FORMS)) -> Column:
    """The pseudonym of one found value of one of these kinds; itself where its number is not valid."""
    whole = {kind: m.rlike("^(?:" + form + ")$") for kind, form in FORMS.items()}
    ways = {
        "email": (m.contains("@"), lambda: _email(m, key)), "ip6": (whole["ip6"], lambda: _ip6(m, key)), "ip": (whole["ip"], lambda: _ip(m, key)), "date": (whole["date"], lambda: _date(m, key)),
        "ssn": (whole["ssn"], lambda: _ssn(m, key)),
        "card": (whole["card"] & ~m.startswith("+"), lambda: _card(m, key)), 
        "phone": (whole["phone"] | m.rlike(r"^(?:\(?[0-9]{3}\)? )?[0-9]{3} [0-9]{4}$"), lambda: _phone(m, key)),
        "key": (whole["key"], lambda: F.concat(F.substring(m, 1, 4), _in_classes(F.substring(m, F.lit(5), F.length(m)), key, "key"))),
        "iban": (whole["iban"], lambda: _iban(m, key)), "secret": (m.rlike("^[0-9a-f]+$"), lambda: _in_classes(m, key, "secret", hexadecimal=True)),
    }
    out = F
    for kind, (found, made) in ways.items():
        out = out.when(found, made()) if kind in kinds else out
    return out.otherwise(_in_classes(m, key, "secret") if "secret" in kinds else m)


def _listed(values: Column, before: str) -> Column:
    """A further alternative of a pattern that finds these values, digits, capitals, spaces and hyphens only; nothing without values."""
    return F.when(F.size(values) > 0, F.concat(F.lit("|" + before + "(?:"), F.array_join(F.array_distinct(values), "|"), F.lit(")" + _AFTER))).otherwise("")


def _valid_cards(text: Column) -> Column:
    """The card numbers of a text, from any place on, the longest first."""
    found = F.concat(*(F.regexp_extract_all(text, F.lit(f"{_BEFORE}(?=({form}){_AFTER})"), F.lit(1)) for form in reversed(_CARDS)))
    valid = F.filter(found, lambda m: F.pmod(_let(_digits(m), _luhn), F.lit(10)) == 0)
    return F.when(text.rlike("[0-9][0-9 -]{11,}[0-9]"), valid).otherwise(F.array().cast("array<string>"))


def _valid_accounts(text: Column) -> Column:
    """The account numbers of a text, from any place on and of any length, those of their country's length first, then the longest."""
    lands = F.lit(" " + " ".join(f"{land}{n}" for n, names in _LANDS.items() for land in names.split()) + " ")
    whole = f"^(?:{FORMS['iban']})$"

    def ends(run: Column) -> Column:
        """Every part of a run from its first character on that ends with a word, with what it is without spaces."""
        cuts = F.filter(F.sequence(F.lit(15), F.greatest(F.length(run), F.lit(15))), lambda n: ~F.substring(run, n + 1, F.lit(1)).rlike(f"[{_WORD}]"))
        parts = F.transform(cuts, lambda n: F.substring(run, F.lit(1), n))
        return F.transform(F.filter(parts, lambda m: m.rlike(whole)), lambda m: F.struct(F.replace(m, F.lit(" "), F.lit("")).alias("plain"), m.alias("m")))

    # at most 43 characters and the one after them
    runs = F.regexp_extract_all(text, F.lit(rf"(?<![{_WORD}])(?=([A-Z]{{2}}[0-9]{{2}}[{_WORD} ]{{11,40}}))"), F.lit(1))
    valid = F.filter(F.flatten(F.transform(runs, ends)), lambda x: (F.length(x["plain"]) >= 15) & (_mod97(x["plain"]) == 1))
    usual = lambda x: F.contains(lands, F.concat(F.lit(" "), F.substring(x["plain"], 1, 2), F.length(x["plain"]).cast("string"), F.lit(" ")))
    ranked = F.array_sort(F.transform(valid, lambda x: F.struct((~usual(x)).alias("other"), (-F.length(x["m"])).alias("n"), x["m"].alias("m"))))
    return F.when(text.rlike("[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"), F.transform(ranked, lambda x: x["m"])).otherwise(F.array().cast("array<string>"))


def _form(kinds: tuple[str, ...]) -> Column:
    return F.lit("|".join(FORMS[kind] for kind in kinds))


def _cut(pieces: Column, form: Column, key: str, kinds: tuple[str, ...]) -> Column:
    """Pieces of a text, where those without a pseudonym (null) are cut at what has the form."""
    def cut(piece: Column) -> Column:
        plain = F.transform(F.split(piece["old"], form, -1), lambda s: F.struct(s.alias("old"), F.lit(None).cast("string").alias("new")))
        found = F.transform(F.regexp_extract_all(piece["old"], form, F.lit(0)), lambda m: F.struct(m.alias("old"), pseudonym(m, key, kinds).alias("new")))
        return F.filter(F.flatten(F.zip_with(plain, found, lambda p, f: F.array(p, f))), lambda x: x["old"] != "")

    return F.flatten(F.transform(pieces, lambda piece: F.when(piece["new"].isNull(), cut(piece)).otherwise(F.array(piece))))


def _named(column: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def replace_personal(docs: DataFrame, key: str, text: str = "text", count: str = "n_replaced") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and their number in ``count``.

    E-mail names, card numbers (Luhn), account numbers (mod 97), IPv4 addresses (not after words such as "version"), IPv6 addresses,
    dates from 1900 to 2099, social security numbers (no area 000 or 666, group 00 or number 0000), telephone numbers (digits parted by
    spaces alone only after words such as "call"), access keys, passwords and tokens (after their name and ``:`` or ``=``, letters and digits mixed) go through a keyed Feistel network over their
    own characters: lengths, separators, letter case, card and account check digits, country codes,
    date and address ranges stay valid, and equal values get equal pseudonyms in all documents.
    Card numbers in their usual groups and account numbers are found from any word on and up to any that they can end with, so numbers
    and words beside them do not hide them; cards in other groups are found where the whole run of digits is one.
    Numbers that fail their check stay. Null and empty texts stay with count 0, texts of any length are read whole; all rows, repeated
    ones too, and columns of any name return, and a column already named ``count`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != count.lower()]
    held = "pieces"
    while held in {c.lower() for c in (*kept, count)}:
        held += "_"
    old, pieces_ = _named(text), _named(held)
    whole = F.array(F.struct(old.alias("old"), F.lit(None).cast("string").alias("new")))
    first = F.concat(_form(_STEPS[0]), _listed(_valid_accounts(old), rf"(?<![{_WORD}])"), _listed(_valid_cards(old), _BEFORE))
    pieces = _let(first, lambda form: _cut(whole, form, key, (*_STEPS[0], "iban", "card")))
    for kinds in _STEPS[1:]:
        pieces = _cut(pieces, _form(kinds), key, kinds)
    # texts without a digit, @ or = hold none of the forms
    pieces = F.when(old.rlike("[0-9@=]"), pieces).otherwise(F.array().cast("array<struct<old:string,new:string>>"))
    rows = docs.select(*map(_named, kept), pieces.alias(held))
    changed = F.when(F.size(pieces_) > 0, F.array_join(F.transform(pieces_, lambda x: F.coalesce(x["new"], x["old"])), "")).otherwise(old)
    n = F.size(F.filter(pieces_, lambda x: x["new"].isNotNull() & (x["old"] != x["new"])))
    return rows.select(*(changed.alias(c) if c == text else _named(c) for c in kept), F.greatest(n, F.lit(0)).cast("long").alias(count))
