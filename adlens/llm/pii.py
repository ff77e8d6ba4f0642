"""Format-preserving pseudonyms for personal data (keyed Feistel permutation).

A text is scanned once for candidates; a candidate that passes its kind's
validation is replaced by the value that a keyed permutation of the kind's
format gives it: equal values get equal pseudonyms in every document, and
different values of one format different ones. Each kind is a row of symbols
with radices; alternating Feistel rounds add a keyed SHA-256 stream of one
half to the other, modulo each symbol's radix, so every radix mix is permuted
within itself.

========  ==================================  ==============================
kind      validated by                        permuted
========  ==================================  ==============================
card      13-19 digits, Luhn sum              digits, last one recomputed
iban      shape and remainder 97              account part, check recomputed
ssn       area, group and serial in use       (area, group and serial)
phone     7-15 digits after +, or (nnn) nnn-  digits after the country code
date      a calendar date 1900-2099           day number (4297 x 17 days)
ipv4      four octets                         octets
email     local part, domain                  letters and digits, all but the
                                              last two domain labels
secret    token, secret, password, api key    letters and digits (hex as hex)
          = "..."
========  ==================================  ==============================

Dates are written YYYY-MM-DD, DD.MM.YYYY or MM/DD/YYYY (DD/MM/YYYY if only
that is a date). Numbers that fail validation are left alone, and so is all
other text. Only DataFrame functions are used: no shuffle, each row alone.

Defined results: null texts stay null; empty texts and texts without values
stay as they are; values are found wherever they stand in texts of any length
(all repetitions in the patterns are bounded); a value whose format has a
single member maps to itself; other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import fresh

KEY = "corpus-pseudonyms"  # replace by a secret of your own
ROUNDS = 8

HEX = "0123456789abcdef"
_ALNUM = "A-Za-z0-9"
PATTERNS = {
    "secret": r"""(?i:token|secret|password|passwd|api[_-]?key)\s{0,3}[=:]\s{0,3}["'][A-Za-z0-9+/_=.-]{8,256}["']""",
    "email": rf"(?<![{_ALNUM}._%+-])[{_ALNUM}._%+-]{{1,64}}+@(?:[{_ALNUM}-]{{1,63}}\.){{1,8}}[A-Za-z]{{2,24}}(?![{_ALNUM}])",
    "iban": rf"(?<![{_ALNUM}])[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_ALNUM}])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]|\.[0-9])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (r"(?:(?<![0-9+])\+1[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9+])\+[0-9]{7,15}(?![0-9])"
              r"|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]\(?[0-9]{1,4}\)?){2,4}(?![0-9]|\.[0-9])"
              r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-]))"),
    "card": (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?<sep>[ -])[0-9]{4}\k<sep>[0-9]{4}\k<sep>[0-9]{4}"
             r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"),
}
ANY = "|".join(PATTERNS.values())


def feistel(x: Column, key: str) -> Column:
    """Keyed permutation of the symbols ``x.values``, each within its radix in
    ``x.radices``; ``x.kind`` is the tweak."""
    half = F.floor(F.size(x["values"]) / 2).cast("int")
    rest = F.size(x["values"]) - half
    state = F.struct(F.slice(x["values"], F.lit(1), half).alias("l"), F.slice(x["values"], half + 1, rest).alias("r"),
                     F.slice(x["radices"], F.lit(1), half).alias("bl"), F.slice(x["radices"], half + 1, rest).alias("br"),
                     x["kind"].alias("kind"))

    def mixed(a: Column, part: str, base: str, other: str, rnd: Column) -> Column:
        seen = F.concat_ws(":", F.lit(key), a["kind"], rnd.cast("string"), F.array_join(a[other].cast("array<string>"), ","))
        return F.transform(a[part], lambda v, i: F.pmod(v + F.conv(F.substring(
            F.sha2(F.concat_ws(":", seen, i.cast("string")), 256), 1, 12), 16, 10).cast("long"), F.get(a[base], i)))

    return F.aggregate(
        F.array(*[F.lit(r) for r in range(ROUNDS)]), state,
        lambda a, rnd: F.when(rnd % 2 == 0, F.struct(mixed(a, "l", "bl", "r", rnd).alias("l"), a["r"].alias("r"),
                                                     a["bl"].alias("bl"), a["br"].alias("br"), a["kind"].alias("kind")))
        .otherwise(F.struct(a["l"].alias("l"), mixed(a, "r", "br", "l", rnd).alias("r"), a["bl"].alias("bl"),
                            a["br"].alias("br"), a["kind"].alias("kind"))),
        lambda a: F.concat(a["l"], a["r"]))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _start(c: Column) -> Column:
    return F.when(c.between("0", "9"), 48).when(c.between("A", "Z"), 65).otherwise(97)


def _value(c: Column, hexadecimal: Column) -> Column:
    return F.when(hexadecimal, F.instr(F.lit(HEX), F.lower(c)) - 1).otherwise(F.ascii(c) - _start(c)).cast("long")


def _radix(c: Column, hexadecimal: Column) -> Column:
    return F.when(hexadecimal, 16).when(c.between("0", "9"), 10).otherwise(26).cast("long")


def _refill(s: Column, symbols: Column, hexadecimal: Column, lower: Column) -> Column:
    """``s`` with its letters and digits replaced, in order, by symbols."""

    def char(c: Column, v: Column) -> Column:
        digit = F.substring(F.lit(HEX), (v + 1).cast("int"), F.lit(1))
        return F.when(hexadecimal, F.when(lower, digit).otherwise(F.upper(digit))).otherwise(F.char(_start(c) + v))

    return F.aggregate(
        _chars(s), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")),
        lambda a, c: F.when(c.rlike(f"[{_ALNUM}]"), F.struct(F.concat(a["out"], char(c, F.get(symbols, a["k"]))).alias("out"),
                                                           (a["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["k"].alias("k"))),
        lambda a: a["out"])


def _respaced(s: Column, plain: Column) -> Column:
    """The characters of ``plain`` in place of the letters and digits of ``s``."""
    return F.aggregate(
        _chars(s), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
        lambda a, c: F.when(c.rlike(f"[{_ALNUM}]"), F.struct(F.concat(a["out"], F.substring(plain, a["k"], F.lit(1))).alias("out"),
                                                           (a["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["k"].alias("k"))),
        lambda a: a["out"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one counting once."""
    return F.aggregate(F.transform(F.reverse(_chars(digits)), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, v: a + v)


def _mod97(text: Column) -> Column:
    """Remainder of letters-as-numbers text (A is 10) modulo 97."""
    return F.aggregate(_chars(text), F.lit(0), lambda a, c: F.when(c.between("0", "9"), (a * 10 + (F.ascii(c) - 48)) % 97)
                       .otherwise((a * 100 + (F.ascii(c) - 55)) % 97))


_DATES = ("yyyy-MM-dd", "dd.MM.yyyy", "MM/dd/yyyy", "dd/MM/yyyy")
_SHAPES = (r"^[0-9]{4}-", r"^[0-9]{2}\.", "^[0-9]{2}/", "^[0-9]{2}/")


def _day(s: Column, fmt: str, shape: str) -> Column:
    day = F.datediff(F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(fmt))).cast("date"), F.to_date(F.lit("1900-01-01")))
    return F.when(day.between(0, 73048), day)


def _calendar(s: Column) -> tuple[Column, Column]:
    """Day number and format of a date, null if it is none."""
    days = [_day(s, *x) for x in zip(_DATES, _SHAPES, strict=True)]
    return F.coalesce(*days), F.coalesce(*[F.when(d.isNotNull(), f) for d, f in zip(days, _DATES, strict=True)])


def _head(s: Column, kind: Column) -> Column:
    """What stands before the permuted part."""
    return (F.when(kind == "phone", F.regexp_extract(s, r"^\+(?:1|7|[0-9]{1,3}?(?=[ .(-])|[0-9]{2})", 0))
            .when(kind == "secret", F.regexp_extract(s, r"""^[^"']*["']""", 0))
            .when(kind == "iban", F.substring(F.regexp_replace(s, " ", ""), 1, 4)).otherwise(""))


def _tail(s: Column, kind: Column) -> Column:
    """What stands after it."""
    return (F.when(kind == "email", F.regexp_extract(s, r"([@.]?[^.@]+\.[^.@]+)$", 1))
            .when(kind == "secret", F.substring(s, F.length(s), F.lit(1)))
            .when(kind == "card", F.substring(s, F.length(s), F.lit(1))).otherwise(""))


def _symbols(x: Column) -> tuple[Column, Column]:
    """Values and radices of the part to permute."""
    signs = F.filter(_chars(x["body"]), lambda c: c.rlike(f"[{_ALNUM}]"))
    long = lambda *v: F.array(*[F.lit(i).cast("long") for i in v])
    area, group, serial = (F.split_part(x["s"], F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    day = _calendar(x["s"])[0].cast("long")
    octets = F.transform(F.split(x["s"], r"\."), lambda o: o.cast("long"))
    kind = x["kind"]
    return (F.when(kind == "ipv4", octets).when(kind == "date", F.array(F.floor(day / 17), day % 17))
            .when(kind == "ssn", F.array(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1))
            .otherwise(F.transform(signs, lambda c: _value(c, x["hex"]))),
            F.when(kind == "ipv4", long(256, 256, 256, 256)).when(kind == "date", long(4297, 17))
            .when(kind == "ssn", long(898, 989901))
            .otherwise(F.transform(signs, lambda c: _radix(c, x["hex"]))))


def _written(x: Column) -> Column:
    """The pseudonym from permuted symbols."""
    new, kind, a, b = x["new"], x["kind"], F.get(x["new"], 0), F.get(x["new"], 1)
    body = _refill(x["body"], new, x["hex"], x["body"].rlike("[a-f]"))
    ssn = F.concat_ws("-", F.lpad((a + F.when(a >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                      F.lpad((F.floor(b / 9999) + 1).cast("string"), 2, "0"), F.lpad((b % 9999 + 1).cast("string"), 4, "0"))
    fmt = _calendar(x["s"])[1]
    day = F.date_add(F.to_date(F.lit("1900-01-01")), (a * 17 + b).cast("int"))
    date = F.coalesce(*[F.when(fmt == f, F.date_format(day, f)) for f in _DATES])
    return (F.when(kind == "ipv4", F.array_join(new.cast("array<string>"), ".")).when(kind == "date", date)
            .when(kind == "ssn", ssn).otherwise(F.concat(x["head"], body, x["tail"])))


def _checked(x: Column) -> Column:
    """Check digits of cards and accounts made right again."""
    digits = _digits(x["out"])
    head = F.substring(digits, F.lit(1), F.length(digits) - 1)
    last = F.pmod(10 - F.pmod(_luhn(F.concat(head, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    land, account = F.substring(x["out"], 1, 2), F.substring(x["out"], F.lit(5), F.length(x["out"]))
    check = F.lpad((98 - _mod97(F.concat(account, land, F.lit("00")))).cast("string"), 2, "0")
    return (F.when(x["kind"] == "card", F.concat(F.substring(x["out"], F.lit(1), F.length(x["out"]) - 1), last))
            .when(x["kind"] == "iban", _respaced(x["s"], F.concat(land, check, account)))
            .when(x["kind"].isNull(), x["s"]).otherwise(x["out"]))


def _kind(s: Column) -> Column:
    """The kind whose validation a candidate passes, or null."""
    whole = lambda k: s.rlike(f"^(?:{PATTERNS[k]})$")
    digits, plain = _digits(s), F.regexp_replace(s, " ", "")
    day = _calendar(s)[0]
    octets = ~F.exists(F.split(s, r"\."), lambda o: (o.cast("int") > 255) | ((F.length(o) > 1) & o.startswith("0")))
    area = F.substring(s, 1, 3)
    return (F.when(whole("secret"), "secret").when(whole("email"), "email")
            .when(whole("iban"), F.when(_mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)),
                                                       F.substring(plain, 1, 4))) == 1, "iban"))
            .when(whole("date"), F.when(day.isNotNull(), "date"))
            .when(whole("ipv4"), F.when(octets, "ipv4"))
            .when(whole("ssn"), F.when(~area.isin("000", "666") & ~area.startswith("9") & (F.substring(s, 5, 2) != "00")
                                       & (F.substring(s, 8, 4) != "0000"), "ssn"))
            .when(whole("phone"), F.when(F.length(digits).between(7, 15), "phone"))
            .when(whole("card"), F.when(_luhn(digits) % 10 == 0, "card")))


def pseudonyms(found: Column, key: str = KEY) -> Column:
    """array of (s, kind) -> array of (kind, value); without a kind s itself."""
    step = F.transform(found, lambda x: F.struct(
        x["s"].alias("s"), x["kind"].alias("kind"), _head(x["s"], x["kind"]).alias("head"), _tail(x["s"], x["kind"]).alias("tail")))
    plain = lambda x: F.when(x["kind"] == "iban", F.regexp_replace(x["s"], " ", "")).otherwise(x["s"])
    step = F.transform(step, lambda x: F.struct(
        x["s"].alias("s"), x["kind"].alias("kind"), x["head"].alias("head"), x["tail"].alias("tail"),
        F.substring(plain(x), F.length(x["head"]) + 1,
                    F.length(plain(x)) - F.length(x["head"]) - F.length(x["tail"])).alias("body")))
    step = F.transform(step, lambda x: F.struct(
        x["s"].alias("s"), x["kind"].alias("kind"), x["head"].alias("head"), x["tail"].alias("tail"), x["body"].alias("body"),
        ((x["kind"] == "secret") & x["body"].rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")).alias("hex")))
    step = F.transform(step, lambda x: F.struct(
        x["s"].alias("s"), x["kind"].alias("kind"), x["head"].alias("head"), x["tail"].alias("tail"), x["body"].alias("body"),
        x["hex"].alias("hex"), _symbols(x)[0].alias("values"), _symbols(x)[1].alias("radices")))
    step = F.transform(step, lambda x: F.struct(
        x["s"].alias("s"), x["kind"].alias("kind"), x["head"].alias("head"), x["tail"].alias("tail"), x["body"].alias("body"),
        x["hex"].alias("hex"), F.when(x["kind"].isNotNull(), feistel(x, key)).alias("new")))
    step = F.transform(step, lambda x: F.struct(
        x["s"].alias("s"), x["kind"].alias("kind"), F.when(x["kind"].isNotNull(), _written(x)).alias("out")))
    return F.transform(step, lambda x: F.struct(x["kind"].alias("kind"), _checked(x).alias("value")))


def pseudonymise(docs: DataFrame, text: str = "text", found: str = "found", key: str = KEY) -> DataFrame:
    """``docs`` with the values in ``text`` replaced, and ``found`` (a free
    name): array of (kind, pseudonym) in text order."""
    has, parts = fresh(docs, "_has", "_parts")
    candidates = F.when(F.col(text).rlike(r"[0-9@]|(?i:token|secret|passw|key)\s{0,3}[=:]"),
                        F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)))
    named = F.transform(candidates, lambda s: F.struct(s.alias("s"), _kind(s).alias("kind")))
    done = pseudonyms(F.col(has), key)
    out = docs.withColumn(has, named).withColumn(has, F.when(F.exists(has, lambda x: x["kind"].isNotNull()), F.col(has)))
    out = out.withColumn(has, F.when(F.col(has).isNotNull(), done)).withColumn(
        parts, F.when(F.col(has).isNotNull(), F.split(F.col(text), ANY, -1)))
    joined = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(
        F.col(has), lambda x, i: F.concat(x["value"], F.get(parts, i + 1))), ""))
    kinds = F.filter(F.col(has), lambda x: x["kind"].isNotNull())
    return (out.withColumn(text, F.when(F.col(has).isNull(), F.col(text)).otherwise(joined))
            .withColumn(found, F.coalesce(kinds, F.array().cast("array<struct<kind:string,value:string>>"))).drop(has, parts))
