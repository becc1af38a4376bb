"""Operator 6: format-preserving pseudonyms by a keyed Feistel permutation (SQL functions only).

Validated values are permuted within their own format, so the same value gets the same
pseudonym in every document (and however it is spaced), and text length and layout stay:

========  =====================================================  =========================
kind      validated by                                           what is permuted
========  =====================================================  =========================
card      13 to 19 digits, Luhn                                  all but the check digit,
                                                                 which is made anew
iban      country, ISO 7064 mod 97                               account part; check digits
                                                                 are made anew
ssn       area, group and serial in their ranges                 within those ranges
phone     international or grouped form                          the last 10 digits (all
                                                                 but a country code)
ipv4      four octets                                            32 bits
date      calendar date 1800..2199 (ISO, dd.mm.yyyy)             day within the 400 years
email     address form                                           local part, class by class
secret    quoted value assigned to token, key, password ...      value, class by class
========  =====================================================  =========================

A round adds a keyed SHA-2 value of the other half to one half (position by position
modulo the size of that position's class, or modulo the half's range), so every round,
and the whole, can be undone with the key; so the caller names one, and an empty one is an
error.  Numbers that fail their check (a 16-digit
number without a Luhn digit, an impossible date) are left alone.

Defined cases: NULL stays NULL with 0 values; a text of any length is searched whole;
repeated rows get equal texts; extra columns are carried, those named like an output
column are replaced; no documents give no rows.  One projection, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: for the registered query, the pipeline and tests: public, so anyone can invert what it makes
PUBLIC_TEST_KEY = "pseudonym-key"
DAYS, DAY_HIGH, DAY_LOW = 146_097, 189, 773        # days of 400 years = 189 * 773
FIRST_DAY = "1800-01-01"
SSN_AREAS, SSN_REST = 898, 99 * 9999               # 001..899 without 666; group x serial
_STREAM = 32                                       # positions served by one digest

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
YEAR, MONTH, DAY = r"(?:1[89]|2[01])\d\d", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
# every value begins where no letter or digit stands before it; what follows is tried there only
PATTERNS = {
    "secret": r"(?i:token|secret|api[_-]?key|access[_-]?key|password|passwd)\b['\"]?\s{0,4}[:=]\s{0,4}"
              r"(?:\"[0-9A-Za-z+/_=-]{16,256}\"|'[0-9A-Za-z+/_=-]{16,256}')",
    "email": r"(?<![._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}",
    "ipv4": rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)",
    "date": rf"(?<![\w./-])(?:{YEAR}(?<ds>[-/]){MONTH}\k<ds>{DAY}|{DAY}\.{MONTH}\.{YEAR})(?!\w|[./-]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:(?:\+\d{1,3}[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}|\+\d{1,3}[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}"
             r"|\d{3}[.-]\d{3}[.-]\d{4}|\+\d{11,15})(?!\w|-\d)",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?<cs>[ -])\d{4}\k<cs>\d{4}\k<cs>\d{4}|\d{4}(?<as>[ -])\d{6}\k<as>\d{5})(?!\w|-\d)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)",
}
_DIGITS_FIRST = "|".join(PATTERNS[k] for k in ("ipv4", "date", "ssn", "phone", "card"))
ANY = (rf"(?<![A-Za-z0-9])(?:(?=[0-9+(])(?:{_DIGITS_FIRST})|(?=[A-Za-z0-9._%+-]++@){PATTERNS['email']}"
       rf"|(?=[A-Z]{{2}}[0-9]){PATTERNS['iban']}|(?=[TtSsAaPp]){PATTERNS['secret']})")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it.

    (An expression named twice inside a lambda is otherwise computed twice, and one named
    in an inner lambda once per element.)
    """
    return F.element_at(F.transform(F.array(value), use), 1)


# ------------------------------------------------------------------ Feistel
def _digest(key: str, kind: str, r: Column, other: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), r.cast("string"), F.lit("|"), other), 512)


def _chars(half: Column, digest: Column) -> Column:
    """Every digit, lower and upper case letter of ``half`` moved within its class."""
    def move(d, c, j):
        at = F.pmod(j, F.lit(_STREAM)) * 4 + 1
        k = F.conv(d.substr(at, F.lit(4)), 16, 10).cast("int")

        def turn(first, size):
            return F.char(F.lit(first) + F.pmod(F.ascii(c) - first + k, F.lit(size)))

        return (F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", "z"), turn(97, 26))
                .when(c.between("A", "Z"), turn(65, 26)).otherwise(c))

    return let(digest, lambda d: F.array_join(F.transform(F.split(half, ""), lambda c, j: move(d, c, j)), ""))


def permute_text(value: Column, key: str, kind: str) -> Column:
    """Format-preserving permutation of a string, class by class."""
    def halves(v):
        cut = F.floor(F.length(v) / 2).cast("int")
        return F.struct(v.substr(F.lit(1), cut).alias("a"), v.substr(cut + 1, F.length(v)).alias("b"),
                        F.concat(F.length(v).cast("string"), F.lit("|")).alias("size"))

    def step(s, r):
        first = r % 2 == 0
        a = F.when(first, _chars(s["a"], _digest(key, kind, r, F.concat(s["size"], s["b"])))).otherwise(s["a"])
        b = F.when(first, s["b"]).otherwise(_chars(s["b"], _digest(key, kind, r, F.concat(s["size"], s["a"]))))
        return F.struct(a.alias("a"), b.alias("b"), s["size"].alias("size"))

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return let(value, lambda v: F.aggregate(rounds, halves(v), step, lambda s: F.concat(s["a"], s["b"])))


def permute_pair(a: Column, b: Column, size_a: int, size_b: int, key: str, kind: str) -> Column:
    """Permutation of the pairs (a, b), 0 <= a < size_a, 0 <= b < size_b; a struct."""
    def number(digest):
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")

    def step(s, r):
        first = r % 2 == 0
        new_a = F.pmod(s["a"] + number(_digest(key, kind, r, s["b"].cast("string"))), F.lit(size_a))
        new_b = F.pmod(s["b"] + number(_digest(key, kind, r, s["a"].cast("string"))), F.lit(size_b))
        return F.struct(F.when(first, new_a).otherwise(s["a"]).cast("long").alias("a"),
                        F.when(first, s["b"]).otherwise(new_b).cast("long").alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


# ------------------------------------------------------------- kinds of values
def _only(value: Column, not_wanted: str) -> Column:
    return F.regexp_replace(value, not_wanted, "")


def refill(shape: Column, filler: Column, wanted: str = "0-9") -> Column:
    """``shape`` with its characters of class ``wanted`` replaced by those of ``filler``."""
    def put(f, i):
        c = shape.substr(i, F.lit(1))
        k = F.length(_only(shape.substr(F.lit(1), i), f"[^{wanted}]"))
        return F.when(c.rlike(f"[{wanted}]"), f.substr(k, F.lit(1))).otherwise(c)

    places = F.sequence(F.lit(1), F.length(shape))
    return let(filler, lambda f: F.array_join(F.transform(places, lambda i: put(f, i)), ""))


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """``digits``: a name (see :func:`let`), as it is read once per digit."""
    n = F.length(digits)

    def add(total, i):
        d = digits.substr(i, F.lit(1)).cast("int")
        doubled = ((n - i) % 2) == (0 if double_last else 1)
        return total + F.when(doubled, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    def new(digits):
        body = permute_text(digits.substr(F.lit(1), F.length(digits) - 1), key, "card")
        with_check = let(body, lambda b: F.concat(b, F.pmod(-_luhn_sum(b, True), F.lit(10)).cast("string")))
        valid = (_luhn_sum(digits, False) % 10 == 0) & digits.rlike("[1-9]")
        return F.when(valid, refill(m, with_check))

    return let(_only(m, "[^0-9]"), new)


def _mod97(text: Column) -> Column:
    def step(acc, i):
        c = text.substr(i, F.lit(1))
        digit = c.between("0", "9")
        v = F.when(digit, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.pmod(F.when(digit, acc * 10).otherwise(acc * 100) + v, F.lit(97))

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    def new(flat):
        land, account = flat.substr(1, 2), flat.substr(F.lit(5), F.length(flat))

        def whole(a):
            check = let(F.concat(a, land, F.lit("00")),
                        lambda t: F.lpad((98 - _mod97(t)).cast("string"), 2, "0"))
            return F.concat(land, check, a)

        valid = let(F.concat(account, flat.substr(1, 4)), lambda t: _mod97(t) == 1) & F.length(flat).between(15, 34)
        return F.when(valid, refill(m, let(permute_text(account, key, "iban"), whole), "0-9A-Z"))

    return let(_only(m, " "), new)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (m.substr(1, 3).cast("int"), m.substr(5, 2).cast("int"), m.substr(8, 4).cast("int"))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)

    def text(new):
        a = new["a"] + F.when(new["a"] >= 665, 2).otherwise(1)
        g, s = F.floor(new["b"] / 9999) + 1, new["b"] % 9999 + 1
        return F.concat_ws("-", *[F.lpad(x.cast("long").cast("string"), w, "0") for x, w in ((a, 3), (g, 2), (s, 4))])

    new = permute_pair(place, (group - 1) * 9999 + serial - 1, SSN_AREAS, SSN_REST, key, "ssn")
    return F.when(valid, let(new, text))


def _phone(m: Column, key: str) -> Column:
    def new(digits):
        n = F.length(digits)
        last = permute_text(digits.substr(n - 9, F.lit(10)), key, "phone")
        return F.when(n >= 10, refill(m, F.concat(digits.substr(F.lit(1), n - 10), last)))

    return let(_only(m, "[^0-9]"), new)


def _ipv4(m: Column, key: str) -> Column:
    def text(new):
        parts = [F.floor(new["a"] / 256), new["a"] % 256, F.floor(new["b"] / 256), new["b"] % 256]
        return F.concat_ws(".", *[p.cast("long").cast("string") for p in parts])

    def new(o):
        octet = lambda i: F.get(o, F.lit(i)).cast("int")
        return permute_pair(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), 65536, 65536, key, "ipv4")

    return let(let(F.split(m, r"\."), new), text)


def _date(m: Column, key: str) -> Column:
    iso = m.rlike(r"^\d{4}")
    flat = F.when(iso, F.translate(m, "/", "-")).otherwise(
        F.concat_ws("-", m.substr(7, 4), m.substr(4, 2), m.substr(1, 2)))
    day = F.to_date(F.try_to_timestamp(flat, F.lit("yyyy-MM-dd")))
    n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    new = permute_pair(F.floor(n / DAY_LOW), n % DAY_LOW, DAY_HIGH, DAY_LOW, key, "date")
    moved = let(new, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["a"] * DAY_LOW + p["b"]).cast("int")))
    out = F.when(~iso, F.date_format(moved, "dd.MM.yyyy")).when(
        m.contains("/"), F.date_format(moved, "yyyy/MM/dd")).otherwise(F.date_format(moved, "yyyy-MM-dd"))
    return F.when(day.isNotNull(), out)


def _email(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    return F.concat(permute_text(m.substr(F.lit(1), at - 1), key, "email"), m.substr(at, F.length(m)))


def _secret(m: Column, key: str) -> Column:
    value = F.regexp_extract(m, r"['\"]([0-9A-Za-z+/_=-]{16,256})['\"]$", 1)
    head = m.substr(F.lit(1), F.length(m) - F.length(value) - 1)
    return F.concat(head, permute_text(value, key, "secret"), m.substr(F.length(m), F.lit(1)))


_MAKE = {"secret": _secret, "email": _email, "ipv4": _ipv4, "date": _date, "ssn": _ssn,
         "phone": _phone, "card": _card, "iban": _iban}
# which kind a match is of, told by its own characters (first that holds)
_IS = {"secret": r"['\"]$", "email": "@", "date": r"^(?:\d{4}[-/]\d\d[-/]\d\d|\d\d\.\d\d\.\d{4})$",
       "ipv4": r"^\d+(?:\.\d+){3}$", "ssn": r"^\d{3}-\d{2}-\d{4}$", "iban": r"^[A-Z]{2}\d\d",
       "phone": r"^(?:[+(]|\d{3}[.-]\d{3}[.-]\d{4}$)", "card": r"^\d"}


def pseudonym(m: Column, key: str) -> Column:
    """Pseudonym of one match; NULL if it fails its validation."""
    out = None
    for kind, shape in _IS.items():
        made = _MAKE[kind](m, key)
        out = F.when(m.rlike(shape), made) if out is None else out.when(m.rlike(shape), made)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with validated values in ``text`` replaced, and ``n_pseudonyms``."""
    if not key:
        raise ValueError("name a key: whoever has it can undo the pseudonyms")
    cols = [c for c in docs.columns if c.lower() not in (text.lower(), "n_pseudonyms")]
    may = F.coalesce(F.col("_t").rlike("[0-9@'\"]"), F.lit(False))
    none = F.array().cast("array<string>")
    rows = docs.select(F.struct(*cols).alias("_row") if cols else F.lit(None).alias("_row"),
                       F.col(text).alias("_t"))
    rows = rows.withColumn("_m", F.when(may, F.regexp_extract_all("_t", F.lit(ANY), F.lit(0))).otherwise(none))
    rows = rows.withColumn("_new", F.when(F.size("_m") > 0, F.transform("_m", lambda m: pseudonym(m, key))).otherwise(none))
    between = F.split("_t", ANY, -1)
    joined = F.array_join(F.zip_with(between, F.zip_with(
        "_m", "_new", lambda m, n: F.coalesce(n, m)), lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
    out = rows.select(
        *[F.col("_row")[c].alias(c) for c in cols],
        F.when(F.size("_m") > 0, joined).otherwise(F.col("_t")).alias(text),
        F.size(F.filter("_new", lambda x: x.isNotNull())).cast("long").alias("n_pseudonyms"))
    order = [c if c.lower() != text.lower() else text for c in docs.columns if c.lower() != "n_pseudonyms"]
    return out.select(*order, "n_pseudonyms")
