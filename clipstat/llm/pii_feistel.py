"""Personal numbers and dates replaced by format-preserving Feistel pseudonyms (native DataFrame code only).

Numbers and dates are found by pattern and validated: card numbers by their
Luhn digit, IPv4 addresses by their octets, social security numbers by their
areas, phone numbers by their count of digits, dates by the calendar.  What is
valid is permuted within its own format by a keyed Feistel network and written
back in place, with the same separators, so equal values of a kind get equal
pseudonyms in every document, however they are punctuated, and different
values different ones.  The names before the @ of mail addresses are permuted
the same way, letters to letters and digits to digits.

A value is a pair (x, y) with x below a and y below b.  Each round adds a keyed
hash of one half to the other modulo its bound, which is a bijection for any a
and b, so no cycle walking is needed:

  kind   a x b                     what is permuted
  card   halves of the digits      all but the last digit, which is made to fit
  phone  halves of the digits      all digits (after +: all but the first)
  ssn    898 x 989,901             area (not 000, 666, 9xx) x group and serial (not 0)
  ipv4   65,536 x 65,536           the two halves of the address
  date   192 x 192                 the day within its era of 36,864 days
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import column, spare

ROUNDS = 10
KINDS = ("email", "ipv4", "date", "ssn", "phone", "card")

# labels and their number are bounded as in host names: the regex recurses for each label
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,126}"
_IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
_DATE = (r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{4}\.\d{2}\.\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?!\d)"
         r"|(?<![\d-])\d{1,2}-\d{1,2}-\d{4}(?![\d-])")
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_PHONE = (r"\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?)(?:[ .-]?\d{2,4}){2,3}(?!\d)"
          r"|(?<!\d)(?:1[ .-]?)?\(\d{3}\)[ -]?\d{3}[ .-]\d{4}(?!\d)"
          r"|(?<![\d.-])(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
          r"|(?<![\d.-])(?:1[ .-])?\d{3} \d{3}[ -]\d{4}(?![ -]?\d)")
# a run of 13 digits or more over single blanks or hyphens; it ends before a value of another kind
_CARD = (r"(?<!\d)(?=\d(?:[ -]?\d){12})\d(?:(?![ -]{2})(?![ -](?:" + "|".join((_DATE, _SSN, _PHONE)) + r"))[\d -])*(?<=\d)(?!\d)")
PATTERN = "|".join((_EMAIL, _IPV4, _DATE, _SSN, _PHONE, _CARD))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def keyed(key: str, *parts: Column) -> Column:
    """A non-negative 60-bit number that depends on the key and the parts."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def permute_pair(x: Column, y: Column, a: Column, b: Column, tweak: Column, key: str) -> Column:
    """Struct (x, y): the Feistel image of the pair, below the same bounds."""
    def step(s: Column, r: Column) -> Column:
        left = F.when(r % 2 == 0, F.pmod(s["x"] + F.pmod(keyed(key, tweak, r, s["y"]), a), a)).otherwise(s["x"])
        right = F.when(r % 2 == 1, F.pmod(s["y"] + F.pmod(keyed(key, tweak, r, s["x"]), b), b)).otherwise(s["y"])
        return F.struct(left.alias("x"), right.alias("y"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def permute_digits(d: Column, kind: str, key: str) -> Column:
    """A string of 2 to 36 digits as another one of the same length."""
    n = F.length(d)
    half = F.floor(n / 2).cast("int")
    a, b = F.pow(F.lit(10), half).cast("long"), F.pow(F.lit(10), n - half).cast("long")
    image = permute_pair(F.left(d, half).cast("long"), F.right(d, n - half).cast("long"), a, b, F.concat(F.lit(f"{kind}:"), n), key)
    return let(image, lambda p: F.concat(F.lpad(p["x"].cast("string"), half, "0"), F.lpad(p["y"].cast("string"), n - half, "0")))


def luhn_sum(d: Column, shift: int) -> Column:
    """Sum of the digits, every second doubled, counted from the right; ``shift`` 1 doubles the last one."""
    places = F.sequence(F.lit(1), F.length(d))
    return F.aggregate(places, F.lit(0), lambda s, i: s + F.when(
        (F.length(d) - i + shift) % 2 == 1,
        F.substr(d, i, F.lit(1)).cast("int") * 2 - F.when(F.substr(d, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)
    ).otherwise(F.substr(d, i, F.lit(1)).cast("int")))


def fill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))
    return let(digits, lambda d: F.aggregate(F.split(shape, ""), start, lambda s, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substr(d, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i"))
    ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))))["out"])


def _card(m: Column, key: str) -> Column:
    """Struct (new, n): the run of digits with its n cards replaced; new is null without any.

    A whole grouping with a valid check digit (13 to 19 digits on end, 4-4-4-4,
    4-6-5, 4-6-4, 4-4-4-4 with up to 3 more) is a card wherever it stands in the
    run; only a run without one is judged as a whole.
    """
    def valid(d: Column) -> Column:
        return F.length(d).between(13, 19) & (luhn_sum(d, 0) % 10 == 0)

    def made(shape: Column, d: Column) -> Column:
        body = permute_digits(F.left(d, F.length(d) - 1), "card", key)
        return fill(shape, let(body, lambda b: F.concat(b, F.pmod(-luhn_sum(b, 1), F.lit(10)).cast("string"))))

    def size(groups: Column, at: Column) -> Column:
        """How many groups the card that starts with group ``at`` has; 0 for no card."""
        digits = lambda n: F.array_join(F.slice(groups, at, n), "")
        shape = F.array_join(F.transform(F.slice(groups, at, 5), lambda g: F.length(g)), "-")
        out = F.when(shape.rlike("^1[3-9](?:-|$)") & valid(digits(1)), 1)
        for pattern, n in (("^4-4-4-4(?:-|$)", 4), ("^4-6-[45](?:-|$)", 3), ("^4-4-4-4-[1-3]$", 5)):
            out = out.when(shape.rlike(pattern) & valid(digits(n)), n)
        return out.otherwise(0)

    def parts(groups: Column, blanks: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"), F.lit(1).alias("next"))

        def step(s: Column, at: Column) -> Column:
            shape = lambda k: F.array_join(F.zip_with(F.slice(groups, at, k), F.concat(
                F.slice(blanks, at, k - 1), F.array(F.lit(""))), lambda g, x: F.concat(g, x)), "")
            after = lambda k: F.coalesce(F.get(blanks, at + k - 2), F.lit(""))
            card = lambda k: F.struct(
                F.concat(s["out"], made(shape(k), F.array_join(F.slice(groups, at, k), "")), after(k)).alias("out"),
                (s["n"] + 1).alias("n"), (at + k).alias("next"))
            plain = F.struct(F.concat(s["out"], F.get(groups, at - 1), after(F.lit(1))).alias("out"), s["n"].alias("n"), (at + 1).alias("next"))
            return F.when(at < s["next"], s).otherwise(let(size(groups, at), lambda k: F.when(k > 0, card(k)).otherwise(plain)))

        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, step)

    def new(found: Column) -> Column:
        whole = let(_digits(m), lambda d: F.when(valid(d), made(m, d)))
        return F.when(found["n"] > 0, F.struct(found["out"].alias("new"), found["n"].alias("n"))).otherwise(
            F.struct(whole.alias("new"), F.lit(1).alias("n")))

    found = let(F.split(m, "[ -]"), lambda g: let(F.regexp_extract_all(m, F.lit("([ -])"), F.lit(1)), lambda x: parts(g, x)))
    return let(found, new)


def _phone(m: Column, key: str) -> Column:
    lead = F.when(m.startswith("+"), 1).otherwise(0)

    def valid(d: Column) -> Column:
        rest = F.right(d, F.length(d) - lead)
        return fill(m, F.concat(F.left(d, lead), let(rest, lambda r: permute_digits(r, "phone", key))))

    return let(_digits(m), lambda d: F.when(F.length(d).between(8, 15), valid(d)))


def _ssn(m: Column, key: str) -> Column:
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")

    def new(d: Column) -> Column:
        area, group, serial = (F.substring(d, p, n).cast("long") for p, n in ((1, 3), (4, 2), (6, 4)))
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        x = area - F.when(area > 666, 2).otherwise(1)
        image = permute_pair(x, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), F.lit("ssn"), key)
        made = let(image, lambda p: F.concat_ws("-", pad(p["x"] + F.when(p["x"] >= 665, 2).otherwise(1), 3),
                                                pad(F.floor(p["y"] / 9999) + 1, 2), pad(p["y"] % 9999 + 1, 4)))
        return F.when(valid, made)

    return let(_digits(m), new)


def _ipv4(m: Column, key: str) -> Column:
    def new(o: Column) -> Column:
        image = permute_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), F.lit("ipv4"), key)
        made = let(image, lambda p: F.concat_ws(".", *[x.cast("string") for x in (
            F.floor(p["x"] / 256), p["x"] % 256, F.floor(p["y"] / 256), p["y"] % 256)]))
        return F.when(F.forall(o, lambda x: x < 256), made)

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), new)


def _date(m: Column, key: str) -> Column:
    d, iso = _digits(F.regexp_replace(m, r"(?<!\d)(?=\d(?!\d))", "0")), m.rlike(r"^\d{4}")
    short = m.rlike(r"(?<!\d)\d(?!\d)")
    year = F.when(iso, F.left(d, F.lit(4))).otherwise(F.right(d, F.lit(4)))
    first, second = (F.substring(d, p, 2) for p in (1, 3))
    as_date = lambda y, mo, da: F.concat_ws("-", y, mo, da).try_cast("date")
    ymd = as_date(year, F.substring(d, 5, 2), F.substring(d, 7, 2))
    dmy, mdy = as_date(year, second, first), as_date(year, first, second)
    # dots: day first; slashes and hyphens: month first where that is a date
    day_first = m.contains(".") | mdy.isNull()
    day = F.when(iso, ymd).when(day_first, dmy).otherwise(mdy)

    def new(n: Column) -> Column:
        era = F.floor(n / 36864)
        inside = n - era * 36864
        image = permute_pair(F.floor(inside / 192), inside % 192, F.lit(192), F.lit(192), F.concat(F.lit("date:"), era), key)
        made = let(image, lambda p: F.date_from_unix_date((era * 36864 + p["x"] * 192 + p["y"]).cast("int")))
        sep = F.regexp_extract(m, r"\D", 0)
        # without leading zeros, as the old one, if it has a day or month of one digit
        free = lambda t: F.when(day_first, F.concat_ws("/", F.dayofmonth(t), F.month(t), F.date_format(t, "yyyy"))).otherwise(
            F.concat_ws("/", F.month(t), F.dayofmonth(t), F.date_format(t, "yyyy")))
        return let(made, lambda t: F.when(short, F.replace(free(t), F.lit("/"), sep)).otherwise(fill(m, F.when(
            iso, F.date_format(t, "yyyyMMdd")).when(day_first, F.date_format(t, "ddMMyyyy")).otherwise(F.date_format(t, "MMddyyyy")))))

    return let(F.unix_date(day).cast("long"), lambda n: F.when(n.isNotNull(), new(n)))


def _email(m: Column, key: str) -> Column:
    """Letters and digits of the local part, each kept in its class; the halves are permuted in turn."""
    def lows(codes: Column) -> Column:
        return F.transform(codes, lambda c: F.when(c.between(48, 57), 48).when(c.between(65, 90), 65).when(c.between(97, 122), 97).otherwise(c))

    def new(codes: Column, low: Column, shape: Column) -> Column:
        half = F.floor(F.size(codes) / 2)
        size = lambda i: F.when(F.get(low, i) == 48, 10).when(F.get(low, i).isin(65, 97), 26).otherwise(1)

        def step(v: Column, r: Column) -> Column:
            turn = lambda i: (i < half) == (r % 2 == 0)
            other = F.array_join(F.filter(v, lambda x, i: ~turn(i)), ",")
            return let(other, lambda o: F.transform(v, lambda x, i: F.when(
                turn(i), F.pmod(x + F.pmod(keyed(key, F.lit("email"), shape, r, i, o), size(i)).cast("int"), size(i))).otherwise(x)))

        image = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.zip_with(codes, low, lambda c, z: c - z), step)
        return F.array_join(F.zip_with(image, low, lambda v, z: F.char(v + z)), "")

    codes = F.transform(F.split(F.regexp_extract(m, "^[^@]+", 0), ""), lambda c: F.ascii(c))
    local = let(codes, lambda c: let(lows(c), lambda z: let(F.array_join(z, ","), lambda shape: new(c, z, shape))))
    return F.concat(local, F.regexp_extract(m, "@.*$", 0))


_BY_KIND = {"email": _email, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def kind_of(m: Column) -> Column:
    """The kind whose pattern matched, in the order of the pattern."""
    out = F.when(m.contains("@"), "email")
    for kind, pattern in (("ipv4", _IPV4), ("date", _DATE), ("ssn", _SSN), ("phone", _PHONE)):
        out = out.when(m.rlike(f"^(?:{pattern})$"), kind)
    return out.otherwise("card")


def pseudonym(m: Column, key: str) -> Column:
    """Struct (kind, new, n): the match with its n values replaced; all are null where none is valid."""
    def made(kind: Column) -> Column:
        new = F.struct(F.lit(None).cast("string").alias("new"), F.lit(1).alias("n"))
        for k, f in _BY_KIND.items():
            got = f(m, key) if k == "card" else F.struct(f(m, key).alias("new"), F.lit(1).alias("n"))
            new = F.when(kind == k, got).otherwise(new)
        return let(new, lambda x: F.when(x["new"].isNotNull(), F.struct(kind.alias("kind"), x["new"].alias("new"), x["n"].alias("n"))))

    return let(kind_of(m), made)


def pseudonymise(docs: DataFrame, *, key: str, text_col: str = "text", out_col: str | None = None) -> DataFrame:
    """``docs`` with the text rewritten (in ``out_col`` or in place) and ``pii_kinds``, the kinds replaced, in order.

    ``key`` is the secret that the pseudonyms hang on: who has it can undo them, so
    there is no default.  Null texts stay null with no kinds; texts without a digit or @ stay as they
    are.  What looks like a number but is not valid stays.  All rows and other
    columns come back as they are; columns with the names of the results are
    replaced.
    """
    out_col = out_col or text_col
    text = column(text_col)
    look = text.rlike("[0-9]|@")
    found = F.when(look, F.regexp_extract_all(text, F.lit(f"({PATTERN})"), F.lit(1))).otherwise(F.array().cast("array<string>"))
    hits, new = spare(docs, "pii_hits"), spare(docs, "pii_new")
    got = docs.withColumn(hits, found).withColumn(new, F.transform(hits, lambda m: pseudonym(m, key)))
    between = F.split(text, PATTERN, -1)
    pieces = F.zip_with(F.concat(F.array(F.lit("")), F.zip_with(new, hits, lambda n, m: F.coalesce(n["new"], m))), between, lambda a, b: F.concat(a, b))
    rewritten = F.when(F.size(hits) > 0, F.array_join(pieces, "")).otherwise(text)
    kinds = F.flatten(F.transform(F.filter(new, lambda n: n["new"].isNotNull()), lambda n: F.array_repeat(n["kind"], n["n"])))
    return got.withColumns({out_col: rewritten, "pii_kinds": kinds}).drop(hits, new)


def count_of(kind: str) -> Column:
    """How many values of a kind were replaced."""
    return F.size(F.filter("pii_kinds", lambda k: k == F.lit(kind))).cast("long")
