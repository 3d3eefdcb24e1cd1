"""Personal data become format-preserving pseudonyms: keyed Feistel permutations in SQL functions.

Kinds: e-mail addresses (the ASCII letters and digits of the local part change, each letter keeps its case and the case doesn't change the pseudonym), card numbers (13-19 digits that pass the Luhn test;
the check digit is made anew, so the pseudonym passes it too), international phone numbers (8-15
digits; the country code stays, however the number is grouped), IPv4 addresses and calendar dates from 1900 to 2099. A value is
written as numbers in their own ranges (digit, letter of a case, octet, day), the list is cut in two
halves, and in each of eight rounds one half is shifted, range by range, by numbers drawn from
SHA-512 of the key, the kind, the round and the other half. That is a permutation of all values of the
format: equal values get equal pseudonyms in every document, different values different ones, and
the holder of the key can go back. Dates walk the cycle until they are inside the calendar range.

Everything is one projection of built-in functions; there is no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import let

KEY = "ferry-demo-key"
ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", 73049      # up to 2099-12-31
DATE_BASE = 271                            # 271 * 271 is the least square that holds all days
OCTET = 1000                               # octets are written as 1000..1255

# What the kinds look like.
# A local part has letters and digits of any script; its ASCII ones are permuted, the others stay.
EMAIL = r"(?<![\p{L}\p{M}\p{N}._%+-])(?=[._%+-]*+[\p{L}\p{N}])[\p{L}\p{M}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP_PART = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{IP_PART}\.){{3}}{IP_PART}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9-])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9-])"
# Card numbers as they are printed; a run of digits of another grouping is tried after these.
CARD_FORMS = (r"[0-9]{13,19}", r"[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}", r"[0-9]{4}(?:[ -][0-9]{4}){3}",
              r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}")
# No number runs on into a value of another kind behind a blank, a dot or a hyphen.
OTHER = rf"(?!{EMAIL}|{DATE}|{IP})"
# A phone number stops before printed cards. Its area code may be in brackets; other groups have two digits or more.
_CARDS = r"(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|(?:[0-9]{4}[ -]){3}[0-9]{4}(?:(?:[ -][0-9]{4}){4}){0,4}(?![ -][0-9]{4}(?![0-9])))"
_LOOSE = rf"{OTHER}(?=[0-9]{{2}})"
_GAP = rf"(?!{_CARDS}(?![0-9])){_LOOSE}"
_AREA = r"[ .-]?(?<=\+[0-9]{1,3}[ .-]?)\((?=[0-9]{1,4}\)[ .-]?[0-9]{2})|(?<=\([0-9]{1,4})\)[ .-]?" + _LOOSE
# Complete forms first: ten digits behind +1; ten digits or more without a blank behind a group that a dot or hyphen
# introduced; then all that has 8 to 15 digits, if possible without cutting a decimal or dotted number or a card.
_NEAT = rf"(?:[.-]|(?<!(?<!\+[0-9]{{1,3}})[.-][0-9]{{2,14}}) ){_GAP}"
PHONE = (r"\+(?:1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
         rf"|[0-9](?:(?:{_NEAT}|{_AREA})?[0-9]){{9,14}}(?![0-9]|\.[0-9])"
         rf"|[0-9](?:(?:[ .-]{_GAP}|{_AREA})?[0-9]){{7,14}}(?![0-9]|\.[0-9])"
         rf"|[0-9](?:(?:[ .-]{_LOOSE}|{_AREA})?[0-9]){{7,14}}(?![0-9]))")
# Calling codes of one and two digits; all others have three. A trunk zero in brackets is not dialled with the code.
CALLING_CODE = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
TRUNK, TRUNK_MARK = r"\(0\)", "(\u0001)"
# All groups of digits around a possible card; the check digit decides which of them are one (``_cards``): the
# printed forms, then groups of three digits or more, then any grouping from the left.
DIGITS = rf"(?<![0-9])(?=[0-9](?:[ -]?[0-9]){{12}})[0-9](?:[0-9]|[ -]{OTHER}[0-9])++"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
PASSES = (*[rf"(?<![0-9])(?=({f})(?![0-9]))" for f in CARD_FORMS],
          *[rf"(?<![0-9])(?=([0-9]{{3,}}(?:[ -][0-9]{{3,}}){{{k}}})(?![0-9]))" for k in (5, 4, 3, 2, 1)], f"({CARD})")
ANY = "|".join((EMAIL, PHONE, DATE, DIGITS, IP))
KINDS = ("email", "phone", "card", "ip", "date")


def _range(code: Column) -> tuple[Column, Column]:
    """Start and size of the range a number belongs to."""
    start = F.when(code >= OCTET, OCTET).when(code >= 97, 97).when(code >= 65, 65).otherwise(48)
    return start, F.when(code >= OCTET, 256).when(code >= 65, 26).otherwise(10)


def _stream(key: str, kind: str, turn: Column, half: Column, n: Column) -> Column:
    """At least 8 hex digits for each of ``n`` numbers."""
    blocks = F.sequence(F.lit(0), F.floor(n / 16).cast("int"))
    said = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), F.array_join(F.transform(
        half, lambda c: c.cast("string")), ","))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", said, b.cast("string")), 512)), "")


def _number(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint")


def _shift(half: Column, stream: Column) -> Column:
    def one(bits: Column) -> Column:
        def move(c: Column, i: Column) -> Column:
            start, size = _range(c)
            return (start + F.pmod(c - start + _number(bits, i), size)).cast("int")
        return F.transform(half, move)
    return let(stream, one)


def permuted(codes: Column, key: str, kind: str) -> Column:
    """Feistel permutation of an array of range numbers."""
    def run(all_: Column) -> Column:
        cut = F.floor(F.size(all_) / 2).cast("int")
        halves = F.struct(F.slice(all_, F.lit(1), cut).alias("a"),
                          F.slice(all_, cut + 1, F.size(all_) - cut).alias("b"))
        turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        done = F.aggregate(turns, halves, lambda h, t: F.when(
            t % 2 == 0, F.struct(_shift(h["a"], _stream(key, kind, t, h["b"], F.size(h["a"]))).alias("a"),
                                 h["b"].alias("b"))).otherwise(
            F.struct(h["a"].alias("a"), _shift(h["b"], _stream(key, kind, t, h["a"], F.size(h["b"]))).alias("b"))))
        return let(done, lambda h: F.concat(h["a"], h["b"]))
    return let(codes, run)


def _codes(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("int"))


def _text(codes: Column) -> Column:
    return F.array_join(F.transform(codes, lambda c: F.char(c)), "")


def _refill(template: Column, chars: Column) -> Column:
    """The template with its letters and digits replaced, in order, by those of ``chars`` in the case they had."""
    both = F.struct(F.split(template, "").alias("t"), chars.alias("c"))
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("n"))
    return let(both, lambda x: F.aggregate(
        x["t"], start, lambda a, c: F.when(c.rlike("^[A-Za-z0-9]$"), F.struct(
            F.concat(a["s"], F.when(c.rlike("^[A-Z]$"), F.upper(F.substring(x["c"], a["n"] + 1, F.lit(1))))
                     .otherwise(F.substring(x["c"], a["n"] + 1, F.lit(1)))).alias("s"), (a["n"] + 1).alias("n")))
        .otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["n"].alias("n"))), lambda a: a["s"]))


def luhn_digit(payload: Column) -> Column:
    """Check digit (as text) that completes a string of digits."""
    total = F.aggregate(F.transform(_codes(F.reverse(payload)), lambda c, i: F.when(
        i % 2 == 0, F.when(c - 48 > 4, (c - 48) * 2 - 9).otherwise((c - 48) * 2)).otherwise(c - 48)),
        F.lit(0), lambda a, x: (a + x).cast("int"))
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _luhn(number: Column) -> Column:
    return let(_alnum(number), lambda d: luhn_digit(F.substring(d, F.lit(1), F.length(d) - 1)) == F.right(d, F.lit(1)))


def _alnum(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9]", "")


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(_refill(local, _text(permuted(_codes(F.lower(_alnum(local))), key, "email"))),
                    F.substring(m, F.length(local) + 1, F.length(m)))


def _phone(m: Column, key: str) -> Column:
    def new(digits: Column) -> Column:
        country = F.regexp_extract(digits, CALLING_CODE, 0)
        rest = F.substring(digits, F.length(country) + 1, F.length(digits))
        return F.concat(country, _text(permuted(_codes(rest), key, "phone")))
    template = F.regexp_replace(m, TRUNK, TRUNK_MARK)
    return F.replace(_refill(template, let(_alnum(template), new)), F.lit(TRUNK_MARK), F.lit("(0)"))


def _card(m: Column, key: str) -> Column:
    digits = _alnum(m)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return let(_text(permuted(_codes(body), key, "card")), lambda p: _refill(m, F.concat(p, luhn_digit(p))))


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: (o.cast("int") + OCTET))
    return F.array_join(F.transform(permuted(octets, key, "ip"), lambda o: (o - OCTET).cast("string")), ".")


def _day(d: Column, key: str) -> Column:
    """One step of the day permutation on 0 .. DATE_BASE^2 - 1."""
    start = F.struct(F.floor(d / DATE_BASE).cast("bigint").alias("a"), (d % DATE_BASE).cast("bigint").alias("b"))

    def turn(h: Column, t: Column) -> Column:
        move = lambda x, by: F.pmod(x + _number(_stream(key, "date", t, F.array(by), F.lit(1)), F.lit(0)),
                                    F.lit(DATE_BASE))
        return F.when(t % 2 == 0, F.struct(move(h["a"], h["b"]).alias("a"), h["b"].alias("b"))) \
            .otherwise(F.struct(h["a"].alias("a"), move(h["b"], h["a"]).alias("b")))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda h: h["a"] * DATE_BASE + h["b"])


def _date(m: Column, key: str) -> Column:
    day = F.datediff(F.try_to_date(m, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date")).cast("bigint")
    # cycle walking: a step lands outside the calendar once in 187 times
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(12)), _day(day, key),
                         lambda d, _: F.when(d < DAYS, d).otherwise(_day(d, key)))
    return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), walked.cast("int")), "yyyy-MM-dd")


def kind_of(m: Column) -> Column:
    """Kind of a match, or null where it fails its validation."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    return (F.when(m.contains("@"), "email")
            .when(m.startswith("+"), F.when(F.length(digits).between(8, 15), "phone"))
            .when(m.rlike(r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$"), "ip")
            .when(m.rlike("^" + DATE + "$"), F.when(F.try_to_date(m, "yyyy-MM-dd").isNotNull(), "date"))
            .when(_luhn(digits), "card"))


def pseudonym(m: Column, kind: Column, key: str = KEY) -> Column:
    return (F.when(kind == "email", _email(m, key)).when(kind == "phone", _phone(m, key))
            .when(kind == "card", _card(m, key)).when(kind == "ip", _ip(m, key))
            .when(kind == "date", _date(m, key)).otherwise(m))


def _cards(m: Column) -> Column:
    """array<struct<text, kind>> of a run of digit groups: its card numbers and what lies between.

    The forms of ``PASSES`` are tried one after the other on what no earlier one took, each at every group; a number
    whose check digit is right is marked (in brackets, digits as letters).
    """
    def one_pass(run: Column, form: Column) -> Column:
        valid = F.filter(F.regexp_extract_all(run, form, F.lit(1)), lambda c: F.length(_alnum(c)).between(13, 19) & _luhn(c))
        return F.aggregate(valid, run, lambda r, c: F.regexp_replace(
            r, F.concat(F.lit("(?<![0-9])"), c, F.lit("(?![0-9])")),
            F.concat(F.lit("["), F.translate(c, "0123456789", "ABCDEFGHIJ"), F.lit("]"))))

    def pieces(marked: Column) -> Column:
        of = F.struct(F.split(marked, r"\[[^\]]*\]", -1).alias("gaps"), F.transform(
            F.regexp_extract_all(marked, F.lit(r"\[([^\]]*)\]"), F.lit(1)),
            lambda c: F.translate(c, "ABCDEFGHIJ", "0123456789")).alias("cards"))
        return let(of, lambda x: F.flatten(F.transform(x["gaps"], lambda g, i: F.array(
            _piece(g, F.lit(None).cast("string")),
            _piece(F.coalesce(F.get(x["cards"], i), F.lit("")), F.when(i < F.size(x["cards"]), "card"))))))
    return let(F.aggregate(F.array(*[F.lit(p) for p in PASSES]), m, one_pass), pieces)


def _piece(text: Column, kind: Column) -> Column:
    return F.struct(text.alias("text"), kind.alias("kind"))


def _parts(text: Column) -> Column:
    """For each match of ``ANY`` in order, the array<struct<text, kind>> it consists of."""
    some = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: F.when(
        m.rlike("^[0-9][0-9 -]*$") & ~m.rlike("^" + DATE + "$"), _cards(m)).otherwise(F.array(_piece(m, kind_of(m)))))
    return F.when(text.rlike("[@0-9]"), some) \
        .otherwise(F.array().cast("array<array<struct<text:string,kind:string>>>"))


def found(text: Column) -> Column:
    """array<struct<text, kind>> of the matches in order (kind null: not validated); null text: empty."""
    return F.flatten(_parts(text))


def _rebuilt(text: Column, matches: Column, key: str) -> Column:
    parts = F.struct(F.split(text, ANY, -1).alias("gaps"), F.transform(matches, lambda m: F.array_join(F.transform(
        m, lambda x: pseudonym(x["text"], x["kind"], key)), "")).alias("new"))
    joined = let(parts, lambda p: F.array_join(F.transform(
        p["gaps"], lambda g, i: F.concat(g, F.coalesce(F.get(p["new"], i), F.lit("")))), ""))
    return F.when(F.exists(F.flatten(matches), lambda m: m["kind"].isNotNull()), joined).otherwise(text)


def pseudonymised(text: Column, key: str = KEY) -> Column:
    """The whole text with every validated value replaced by its pseudonym (null stays null)."""
    return F.when(text.rlike("[@0-9]"), let(_parts(text), lambda ms: _rebuilt(text, ms, key))).otherwise(text)


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per document: doc_id, the number of values of each kind, and the new text.

    Input needs ``doc_id`` and ``text``; other columns are ignored. A null text stays null with zero
    counts, an empty one stays empty. Repeated rows and null doc_ids are treated alike: the result of a
    row depends on its text and the key only. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       _parts(F.coalesce("text", F.lit(""))).alias("ms"))
    of = lambda k: F.size(F.filter(F.flatten("ms"), lambda m: m["kind"].eqNullSafe(F.lit(k)))).cast("bigint")
    counts = [of(k).alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.when(F.size("ms") > 0, _rebuilt(F.col("text"), F.col("ms"), key))
                       .otherwise(F.col("text")).alias("text"))
