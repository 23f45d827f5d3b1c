"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Kinds, in the order in which equal starts are listed:

* ``email``, ``ip`` (parts at most 255), ``card`` (12 to 19 digits, Luhn), ``phone`` (``+`` and 9 to 15
  digits): what their pattern and check accept is always reported;
* ``iban`` (mod 97) and ``ssn`` (three, two and four digits): reported when the score reaches
  ``threshold``.

The score starts from the kind's prior, gains for a checksum that holds and for a context word in the
``window`` code points on either side of the span. An IBAN ends where a group does and mod 97 holds: at its
country's length if that is such a place, else at the last one. Spans are in code points, end exclusive. Only DataFrame
functions are used. The patterns match what the plain ones in the comments match; possessive
quantifiers and look-behinds keep them linear and free of recursion on very long runs.

Null texts count as empty (no spans); a null text stays null when replaced. Repeated rows and extra
columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import col, fresh, text_or_empty
from shelfcast.llm.spans import MATCH, labelled, matches, replaced

# The patterns of the four base kinds.
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
# [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# [0-9]([\x20-]?[0-9])+ of at least 12 digits
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
# \+[0-9][\x20().0-9-]+[0-9]
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Where one may start; the end is looked for in what follows.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
IBAN_RUN = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

PRIOR = {"email": 0.6, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.3, "ssn": 0.4}
CHECKED = {"email": 0.0, "ip": 0.0, "card": 0.3, "phone": 0.0, "iban": 0.5, "ssn": 0.0}
CONTEXT = {
    "email": r"(?i)(e-?mail|contact|mailto|write)",
    "ip": r"(?i)(\bip\b|address|host|server)",
    "card": r"(?i)(card|visa|master|credit|debit|payment|karte|carte|tarjeta)",
    "phone": r"(?i)(phone|tel|call|mobile|fax|whatsapp)",
    "iban": r"(?i)(iban|account|bank|konto|compte|cuenta)",
    "ssn": r"(?i)(ssn|social|security)",
}
RANK = {kind: i for i, kind in enumerate(PRIOR)}
BASE = ("email", "ip", "card", "phone")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_ip(value: Column) -> Column:
    """Four numbers of at most 255, leading zeros allowed."""
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(bare) <= 3) & (F.substring(bare, 1, 3).cast("int") <= 255)

    return F.forall(F.split(value, r"\."), small)


def is_card(value: Column) -> Column:
    number = digits(value)
    return F.length(number).between(12, 19) & F.call_function("luhn_check", number)


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(9, 15)


def is_iban(value: Column) -> Column:
    """ISO 7064 mod 97-10: the first four characters moved to the end, letters as 10 to 35, leaves 1."""
    bare = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        letter = (rest * 100 + code - 55) % 97
        return F.when(code >= 65, letter).otherwise((rest * 10 + code - 48) % 97)

    rest = F.aggregate(F.split(turned, ""), F.lit(0), step)
    return F.length(bare).between(15, 34) & (rest == 1)


def ibans(text: Column) -> Column:
    """Confirmed IBANs that start outside the one before: array of (start, end, value)."""
    length = F.create_map(*[F.lit(x) for n, names in IBAN_LENGTHS.items() for c in names.split() for x in (c, n)])

    def ended(m: Column) -> Column:
        tail = F.substring(text, m["start"] + 1, F.lit(68))  # 34 characters, a blank before each, and the next
        run = F.regexp_extract(tail, IBAN_RUN, 0)
        after = F.substring(tail, F.length(run) + 1, F.lit(1))

        def border(at: Column) -> Column:
            inside = (at < F.length(run)) & (F.substring(run, at + 1, F.lit(1)) == " ")
            last = (at == F.length(run)) & ~after.rlike("[A-Za-z0-9]")
            return (inside | last) & is_iban(F.substring(run, F.lit(1), at))

        def whole(at: Column) -> Column:
            bare = F.regexp_replace(F.substring(run, F.lit(1), at), " ", "")
            return F.coalesce(F.length(bare) == F.try_element_at(length, F.substring(run, 1, 2)), F.lit(False))

        ends = F.filter(F.sequence(F.lit(15), F.greatest(F.length(run), F.lit(15))), border)
        end = F.coalesce(F.array_max(F.filter(ends, whole)), F.array_max(ends))
        return F.struct(m["start"].alias("start"), (m["start"] + end).alias("end"), F.substring(run, F.lit(1), end).alias("value"))

    found = F.filter(F.transform(matches(text, IBAN), ended), lambda m: m["end"].isNotNull())

    def add(out: Column, m: Column) -> Column:
        return F.when(m["start"] < F.try_element_at(out, F.lit(-1))["end"], out).otherwise(F.concat(out, F.array(m)))

    return F.aggregate(found, F.array().cast(MATCH), add)


CHECKS = {"ip": is_ip, "card": is_card, "phone": is_phone}
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "ssn": SSN}


def _found(text: Column, kind: str, window: int, threshold: float) -> Column:
    """Confirmed matches of one kind with their score: array of (start, end, score)."""
    found = ibans(text) if kind == "iban" else matches(text, PATTERNS[kind])
    if kind in CHECKS:
        found = F.filter(found, lambda m: CHECKS[kind](m["value"]))

    def scored(m: Column) -> Column:
        first = F.greatest(m["start"] - window, F.lit(0))
        before = F.substring(text, first + 1, m["start"] - first)
        after = F.substring(text, m["end"] + 1, F.lit(window))
        bonus = F.when(before.rlike(CONTEXT[kind]) | after.rlike(CONTEXT[kind]), 0.25).otherwise(0.0)
        score = F.least(F.lit(1.0), F.lit(PRIOR[kind] + CHECKED[kind]) + bonus)
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), score.alias("score"))

    found = F.transform(found, scored)
    return found if kind in BASE else F.filter(found, lambda m: m["score"] >= threshold)


def with_spans(
    docs: DataFrame, *, text: str = "text", into: str = "pii", window: int = 40, threshold: float = 0.5
) -> DataFrame:
    """``docs`` with a struct column ``into``: for each kind an array of (start, end, score).

    A column of that name is replaced; to keep it, name another.
    """
    body = text_or_empty(text)
    none = F.array().cast("array<struct<start:int,end:int,score:double>>")
    fields = [
        F.when(body.rlike(PATTERNS[kind]), _found(body, kind, window, threshold)).otherwise(none).alias(kind)
        for kind in PRIOR
    ]
    return docs.withColumn(into, F.struct(*fields))


def spans(found: str, kinds=tuple(PRIOR)) -> Column:
    """All spans of ``kinds`` in a column made by ``with_spans``, in the order in which they are listed."""
    return F.array_sort(F.concat(*[labelled(F.col(f"`{found}`.{k}"), k, RANK[k]) for k in kinds]))


def redacted(docs: DataFrame, *, text: str = "text", n_chars: str | None = None, **options) -> DataFrame:
    """``docs`` with each span replaced by its kind, as in ``[EMAIL]``; ``n_chars``, if named, is counted anew."""
    found, listed = fresh(docs, "pii"), fresh(docs, "pii_spans")
    out = with_spans(docs, text=text, into=found, **options).withColumn(listed, spans(found))
    out = out.withColumn(text, F.when(F.size(listed) > 0, replaced(col(text), F.col(listed))).otherwise(col(text)))
    if n_chars:
        out = out.withColumn(n_chars, F.when(F.size(listed) > 0, F.length(col(text))).otherwise(col(n_chars)))
    return out.drop(found, listed)
