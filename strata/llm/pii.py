"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust their score.
Only DataFrame functions; every document is a row of its own, so nothing is shuffled.

The patterns are written so that the regex engine neither recurses nor rescans long runs: possessive repeats where
what follows can't match the repeated class, and a look-behind (or the last match's end, ``\\G``) that lets a match
start at the beginning of a run only. The proposals are those of the plain patterns. IBANs are proposed at every place
where one can start, with the length of their country.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bound

#: Code points on both sides of a span that are searched for context words.
CONTEXT = 48
#: Spans of the kinds that need a score are kept from this score on; base kinds always are.
MIN_SCORE = 0.5
CONTEXT_SCORE, CHECKSUM_SCORE = 0.3, 0.4


def _luhn(found: Column) -> Column:
    def total(digits: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            d = F.substr(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return acc + F.when(d > 9, d - 9).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)

    return bound(F.regexp_replace(found, "[^0-9]", ""), total) % 10 == 0


def _mod97(found: Column) -> Column:
    """ISO 7064 mod 97-10, as IBANs use it: the first four characters go last, letters count from 10."""
    turned = bound(F.regexp_replace(found, " ", ""), lambda x: F.concat(F.substring(x, 5, 1000), F.substring(x, 1, 4)))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _digits(found: Column) -> Column:
    return F.length(F.regexp_replace(found, "[^0-9]", ""))


OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: float
    context: str
    #: What every kept match must pass; None: nothing.
    valid: Callable[[Column], Column] | None = None
    #: Whether ``valid`` is a checksum.
    checksum: bool = False
    #: A text without this string has no match.
    needs: str | None = None
    #: The whole span, found from the match's start on; None: the match. A match that is only the start of a span can't
    #: hide another start.
    whole: str | None = None


#: IBAN lengths by country: the ISO 13616 registry, then countries that use the form without being in it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN_LENGTHS_UNLISTED = {25: "AO CV GW MZ", 26: "DZ IR", 27: "CF CG CM GA GQ KM MG TD", 28: "BF BJ CI MA ML NE SN TG"}


def _iban() -> str:
    """An IBAN in groups of four, with or without spaces, as long as its country's are. Under other codes the groups go
    as far as they can."""
    def groups(n: int) -> str:
        return rf"(?: ?[A-Z0-9]{{4}}){{{n // 4}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")

    known = [(n, c.split()) for table in (IBAN_LENGTHS, IBAN_LENGTHS_UNLISTED) for n, c in table.items()]
    codes = "|".join(c for _, cs in known for c in cs)
    forms = [rf"(?:{'|'.join(cs)})[0-9]{{2}}{groups(n - 4)}" for n, cs in known]
    other = rf"(?!{codes})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}+(?: ?[A-Z0-9]{{1,3}})?+"
    return rf"(?:{'|'.join([*forms, other])})(?![A-Za-z0-9])"


IBAN = _iban()
#: The longest span is so many code points longer than its match: 30 characters and 8 spaces of an IBAN.
REACH = 38

#: The kinds whose valid matches are always kept.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.8,
         "mail|contact|write|kontakt|correo|courriel", needs="@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip|host|server|address|adresse",
         valid=lambda x: x.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), needs="."),
    # a chain of digits starts after anything but a digit, or a digit and one separator; shorter and longer chains
    # fail the digit count and are not proposed
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])", 0.4,
         "card|visa|master|credit|karte|tarjeta|carte", valid=_luhn, checksum=True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", 0.6, "phone|tel|call|mobile|fax|handy",
         valid=lambda x: _digits(x).between(9, 15), needs="+"),
)
#: What the method adds: kept from MIN_SCORE on, and only where no base span lies.
ADDED = (
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}}[ A-Z0-9])(?={IBAN})[A-Z]{{2}}[0-9]{{2}}", 0.3,
         "iban|bank|account|konto|cuenta|compte", valid=_mod97, checksum=True, whole=f"^{IBAN}"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, "ssn|social|security|insurance"),
    Kind("local_phone", r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", 0.3, "phone|tel|call|mobile|fax|handy"),
)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda n, x: n + x)


def _running(lengths: Column) -> Column:
    """Sums of the elements before each, in steps of the square root of their number."""
    def sums(m: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(m["v"]))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(m["v"]) - 1) / step).cast("int")),
                             lambda b: _sum(F.slice(m["v"], b * step + 1, step)))
        return bound(blocks, lambda total: F.transform(m["v"], lambda _, i: (
            _sum(F.slice(total, F.lit(1), F.floor(i / step).cast("int"))) + _sum(F.slice(m["v"], F.floor(i / step).cast("int") * step + 1, i % step)))))

    return F.when(F.size(lengths) > 0, bound(F.struct(lengths.alias("v")), sums)).otherwise(F.array().cast("array<bigint>"))


SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _spans(text: Column, kind: Kind, base: bool) -> Column:
    """Spans of one kind: the text between the matches and the matches themselves give the positions and the text around
    them. A match has at least one code point, so as many matches as code points make up the text beside one."""
    def placed(m: Column) -> Column:
        both = F.transform(m["found"], lambda x, i: (F.length(x) + F.length(F.get(m["rest"], i))).cast("long"))
        left = F.transform(m["found"], lambda x, i: F.right(F.concat(F.get(m["rest"], i), x), F.lit(CONTEXT)))
        right = F.transform(m["found"], lambda x, i: F.substring(F.concat(x, F.get(m["rest"], i + 1)), 1, CONTEXT + REACH))

        def span(x: Column, i: Column, p: Column) -> Column:
            after = F.concat(F.get(m["rest"], i + 1), F.array_join(F.slice(p["right"], i + 2, F.lit(CONTEXT + REACH)), ""))
            if kind.whole is None:
                return scored(x, after, i, p)
            return bound(F.concat(x, F.substring(after, 1, CONTEXT + REACH)), lambda t: bound(
                F.regexp_extract(t, kind.whole, 0), lambda w: scored(w, F.substr(t, F.length(w) + 1), i, p)))

        def scored(x: Column, after: Column, i: Column, p: Column) -> Column:
            start = F.get(p["before"], i) + F.length(F.get(m["rest"], i))
            ahead = F.concat(F.array_join(F.slice(p["left"], F.greatest(i - CONTEXT, F.lit(0)) + 1, F.least(i, F.lit(CONTEXT))), ""), F.get(m["rest"], i))
            near = F.lower(F.concat(F.right(ahead, F.lit(CONTEXT)), F.lit(" "), F.substring(after, 1, CONTEXT)))
            score = F.lit(kind.score) + (CHECKSUM_SCORE if kind.checksum else 0.0) + F.when(
                near.rlike(rf"(?<![a-z])(?:{kind.context})"), CONTEXT_SCORE).otherwise(0.0)
            ok = kind.valid(x) if kind.valid else F.lit(True)
            return F.when(ok, F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(x)).alias("end"),
                                       F.round(score, 3).alias("score")))

        each = bound(F.struct(_running(both).alias("before"), left.alias("left"), right.alias("right")),
                     lambda p: F.transform(m["found"], lambda x, i: span(x, i, p)))
        return F.filter(each, lambda s: s.isNotNull() if base else s.isNotNull() & (s["score"] >= MIN_SCORE))

    split = F.struct(F.split(text, kind.pattern, -1).alias("rest"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"))
    there = text.rlike(kind.pattern) if kind.needs is None else F.contains(text, F.lit(kind.needs)) & text.rlike(kind.pattern)
    return F.coalesce(F.when(there, bound(split, placed)).cast(SPAN), F.array().cast(SPAN))


def find_pii(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Every row with ``base_spans`` and ``spans``: arrays of (kind, start, end, score), code points, end exclusive, by
    kind as listed in BASE and ADDED, then start. ``base_spans`` are all valid matches of the base kinds; ``spans``
    has them and the added kinds' matches that pass their check, score at least MIN_SCORE and overlap no base span.

    Null and empty texts have no spans. Rows don't influence each other: repeated rows and null ids get the same result
    as any. An input column with the name of a result column is left out. An empty table gives no rows.
    """
    added = ["base_spans", "spans"]
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = F.concat(*(_spans(own, k, True) for k in BASE))
    more = F.concat(*(_spans(own, k, False) for k in ADDED))
    free = lambda b, m: F.filter(m, lambda s: ~F.exists(b, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    return (docs.select(*keep, bound(base, lambda b: F.struct(b.alias("base_spans"), F.concat(b, free(b, more)).alias("spans"))).alias("__found"))
            .select(*keep, "__found.*"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
