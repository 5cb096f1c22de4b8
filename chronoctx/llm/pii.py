"""Personal data: patterns propose spans, checksums confirm them, words nearby
adjust their score. Column expressions only.

Patterns are leftmost and non-overlapping within a kind. They are written with
possessive repeats and anchors at the start of a run, which match the same
spans as the plain forms in one pass without backtracking or deep recursion.
Account numbers are confirmed before they are matched, so what is none hides none.

Positions count code points. A null text counts as empty and has no spans;
rows stand alone, so repeated rows, ties and clashing extra columns are
harmless; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from chronoctx.llm.common import let, text_of

#: Positions are summed in runs of this many spans, so a text with very many
#: spans costs n * RUN steps rather than n * n.
RUN = 128
#: Context is looked for in this many characters on each side of a span, whatever they are.
NEAR = 40
#: Every match has two characters or more, so as many neighbouring ones reach as far as NEAR.
NEAR_MATCHES = NEAR // 2


@dataclass(frozen=True)
class Kind:
    """``gate`` is a cheap test that a text can have such a span at all;
    ``valid`` confirms a match; ``score`` is its weight, ``lift`` what a context
    word adds. Spans below ``least`` are dropped. ``confirmed`` makes of a text
    the pattern of its confirmed spans, for a kind whose unconfirmed matches could
    reach into another span."""

    name: str
    gate: Callable[[Column], Column]
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    lift: float = 0.0
    least: float = 0.0
    confirmed: Callable[[Column], Column] | None = None


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    def step(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        doubled = (F.length(digits) - place) % 2 == 1
        twice = digit * 2
        return total + F.when(doubled, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an IBAN without spaces leaves 1 when divided by 97, letters
    counting from 10 and the first four characters moved to the end."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, place: Column) -> Column:
        value = F.ascii(F.substring(moved, place, F.lit(1)))
        return F.when(value >= 65, (rest * 100 + value - 55) % 97).otherwise((rest * 10 + value - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _card(match: Column) -> Column:
    return let(digits_of(match), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))


def _ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) <= 3) & (F.coalesce(F.try_to_number(F.lpad(bare, 3, "0"), F.lit("999")), F.lit(0)) <= 255)

    return F.forall(F.split(match, r"\.", -1), small)


def _iban(match: Column) -> Column:
    return let(F.regexp_replace(match, " ", ""), lambda c: F.when(F.length(c).between(15, 34), mod97(c)).otherwise(F.lit(False)))


#: Countries by the length of their account numbers.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_COUNTRIES = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")


def _iban_forms() -> str:
    """Each country's number in groups of four, with or without spaces; of other
    countries the longest that can be one."""
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}(?![A-Za-z0-9])")
    other = rf"(?!{_COUNTRIES})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}+(?:\x20?[A-Z0-9]{{1,3}})?+"
    return "|".join([*forms, other])


_IBAN_START = r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2}[\x20A-Z0-9])"
#: Takes only the first four characters, so each place that can begin a number is seen.
_IBAN = rf"{_IBAN_START}(?=({_iban_forms()}))[A-Z]{{2}}[0-9]{{2}}"


def _confirmed_ibans(text: Column) -> Column:
    """A pattern of the account numbers in a text, longer ones before those they
    begin with. Of a country without a known length every cut is tried."""
    def cuts(longest: Column) -> Column:
        return F.when(longest.rlike(f"^(?:{_COUNTRIES})"), F.array(longest)).otherwise(F.transform(
            F.sequence(F.lit(1), F.length(longest)), lambda n: F.rtrim(F.substring(longest, F.lit(1), n))))

    found = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_IBAN), F.lit(1)), cuts))
    return let(F.sort_array(F.filter(F.array_distinct(found), _iban), asc=False), lambda codes: F.when(
        F.size(codes) > 0, F.concat(F.lit(f"{_IBAN_START}(?:"), F.array_join(codes, "|"), F.lit(")(?![A-Za-z0-9])")),
    ).otherwise(F.lit("(?!)")))


def _has_digit(text: Column) -> Column:
    return text.rlike("[0-9]")


#: The kinds every caller gets, in the order that settles ties.
BASE = (
    Kind("email", lambda t: t.contains("@"),
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m: F.lit(True), 0.9, r"(?i)\b(mail|e-?mail|contact|correo|write|courriel)\b", 0.1),
    Kind("ip", _has_digit, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, 0.6,
         r"(?i)\b(ip|host|server|address|login|from)\b", 0.3),
    Kind("card", _has_digit, r"[0-9](?:[\x20-]?[0-9])++", _card, 0.7,
         r"(?i)\b(card|visa|mastercard|credit|karte|carte|tarjeta|pay)\b", 0.3),
    Kind("phone", lambda t: t.contains("+"), r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda m: F.length(digits_of(m)).between(10, 15), 0.6,
         r"(?i)\b(phone|tel|call|mobile|fax|telefon|teléfono|téléphone)\b", 0.3),
)
#: Kinds of the method: mod-97 confirms account numbers, context words carry
#: social security numbers, whose form alone says little.
ADDED = (
    Kind("iban", lambda t: t.rlike(_IBAN), _IBAN, lambda m: F.lit(True), 0.9,
         r"(?i)\b(iban|account|bank|konto|compte|cuenta)\b", 0.1, confirmed=_confirmed_ibans),
    Kind("ssn", _has_digit, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: ~m.rlike("^(000|666|9)"), 0.3,
         r"(?i)\b(ssn|social security|tax id|steuernummer)\b", 0.5, 0.5),
)
KINDS = BASE + ADDED
_SPAN = "array<struct<start:int,kind:int,end:int,score:double>>"


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def starts_of(lengths: Column) -> Column:
    """What stands before each element: running sums, in runs."""
    def with_runs(runs: Column) -> Column:
        def with_sums(sums: Column) -> Column:
            return F.flatten(F.transform(runs, lambda run, k: let(
                _total(F.slice(sums, F.lit(1), k)),
                lambda base: F.transform(run, lambda _, i: base + _total(F.slice(run, F.lit(1), i))),
            )))

        return let(F.transform(runs, _total), with_sums)

    count = F.ceil(F.size(lengths) / RUN).cast("int")
    return let(F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(lengths, k * RUN + 1, F.lit(RUN))), with_runs)


def spans_of_kind(text: Column, kind: Kind, order: int) -> Column:
    """Confirmed spans of one kind as ``(start, kind, end, score)``. The parts
    between matches give the positions: a match starts after all parts and
    matches before it."""
    def placed(pair: Column) -> Column:
        found, gaps = pair["found"], pair["gaps"]
        before = starts_of(F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m)))

        def span(start: Column, i: Column) -> Column:
            match, gap = F.get(found, i), F.get(gaps, i)
            at = start + F.length(gap)
            return F.struct(
                at.alias("start"), F.lit(order).alias("kind"), (at + F.length(match)).alias("end"),
                _score(kind, pair, i).alias("score"), kind.valid(match).alias("valid"),
            )

        return F.filter(F.transform(before, span), lambda s: s["valid"] & (s["score"] >= kind.least))

    none = F.array().cast(_SPAN)
    found = let(
        _matches(text, kind),
        lambda pair: F.when(F.size(pair["found"]) == 0, none).otherwise(F.transform(placed(pair), lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["score"].alias("score")))),
    )
    return F.when(kind.gate(text), found).otherwise(none)


def _matches(text: Column, kind: Kind) -> Column:
    """All matches and the parts between them, one part more than matches, and
    the last characters of each part with the match after it, the first ones of
    each match with the part after it."""
    def cut(pattern: Column) -> Column:
        return F.struct(
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))

    def with_ends(pair: Column) -> Column:
        ends = F.transform(pair["found"], lambda m, i: F.right(F.concat(F.get(pair["gaps"], i), m), F.lit(NEAR)))
        heads = F.transform(pair["found"], lambda m, i: F.left(F.concat(m, F.get(pair["gaps"], i + 1)), F.lit(NEAR)))
        return F.struct(pair["found"].alias("found"), pair["gaps"].alias("gaps"), ends.alias("ends"), heads.alias("heads"))

    return let(let(kind.confirmed(text), cut) if kind.confirmed else cut(F.lit(kind.pattern)), with_ends)


def _before(pair: Column, i: Column) -> Column:
    """The characters before match ``i`` that context is looked for in."""
    gap, first = F.get(pair["gaps"], i), F.greatest(i - NEAR_MATCHES, F.lit(0))
    earlier = F.array_join(F.slice(pair["ends"], first + 1, i - first), "")
    return F.right(F.when(F.length(gap) < NEAR, F.concat(earlier, gap)).otherwise(gap), F.lit(NEAR))


def _after(pair: Column, i: Column) -> Column:
    """The characters after match ``i`` that context is looked for in."""
    gap = F.get(pair["gaps"], i + 1)
    later = F.array_join(F.slice(pair["heads"], i + 2, F.lit(NEAR_MATCHES)), "")
    return F.left(F.when(F.length(gap) < NEAR, F.concat(gap, later)).otherwise(gap), F.lit(NEAR))


def _score(kind: Kind, pair: Column, i: Column) -> Column:
    near = _before(pair, i).rlike(kind.context) | _after(pair, i).rlike(kind.context)
    return F.round(F.lit(kind.score) + F.when(near, F.lit(kind.lift)).otherwise(0.0), 3)


def spans(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All confirmed spans by start, then kind, then end."""
    return F.array_sort(F.concat(*[spans_of_kind(text, kind, i) for i, kind in enumerate(kinds)]))


def masked(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """The text with each confirmed span replaced by its kind in brackets, one
    kind after the other, so a span inside an earlier one is gone with it."""
    for kind in kinds:
        text = let(text, partial(_mask_kind, kind))
    return text


def _mask_kind(kind: Kind, text: Column) -> Column:
    def rebuilt(pair: Column) -> Column:
        found, gaps = pair["found"], pair["gaps"]

        def tagged(match: Column, i: Column) -> Column:
            return F.when(kind.valid(match) & (_score(kind, pair, i) >= kind.least), F.lit(f"[{kind.name.upper()}]")).otherwise(match)

        parts = F.transform(gaps, lambda gap, i: F.concat(
            gap, F.when(i < F.size(found), tagged(F.get(found, i), i)).otherwise("")))
        return F.when(F.size(found) > 0, F.array_join(parts, "")).otherwise(text)

    return F.when(kind.gate(text), let(_matches(text, kind), rebuilt)).otherwise(text)


def joined(found: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in kinds])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``doc_id`` and its ``found`` spans, one row per document."""
    return docs.select("doc_id", spans(text_of("text"), kinds).alias("found"))


def _equal(value: int, element: Column) -> Column:
    return element == value


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, and the spans as texts and hash."""
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, partial(_equal, i))).cast("long").alias(f"n_{kind.name}") for i, kind in enumerate(BASE)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def masked_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked and lengths set anew."""
    clean = docs.withColumn("text", masked(text_of("text")))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean
