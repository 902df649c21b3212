"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import let

CONTEXT_CHARS = 40
KEEP_SCORE = 0.5
CONTEXT_BONUS = 0.3
CHECK_BONUS = 0.3
#: Running totals are built in runs of this length.
RUN = 128


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes; ``holds`` (on the matched text) must confirm; a span needs ``KEEP_SCORE``.

    The score is ``prior``, plus a bonus if a checksum confirmed it, plus a bonus if a word of ``context`` stands near:
    within ``CONTEXT_CHARS`` on either side, up to the next match of the kind.
    Patterns take what they can without giving back, and start at no place inside a run they would have taken whole, so
    matching is linear in the text; that changes no match.
    """

    name: str
    hint: str
    pattern: str
    holds: Callable[[Column], Column] | None = None
    checksum: bool = False
    prior: float = 0.5
    context: Sequence[str] = ()


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ip(value: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def _mod97(value: Column) -> Column:
    """International account numbers: country and check digits to the end, letters as 10 to 35, remainder 1."""
    compact = F.replace(value, F.lit(" "))
    turned = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


#: The base kinds keep every confirmed span; the others are added where checksum or context speak for them.
BASE = (
    Kind(
        "email",
        "@",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        context=("mail", "email", "contact", "contacto", "kontakt", "courriel"),
    ),
    Kind("ip", ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, context=("ip", "address", "server", "host")),
    Kind(
        "card",
        "",
        r"[0-9](?:[\x20-]?[0-9])++",
        _card,
        checksum=True,
        context=("card", "visa", "mastercard", "karte", "carte", "tarjeta", "credit"),
    ),
    Kind(
        "phone",
        "+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda v: F.length(_digits(v)).between(10, 15),
        context=("tel", "phone", "call", "mobile", "fax", "telefon", "telefono", "téléphone", "appeler"),
    ),
)
ADDED = (
    Kind(
        "iban",
        "",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        _mod97,
        checksum=True,
        prior=0.3,
        context=("iban", "account", "bank", "konto", "compte", "cuenta"),
    ),
    Kind(
        "local_phone",
        "",
        r"(?<![A-Za-z0-9+.(/-])(?:\([0-9]{2,4}\)[\x20-]?|0[0-9]{1,4}[\x20/-])[0-9]{3,4}[\x20-]?[0-9]{3,4}(?![0-9])",
        prior=0.3,
        context=("tel", "phone", "call", "mobile", "fax", "telefon", "telefono", "téléphone", "appeler"),
    ),
)

_SPAN = "array<struct<start:bigint,place:int,end:bigint,kind:string,value:string,score:double>>"


def _running(steps: Column) -> Column:
    """Running totals of an array of longs, in runs, so that long arrays are not copied once per element."""
    extend = lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x)
    zero = F.array(F.lit(0).cast("long"))

    def totals(all_steps: Column) -> Column:
        last = F.floor((F.size(all_steps) - 1) / F.lit(RUN)).cast("int")
        runs = F.transform(
            F.sequence(F.lit(0), last),
            lambda b: F.aggregate(F.slice(all_steps, b * RUN + 1, RUN), zero, extend),
        )

        def joined(all_runs: Column) -> Column:
            heads = F.aggregate(F.transform(all_runs, lambda r: F.element_at(r, -1)), zero, extend)
            return let(
                heads,
                lambda h: F.flatten(
                    F.transform(
                        all_runs,
                        lambda r, b: F.transform(F.slice(r, 2, RUN), lambda x: x + F.get(h, b)),
                    )
                ),
            )

        return let(runs, joined)

    return let(steps, totals)


def _spans(text: Column, kind: Kind, place: int) -> Column:
    """Confirmed spans of one kind. Ends are running totals over the gaps between matches and the matches."""
    near = "(^|[^a-zà-ÿ])(" + "|".join(kind.context) + ")($|[^a-zà-ÿ])"

    def spans(matches: Column) -> Column:
        def of_gaps(gaps: Column) -> Column:
            steps = F.transform(matches, lambda m, i: (F.length(m) + F.length(F.get(gaps, i))).cast("long"))

            def of_ends(ends: Column) -> Column:
                def span(match: Column, i: Column) -> Column:
                    around = F.concat(
                        F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS)),
                        F.lit(" "),
                        F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS)),
                    )
                    bonus = F.when(F.lower(around).rlike(near), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
                    score = F.lit(kind.prior + (CHECK_BONUS if kind.checksum else 0.0)) + bonus
                    return F.struct(
                        (F.get(ends, i) - F.length(match)).alias("start"),
                        F.lit(place).alias("place"),
                        F.get(ends, i).alias("end"),
                        F.lit(kind.name).alias("kind"),
                        match.alias("value"),
                        F.least(score, F.lit(1.0)).alias("score"),
                    )

                return F.transform(matches, span)

            return let(_running(steps), of_ends)

        none = F.array().cast(_SPAN)
        found = F.when(F.size(matches) > 0, let(F.split(text, kind.pattern, -1), of_gaps).cast(_SPAN)).otherwise(none)
        good = lambda s: s["score"] >= KEEP_SCORE
        if kind.holds is not None:
            good = lambda s: (s["score"] >= KEEP_SCORE) & kind.holds(s["value"])
        return F.filter(found, good)

    every = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), spans)
    if kind.hint:
        return F.when(F.contains(text, F.lit(kind.hint)), every).otherwise(F.array().cast(_SPAN))
    return every


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def find_pii(docs: DataFrame, base: Sequence[Kind] = BASE, added: Sequence[Kind] = ADDED) -> DataFrame:
    """``docs`` with ``spans``: an array of ``start, place, end, kind, value, score`` by start, then kind as listed.

    Offsets are code points, the end is excluded. Matches of a kind are leftmost and do not overlap; a match that its
    checksum or rule refutes is dropped and not tried again. Spans of different kinds may overlap.

    Null and empty texts have no spans. Repeated rows get equal spans. An empty table gives an empty one. ``spans``
    replaces a column of that name; all others are carried.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = [_spans(text, kind, place) for place, kind in enumerate([*base, *added])]
    return docs.withColumn("spans", F.sort_array(F.concat(*found)))


def pii_digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds and digests of the spans of each row; cases as in :func:`find_pii`."""
    found = find_pii(docs.select("doc_id", "text")).drop("text")
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    return found.select(
        "doc_id",
        *(count(kind.name).alias(f"n_{kind.name}") for kind in BASE),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )

