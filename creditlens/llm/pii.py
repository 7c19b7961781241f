"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Only built-in expressions. Spark's pattern functions give matches without places, so a
text is also split by the same pattern: the pieces between matches and the matches
themselves give every place by running sums. Places count code points, ends exclude.

The patterns are written so that no input makes Java's matcher recurse or retry: runs
are possessive, and a run is only entered at its first character (or where the last
match ended). They find what the plain patterns find.

Context is ``CONTEXT_CHARS`` on each side of a match, in which matches of the same kind
take no room but a blank, so it reaches past them. Matches with only separators or a
short conjunction between them are a list, however long; a context word near one
confirmed member counts for all.
Four base kinds always stay once confirmed. Further kinds stay when their score, raised
by context words near by, reaches ``LEAST_SCORE``.

Defined results: a null or empty text has no spans; spans of different kinds may
overlap and all are reported; each row is judged by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = "A-Za-z0-9._%+-"
#: kind: (pattern, score without context, context words, base kind)
KINDS = {
    "email": (rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write", True),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip|host|server|address|login", True),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", 0.8, "card|credit|visa|payment|cvv|expir", True),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|tel|call|mobile|fax|whatsapp", True),
    "iban": (
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        0.9,
        "iban|bank|account|konto|cuenta|compte",
        False,
    ),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.4, "ssn|social security|taxpayer", False),
    "local_phone": (
        r"(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
        0.4,
        "phone|tel|call|mobile|fax|whatsapp",
        False,
    ),
}
BASE = [kind for kind, (_, _, _, base) in KINDS.items() if base]
CONTEXT_CHARS = 40
#: What may stand between two members of a list.
LIST_GAP = r"(?i)^[\s\p{Punct}]*+(?:(?:and|or|und|oder|et|ou|y|o|e)(?![\p{L}\p{N}])[\s\p{Punct}]*+)?$"
CONTEXT_GAIN = 0.3
LEAST_SCORE = 0.6
#: A character without which a kind cannot match, looked for first.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
BLOCK = 128
SPAN = "array<struct<start: long, kind_no: int, kind: string, end: long, score: double>>"


def _sums(values: Column) -> Column:
    """Exclusive running sums of an array, as (sum, sums)."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("sums"))
    return F.aggregate(
        values,
        start,
        lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["sums"], F.array(acc["sum"])).alias("sums")),
    )


def _running(values: Column) -> Column:
    """Exclusive running sums by blocks, so that long arrays are not copied once per element."""
    blocks = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK)),
        lambda at: _sums(F.slice(values, at, BLOCK)),
    )
    starts = _sums(F.transform(blocks, lambda b: b["sum"]))["sums"]
    return F.flatten(F.zip_with(blocks, starts, lambda block, start: F.transform(block["sums"], lambda v: v + start)))


def _beside(i: Column, tails: Column, heads: Column) -> Column:
    """The text on both sides of match ``i``; a piece between matches may be empty, a blank stands for a match."""
    first = F.greatest(i + 1 - CONTEXT_CHARS, F.lit(1))
    left = F.array_join(F.slice(tails, first, i + 2 - first), " ")
    right = F.array_join(F.slice(heads, i + 2, F.lit(CONTEXT_CHARS + 1)), " ")
    return F.concat_ws(" ", F.right(left, F.lit(CONTEXT_CHARS)), F.left(right, F.lit(CONTEXT_CHARS)))


def luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc + _doubled(F.substring(F.reverse(digits), i, F.lit(1)).cast("int"), i % 2 == 0),
    )
    return total % 10 == 0


def _doubled(digit: Column, twice: Column) -> Column:
    value = F.when(twice, digit * 2).otherwise(digit)
    return F.when(value > 9, value - 9).otherwise(value)


def mod97(iban: Column) -> Column:
    """Whether the account number, its head moved behind and letters as 10 to 35, leaves 1."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    rest = F.aggregate(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        F.lit(0),
        lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*+(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5]|(?<=0))"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(value, r"[\x20-]", "")
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    if kind == "iban":
        plain = F.regexp_replace(value, r"\x20", "")
        return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(F.lit(False))
    if kind == "ssn":
        return ~value.rlike("^(?:000|666|9)") & ~value.rlike("-00-|-0000$")
    return F.lit(True)


def find_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``_spans``, all confirmed spans by start and kind."""
    frame = docs.select(*keep, F.col("text").alias("_pii_text"))
    text = F.col("_pii_text")
    matched, placed, around, judged, summed, spans = {}, {}, {}, {}, {}, {}
    for number, (kind, (pattern, base_score, words, base)) in enumerate(KINDS.items()):
        cue = rf"(?i)\b(?:{words})"
        found = text.rlike(pattern)
        if kind in NEEDS:
            found = F.contains(text, F.lit(NEEDS[kind])) & found
        matched[f"_{kind}_values"] = F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        values = F.col(f"_{kind}_values")
        placed[f"_{kind}_pieces"] = F.when(values.isNotNull(), F.split(text, pattern, -1))
        pieces = F.col(f"_{kind}_pieces")
        cued = values.isNotNull() & text.rlike(cue)
        around[f"_{kind}_left"] = F.slice(pieces, F.lit(1), F.size(values))
        around[f"_{kind}_tails"] = F.when(cued, F.transform(pieces, lambda x: F.right(x, F.lit(CONTEXT_CHARS))))
        around[f"_{kind}_heads"] = F.when(cued, F.transform(pieces, lambda x: F.left(x, F.lit(CONTEXT_CHARS))))
        around[f"_{kind}_sure"] = F.transform(values, lambda x: confirmed(kind, x))
        gap, sure = F.col(f"_{kind}_left"), F.col(f"_{kind}_sure")
        tails, heads = F.col(f"_{kind}_tails"), F.col(f"_{kind}_heads")
        steps = F.zip_with(values, gap, lambda value, before: (F.length(value) + F.length(before)).cast("long"))
        judged[f"_{kind}_before"] = F.when(values.isNotNull(), _running(steps))
        # 1 where a match is confirmed and has a context word, and where a list begins.
        judged[f"_{kind}_near"] = F.when(
            tails.isNotNull(),
            F.transform(
                sure,
                lambda x, i: F.when(x, _beside(i, tails, heads).rlike(cue)).otherwise(F.lit(False)).cast("long"),
            ),
        )
        judged[f"_{kind}_begins"] = F.when(
            tails.isNotNull(), F.transform(gap, lambda x, i: ((i == 0) | ~x.rlike(LIST_GAP)).cast("long"))
        )
        near, begins = F.col(f"_{kind}_near"), F.col(f"_{kind}_begins")
        # Context words before each match and before the end; the list of each match; where each list begins.
        summed[f"_{kind}_seen"] = F.when(near.isNotNull(), _running(F.concat(near, F.array(F.lit(0).cast("long")))))
        summed[f"_{kind}_lists"] = F.when(near.isNotNull(), F.zip_with(_running(begins), begins, lambda x, y: (x + y).cast("int")))
        summed[f"_{kind}_firsts"] = F.when(
            near.isNotNull(),
            F.concat(
                F.filter(F.sequence(F.lit(0), F.size(begins) - 1), lambda i: F.get(begins, i) == 1),
                F.array(F.size(begins)),
            ),
        )
        spans[kind] = (number, base_score, base)
    for layer in (matched, placed, around, judged, summed):
        frame = frame.select("*", *[c.alias(n) for n, c in layer.items()])
    lists = []
    for kind, (number, base_score, base) in spans.items():
        value_of, left_of, at, sure_of = (F.col(f"_{kind}_{x}") for x in ("values", "left", "before", "sure"))
        seen, member, firsts = (F.col(f"_{kind}_{x}") for x in ("seen", "lists", "firsts"))
        near = F.transform(
            member,
            lambda n: F.get(seen, F.get(firsts, n)) > F.get(seen, F.get(firsts, n - 1)),
        )
        near = F.coalesce(near, F.transform(value_of, lambda _: F.lit(False)))
        zipped = F.arrays_zip(
            value_of.alias("value"), left_of.alias("left"), at.alias("before"), sure_of.alias("sure"), near.alias("near")
        )

        def is_sure(x):
            return x["sure"]

        def placed_span(x):
            start = x["before"] + F.length(x["left"])
            end = start + F.length(x["value"])
            score = F.lit(base_score) + F.when(x["near"], F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))
            return F.struct(
                start.alias("start"),
                F.lit(number).alias("kind_no"),
                F.lit(kind).alias("kind"),
                end.cast("long").alias("end"),
                F.least(score, F.lit(1.0)).alias("score"),
            )

        made = F.transform(F.filter(zipped, is_sure), placed_span)
        if not base:
            made = F.filter(made, lambda x: x["score"] >= LEAST_SCORE)
        lists.append(F.coalesce(made, F.array().cast(SPAN)).cast(SPAN))
    return frame.select(*keep, F.array_sort(F.concat(*lists)).alias("_spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
