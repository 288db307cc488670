"""Personal data: patterns propose spans, checksums confirm, context scores.

All spans of a text are found inside its own row with SQL functions: there is
no explode, shuffle or Python.  ``regexp_extract_all`` of ``gap`` and ``match``
pairs (a lazy gap, then the pattern, anchored where the last match ended) gives
the same matches as a leftmost non-overlapping search; summing the lengths of
gaps and matches gives positions in code points.

Kinds:

* ``email``, ``ip``, ``card`` (Luhn), ``phone``: the base kinds.
* ``iban``: the length of its country (``IBAN_LENGTHS``), or 15-34 letters and digits
  where the country has none, confirmed by mod 97.
* ``local_phone``: ``NNN-NNN-NNNN`` without a country code; many other numbers have
  this shape, so these need a context word nearby.

Every span has a score in hundredths: the kind's prior, plus ``CONTEXT_BONUS`` if
one of the kind's context words stands in the ``CONTEXT_CHARS`` code points
before it (back to the previous match of the kind at most).  Spans under
``MIN_SCORE`` are dropped; base kinds start at or above it and always stay.

Edge cases: a null or empty text has no spans; repeated rows each give their own
result; an empty table gives an empty one; other columns are passed by or
ignored, whatever their names.  The patterns never backtrack over a run twice,
so a very long text costs time in proportion to its length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
CONTEXT_BONUS = 30
MIN_SCORE = 50
# Spans are gathered in blocks of so many: no bound on a text's spans.
SPAN_BLOCK = 256


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # Java regex, possessive where a run need not be given back
    sql_pattern: str  # the same language for RE2
    needs: str  # a cheap test that every text with a match passes
    prior: int
    context: str


# Characters of an IBAN by country (SWIFT's IBAN registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU"}
_COUNTRIES = "|".join(IBAN_LENGTHS.values())
_IBAN = "|".join(rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9_])" for n, c in IBAN_LENGTHS.items())

_LOCAL = "A-Za-z0-9._%+-"
# Fixed values of the contract: the four base patterns.  A match can only start
# where its first run starts (or right after the last match), which the
# look-behinds state, so failed starts inside a run are not tried again.
KINDS = (
    Kind("email",
         rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         rf"[{_LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
         "@", 70, "mail|email|contact|write|correo|courriel"),
    Kind("ip",
         r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
         r"[0-9]\.[0-9]", 60, "ip|host|server|address|login"),
    Kind("card",
         r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
         r"[0-9](?:[\x20-]?[0-9])+",
         r"[0-9](?:[\x20-]?[0-9]){15}", 60, "card|visa|credit|payment|karte|carte|tarjeta"),
    Kind("phone",
         r"\+[0-9][\x20().0-9-]+[0-9]",
         r"\+[0-9][\x20().0-9-]+[0-9]",
         r"\+[0-9]", 60, "phone|tel|call|mobile|fax"),
    Kind("iban",
         rf"(?<![A-Za-z0-9_])(?:{_IBAN}|(?!{_COUNTRIES})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9_]))",
         r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
         r"[A-Z]{2}[0-9]{2}", 60, "iban|account|bank|konto|compte|cuenta"),
    Kind("local_phone",
         r"(?<![A-Za-z0-9_])[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9_])",
         r"\b[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}\b",
         r"[0-9]{3}[\x20.-][0-9]{4}", 30, "phone|tel|call|mobile|fax"),
)
BASE_KINDS = ("email", "ip", "card", "phone")
SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,value:string,score:int>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(total: Column, d: Column) -> Column:
        return total + d

    from_right = F.split(F.reverse(number), "")
    values = F.transform(from_right, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(values, F.lit(0), add) % 10 == 0


def mod_97(iban: Column) -> Column:
    """Whether an IBAN's check digits are right: move the first four characters
    to the end, letters become 10-35, the number modulo 97 is 1."""
    compact = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.split(F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4)), "")

    def fold(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return (F.length(compact).between(15, 34)) & (F.aggregate(moved, F.lit(0), fold) == 1)


def _ip_ok(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3)
                    & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))


CONFIRM = {
    "email": lambda v: F.lit(True),
    "ip": _ip_ok,
    "card": lambda v: F.length(digits(v)).between(16, 19) & luhn(digits(v)),
    "phone": lambda v: F.length(digits(v)).between(8, 15),
    "iban": mod_97,
    "local_phone": lambda v: F.lit(True),
}


def kind_spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, in order of start (empty array: none)."""
    both = rf"(?s)\G(.*?)({kind.pattern})"
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(both), F.lit(1)).alias("gap"),
                         F.regexp_extract_all(text, F.lit(both), F.lit(2)).alias("hit"))
    context = rf"(?i)(?:^|[^A-Za-z])(?:{kind.context})(?:[^A-Za-z]|$)"
    none = F.array().cast(SPAN_TYPE)

    def step(acc: Column, pair: Column) -> Column:
        gap, hit = pair["gap"], pair["hit"]
        begin = acc["at"] + F.length(gap)
        end = begin + F.length(hit)
        score = F.lit(kind.prior) + F.when(F.right(gap, F.lit(CONTEXT_CHARS)).rlike(context), CONTEXT_BONUS).otherwise(0)
        span = F.struct(F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"),
                        hit.alias("value"), score.cast("int").alias("score"))
        ok = CONFIRM[kind.name](hit) & (score >= MIN_SCORE)
        return F.struct(end.alias("at"), F.when(ok, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    def block(acc: Column, part: Column) -> Column:
        # The spans of a block are gathered by themselves: adding one copies those of its block only.
        start = F.struct(acc["at"].alias("at"), none.alias("found"))
        return F.aggregate(part, start, step, lambda r: F.struct(
            r["at"].alias("at"), F.concat(acc["found"], F.array(r["found"])).alias("found")))

    def blocks(all_pairs: Column) -> Column:
        last = F.floor(F.greatest(F.size(all_pairs) - 1, F.lit(0)) / SPAN_BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_pairs, i * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)))

    # A lambda's argument is computed once, so the pairs are matched once and not for each block.
    cut = F.transform(F.array(pairs), blocks)[0]
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN_TYPE}>").alias("found"))
    found = F.flatten(F.aggregate(cut, start, block, lambda acc: acc["found"]))
    return F.when(text.rlike(kind.needs), found).otherwise(F.array().cast(SPAN_TYPE))


def find_pii(docs: DataFrame, text_col: str = "text", into: str = "spans") -> DataFrame:
    """``docs`` with an array of all spans (kind, start, end, value, score), by
    kind as in ``KINDS``, then start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(into, F.concat(*[kind_spans(text, k) for k in KINDS]))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with counts, the digest of the base spans and all
    spans (columns of the op1 query)."""
    found = find_pii(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).drop("text")

    def n(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", *[n(k.name) for k in KINDS],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0)).alias("max_score"),
    )
