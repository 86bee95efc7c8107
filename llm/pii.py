"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Built-in expressions only. A pattern's matches are leftmost and do not overlap; a
match that its validator refuses is dropped and not tried again from inside. Four
base kinds (email, ip, card, phone) stand whatever their context; further kinds need
a score of ``ACCEPTED``, which takes a checksum (IBAN) or a word nearby that names them.

Offsets count code points from 0, ends exclusive. Patterns are written to run in
time linear in the text: possessive repeats, and no start inside a run that another
start has seen fail.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from llm.shared import free_name

ACCEPTED = 0.8
NEARBY = 40
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    """What is looked for: how often a match is right by itself, confirmed, and named nearby."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    context: str
    needs: str = ""  # a literal that every match holds
    base: bool = False
    alone: bool = False  # no letter or digit may touch the match
    plain: float = 0.5
    confirmed: float = 0.3
    named: float = 0.2


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _octets(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"\A{part}(?:\.{part}){{3}}\z")


def _luhn(low: int, high: int) -> Callable[[Column], Column]:
    return lambda m: F.length(_digits(m)).between(low, high) & F.call_function("luhn_check", _digits(m))


def _mod97(match: Column) -> Column:
    """The remainder of an IBAN whose first four characters went to its end, letters as 10 to 35."""
    packed = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(packed, 5, 99), F.substring(packed, 1, 4))
    value = lambda c: F.ascii(c) - F.when(c >= "A", F.lit(55)).otherwise(F.lit(48))
    step = lambda r, c: F.pmod(r * F.when(c >= "A", F.lit(100)).otherwise(F.lit(10)) + value(c), F.lit(97))
    return F.length(packed).between(15, 34) & (F.aggregate(F.split(moved, "(?<=.)(?=.)"), F.lit(0), step) == 1)


def _random_looking(match: Column) -> Column:
    """Long hex or base64: many different signs, digits among letters, and no letter or digit too often."""
    signs = F.split(match, "(?<=.)(?=.)")
    different = F.size(F.array_distinct(signs))
    mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return mixed & (different >= 9) & (F.length(F.regexp_replace(match, "[^0-9]", "")) >= 3)


# The four base patterns are fixed by their contract; see the module text for how they are written.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        needs="@",
        base=True,
        context="mail|contact|kontakt|correo|courriel|write to|schreib",
    ),
    Kind(
        "ip",
        r"(?=[0-9])(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _octets,
        needs=".",
        base=True,
        context="address|adresse|host|server|login|dirección",
    ),
    Kind(
        "card",
        # A whole run of digits with single spaces or hyphens between them, of 16 to 19 digits.
        r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
        _luhn(16, 19),
        base=True,
        context="card|visa|master|karte|carte|tarjeta|credit|kredit",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: F.length(_digits(m)).between(8, 15),
        needs="+",
        base=True,
        context="tel|phone|call|fax|mobil|anruf|llam|appel",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
        _mod97,
        alone=True,
        plain=0.4,
        confirmed=0.4,
        context="iban|account|konto|cuenta|compte|bank|banque|banco",
    ),
    Kind(
        "secret",
        # Runs as keys and tokens have them; what they hold must look drawn at random.
        r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])",
        _random_looking,
        plain=0.3,
        confirmed=0.2,
        named=0.4,
        context=r"(?:token|secret|key|schl\u00fcssel|clave|jeton|passw|pwd|credential|bearer|auth)[a-z_-]{0,12}[\"']?\s*(?:[:=]|is\b|ist\b|es\b|est\b)?\s*[\"']?\n",
    ),
    Kind(
        "ssn",
        r"[0-9-]{11,}+",
        lambda m: m.rlike(r"\A(?:00[1-9]|0[1-9][0-9]|[1-578][0-9]{2}|6[0-57-9][0-9]|66[0-57-9])-(?:0[1-9]|[1-9][0-9])-(?!0000)[0-9]{4}\z"),
        needs="-",
        plain=0.3,
        confirmed=0.2,
        named=0.4,
        context="ssn|social security",
    ),
    Kind(
        "card_short",
        r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
        _luhn(13, 15),
        plain=0.2,
        confirmed=0.3,
        named=0.4,
        context="card|amex|diners|visa|karte|carte|tarjeta|credit|kredit",
    ),
)

SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, kind: Kind) -> Column:
    """The accepted spans of one kind in text order.

    Everything is read off the stretches between matches, so the work is linear in
    the text. Context is at most ``NEARBY`` code points of the stretch on either side.
    """
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    parts = F.struct(F.split(text, kind.pattern, -1).alias("gaps"), matches.alias("matches"))
    zipped = lambda p: F.arrays_zip(
        p["gaps"].alias("gap"), p["matches"].alias("match"), F.slice(p["gaps"], 2, F.size(p["matches"])).alias("next")
    )

    def step(state: Column, row: Column) -> Column:
        # The last gap has no match; only accepted spans are appended.
        start = state["at"] + F.length(row["gap"])
        end = start + F.coalesce(F.length(row["match"]), F.lit(0))
        near = F.lower(F.concat(F.substring(row["gap"], -NEARBY, NEARBY), F.lit("\n"), F.substring(row["next"], 1, NEARBY)))
        score = F.lit(kind.plain + kind.confirmed) + F.when(near.rlike(kind.context), F.lit(kind.named)).otherwise(F.lit(0.0))
        taken = kind.valid(row["match"])
        if kind.alone:
            beside = F.concat(F.substring(row["gap"], -1, 1), F.substring(row["next"], 1, 1))
            taken = taken & ~beside.rlike("[A-Za-z0-9]")
        if not kind.base:
            taken = taken & (score >= ACCEPTED - 1e-9)
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        found = F.when(row["match"].isNotNull() & taken, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    empty = F.array().cast(SPANS)
    zero = F.lit(0).cast("bigint").alias("at")
    # Blocks of matches with offsets of their own, then moved to their place: appending
    # copies, and so costs a block's length at most.
    def blocks(rows: Column) -> Column:
        count = F.greatest(F.ceil(F.size(rows) / BLOCK), F.lit(1)).cast("int")
        block = lambda b: F.aggregate(F.slice(rows, b * BLOCK + 1, F.lit(BLOCK)), F.struct(zero, empty.alias("found")), step)
        return F.transform(F.sequence(F.lit(0), count - 1), block)

    def place(state: Column, block: Column) -> Column:
        move = lambda s: F.struct(s["kind"], (s["start"] + state["at"]).alias("start"), (s["end"] + state["at"]).alias("end"), s["score"])
        moved = F.concat(state["found"], F.array(F.transform(block["found"], move)))
        return F.struct((state["at"] + block["at"]).alias("at"), moved.alias("found"))

    none = F.struct(zero, F.array().cast(f"array<{SPANS}>").alias("found"))
    found = F.when(F.size(matches) > 0, F.flatten(F.aggregate(_let(_let(parts, zipped), blocks), none, place, lambda s: s["found"]))).otherwise(empty)
    return F.when(F.instr(text, kind.needs) > 0, found).otherwise(empty) if kind.needs else found


def find_pii(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS, name: str = "pii") -> DataFrame:
    """``docs`` with ``name``: the spans found, by kind as listed, then by start.

    Keeps every row and every other column; a column of that name is replaced. A
    null or empty text has no spans.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    per_kind = [_spans(whole, kind) for kind in kinds]
    return docs.withColumn(name, F.concat(*per_kind))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets.

    Spans that overlap become one, under the kind that starts first. Texts without
    spans, null among them, stay as they are.
    """
    spans, joint = free_name(docs, "pii"), free_name(docs, "merged")
    found = find_pii(docs, text, kinds, spans)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def merge(state: Column, span: Column) -> Column:
        last = F.element_at(state, -1)
        joined = F.struct(last["start"], F.greatest(last["end"], span["end"]).alias("end"), last["kind"])
        overlaps = (F.size(state) > 0) & (F.coalesce(F.try_element_at(state, F.lit(-1))["end"], F.lit(0)) > span["start"])
        return F.when(overlaps, F.concat(F.slice(state, 1, F.size(state) - 1), F.array(joined))).otherwise(F.concat(state, F.array(span)))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    merged = found.withColumn(joint, F.aggregate(ordered, empty, merge))
    body = F.col(text)

    def piece(span: Column, i: Column) -> Column:
        begin = F.when(i > 0, F.coalesce(F.get(F.col(joint), i - 1)["end"], F.lit(0))).otherwise(F.lit(0))
        kept = F.substring(body, (begin + 1).cast("int"), (span["start"] - begin).cast("int"))
        return F.concat(kept, F.lit("["), F.upper(span["kind"]), F.lit("]"))

    rest = F.substring(body, (F.element_at(joint, -1)["end"] + 1).cast("int"), F.length(body))
    replaced = F.concat(F.array_join(F.transform(joint, piece), ""), rest)
    return merged.withColumn(text, F.when(F.size(joint) > 0, replaced).otherwise(body)).drop(joint, spans)


def pii_digest(docs: DataFrame) -> DataFrame:
    """One row per input row: base counts, the digest of the base spans, and all spans as text."""
    found = find_pii(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    names = [kind.name for kind in KINDS if kind.base]
    count = lambda name: F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long")
    base = F.filter("pii", lambda s: s["kind"].isin(names))
    return found.select(
        "doc_id",
        *(count(name).alias(f"n_{name}") for name in names),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
    )
