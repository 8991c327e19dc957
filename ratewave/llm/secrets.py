"""Secret scan: patterns, and Shannon entropy in sliding windows of candidate strings.

Only DataFrame functions.  Matches come from ``regexp_extract_all``; their places from
the lengths of the pieces between them (``split`` by the same pattern), so spans are in
code points.  For the entropy, a candidate is a longest run of one character class; a
window of fixed width slides over it, and its entropy is kept by counts: a step adds one
character and takes one away, and changes sum(c * log2 c) by four terms.  A candidate
counts if the best window reaches the class's threshold and no allow-list pattern covers
it.  Where earlier spans (pattern matches, then earlier classes' spans) overlap it, they are
cut out and what is left, joined, is judged; if it counts, the span is the whole candidate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pattern:
    """``value``: the group whose length counts; it ends where the match ends."""

    kind: str
    regex: str
    value: int
    least: int


@dataclass(frozen=True)
class EntropyClass:
    """Runs of ``chars`` (a character class) with a window of ``width`` and at least ``bits``."""

    kind: str
    chars: str
    width: int
    bits: float


#: The stated patterns, in their stated order.
PATTERNS = (
    Pattern(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Pattern("access", r"AKIA[A-Z0-9]+", 0, 20),
    # a longest run of 24 or more is found where the run begins, as with `+` and a check after it
    Pattern("hex", r"[0-9a-f]{24,}", 0, 24),
)
ENTROPY = (
    EntropyClass("entropy_hex", "0-9A-Fa-f", 24, 3.0),
    EntropyClass("entropy_b64", "A-Za-z0-9+/_-", 20, 3.6),
)
#: Letters that look like a word: one case, one capital at the front, or CamelCase.
WORDLIKE = r"(?:[a-z]+|[A-Z]+|[A-Z][a-z]+|(?:[a-z]{2,})?(?:[A-Z][a-z]{2,})+)"
#: A candidate that one of these covers wholly is no secret: words and numbers, alone or
#: joined, a word with a number after it, dates and times, dashed identifiers (UUID).
ALLOWED = (
    rf"{WORDLIKE}(?:[-_/+]+{WORDLIKE})*[-_/+]*",
    r"[-_/+]*[0-9]+(?:[-_/+]+[0-9]+)*[-_/+]*",
    rf"(?:{WORDLIKE}[0-9]{{0,4}}|[0-9]+)(?:[-_/+]+(?:{WORDLIKE}[0-9]{{0,4}}|[0-9]+))+",
    rf"{WORDLIKE}[0-9]{{1,6}}",
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"[-_/+=]+",
)


def entropy_pattern(c: EntropyClass) -> Pattern:
    return Pattern(c.kind, f"[{c.chars}]{{{c.width},}}", 0, c.width)


def _spans(text: Column, matches: Column, values: Column, pattern: Pattern, order: int) -> Column:
    """Array of (start, ord, end, kind, value_length, found) of the matches that are long enough."""
    pieces = F.split(text, F.lit(pattern.regex), -1)
    rows = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("p"), matches.alias("m"), values.alias("v"))
    kind = "struct<start:bigint,ord:int,end:bigint,kind:string,value:int,found:string>"
    first = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["p"])
        end = start + F.length(x["m"])
        one = F.struct(
            start.alias("start"),
            F.lit(order).alias("ord"),
            end.alias("end"),
            F.lit(pattern.kind).alias("kind"),
            F.length(x["v"]).alias("value"),
            x["m"].alias("found"),
        )
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(one).cast(f"array<{kind}>")).alias("out"))

    found = F.aggregate(rows, first, step, lambda acc: acc["out"])
    kept = F.filter(found, lambda x: x["value"] >= pattern.least)
    return F.when(F.size(matches) > 0, kept).otherwise(F.array().cast(f"array<{kind}>"))


def window_entropy(text: Column, width: int) -> Column:
    """The largest Shannon entropy, in bits, of ``width`` consecutive ASCII characters of
    ``text``; NULL where it is shorter."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) + 1)
    gain = lambda c: F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))

    def step(acc: Column, i: Column) -> Column:
        # the new character in; the one that stands ``width`` before it out
        enter = F.element_at(acc["codes"], i)
        leave = F.when(i > width, F.get(acc["codes"], i - 1 - width)).otherwise(F.lit(0))
        had = F.element_at(acc["counts"], enter).cast("double")
        had_left = F.when(leave > 0, F.get(acc["counts"], leave - 1)).otherwise(F.lit(0)).cast("double")
        change = F.when(leave == enter, F.lit(0.0)).otherwise(
            gain(had + 1) - gain(had) + F.when(leave > 0, gain(had_left - 1) - gain(had_left)).otherwise(F.lit(0.0))
        )
        total = acc["total"] + change
        counts = F.transform(
            acc["counts"],
            lambda c, k: c + (k + 1 == enter).cast("int") - (k + 1 == leave).cast("int"),
        )
        bits = F.log2(F.lit(float(width))) - total / width
        best = F.when(i >= width, F.greatest(acc["best"], bits)).otherwise(acc["best"])
        return F.struct(acc["codes"].alias("codes"), counts.alias("counts"), total.alias("total"), best.alias("best"))

    first = F.struct(
        codes.alias("codes"),
        F.array_repeat(F.lit(0), 129).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(None).cast("double").alias("best"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.size(codes)), first, step, lambda acc: acc["best"])


def _rest(x: Column, earlier: Column) -> Column:
    """What is left of a candidate without the earlier spans, in order of start; separators
    at the cut's front go too."""
    over = F.filter(earlier, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    cut = lambda lo, hi: F.substring(
        x["found"], (lo - x["start"] + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int")
    )
    first = F.struct(x["start"].alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, y: Column) -> Column:
        return F.struct(
            F.greatest(acc["pos"], y["end"]).alias("pos"), F.concat(acc["out"], cut(acc["pos"], y["start"])).alias("out")
        )

    left = F.aggregate(over, first, step, lambda acc: F.concat(acc["out"], cut(acc["pos"], x["end"])))
    return F.when(F.size(over) > 0, F.regexp_replace(left, "^[-_/+]+", "")).otherwise(x["found"])


def _secrets(c: EntropyClass, plain: str, found: Column, earlier: Column) -> Column:
    def keep(z: Column) -> Column:
        enough = F.coalesce(window_entropy(z["rest"], c.width), F.lit(0.0)) >= c.bits
        return ~z["rest"].rlike(plain) & (F.length(z["rest"]) >= c.width) & enough

    judged = F.transform(found, lambda x: F.struct(x.alias("x"), _rest(x, earlier).alias("rest")))
    return F.transform(F.filter(judged, keep), lambda z: z["x"])


def _with_spans(
    rows: DataFrame, text: str, out: str, patterns: tuple[Pattern, ...], classes: tuple[EntropyClass, ...], allowed: tuple[str, ...]
) -> DataFrame:
    """``rows`` with a struct column ``out``: base and extra, sorted arrays of spans."""
    every = [*patterns, *map(entropy_pattern, classes)]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = rows.withColumn(
        out, F.struct(*[F.regexp_extract_all(t, F.lit(p.regex), F.lit(0)).alias(p.kind) for p in every])
    )
    found = lambda p: F.col(f"{out}.{p.kind}")
    rows = rows.withColumn(
        out,
        F.struct(
            *[
                _spans(
                    t,
                    found(p),
                    F.when(F.size(found(p)) > 0, F.regexp_extract_all(t, F.lit(p.regex), F.lit(p.value))).otherwise(found(p))
                    if p.value
                    else found(p),
                    p,
                    i,
                ).alias(p.kind)
                for i, p in enumerate(every)
            ]
        ),
    )
    base = F.array_sort(F.concat(*map(found, patterns)))
    rows = rows.withColumn(
        out, F.struct(base.alias("base"), *[F.col(f"{out}.{c.kind}").alias(c.kind) for c in classes])
    )
    plain = "^(?:" + "|".join(allowed) + ")$" if allowed else "^$"
    base = F.col(f"{out}.base")
    extra: list[Column] = []
    for c in classes:
        earlier = F.array_sort(F.concat(base, *extra)) if extra else base
        extra.append(_secrets(c, plain, F.col(f"{out}.{c.kind}"), earlier))
    more = F.array_sort(F.concat(*extra)) if extra else F.slice(base, 1, 0)
    return rows.withColumn(out, F.struct(base.alias("base"), more.alias("extra")))


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    patterns: tuple[Pattern, ...] = PATTERNS,
    classes: tuple[EntropyClass, ...] = ENTROPY,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """doc_id, base, extra: per row the spans of the patterns and those of the entropy
    windows, each an array of (start, ord, end, kind, value, found) in order of start, then
    kind as listed.  Starts and ends count code points, ends exclusive; a span of ``extra``
    may hold earlier ones.  NULL counts as the
    empty text: no spans.  Rows are independent of each other; an empty table gives none."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = _with_spans(rows, "text", "_found", patterns, classes, allowed)
    return rows.select("doc_id", F.col("_found.base").alias("base"), F.col("_found.extra").alias("extra"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact_secrets(
    docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", length_col: str | None = None
) -> DataFrame:
    """``docs`` with every found value replaced by ``mark`` (of an assignment, only the value;
    overlapping values by one mark).  All rows and columns stay; NULL texts stay NULL.
    ``length_col``, if given, is set to the new length of the texts that changed."""
    rows = _with_spans(docs, text_col, "_secrets", PATTERNS, ENTROPY, ALLOWED)
    text = F.col(f"`{text_col}`")
    values = F.array_sort(
        F.transform(
            F.concat(F.col("_secrets.base"), F.col("_secrets.extra")),
            lambda x: F.struct((x["end"] - x["value"]).alias("start"), x["end"].alias("end")),
        )
    )
    rows = rows.withColumn("_secrets", values)
    cut = lambda lo, hi: F.substring(text, (lo + 1).cast("int"), (hi - lo).cast("int"))

    def step(acc: Column, x: Column) -> Column:
        apart = x["start"] >= acc["pos"]
        return F.struct(
            F.greatest(acc["pos"], x["end"]).alias("pos"),
            F.when(apart, F.concat(acc["out"], cut(acc["pos"], x["start"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    first = F.struct(F.lit(0).cast("long").alias("pos"), F.lit("").alias("out"))
    clean = F.aggregate(
        F.col("_secrets"), first, step, lambda acc: F.concat(acc["out"], cut(acc["pos"], F.length(text).cast("long")))
    )
    hit = F.size("_secrets") > 0
    rows = rows.withColumn("_secrets", F.when(hit, clean))
    changed = F.col("_secrets").isNotNull()
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.coalesce(F.col("_secrets"), text).alias(c))
        elif c == length_col:
            kind = docs.schema[c].dataType
            out.append(F.when(changed, F.length("_secrets").cast(kind)).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return rows.select(*out)
