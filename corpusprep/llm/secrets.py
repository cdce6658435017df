"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

Everything is a Column expression; no Python runs on the executors.

* A **base** span is a match of one of ``BASE`` that passes its length.
* A **candidate** is a maximal run of the base-64 alphabet with a digit and a
  letter in it. Its character class (hex or base 64) sets window and threshold.
  A window of fixed width slides over it; running counts of the characters give
  the entropy, from the one that enters and the one that leaves. The span
  reaches from the first window over the threshold to the last one.
* Candidates on the **allow-list**, and entropy spans inside a base span, are
  suppressed. Base spans never are.

A null text counts as empty and has no spans. Offsets count code points, ends
exclusive. Repeated rows each get their spans and rows without an id get theirs;
nothing is kept between rows. An empty table has none. Texts and candidates of
any length are scanned whole: no pattern repeats a group. Further columns stay
as they are; one named like the result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from corpusprep.llm.common import fresh, let, prefix_sums

# Kind, pattern, and which group needs how many characters. Runs of one class
# are matched from the least length on, which finds the same spans as matching and then dropping.
BASE = (
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        (2, 6),
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", (0, 20)),
    ("hex", r"[0-9a-f]{24,}", (0, 24)),
)
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")


@dataclass(frozen=True)
class EntropyClass:
    """Windows of ``width`` characters count from ``bits`` of Shannon entropy on."""

    kind: str
    members: str
    width: int
    bits: float


# The first class whose pattern covers the whole candidate is its class.
CLASSES = (
    EntropyClass("entropy_hex", r"^([0-9a-f_=-]+|[0-9A-F_=-]+)$", 20, 2.9),
    EntropyClass("entropy_base64", r"^[A-Za-z0-9+/_=-]+$", 20, 3.7),
)


@dataclass(frozen=True)
class AllowList:
    """Candidates that are not secrets: whole values, and patterns found anywhere in them."""

    values: tuple[str, ...] = ()
    patterns: tuple[str, ...] = field(
        default=(
            r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs
            r"(?i)example|sample|dummy|placeholder|changeme|redacted|your[_-]",
            r"(?i)abcdefgh|01234567|12345678",
        )
    )
    paths: bool = True  # paths and names in words

    def holds(self, candidate: Column) -> Column:
        found = candidate.isin(*self.values) if self.values else F.lit(False)
        for pattern in self.patterns:
            found = found | candidate.rlike(pattern)
        return found | in_words(candidate) if self.paths else found


def in_words(candidate: Column) -> Column:
    """Whether a candidate is words, then numbers of up to four digits, all parted by ``_/=-``, perhaps between slashes.

    Every pattern is a run of one class at a time: a repeated group would make
    the matcher's stack as deep as the candidate is long.
    """
    return (
        candidate.rlike("^/?+[a-z_/=-]++[0-9_/=-]*+$")
        & candidate.rlike("^/?+[a-z]")
        & candidate.rlike("[a-z0-9]/?+$")
        & ~candidate.rlike("[a-z][0-9]|[0-9]{5}")
    )


def _span(kind: Column | str, start: Column, end: Column, rank: int | Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    rank = F.lit(rank) if isinstance(rank, int) else rank
    return F.struct(start.alias("start"), rank.alias("rank"), kind.alias("kind"), end.alias("end"))


_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def _found(text: Column, pattern: str, group: int) -> Column:
    """Matches as ``(start, hit, part)``: what lies between two matches gives their places."""

    def place(hits: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        between = F.transform(F.slice(pieces, 1, F.size(hits)), lambda p: F.length(p))
        lengths = F.transform(hits, lambda h: F.length(h))
        # A match starts after all pieces up to its own and all matches before it.
        gaps = F.zip_with(between, lengths, lambda b, n: b + n)
        starts = F.zip_with(prefix_sums(gaps), between, lambda at, b: at + b)
        parts = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return F.transform(
            F.arrays_zip(starts.alias("start"), hits.alias("hit"), parts.alias("part")),
            lambda m: F.struct(m["start"].alias("start"), m["hit"].alias("hit"), m["part"].alias("part")),
        )

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)
    return F.when(text.rlike(pattern), found)


def base_spans(text: Column) -> Column:
    """Base spans of a text, kind by kind."""

    def of(rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
        matches = F.filter(_found(text, pattern, group), lambda m: F.length(m["part"]) >= least)
        spans = F.transform(matches, lambda m: _span(kind, m["start"], m["start"] + F.length(m["hit"]), rank))
        return F.coalesce(spans, _none())

    return F.concat(*[of(rank, kind, pattern, *needs) for rank, (kind, pattern, needs) in enumerate(BASE)])


def _gains(width: int) -> Column:
    """``x log2 x - (x - 1) log2 (x - 1)`` for x from 1 to ``width``: what one more of a character adds."""
    return F.array(*[F.lit(x * log2(x) - ((x - 1) * log2(x - 1) if x > 1 else 0.0)) for x in range(1, width + 1)])


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_BITS = 6  # of a character's count: windows have fewer than 64 characters
_PER_LONG = 10
_LONGS = -(-len(ALPHABET) // _PER_LONG)


def hot_windows(candidate: Column, width: int, bits: float) -> Column:
    """``(first, last)``: starts of the first and the last window of at least ``bits`` entropy; -1 if none.

    With S = sum of c log2 c over the window's character counts c, the entropy
    is log2(width) - S / width. A step takes the leaving character's share from
    S and adds the entering one's; both counts come from running counts of the
    alphabet's characters, packed into a few integers.
    """
    enough = width * (log2(width) - bits) + 1e-9
    gains = _gains(width)

    def slide(codes: Column) -> Column:
        def place(code: Column) -> tuple[Column, Column]:
            """Which integer holds the count of a character, and by how many bits it is shifted."""
            return F.floor(code / _PER_LONG).cast("int"), (code % _PER_LONG) * _BITS

        def count(counts: Column, code: Column) -> Column:
            at, shift = place(code)
            return F.call_function("shiftright", F.get(counts, at), shift).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")

        def change(counts: Column, code: Column, by: int) -> Column:
            at, shift = place(code)
            one = F.call_function("shiftleft", F.lit(by).cast("bigint"), shift)
            return F.transform(counts, lambda v, j: F.when(j == at, v + one).otherwise(v))

        def step(state: Column, i: Column) -> Column:
            entering, leaving = F.get(codes, i), F.get(codes, i - width)
            full = i >= width
            loss = F.when(full, F.element_at(gains, count(state["counts"], F.coalesce(leaving, F.lit(0))))).otherwise(F.lit(0.0))
            rest = F.when(full, change(state["counts"], leaving, -1)).otherwise(state["counts"])

            def enter(counts: Column) -> Column:
                s = state["s"] - loss + F.element_at(gains, count(counts, entering) + 1)

                def note(now: Column) -> Column:
                    begin = i - (width - 1)
                    hot = (begin >= 0) & (now <= enough)
                    return F.struct(
                        now.alias("s"),
                        F.when(hot & (state["first"] < 0), begin).otherwise(state["first"]).alias("first"),
                        F.when(hot, begin).otherwise(state["last"]).alias("last"),
                        change(counts, entering, 1).alias("counts"),
                    )

                return let(s, note)

            return let(rest, enter)

        none = F.array(*[F.lit(0).cast("bigint")] * _LONGS)
        begin = F.struct(F.lit(0.0).alias("s"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), none.alias("counts"))
        places = F.sequence(F.lit(0), F.size(codes) - 1)
        return F.aggregate(places, begin, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))

    chars = F.split(candidate, "", -1)
    codes = F.transform(F.slice(chars, F.lit(1), F.length(candidate)), lambda c: F.call_function("instr", F.lit(ALPHABET), c) - 1)
    return let(codes, slide)


def entropy_spans(text: Column, classes=CLASSES, allow: AllowList = AllowList()) -> Column:
    """Spans of candidates whose windows reach their class's entropy."""
    mixed = F.filter(
        _found(text, CANDIDATE, 0),
        lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]") & ~allow.holds(m["hit"]),
    )

    def span_in(m: Column, c: EntropyClass) -> Column:
        def span(w: Column) -> Column:
            begin, end = m["start"] + w["first"], m["start"] + w["last"] + c.width
            return F.when(w["first"] >= 0, _span(c.kind, begin, end, KINDS.index(c.kind)))

        return let(hot_windows(m["hit"], c.width, c.bits), span)

    def judge(m: Column) -> Column:
        found = F.lit(None).cast("struct<start:int,rank:int,kind:string,end:int>")
        for c in reversed(classes):
            found = F.when(m["hit"].rlike(c.members), span_in(m, c)).otherwise(found)
        return found

    return F.coalesce(F.filter(F.transform(mixed, judge), lambda s: s.isNotNull()), _none())


def secret_spans(text: Column, classes=CLASSES, allow: AllowList = AllowList()) -> Column:
    """All spans of a text as ``array<struct<start,rank,kind,end>>``, by start, then kind as in ``KINDS``."""
    text = F.coalesce(text, F.lit(""))

    def join(base: Column) -> Column:
        def outside(s: Column) -> Column:
            return ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

        return F.array_sort(F.concat(base, F.filter(entropy_spans(text, classes, allow), outside)))

    return let(base_spans(text), join)


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def find_secrets(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``df`` with the spans of each text as the column ``out``, in place of a column of that name."""
    return df.withColumn(out, secret_spans(F.col(text)))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span (overlapping ones as one) replaced by ``[SECRET]``."""

    def step(state: Column, s: Column) -> Column:
        after = s["start"] >= state["at"]
        gap = F.substr(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(
            F.when(after, F.concat(state["out"], gap, F.lit("[SECRET]"))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    def close(state: Column) -> Column:
        return F.concat(state["out"], F.substr(text, state["at"] + 1, F.length(text)))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, close)).otherwise(text)


def redact_secrets(df: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``df`` with secrets redacted; ``length`` names a column to set to the new length where a text changed.

    Columns and their order stay; null texts stay null.
    """
    spans = fresh(df, "__spans")
    found = df.withColumn(spans, secret_spans(F.col(text)))
    changed = F.size(spans) > 0
    clean = {text: F.when(changed, redact(F.col(text), F.col(spans))).otherwise(F.col(text))}
    if length:
        kind = df.schema[length].dataType
        clean[length] = F.when(changed, F.length(redact(F.col(text), F.col(spans))).cast(kind)).otherwise(F.col(length))
    return found.withColumns(clean).select(*[F.col(f"`{c}`") for c in df.columns])


def op3(docs: DataFrame) -> DataFrame:
    """The contract's digest columns, one row per document."""
    spans = docs.select("doc_id", secret_spans(F.col("text")).alias("s"))
    n_base = len(BASE)

    def count(rank: int) -> Column:
        return F.size(F.filter("s", lambda s: s["rank"] == rank)).cast("bigint")

    return spans.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(digest(F.filter("s", lambda s: s["rank"] < n_base)), 256).alias("base_sha256"),
        digest(F.col("s")).alias("spans"),
    )
