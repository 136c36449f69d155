"""Secret scan in DataFrame functions alone: patterns, and a battery of randomness tests for other tokens.

Base spans come from three patterns, leftmost and non-overlapping for each kind:

- ``assign``: a name such as ``password`` or ``api_key``, ``=`` or ``:``, and a value of 12 characters or more;
- ``access``: ``AKIA`` and capitals or digits, 18 characters or more;
- ``hex``: 16 or more of ``0-9a-f``.

``random`` spans are added to them. Every run of 20 or more token characters of at least two kinds (capitals,
small letters, digits) is a candidate; runs inside a base span aren't. Its encoding is inferred from its
characters (hexadecimal, base 32, one case with digits, letters, or base 64), and three statistics are taken:

- chi-squared: how unevenly the alphabet is used. In text it is by the index of coincidence of text;
- runs: how often the kind of character changes. In words and identifiers it does so seldom;
- serial correlation of neighbours. In counted or repeated sequences they depend on each other.

Each is set against its distribution under order, and under uniform draws from the encoding's alphabet, for the
token's own length, so short tokens can't reach small values. A token is reported if

- no test speaks against randomness: each statistic lies within ``PLAUSIBLE`` deviations of what uniform draws give; and
- order is rejected in both its forms: that of words, by alphabet and runs together, and that of sequences, by runs and
  serial correlation together (sums of two normal scores). Its p-value is the larger of the two.

Over all candidates of the table the Benjamini-Hochberg rule holds the expected share of false ones at
``FALSE_SHARE``; candidates that aren't plausible count with a p-value of 1. It needs the number of candidates by
p-value only, in ``BINS`` bins, however large the table is.

NULL texts count as empty. Positions are code points, ends exclusive. Spans are sorted by start and kind.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.staging import Stage

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: What any text with an ``assign`` span matches: a quick first look.
ASSIGN_LOOK = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}"""
KINDS = ("assign", "access", "hex", "random")
FALSE_SHARE = 0.01
BINS = 300
#: The index of coincidence of text in its own alphabet, how often the kind of character changes in words and
#: identifiers (twice in seven characters, for a word and what divides it), and the correlation of neighbours in
#: ordered sequences.
TEXT_COINCIDENCE = 0.066
TEXT_CHANGES = 0.28
ORDER_CORRELATION = 0.5
#: Deviations within which a statistic agrees with uniform draws: 0.05 % of random tokens are outside on each side.
PLAUSIBLE = 3.3
BLOCK = 256
REDACTED = "[SECRET]"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once; named in a lambda itself it would be for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _prefix(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """0 and the running totals of a short array."""
    return F.aggregate(values, F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(add(F.element_at(done, -1), x))))


def _before(values: Column, add: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """The total before each element, in blocks, as a growing array is copied at every step."""
    def blocks(values: Column) -> Column:
        count = F.ceil(F.size(values) / F.lit(BLOCK)).cast("int")
        cut = F.transform(F.sequence(F.lit(1), count), lambda b: F.slice(values, (b - 1) * BLOCK + 1, F.lit(BLOCK)))
        return F.when(count > 0, cut).otherwise(F.array().cast("array<array<int>>"))

    def joined(parts: Column) -> Column:
        totals = _prefix(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), add)), add)
        bases = F.slice(totals, F.lit(1), F.size(parts))
        inside = lambda p, base: F.transform(F.slice(_prefix(p, add), F.lit(1), F.size(p)), lambda v: add(v, base))
        return F.flatten(F.zip_with(parts, bases, inside))

    return _let(_let(values, blocks), joined)


def _reached(rows: Column) -> Column:
    """For each of sorted ``rows`` (with ``end``) the greatest end of those before it, 0 for the first."""
    return _before(F.transform(rows, lambda x: x["end"]), lambda a, b: F.greatest(a, b))


def _spans(text: Column, pattern: str, kind: int, look: str, value: int = 0, least: int = 0) -> Column:
    """Spans of all matches of which group ``value`` has ``least`` characters or more."""
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    # One gap more than matches, behind the last.
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), sizes.alias("size")), lambda x: x["size"].isNotNull())
    span = lambda x, before: F.struct(
        (before + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (before + x["gap"] + x["size"]).alias("end")
    )
    spans = _let(pairs, lambda p: F.zip_with(p, _before(F.transform(p, lambda x: x["gap"] + x["size"])), span))
    if least:
        kept = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value)), F.length)
        spans = F.filter(F.arrays_zip(spans.alias("span"), kept.alias("kept")), lambda x: x["kept"] >= least)
        spans = F.transform(spans, lambda x: x["span"])
    return F.when(text.rlike(look), spans).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def base_spans(text: Column) -> Column:
    return F.concat(
        _spans(text, ASSIGN, 0, ASSIGN_LOOK, value=2, least=12), _spans(text, ACCESS, 1, ACCESS), _spans(text, HEX, 2, HEX)
    )


def _below(z: Column) -> Column:
    """The normal distribution function, by a logistic curve of third degree."""
    z = F.least(F.greatest(z, F.lit(-12.0)), F.lit(12.0))
    return 1 / (1 + F.exp(-(0.07056 * z * z * z + 1.5976 * z)))


def _p_value(token: Column) -> Column:
    """The larger p-value of the two forms of order; 1 for tokens that uniform draws don't explain."""
    n = F.length(token).cast("double")
    # Symbols of the encoding, and how often two neighbours drawn from it are of different kinds.
    encodings = [
        ("^([0-9a-f]+|[0-9A-F]+)$", (6, 10)), ("^[A-Z2-7]+=*$", (26, 6)), ("^([0-9a-z]+|[0-9A-Z]+)$", (26, 10)), ("^[A-Za-z]+$", (26, 26)),
        ("^[A-Za-z0-9]+$", (26, 26, 10)), ("", (26, 26, 10, 2)),
    ]
    symbols = [(look, sum(kinds), 1 - sum((c / sum(kinds)) ** 2 for c in kinds)) for look, kinds in encodings]
    by_encoding = lambda value: F.coalesce(*[F.when(token.rlike(x[0]), F.lit(float(value(x)))) for x in symbols])
    k, turns = by_encoding(lambda x: x[1]), by_encoding(lambda x: x[2])
    alphabet = F.array(*[F.lit(c) for c in string.ascii_letters + string.digits + "+/_=-"])

    squares = F.aggregate(alphabet, F.lit(0.0), lambda a, c: a + F.pow(n - F.length(F.replace(token, c, F.lit(""))), F.lit(2)))
    uneven = k * squares / n - n
    excess = F.greatest(k * TEXT_COINCIDENCE - 1, 0.5 + F.lit(0.0))
    mean, spread = (k - 1) + (n - 1) * excess, F.sqrt(2 * (k - 1) + 4 * (n - 1) * excess)
    by_alphabet = (uneven - mean) / spread

    changes = F.length(F.regexp_replace(token, "(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[^A-Za-z0-9])[A-Za-z0-9]", "~~"))
    changes = changes - n
    by_runs = ((n - 1) * TEXT_CHANGES + 0.5 - changes) / F.sqrt((n - 1) * TEXT_CHANGES * (1 - TEXT_CHANGES))

    def correlation(codes: Column) -> Column:
        total, count = F.aggregate(codes, F.lit(0.0), lambda a, c: a + c), F.size(codes).cast("double")
        middle = total / count
        power = F.aggregate(codes, F.lit(0.0), lambda a, c: a + c * c) - count * middle * middle
        pairs = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1), lambda a, b: a * b)
        ends = F.element_at(codes, 1) + F.element_at(codes, -1)
        joint = F.aggregate(pairs, F.lit(0.0), lambda a, c: a + c) - middle * (2 * total - ends) + (count - 1) * middle * middle
        return F.when(power < 1e-6, 1.0).otherwise(F.abs(joint) / F.greatest(power, F.lit(1e-9)))

    codes = F.filter(F.transform(F.split(token, ""), lambda c: F.ascii(c).cast("double")), lambda c: c > 0)
    serial = _let(codes, correlation)
    by_order = (serial - ORDER_CORRELATION) * F.sqrt(n) / (1 - ORDER_CORRELATION**2)

    as_drawn = (
        (F.abs(uneven - (k - 1)) <= PLAUSIBLE * F.sqrt(2 * (k - 1)))
        & (F.abs(changes - (n - 1) * turns) <= PLAUSIBLE * F.sqrt((n - 1) * turns * (1 - turns)) + 0.5)
        & (serial * F.sqrt(n) <= PLAUSIBLE)
    )
    two = 2**0.5
    order = _below(F.greatest((by_alphabet + by_runs) / two, (by_runs + by_order) / two))
    return F.when(as_drawn, order).otherwise(F.lit(1.0))


def _candidates(text: Column, base: Column) -> Column:
    """Tested tokens: ``start, end, bin``; bin b holds p-values from 10 ** -((b + 1) / 10) to 10 ** -(b / 10)."""
    spans = _spans(text, CANDIDATE, 3, CANDIDATE)
    tokens = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    mixed = F.filter(
        F.arrays_zip(spans.alias("span"), tokens.alias("token")), lambda x: x["token"].rlike("[a-z].*[A-Z0-9]|[A-Z].*[a-z0-9]|[0-9].*[A-Za-z]")
    )
    # Known spans and candidates by start, known ones first: a candidate lies inside one if one reaches its end.
    row = "array<struct<start:int,kind:int,end:int,stop:int,token:string>>"
    known = F.transform(base, lambda b: F.struct(b["start"], b["kind"], b["end"], b["end"], F.lit("")))
    asked = F.transform(mixed, lambda x: F.struct(x["span"]["start"], F.lit(3), F.lit(0), x["span"]["end"], x["token"]))
    uncovered = lambda every: F.filter(
        F.arrays_zip(every.alias("row"), _reached(every).alias("reached")), lambda x: (x["row"]["kind"] == 3) & (x["reached"] < x["row"]["stop"])
    )
    rows = F.when(text.rlike(CANDIDATE), _let(F.array_sort(F.concat(known.cast(row), asked.cast(row))), uncovered))
    tested = F.transform(
        rows,
        lambda x: F.struct(
            x["row"]["start"].alias("start"), x["row"]["stop"].alias("end"),
            F.least(F.floor(-10 * F.log10(_p_value(x["row"]["token"]))), F.lit(BINS)).cast("int").alias("bin"),
        ),
    )
    return F.coalesce(tested, F.array().cast("array<struct<start:int,end:int,bin:int>>"))


def threshold(bins: DataFrame) -> int:
    """The smallest bin that is accepted; ``bins`` has a row for each candidate's ``bin``."""
    counts = bins.groupBy("bin").agg(F.count("*").alias("n"))
    # At most BINS + 1 rows.
    passed = F.sum("n").over(Window.orderBy(F.desc("bin")))
    found = counts.select("bin", passed.alias("passed"), F.sum("n").over(Window.partitionBy()).alias("m"))
    least = found.where(F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("m") <= FALSE_SHARE * F.col("passed")).agg(F.min("bin")).first()[0]
    return BINS + 1 if least is None else least


def _with_spans(docs: DataFrame, stage: Stage | None) -> tuple[DataFrame, int]:
    """``doc_id, base, tested`` in the shared folder, and the threshold of the whole table."""
    stage = stage or Stage(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text"))).withColumn("tested", _candidates(F.col("text"), F.col("base")))
    rows = stage.table(rows.drop("text"), "spans")
    bins = rows.where(F.size("tested") > 0).select(F.explode("tested").alias("t")).select("t.bin")
    return rows, threshold(bins)


def _all_spans(base: Column, tested: Column, least: int) -> Column:
    accepted = F.filter(tested, lambda t: t["bin"] >= least)
    added = F.transform(accepted, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return F.array_sort(F.concat(base, added.cast(_SPAN)))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, stage: Stage | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` for every row of ``docs``."""
    rows, least = _with_spans(docs, stage)
    every = _all_spans(F.col("base"), F.col("tested"), least)
    count = lambda kind: F.size(F.filter(F.col("all"), lambda s: s["kind"] == kind)).cast("long")
    return rows.withColumn("all", every).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), count(3).alias("n_random"),
        F.sha2(_joined(F.array_sort(F.col("base"))).cast("binary"), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced; ``n_chars``, if there, follows. No shuffle of texts."""
    text = F.col("text").cast("string")
    tested = docs.select(F.explode(_candidates(F.coalesce(text, F.lit("")), base_spans(F.coalesce(text, F.lit(""))))).alias("t"))
    least = threshold(tested.select("t.bin"))
    filled = F.coalesce(text, F.lit(""))
    base = base_spans(filled)
    spans = _all_spans(base, _candidates(filled, base), least)
    # What is kept lies between spans; a span that begins inside what is replaced already only extends it. Pieces are cut from
    # a form of four bytes a code point, where no text before them has to be walked through; the mark in front of each
    # is taken off again by the decoder.
    wide, mark = F.encode(filled, "UTF-32"), F.lit(bytearray(b"\x00\x00\xfe\xff"))
    last = F.struct(F.length(filled), F.lit(0), F.length(filled))
    between = lambda rows: F.filter(
        F.arrays_zip(rows.alias("row"), _reached(rows).alias("from")), lambda x: x["row"]["start"] >= x["from"]
    )
    kept = _let(F.concat(spans, F.array(last).cast(_SPAN)), between)

    def joined(wide: Column) -> Column:
        piece = lambda x: F.substring(wide, 4 * x["from"] + 1, 4 * (x["row"]["start"] - x["from"]))
        return F.array_join(F.transform(kept, lambda x: F.decode(F.concat(mark, piece(x)), "UTF-32")), REDACTED)

    secret = filled.rlike(ASSIGN_LOOK) | filled.rlike(ACCESS) | filled.rlike(HEX) | filled.rlike(CANDIDATE)
    clean = F.when(secret, _let(wide, joined)).otherwise(text)
    # The length is taken in a step of its own, from the finished text.
    flag = next(name for name in (f"redacted_{i}" for i in range(len(docs.columns) + 1)) if name not in docs.columns)
    done = docs.withColumns({flag: secret, "text": clean})
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col(flag), size).otherwise(F.col("n_chars")))
    return done.drop(flag)
