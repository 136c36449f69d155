"""Fill-in-the-middle: a text cut into prefix, middle and suffix, put in another order between marks.

A text is a sequence of units, code points unless another pattern is given. One ``fullmatch`` of
``(unit)*`` by the ``regex`` library keeps every repetition of the group: ``match.ends(1)`` is where each unit
ends, so its length is the number of units and two of its entries are the cuts. No loop looks at units.

The cuts and the form are drawn from the hash of the id, so reruns agree whatever the partitioning:
``plain`` leaves the text as it is, ``psm`` is prefix, suffix, middle, and ``spm`` suffix, prefix, middle. Texts that
are empty or hold a mark stay plain, so an output can always be taken apart again (``restore``).

A match keeps some 100 bytes a unit while it lasts, so texts above ``BLOCK`` code points are matched by as many units at
a time, each match beginning where the last one ended. NULL texts count as empty, a NULL id as an
empty number. Texts that aren't a sequence of units (never so with code points) stay plain, with ``n`` NULL.
Rows with equal ids are cut by the same draws, each in its own text. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.words import chunks, strings

UNIT = r"[\s\S]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20
#: The longest text that is matched at once.
BLOCK = 1 << 20

CUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _draw(doc_id: Column, group: int) -> Column:
    """An 8-digit group of the hash of an id, as a number."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


class Cutter:
    """Where the units of a text end."""

    def __init__(self, unit: str):
        import regex

        self.whole = regex.compile(f"({unit})*")
        self.block = regex.compile(f"({unit}){{1,{BLOCK}}}+")

    def ends(self, text: str) -> list[int] | np.ndarray | None:
        if len(text) <= BLOCK:
            match = self.whole.fullmatch(text)
            return match and match.ends(1)
        found, at = [], 0
        while at < len(text):
            match = self.block.match(text, at)
            if not match or match.end() == at:
                return None
            found.append(np.array(match.ends(1)))
            at = match.end()
        return np.concatenate(found)


def transform(docs: DataFrame, unit: str = UNIT) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs`` (``doc_id, text``).

    ``n`` counts units; the two lengths are code points, NULL if plain.
    """
    marks = (PREFIX, SUFFIX, MIDDLE)

    def cut(batches):
        cutter = Cutter(unit)
        for batch in batches:
            for part in chunks(batch, "text"):
                rows = []
                draws = zip(*(part.column(f"h{k}").to_pylist() for k in range(1, 5)))
                for text, (h1, h2, h3, h4) in zip(strings(part.column("text")), draws):
                    ends = cutter.ends(text)
                    n = None if ends is None else len(ends)
                    if not n or h3 % 100 >= PLAIN_FROM or any(mark in text for mark in marks):
                        rows.append((n, "plain", None, None, text))
                        continue
                    first, last = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    prefix, middle, suffix = text[:first], text[first:last], text[last:]
                    if h4 % 100 < SPM_BELOW:
                        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
                    else:
                        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
                    rows.append((n, form, first, last - first, output))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *[_draw(F.col("doc_id"), k).alias(f"h{k}") for k in range(1, 5)],
    )
    return chosen.mapInArrow(cut, CUT)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of. Its texts hold no mark, so the marks take it apart."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def digests(cut: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts rebuilt from them."""
    sha = [F.sha2(F.col("output").cast("binary"), 256), F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256)]
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha[0].alias("output_sha256"), sha[1].alias("restored_sha256")
    )


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, cast('0x' || h[1:8] AS bigint) % (n + 1) AS a, cast('0x' || h[9:16] AS bigint) % (n + 1) AS b,
    CASE WHEN n = 0 OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
      OR cast('0x' || h[17:24] AS bigint) % 100 >= {PLAIN_FROM} THEN 'plain'
      WHEN cast('0x' || h[25:32] AS bigint) % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM d
), parts AS (
  SELECT *, substring(t, 1, least(a, b)) AS p, substring(t, least(a, b) + 1, abs(a - b)) AS m,
    substring(t, greatest(a, b) + 1) AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
