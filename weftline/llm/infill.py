"""Fill-in-middle transformation by one counted match for each text.

A text is a row of units: a word with the blanks before it, or the blanks at its end.
``regexp_count`` gives their number n, a hash of the seed and the id gives two cuts a <= b, and a
pattern of the row's own takes a units, then b - a, then the rest. Its groups are possessive,
so the match neither tracks back nor recurses, however long the text; a single replacement by
group references writes the parts in their new order. Texts stay where they lie: there is no
exchange and no Python.

Form ``plain`` is the text itself: empty texts, texts that hold a mark, and those the hash leaves
alone. ``psm`` is prefix, suffix, middle and ``spm`` suffix, prefix, middle, each after its mark.
No mark can begin inside another or across a part's end, so the first of each mark tells the
parts apart and ``restore`` is exact.

A null text is empty. A null id hashes as an empty one; equal rows have equal results. An empty
table gives no rows. Of the input, ``doc_id`` and ``text`` are kept; further columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import text_or_empty

# White space that separates words, a unit of text, and the marks of the parts.
_BLANK = r"\x20\x09-\x0D"
UNIT = rf"(?:[{_BLANK}]*+[^{_BLANK}]++|[{_BLANK}]++)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SEED = 42
#: Of a hundred texts, how many are transformed, and how many of those put the suffix first.
SHARE = 50
SUFFIX_FIRST = 80

_PARTS = f"(?s)\\A{{}}(.*?){{}}(.*?){MIDDLE}(.*+)\\z"


def _draw(which: int) -> Column:
    """One of the first four 32-bit numbers of the row's hash."""
    return F.conv(F.substring("_hash", 8 * which - 7, 8), 16, 10).cast("bigint")


def infill(docs: DataFrame, seed: int = SEED, share: int = SHARE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, text, n, form, output, prefix_chars, middle_chars) of every row of ``docs``."""
    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    rows = rows.withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("bigint"))
    one, other = (F.pmod(_draw(k), F.col("n") + 1) for k in (1, 2))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (_draw(3) % 100 >= share)
    form = F.when(plain, "plain").when(_draw(4) % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(one, other).alias("_a"), F.greatest(one, other).alias("_b"))
    pattern = F.concat(
        F.lit(f"(?s)\\A({UNIT}{{"), F.col("_a").cast("string"), F.lit(f"}}+)({UNIT}{{"),
        (F.col("_b") - F.col("_a")).cast("string"), F.lit("}+)(.*+)\\z"),
    )
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace(F.col("text"), pattern, order))
    rows = rows.select("doc_id", "text", "n", "form", output.alias("output"))
    # Where each mark first stands gives the lengths of the parts, in characters.
    at = {mark: F.locate(mark, F.col("output")) for mark in (PREFIX, SUFFIX, MIDDLE)}
    last = F.length("output") + 1
    prefix = F.when(F.col("form") == "psm", at[SUFFIX]).when(F.col("form") == "spm", at[MIDDLE]) - at[PREFIX] - 3
    middle = F.when(F.col("form") != "plain", last - at[MIDDLE] - 3)
    return rows.withColumns({"prefix_chars": prefix.cast("bigint"), "middle_chars": middle.cast("bigint")})


def restore(output: Column, form: Column) -> Column:
    """The text that became ``output`` in ``form``."""
    psm = F.regexp_replace(output, F.lit(_PARTS.format(PREFIX, SUFFIX)), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(_PARTS.format(SUFFIX, PREFIX)), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(rows: DataFrame) -> DataFrame:
    """What ``infill`` returned, with digests for the texts."""
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
