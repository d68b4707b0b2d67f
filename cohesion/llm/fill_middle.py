"""Fill-in-the-middle rearrangement of texts, as one pyarrow.compute pipeline for each batch.

A text is cut into units: runs of A-Z and a-z, and single other code points. Every unit gets
a separator byte that UTF-8 never holds, which turns one binary split into a list array of
units. Flattened with parent indices, a unit's ordinal is its place less its list's offset;
the ordinal against the two cuts of its document gives its role. Units filtered by role make
three list arrays again, binary_join makes them pieces, and the pieces are joined by form.

The form and the cuts follow from the first 32 hex digits of SHA-256 of ``seed:doc_id``, so a
task that runs again gives the same rows. Sentinels can't be found in a rearranged text but where
they were put, so ``restore`` gives the exact text back from output and form.

Null texts count as empty; empty texts and texts that hold a sentinel stay plain. A null doc_id is
hashed as the seed and an empty id. Every row is independent: repeated rows give repeated rows, there are
no ties, extra columns are ignored whatever their names, and an empty table gives no rows. A batch is
worked on in slices of ``SLICE_BYTES`` of text (or one longer text), so long texts don't add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, how many are rearranged, and of 100 rearranged ones, how many put the suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: Bytes of text in one pass of the pipeline.
SLICE_BYTES = 4 << 20

#: A unit in the bytes of UTF-8: letters, another ASCII byte, or a lead byte with its continuation bytes.
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc2-\xf4][\x80-\xbf]+)"
#: Never a byte of UTF-8.
MARK = b"\xff"


def arrange(text: pa.Array, h: list[pa.Array], rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a string array, from four hashes for each text."""
    marked = pc.replace_substring_regex(text.cast(pa.large_binary()), UNIT, MARK + rb"\1")
    lists = pc.split_pattern(marked, MARK)  # the first item of every list stands before the first mark and is empty
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    begin = lists.offsets.slice(0, len(lists))
    at = pc.subtract(pa.array(np.arange(len(units))), pc.take(begin, parent).cast(pa.int64()))  # 0 for the empty item, then 1, 2, ...
    n = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)

    cuts = [_modulo(x, pc.add(n, 1)) for x in h[:2]]
    first, second = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    in_prefix = pc.less_equal(at, pc.take(first, parent))
    in_suffix = pc.greater(at, pc.take(second, parent))
    sizes = {PREFIX: pc.add(first, 1), MIDDLE: pc.subtract(second, first), SUFFIX: pc.subtract(n, second)}
    roles = {PREFIX: in_prefix, MIDDLE: pc.invert(pc.or_(in_prefix, in_suffix)), SUFFIX: in_suffix}
    piece = {}
    for role, mine in roles.items():
        ends = pc.cumulative_sum(sizes[role])
        offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends])
        joined = pc.binary_join(pa.LargeListArray.from_arrays(offsets, pc.filter(units, mine)), pa.scalar(b"", pa.large_binary()))
        piece[role] = joined.cast(pa.large_string())

    text = text.cast(pa.large_string())
    word = lambda s: pa.scalar(s, pa.large_string())
    put = lambda *roles: pc.binary_join_element_wise(*(x for r in roles for x in (word(r), piece[r])), word(""))
    held = [pc.match_substring(text, s) for s in (PREFIX, SUFFIX, MIDDLE)]
    plain = pc.or_(pc.or_(pc.or_(held[0], held[1]), held[2]), pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(h[2], 100), rate)))
    spm = pc.less(_modulo(h[3], 100), suffix_first)
    none = pa.scalar(None, pa.int64())
    length = lambda r: pc.if_else(plain, none, pc.utf8_length(piece[r]).cast(pa.int64()))
    return {
        "n": n, "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": length(PREFIX), "middle_chars": length(MIDDLE),
        "output": pc.if_else(plain, text, pc.if_else(spm, put(SUFFIX, PREFIX, MIDDLE), put(PREFIX, SUFFIX, MIDDLE))).cast(pa.string()),
    }


def _modulo(a: pa.Array, b) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most SLICE_BYTES of text, or one row."""
    size, start, held = pc.binary_length(batch.column(text)).to_pylist(), 0, 0
    for i, b in enumerate(size):
        if i > start and held + b > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += b
    if start < batch.num_rows:
        yield batch.slice(start)


def transform(docs: DataFrame, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output of every document."""
    bound_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    hashes = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _slices(batch, 5):
                out = {"doc_id": b.column(0)} | arrange(b.column(5), [b.column(i) for i in range(1, 5)], rate, suffix_first)
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), *hashes, text_or_empty().alias("text"))
            .mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"))


def restore(arranged: DataFrame) -> DataFrame:
    """The columns of ``transform``'s rows with ``restored``: the text rebuilt from output and form alone."""
    def between(rest: str, mark: str):
        """What stands before the first mark, and after it."""
        part = F.substring_index(rest, mark, 1)
        return part, F.expr(f"substring({rest}, char_length(substring_index({rest}, '{mark}', 1)) + {len(mark) + 1})")

    rest = arranged.withColumn("_rest", F.expr(f"substring(output, {len(PREFIX) + 1})"))
    psm, spm = between("_rest", SUFFIX), between("_rest", PREFIX)
    is_spm = F.col("form") == "spm"
    cut = rest.withColumns({"_one": F.when(is_spm, spm[0]).otherwise(psm[0]), "_rest": F.when(is_spm, spm[1]).otherwise(psm[1])})
    two, middle = between("_rest", MIDDLE)
    text = F.when(F.col("form") == "plain", F.col("output")).when(is_spm, F.concat(two, middle, "_one")).otherwise(F.concat("_one", middle, two))
    return cut.select(*arranged.columns, text.alias("restored"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of output and restored text."""
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return restore(transform(docs)).select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                                           sha("output").alias("output_sha256"), sha("restored").alias("restored_sha256"))
