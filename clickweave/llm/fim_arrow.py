"""Fill-in-middle transformation as a pipeline of Arrow compute kernels.

A text is cut into units: optional white space and what follows it up to the next white
space; white space at the end is a unit of its own. Two numbers hashed from the document's
id choose where the prefix and the middle end, two more the form: ``plain`` (the text as it
is), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), each piece behind
its mark. A text that is empty or holds a mark stays plain, so every output can be undone.

Per slice of a batch, without a Python loop over texts or units: the texts are split into a
list array (a byte that UTF-8 never uses is put behind each unit), the lists are flattened
with their parent indices, ordinals inside the parent say which of the three pieces a unit
belongs to, the units of each piece are filtered and gathered into lists again, and the
lists are joined. A slice has about ``SLICE_BYTES`` of text (one text may be longer), which
bounds a task's memory. There is no shuffle.

Rows: a null text is an empty one; a null id is hashed as an empty string. Repeated rows give
repeated results. Bytes that are not UTF-8 are first replaced as Spark's
``make_valid_utf8`` does. An empty table gives an empty result. Extra columns are ignored
unless named in ``carry``; a carried column whose name is one of the result's is refused.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# The contract's white space, marks and rates.
SPACE = r"\x20\x09-\x0D"
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, MOVED_OF_100, SPM_OF_100 = 42, 50, 80

UNIT_END = rf"([^{SPACE}])([{SPACE}])"
CUT = b"\xff"  # in no UTF-8 text
SLICE_BYTES = 16_000_000
RESULT = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def _mod(a: pa.Array, b: pa.Array | int) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _offsets(counts: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)]).cast(pa.int32())


def _units(texts: pa.Array) -> pa.Array:
    """Each text's units as a list; an empty text has one empty entry."""
    return pc.split_pattern(pc.replace_substring_regex(texts, pattern=UNIT_END, replacement=b"\\1" + CUT + b"\\2"), CUT)


def _chars(pieces: pa.Array) -> pa.Array:
    return pc.utf8_length(pieces.view(pa.large_string())).cast(pa.int64())


def _pieces(units: pa.Array, first: pa.Array, second: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of each list of units: the cuts are behind ``first`` and ``second`` units."""
    counts = pc.list_value_length(units).cast(pa.int64())
    values, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    starts = pc.subtract(pc.cumulative_sum(counts), counts)
    ordinal = pc.subtract(pc.subtract(pc.cumulative_sum(pa.repeat(pa.scalar(1, pa.int64()), len(values))), 1), starts.take(parent))
    in_prefix, behind = pc.less(ordinal, first.take(parent)), pc.greater_equal(ordinal, second.take(parent))
    roles = (in_prefix, first), (pc.invert(pc.or_(in_prefix, behind)), pc.subtract(second, first)), (behind, pc.subtract(counts, second))
    return [pc.binary_join(pa.ListArray.from_arrays(_offsets(size), values.filter(mask)), pa.scalar(b"", pa.large_binary())) for mask, size in roles]


def transform(texts: pa.Array, hashes: Sequence[pa.Array], moved_of_100: int = MOVED_OF_100, spm_of_100: int = SPM_OF_100) -> dict[str, pa.Array]:
    """The result's columns for texts (UTF-8 bytes, no nulls) and four hash numbers each."""
    texts = texts.cast(pa.large_binary())
    h1, h2, h3, h4 = hashes
    units = _units(texts)
    empty = pc.equal(pc.binary_length(texts), 0)
    n = pc.if_else(empty, 0, pc.list_value_length(units).cast(pa.int64()))
    marked = pc.or_(pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)), pc.match_substring(texts, MIDDLE))
    moved = pc.invert(pc.or_(pc.or_(empty, marked), pc.greater_equal(_mod(h3, 100), moved_of_100)))

    span = pc.add(n, 1).filter(moved)
    a, b = _mod(h1.filter(moved), span), _mod(h2.filter(moved), span)
    prefix, middle, suffix = _pieces(units.filter(moved), pc.min_element_wise(a, b), pc.max_element_wise(a, b))
    spm = pc.less(_mod(h4.filter(moved), 100), spm_of_100)
    marks = [pa.scalar(m, pa.large_binary()) for m in (PREFIX, SUFFIX, MIDDLE, b"")]
    output = pc.if_else(spm, pc.binary_join_element_wise(marks[1], suffix, marks[0], prefix, marks[2], middle, marks[3]),
                        pc.binary_join_element_wise(marks[0], prefix, marks[1], suffix, marks[2], middle, marks[3]))

    # Row i of all rows is row at[i] of the moved ones, null for a plain one.
    at = pc.if_else(moved, pc.subtract(pc.cumulative_sum(moved.cast(pa.int64())), 1), None)
    return {"n": n, "form": pc.if_else(moved, pc.if_else(spm, "spm", "psm").take(at), "plain"),
            "prefix_chars": _chars(prefix).take(at), "middle_chars": _chars(middle).take(at),
            "output": pc.coalesce(output.take(at), texts)}


def _slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of whole texts of about ``limit`` bytes."""
    start, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if i > start and held + size > limit:
            yield start, i - start
            start, held = i, 0
        held += size
    if len(texts) > start:
        yield start, len(texts) - start


def fill_in_middle(docs: DataFrame, seed: int = SEED, moved_of_100: int = MOVED_OF_100, spm_of_100: int = SPM_OF_100,
                   carry: Sequence[str] = (), slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain), output
    and the carried columns, a row per document."""
    if set(carry) & set(RESULT):
        raise ValueError(f"carried columns clash with the result: {sorted(set(carry) & set(RESULT))}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    kept = docs.select(*carry).schema.fields
    rows = docs.select(
        F.col("doc_id").cast("long"), F.make_valid_utf8(F.coalesce(F.col("text"), F.lit(""))).cast("binary"),
        *[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)], *carry,
    ).toDF("doc_id", "text", "h1", "h2", "h3", "h4", *[f"_in_{i}" for i in range(len(kept))])
    schema = StructType([StructField("doc_id", LongType()), StructField("n", LongType()), StructField("form", StringType()),
                         StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                         StructField("output", StringType()), *[StructField(f"_in_{i}", f.dataType) for i, f in enumerate(kept)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in _slices(batch.column(1), slice_bytes):
                part = batch.slice(start, length)
                out = transform(part.column(1), part.columns[2:6], moved_of_100, spm_of_100)
                text = out["output"].cast(pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), out["n"], out["form"], out["prefix_chars"], out["middle_chars"], text, *part.columns[6:]],
                    names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*RESULT, *[f.name for f in kept])


def restore(output: Column, form: Column) -> Column:
    """The text that a transformed output came from. A moved text holds no mark, so each
    mark's first occurrence is the one that was put there."""
    def split(s: Column, mark: bytes) -> tuple[Column, Column]:
        before = F.substring_index(s, mark.decode(), 1)
        return before, F.substring(s, F.length(before) + 1 + len(mark), F.length(s))

    body = F.substring(output, F.lit(1 + len(PREFIX)), F.length(output))
    prefix, rest = split(body, SUFFIX)
    suffix, middle = split(rest, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, rest = split(body, PREFIX)
    prefix, middle = split(rest, MIDDLE)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
