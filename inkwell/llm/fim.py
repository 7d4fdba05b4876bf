"""Fill-in-middle: documents cut at two drawn units and put out as prefix, suffix, middle.

The cut is found by bit-parallel work on whole numbers of one bit a byte: a table lookup
over the text's bytes makes the mask of a class, shifts and boolean operations mark where
units begin, the number of set bits is the number of units, and halving finds the bit of a
given rank.  All of it is linear in the text.

Defined results: a null text is an empty one, which is plain; a null id draws as an empty
one; repeated rows get equal results; an empty table gives an empty result; other columns
pass, those of the names below are replaced.  A text that holds a sentinel is plain, so a
document can always be rebuilt from ``output`` and ``form``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: bytes of results that a task holds before it hands them on
FLUSH_BYTES = 8 << 20


def _table(member) -> bytes:
    return bytes(0x31 if member(b) else 0x30 for b in range(256))


_NEWLINE = _table(lambda b: b == 0x0A)
_WORD = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
_HEAD = _table(lambda b: b & 0xC0 != 0x80)


def mask(raw: bytes, table: bytes) -> int:
    """A bit a byte, the first byte's lowest: set where the table says 1."""
    return int(raw.translate(table)[::-1], 2) if raw else 0


def starts(raw: bytes, unit: str) -> int:
    """The mask of first bytes of units: lines with their end, words with the white space behind them, or characters."""
    full = (1 << len(raw)) - 1
    if unit == "line":
        return (mask(raw, _NEWLINE) << 1 | 1) & full
    if unit == "word":
        word = mask(raw, _WORD)
        return (word & ~(word << 1) | 1) & full
    if unit == "char":
        return mask(raw, _HEAD)
    raise ValueError(f"no such unit: {unit}")


def select(bits: int, width: int, rank: int) -> int:
    """Place of the set bit of ``rank`` (from 0) among ``width`` bits; each step looks at half of what is left."""
    at = 0
    while width > 1:
        half = width >> 1
        low = bits & ((1 << half) - 1)
        n = low.bit_count()
        if rank < n:
            bits, width = low, half
        else:
            bits >>= half
            at, rank, width = at + half, rank - n, width - half
    return at


@dataclass(frozen=True)
class Sentinels:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def raw(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def transformed(raw: bytes, draw: tuple[int, int, int, int], unit: str, fim_percent: int, spm_percent: int, marks: tuple[bytes, bytes, bytes]) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, characters of the prefix, of the middle, output) of one text."""
    begin = starts(raw, unit) if raw else 0
    n = begin.bit_count()
    if not raw or any(m in raw for m in marks) or draw[2] % 100 >= fim_percent:
        return n, "plain", None, None, raw
    first, last = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
    a, b = (len(raw) if k == n else select(begin, len(raw), k) for k in (first, last))
    heads = mask(raw, _HEAD)
    n_prefix = (heads & ((1 << a) - 1)).bit_count()
    n_middle = (heads >> a & ((1 << (b - a)) - 1)).bit_count()
    p, s, m = marks
    if draw[3] % 100 < spm_percent:
        return n, "spm", n_prefix, n_middle, b"".join((s, raw[b:], p, raw[:a], m, raw[a:b]))
    return n, "psm", n_prefix, n_middle, b"".join((p, raw[:a], s, raw[b:], m, raw[a:b]))


def rebuilt(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text that gave this output: parts end where the next sentinel first stands, as no text that was cut holds one."""
    if form == "plain":
        return output
    p, s, m = marks
    first, second = (s, p) if form == "spm" else (p, s)
    at, end = output.index(second, len(first)), output.index(m)
    one, two, middle = output[len(first) : at], output[at + len(second) : end], output[end + len(m) :]
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def _texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, one at a time; a null is an empty text."""
    for value in column:
        raw = value.as_buffer() if value.is_valid else None
        yield raw.to_pybytes() if raw is not None else b""


def _batch(columns: list[pa.Array], made: list[list], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    arrays = [pa.array(m, pa.binary()).cast(pa.string()) if pa.types.is_string(t) and m and isinstance(m[0], bytes) else pa.array(m, t) for m, t in zip(made, types, strict=True)]
    return pa.RecordBatch.from_arrays(columns + arrays, names=names)


def _mapped(df: DataFrame, inputs: list[Column], row, fields: list[tuple[str, T.DataType, pa.DataType]], drop: list[str]) -> DataFrame:
    """df without ``drop``, with the columns that ``row`` makes of each row's inputs (the first is a text), handed on in pieces of FLUSH_BYTES."""
    named = [c.alias(f"__in{i}") for i, c in enumerate(inputs)]
    new = [name for name, _, _ in fields]
    kept = [c for c in df.columns if c not in {*new, *drop}]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, t) for n, t, _ in fields])
    types, n_inputs = [t for _, _, t in fields], len(inputs)

    def run(batches):
        for batch in batches:
            own = [batch.column(i) for i in range(len(kept))]
            others = [batch.column(len(kept) + i) for i in range(1, n_inputs)]
            made: list[list] = [[] for _ in types]
            size = lo = 0
            for i, raw in enumerate(_texts(batch.column(len(kept)))):
                values = row(raw, *(o[i].as_py() for o in others))
                for out, value in zip(made, values, strict=True):
                    out.append(value)
                size += len(raw)
                if size >= FLUSH_BYTES or i == batch.num_rows - 1:
                    yield _batch([c.slice(lo, i + 1 - lo) for c in own], made, types, kept + new)
                    made, size, lo = [[] for _ in types], 0, i + 1

    return df.select(*[F.col(f"`{c}`") for c in kept], *named).mapInArrow(run, schema)


def transform(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", seed: int = 7, unit: str = "line", fim_percent: int = 100, spm_percent: int = 50, sentinels: Sentinels = Sentinels()
) -> DataFrame:
    """df with ``output`` in the place of its text, ``n`` units, ``form`` (plain, psm, spm), ``prefix_chars`` and ``middle_chars``.

    The draws are the first four groups of eight hexadecimal digits of the SHA-256 of ``seed:id``.
    """
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    marks = sentinels.raw

    def row(raw: bytes, digest: str):
        h = tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
        return transformed(raw, h, unit, fim_percent, spm_percent, marks)

    fields = [("n", T.LongType(), pa.int64()), ("form", T.StringType(), pa.string()), ("prefix_chars", T.LongType(), pa.int64()), ("middle_chars", T.LongType(), pa.int64()), ("output", T.StringType(), pa.string())]
    return _mapped(df, [F.col(text), draw], row, fields, [text])


def restore(df: DataFrame, text: str = "text", sentinels: Sentinels = Sentinels()) -> DataFrame:
    """df with the text rebuilt from ``output`` and ``form`` alone."""
    marks = sentinels.raw
    return _mapped(df, [F.col("output"), F.col("form")], lambda raw, form: (rebuilt(raw, form, marks),), [(text, T.StringType(), pa.string())], [])


def digests(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document the form, the lengths and the SHA-256 of the output and of the text rebuilt from it."""
    out = restore(transform(df.select(id_col, text), text, id_col), "__back")
    return out.select(id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("__back", 256).alias("restored_sha256"))
