"""Words of a text: runs of letters, digits and anything beyond ASCII, in lower case."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of ASCII: letters in lower case, digits, and a space for all else. Higher bytes stay.
AS_WORDS = bytes(
    ord(chr(code).lower()) if code < 128 and chr(code).isalnum() else code if code > 127 else 32
    for code in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8; none for null."""
    return (text or b"").translate(AS_WORDS).split()


def texts_of(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as UTF-8."""
    return column.cast(pa.binary()).to_pylist()


def sorted_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Rows sorted by ``keys``, cut where a key changes; True with a group's first rows."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(name) for name in keys]
        changed = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
            changed[1:] |= codes[1:] != codes[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(column[start].as_py() for column in columns)
            yield key != last, batch.slice(start, end - start)
            last = key
