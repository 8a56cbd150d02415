"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.storage import BATCH_BYTES, bounded_batches, fresh_path, nullable, shared_dir, stored, table  # noqa: F401

#: Prefix of every helper column, so that columns of the input never clash with them.
OWN = "__weft_"


def fold(column, modulus: int = 5):
    """crc32 of the id as text, modulo ``modulus``; a null id falls in no fold (null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus
