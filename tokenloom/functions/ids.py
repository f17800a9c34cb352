"""Small operations on id arrays and reply text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Buffer cap and preview sizes.
ID_BUFFER_CAP = 262_144
PREVIEW_IDS = 64
PREVIEW_CHARS = 300


def with_bos(ids: Column, bos_id: Column, add_bos: Column) -> Column:
    """Put the BOS id first when the model asks for it and has one."""
    return F.when(
        F.coalesce(add_bos, F.lit(False)) & bos_id.isNotNull(),
        F.concat(F.array(bos_id.cast("int")), ids),
    ).otherwise(ids)


def capped(ids: Column, cap: int = ID_BUFFER_CAP) -> Column:
    """The first ``cap`` ids; report ``size(ids)`` beside it as the full length."""
    return F.slice(ids, 1, cap)


def preview_ids(ids: Column) -> Column:
    return F.slice(ids, 1, PREVIEW_IDS)


def preview_text(body: Column) -> Column:
    return F.left(body, F.lit(PREVIEW_CHARS))


def ids_or_empty(ids: Column) -> Column:
    """A failed encode gives no ids; pair it with ``ids.isNotNull()`` as ``ok``."""
    return F.coalesce(ids, F.array().cast("array<int>"))


def first_difference(a: Column, b: Column) -> Column:
    """1-based position where two id arrays first differ; null when they do not."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    position = F.array_position(same, False)
    return F.when(position > 0, position)
