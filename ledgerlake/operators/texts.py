"""Text columns carried through a shuffle as one column.

A shuffled row gives every column a slot of its own and every text a padded
place, which compresses badly where a row has many short texts.  ``with_texts_packed``
joins them to one text and ``with_texts_unpacked`` gives back the columns, with
the same values: NULL, empty and any characters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Between two texts; what stands before an escaped character; a NULL.
_NEXT, _ESCAPE = "\x02", "\x01"
_NULL = _ESCAPE + "n"
#: The packed column.
PACKED = "_texts"


def _escaped(text: Column) -> Column:
    marked = F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "a")), F.lit(_NEXT), F.lit(_ESCAPE + "b"))
    return F.coalesce(marked, F.lit(_NULL))


def _restored(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit(_ESCAPE + "b"), F.lit(_NEXT)), F.lit(_ESCAPE + "a"), F.lit(_ESCAPE))
    return F.when(~F.contains(text, F.lit(_ESCAPE)), text).when(text != _NULL, plain)


def text_columns(df: DataFrame, besides: Sequence[str] = ()) -> list[str]:
    """The text columns of ``df`` that aren't ``besides``."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string" and f.name not in besides]


def with_texts_packed(df: DataFrame, names: Sequence[str], packed: str = PACKED) -> DataFrame:
    """``df`` with the text columns ``names`` (one at least) joined into the column ``packed``."""
    return df.select(*[c for c in df.columns if c not in names],
                     F.concat_ws(_NEXT, *[_escaped(F.col(c)) for c in names]).alias(packed))


def with_texts_unpacked(df: DataFrame, names: Sequence[str], packed: str = PACKED, like: DataFrame | None = None) -> DataFrame:
    """The columns ``names`` in place of ``packed``, which ``with_texts_packed`` made of them.

    Those whose schema in ``like`` excludes NULL exclude it here too.
    """
    never_null = {f.name for f in like.schema.fields if not f.nullable} if like is not None else set()
    texts = df.withColumn(packed, F.split(packed, _NEXT))

    def text(i: int, name: str) -> Column:
        found = _restored(F.col(packed)[i])
        return (F.coalesce(found, F.lit("")) if name in never_null else found).alias(name)

    return texts.select(*[c for c in df.columns if c != packed], *[text(i, c) for i, c in enumerate(names)])
