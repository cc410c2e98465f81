"""JSON text and nested columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def json_path(col: Column | str, path: str) -> Column:
    """Text at a JSON path: ``$.a.b``, ``$.a[0]``, ``$['odd key']``; NULL when absent."""
    return F.get_json_object(col, path)


def json_paths(col: Column | str, array_path: str, field: str, keep_missing: bool = True) -> Column:
    """The field of every element of a JSON array, as array<string>.

    ``keep_missing`` leaves a NULL in the place of elements without the field; without it they are dropped.
    """
    items = F.from_json(F.get_json_object(col, array_path), "array<string>")
    vals = F.transform(items, lambda x: F.get_json_object(x, f"$['{field}']"))
    return vals if keep_missing else F.array_compact(vals)


def parse_by_example(col: Column | str, example: str) -> Column:
    """Parse JSON text by the schema of an example document."""
    return F.from_json(col, F.schema_of_json(F.lit(example), {"allowSingleQuotes": "true"}))


def parse_items(df: DataFrame, col: str, element: str, keep: list[str], outer: bool = False) -> DataFrame:
    """JSON array text to one row per element with its 0-based ``pos``; the text is parsed once.

    ``element`` is the DDL of one element; nested values declared STRING keep their JSON text.
    """
    arr = F.from_json(F.col(col), f"ARRAY<STRUCT<{element}>>")
    gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
    return df.select(*keep, gen.alias("pos", "item")).select(*keep, "pos", "item.*")


def zip_rows(df: DataFrame, arrays: dict[str, str], keep: list[str]) -> DataFrame:
    """Parallel arrays to rows: element i of every array becomes row i; shorter arrays are padded with NULL."""
    zipped = F.arrays_zip(*[F.col(src).alias(out) for out, src in arrays.items()])
    return df.select(*keep, F.explode(zipped).alias("_z")).select(*keep, *[F.col(f"_z.{out}").alias(out) for out in arrays])
