"""Keys that stand for long texts and seeded hash order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def digest_key(digest: Column) -> Column:
    """A digest as 32 bytes, empty for a null one, so that it is never null itself.

    A nullable join key would get a not-null filter that hashes every text a second time. The empty
    key equals no digest.
    """
    return F.coalesce(F.unhex(digest), F.lit(b""))


def text_key(text: Column) -> Column:
    """The key of a text, so that joins shuffle and sort on it and not on the text."""
    return digest_key(text_digest(text))


def hash_order(record_id: Column, seed: int) -> Column:
    """A uniform hex string per record that depends on nothing but its id and the seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), record_id.cast("string")))


def row_content(df: DataFrame) -> Column:
    """A digest of all columns of a row: rows have the same one when they are equal, and only then."""

    def text(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BinaryType):
            return F.hex(column)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # A null within a list and an absent field are not the same.
            return F.to_json(column, {"ignoreNullFields": "false"})
        return column.cast("string")

    fields = [text(field) for field in df.schema.fields]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in fields]
    return F.md5(F.concat(*sized))
