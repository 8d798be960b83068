"""Column expressions: casts, object keys, checksums."""

from intake.functions.casts import int_cast, int_lenient, int_strict, typed_value
from intake.functions.checksum import checksum, row_hash
from intake.functions.keys import file_type_ok, key_verdict, table_name

__all__ = [
    "checksum",
    "file_type_ok",
    "int_cast",
    "int_lenient",
    "int_strict",
    "key_verdict",
    "row_hash",
    "table_name",
    "typed_value",
]
