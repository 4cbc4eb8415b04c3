from emberwake.sources.delimited import (
    enforce_not_null, read_delimited, read_source, validate,
)
from emberwake.sources.files import list_files, list_tree
from emberwake.sources.points import features, labelled_points, to_rows
from emberwake.sources.spec import parse_nullable, parse_type, schema_from_spec, write_spec

__all__ = [
    "enforce_not_null", "read_delimited", "read_source", "validate", "list_files", "list_tree",
    "features", "labelled_points", "to_rows", "parse_nullable", "parse_type",
    "schema_from_spec", "write_spec",
]
