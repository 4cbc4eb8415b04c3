from emberwake.sinks.tables import (
    DEST_FORMATS, PHOENIX, Destination, describe_schema, profile, read_item, sample, write_by_class,
    write_table,
)

__all__ = ["DEST_FORMATS", "PHOENIX", "Destination", "describe_schema", "profile", "sample",
           "read_item", "write_by_class", "write_table"]
