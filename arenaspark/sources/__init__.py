from arenaspark.sources.io import (  # noqa: F401
    Catalog, conform, empty_frame, read_catalog, read_csv, write_csv, write_table,
)
