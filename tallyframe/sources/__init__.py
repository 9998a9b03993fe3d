from tallyframe.sources.tables import (  # noqa: F401
    TABLES,
    literal_table,
    materialize,
    load,
    parse_pairs,
    read_json_records,
    read_text_lines,
    read_xy_csv,
)
