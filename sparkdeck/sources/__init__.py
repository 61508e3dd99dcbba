"""Readers (line, delimited, CSV) and sinks."""

from sparkdeck.sources.csv import read_csv_inferred, read_csv_named, read_csv_strings  # noqa: F401
from sparkdeck.sources.delimited import (  # noqa: F401
    parse_delimited,
    parse_item_titles,
    parse_items,
    parse_pipe_users,
    parse_rated_pairs,
    parse_tab_ratings,
    parse_user_texts,
)
from sparkdeck.sources.sinks import (  # noqa: F401
    persist_for_reuse,
    read_kv_text,
    write_csv,
    write_kv_text,
    write_text_values,
)
from sparkdeck.sources.text import read_lines  # noqa: F401
