"""Sources and sinks: document tables and the delimited text formats."""

from topic_tables.sources.tables import load_table, tokens_from_text  # noqa: F401
from topic_tables.sources.text import (  # noqa: F401
    format_doc_topic, format_similarity, format_topic_preview, format_topic_word, format_word_table,
    parse_bag_lines, parse_doc_topic_lines, parse_topic_word_lines, read_bags, read_doc_topic,
    read_topic_word, write_lines,
)
