"""Column expressions; all of them stay inside the JVM."""

from catalogflow.functions.clock import ago_text, local_text, parse_local_text
from catalogflow.functions.text import sentiment, split_list, strip, title_year, tokens

__all__ = [
    "ago_text", "local_text", "parse_local_text",
    "sentiment", "split_list", "strip", "title_year", "tokens",
]
