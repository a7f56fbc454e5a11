"""Readers (S1-S11). Every reader uses an explicit schema: no inference."""

from corate.sources.json import REVIEW_SCHEMA, parse_reviews, read_reviews  # noqa: F401
from corate.sources.tables import (  # noqa: F401
    event_ratings, load_table, named_order_ratings, order_ratings, raw_order_triples,
)
from corate.sources.text import (  # noqa: F401
    parse_index, parse_recommendation_lines, parse_triples, read_index,
    read_neighbours, read_recommendation_lines, read_triples, read_user_list,
)
