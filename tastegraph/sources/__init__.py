from tastegraph.sources.messages import format_messages, parse_rating_messages, read_rating_stream
from tastegraph.sources.tables import load_table, save_table
from tastegraph.sources.text import load_products, load_ratings
from tastegraph.sources.views import event_ratings, events_split, products, ratings

__all__ = [
    "event_ratings", "events_split", "format_messages", "load_products", "load_ratings",
    "load_table", "parse_rating_messages", "products", "ratings", "read_rating_stream",
    "save_table",
]
