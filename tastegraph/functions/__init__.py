from tastegraph.functions.lists import as_lists, top_per_group
from tastegraph.functions.scalar import association, delimited, half_up, priority, tokens, year_month

__all__ = ["as_lists", "association", "delimited", "half_up", "priority", "tokens", "top_per_group", "year_month"]
