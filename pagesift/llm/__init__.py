"""Training-data operators (deduplication, scoring, mixing, tokenisation); nothing else in the
library imports this subpackage."""
