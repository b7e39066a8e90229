"""Column expressions: postcode patterns and extraction, website, page predicate, labels
(``text``); scheduler durations, integer division, report thresholds (``durations``)."""
