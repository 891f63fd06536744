"""Training-data operators: packing, search, scoring, deduplication,
tokenising, language and quality models. Nothing else in the library
imports this subpackage."""
