"""Training-data operators on Spark DataFrames: chat formatting, subword
encoding, toxicity and quality scoring, WARC archives, similarity joins,
vector search, decontamination, substring dedup and language-model scoring.

Nothing else in the library imports this subpackage.
"""
