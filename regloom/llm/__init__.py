"""Operators for preparing training text at scale: sharding, quality rules,
near-duplicates, mixing, WARC archives, sketches, tokenizing, toxicity,
licence scans, line deduplication, embedding whitening, chat formatting and
tokenizer alignment.

Nothing outside this package (and ``corpus_pipeline.py``) imports it."""
