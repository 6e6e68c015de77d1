"""Training-data operators: packing, toxicity, near-dedup, language ID, HTML
extraction, quality, line dedup, decontamination, embedding dedup, sharding,
spelling variants, whitening, chat formatting.

Nothing outside this subpackage imports it.
"""
