"""Training-data operators: deduplication, quality, language, secrets, packing, tokens, search, sharding, URL lists.

Nothing else in the library imports this package. Every operator takes and returns DataFrames; the thin `opN_*`
queries stand at the end of each module.
"""

import importlib

_MODULES = ("simhash_dedup", "quality_rules", "packing", "bitsliced_topk", "secret_scan", "language_id", "sharding", "bpe", "token_counts", "url_filters", "decontamination", "conversation_repair", "token_alignment")


def load_all() -> None:
    """Import every operator module, so that its query is registered."""
    for name in _MODULES:
        importlib.import_module(f"shelfline.llm.{name}")
