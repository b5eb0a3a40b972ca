"""Operators for training-data pipelines over documents, pages and benchmark items."""

from importlib import import_module

MODULES = (
    "toxicity_query",
    "warc_query",
    "language_query",
    "fingerprint_query",
    "secret_scan_query",
    "token_files_query",
    "decontaminate_query",
    "packing_query",
    "token_count_query",
    "jaccard_query",
    "superminhash_query",
    "merkle_query",
    "alignment_query",
)


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"tillmark.llm.{name}")
