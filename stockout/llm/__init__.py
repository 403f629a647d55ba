"""Training-data operators: filters, deduplication, tokenization and scoring of documents.

Nothing else in the library imports this subpackage; it imports only general helpers
(``stockout.stage``, ``stockout.session``).
"""
