"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from stockout.llm.chat import CHAT_SQL, chat_query
from stockout.llm.decontaminate import decontaminate_query
from stockout.llm.embeddings import EMBEDDINGS_SQL, embeddings_query
from stockout.llm.lm import lm_query
from stockout.llm.minhash import minhash_query
from stockout.llm.passages import passages_query
from stockout.llm.quality import quality_query
from stockout.llm.secrets import secrets_query
from stockout.llm.sentencepiece import sentencepiece_query
from stockout.llm.spelling import SPELLING_SQL, spelling_query
from stockout.llm.token_files import token_files_query
from stockout.llm.urls import urls_query
from stockout.llm.whitening import whitening_query

QUERIES = {
    "op1_quality": quality_query,
    "op2_decontaminate": decontaminate_query,
    "op3_embeddings": embeddings_query,
    "op4_minhash": minhash_query,
    "op5_sentencepiece": sentencepiece_query,
    "op6_secrets": secrets_query,
    "op7_token_files": token_files_query,
    "op8_urls": urls_query,
    "op9_lm": lm_query,
    "op10_chunks": passages_query,
    "op11_spelling": spelling_query,
    "op12_chat": chat_query,
    "op13_whitening": whitening_query,
}

#: The others are held by tests/llm against brute-force versions, libraries, exact round trips and
#: held-out figures.
ORACLE_SQL: dict[str, str] = {"op3_embeddings": EMBEDDINGS_SQL, "op11_spelling": SPELLING_SQL, "op12_chat": CHAT_SQL}
