"""The registered queries of this package and the SQL for those that SQL can express."""

import corpus_pipeline
from brookhouse.llm.decontaminate import op5_decontaminate
from brookhouse.llm.languages import op6_languages
from brookhouse.llm.lines import OP2_SQL, op2_lines
from brookhouse.llm.minhash import op8_minhash
from brookhouse.llm.mixing import op4_mixing
from brookhouse.llm.neardup_vectors import op1_embeddings
from brookhouse.llm.pages import op9_pages
from brookhouse.llm.quality import op7_quality
from brookhouse.llm.ranking import OP13_SQL, op13_search
from brookhouse.llm.substrings import OP12_SQL, op12_substrings
from brookhouse.llm.tokens import op3_tokens
from brookhouse.llm.trie import OP11_SQL, op11_conversations
from brookhouse.llm.urls import op10_urls

QUERIES = {"pipeline": corpus_pipeline.run} | {
    query.__name__: query
    for query in (
        op1_embeddings, op2_lines, op3_tokens, op4_mixing, op5_decontaminate, op6_languages, op7_quality, op8_minhash, op9_pages, op10_urls,
        op11_conversations, op12_substrings, op13_search,
    )
}
ORACLES = {"op2_lines": OP2_SQL, "op11_conversations": OP11_SQL, "op12_substrings": OP12_SQL, "op13_search": OP13_SQL}
