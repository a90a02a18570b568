"""Query op13: token counts with a public vocabulary."""

from __future__ import annotations

from valuelens.llm import token_counts
from valuelens.llm.tables import register, table

#: Vocabulary file of the query, by its name in the folder of public tokenizers.
VOCABULARY = "byte_bpe_50k.json"


@register("op13_token_counts")
def op13_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), limit=1024)
