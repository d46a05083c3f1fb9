"""The public tokenizer files that the queries use, with how their texts may be cut."""

import public_tokenizers

from jobmart.llm.tokens import LEADING_SPACE, NO_BAR, ONE_SPACE, UNFOLDED, WORDS_ONLY, Encoding

STORE_ENCODING = Encoding(
    public_tokenizers.path("word_bpe_49k.json"), WORDS_ONLY, end_id=1, between=" | ", joins=NO_BAR,
    unfolded=UNFOLDED,
)
PACKING_ENCODING = Encoding(
    public_tokenizers.path("byte_bpe_50k.json"), LEADING_SPACE, end_id=0, between="\n", joins=ONE_SPACE
)
SEQUENCE_TOKENS = 2048
