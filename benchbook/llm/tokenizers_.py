"""Tokenizer files, opened once per Python worker. Their paths are parameters; nothing is trained."""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import public_tokenizers

BYTE_BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE_JSON = public_tokenizers.path("word_bpe_49k.json")

#: Characters on which every Unicode version and regex engine agrees: ASCII, letters of Latin-1 and
#: Latin Extended-A that lower-case one to one, common quotes and dashes. NFC leaves them alone.
PLAIN = re.compile(
    "[\t-\r -~À-ÖØ-öø-įıĴ-ňŊ-ž–—‘’“”…€]*"
)


@lru_cache(maxsize=4)
def ranked(path: str, pattern: str = public_tokenizers.PATTERN):
    """A tiktoken encoding without special tokens from a rank file."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def library(path: str):
    """A tokenizer of the tokenizers library, without truncation or padding."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=4)
def special_strings(path: str) -> tuple[str, ...]:
    """Strings of special tokens, read from the file; the library, which takes much memory, is opened only for texts that need it."""
    with open(path, encoding="utf-8") as file:
        return tuple(t["content"] for t in json.load(file)["added_tokens"])
