"""Token ids inside tasks, from the rank file of a public byte-level BPE vocabulary.

The ids are those of ``tokenizers`` with the JSON file of the same vocabulary, which
the tests compare; the rank file encodes about five times as fast. Its splitting can't
take very long runs of white space, so those are cut out here, where the pattern cuts
them, and encoded as the single pieces that they are.
"""

from __future__ import annotations

import base64
import functools
import os

import regex

VOCABULARY = "byte_bpe_50k.tiktoken"
END_OF_TEXT = "<|endoftext|>"
#: Runs of white space from this length are cut out.
LONG_RUN = 20_000
END_OF_TEXT_ID = 50256


def vocabulary_path(name: str = VOCABULARY) -> str:
    """``name`` itself if it is a path, else the file of that name in the public package."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def encoding(vocabulary: str = VOCABULARY):
    """The encoder, made once per worker process."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "bpe",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={END_OF_TEXT: END_OF_TEXT_ID},
    )


@functools.cache
def _long_run() -> regex.Pattern:
    return regex.compile(rf"\s{{{LONG_RUN},}}+")


def piece_ids(piece: str, vocabulary: str = VOCABULARY) -> list[int]:
    """Ids of one pre-token, which the pattern doesn't split."""
    return encoding(vocabulary)._encode_single_piece(piece)


def token_ids(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    """Ids of a whole text; the end-of-text string is its special token, as in ``tokenizers``."""
    encode = functools.partial(encoding(vocabulary).encode, allowed_special="all", disallowed_special=())
    if len(text) < LONG_RUN:
        return encode(text)
    ids, at = [], 0
    for run in _long_run().finditer(text):
        # The last character of a run belongs to what follows, unless nothing does.
        end = run.end()
        if end < len(text) and not text.startswith(END_OF_TEXT, end):
            end -= 1
        ids += encode(text[at : run.start()]) + piece_ids(text[run.start() : end], vocabulary)
        at = end
    return ids + encode(text[at:])
