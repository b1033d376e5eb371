"""Text to ids of a public byte-level vocabulary."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

#: White space in a row that the fast encoder still takes: its pattern
#: ``\s+(?!\S)`` goes back character by character and runs out of stack on
#: about a million.
LONGEST_BLANK = 100_000


def encoder(vocabulary: str, ranks: str) -> Callable[[str], list[int]]:
    """text -> ids, as the ``tokenizers`` library gives them for ``vocabulary``.

    ``ranks`` holds the same vocabulary for a faster encoder.  A text with the
    vocabulary's special token, or with a very long run of white space, goes
    to the library itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    whole = Tokenizer.from_file(vocabulary)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    blank = re.compile(rf"\s{{{LONGEST_BLANK}}}")

    def encode(text: str) -> list[int]:
        if any(s in text for s in special) or len(text) > LONGEST_BLANK and blank.search(text):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def vocabulary_size(vocabulary: str) -> int:
    """Ids of the vocabulary, special tokens included."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary).get_vocab_size(with_added_tokens=True)
