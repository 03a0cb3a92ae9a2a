"""Bounded memos over the tokenizers library: ids of white-space-free words.

The library is the only encoder here. Words not met yet are put into one text with a
special token between them, which the library always cuts at, so that thousands of
words cost one call; the result of a word doesn't depend on its neighbours.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: Entries of a memo before it is dropped; results never depend on it.
MEMO = 700_000
#: Words of one text given to the library.
JOINED = 256
#: Bytes of text that are split and joined at once.
BATCH_BYTES = 4_000_000

# without the dotted capital I, whose small form ends in a mark that joins what follows
_stem = re.compile(r"(.*[A-Za-zÀ-ÖØ-öø-įı-ɏ])([.,;:!?*%$#&|]+)", re.S).fullmatch


def load(path: str):
    """The tokenizer of a .json file, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encode_apart(tokenizer, separator: str, words: list[str]) -> list[list[int]]:
    """Ids of each word by itself; no word may hold a special token's string."""
    mark = tokenizer.token_to_id(separator)
    blocks = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
    encoded = tokenizer.encode_batch_fast([separator.join(b) for b in blocks], add_special_tokens=False)
    out: list[list[int]] = []
    for block, e in zip(blocks, encoded, strict=True):
        ids = e.ids
        at = [-1, *np.flatnonzero(np.asarray(ids) == mark).tolist(), len(ids)]
        if len(at) != len(block) + 1:
            raise ValueError("a word holds the separator")
        out += [ids[a + 1 : b] for a, b in zip(at, at[1:], strict=False)]
    return out


#: Words of small letters that no normaliser changes: one piece of a pattern that takes runs of letters.
plain_word = re.compile("[a-zà-öø-ÿ]+").fullmatch


def last_tokens(tokenizer, suffix: str = "</w>") -> np.ndarray:
    """Which ids end a piece, for vocabularies that mark it."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    out[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
    return out


def encode_plain(tokenizer, last: np.ndarray, separator: str, words: list[str]) -> list[list[int]]:
    """Ids of each plain word, from texts of many words that are cut where a piece ends.

    A text whose pieces aren't as many as its words is encoded word by word.
    """
    blocks = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
    out: list[list[int]] = []
    for block, e in zip(blocks, tokenizer.encode_batch_fast([" ".join(b) for b in blocks], add_special_tokens=False), strict=True):
        ids = e.ids
        cuts = [0, *(np.flatnonzero(last[ids]) + 1).tolist()]
        whole = len(cuts) == len(block) + 1 and cuts[-1] == len(ids)
        out += [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] if whole else encode_apart(tokenizer, separator, block)
    return out


def stem_and_marks(word: str) -> tuple[str, str]:
    """(word up to its last letter, closing marks): two pieces in every pattern used here."""
    m = _stem(word)
    return (m[1], m[2]) if m else (word, "")
