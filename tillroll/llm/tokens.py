"""Encoding whole texts inside tasks."""

from __future__ import annotations

import functools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillroll.llm.alignment import _byte_of_letter

# Words of ASCII letters, digits and marks, and of the letters that follow them in Unicode, fall
# into these pieces wherever they stand, once in lower case.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PLAIN = f"^[!-~{LETTERS}]*$"
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+"

# A word that holds this may hold a special token, which stays one token as the tokenizer has it.
SPECIAL = "<|"
# Merging takes time with the square of a word's length; longer ones are left to the tokenizer.
PLAIN_BYTES = 128


def _merges_to_a_space(path: str):
    """(encoding, whether an id ends a piece) by the merges of a tokenizer file, for pieces that
    each end in a space in place of the vocabulary's end-of-word suffix.

    A space joins the byte before it ahead of all other merges.  Those are ranked by the ids they
    make; each makes one of its own, which its letters by themselves are merged to as well, and so
    the ids are those of the tokenizer's model.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
    pairs = (pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"])
    first = len(vocabulary) - len(model["merges"])
    if [vocabulary["".join(pair)] for pair in pairs] != list(range(first, len(vocabulary))):
        raise ValueError(f"the merges of {path} are not in the order of their ids")
    letters = _byte_of_letter()
    ranks, ends_piece = {}, np.zeros(len(vocabulary), bool)
    for token, number in vocabulary.items():
        stem = token.removesuffix(suffix)
        ends_piece[number] = stem != token
        ranks[bytes(map(letters.__getitem__, stem)) + b" " * (stem != token)] = number
    encoding = tiktoken.Encoding(
        os.path.basename(path), pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}
    )
    return encoding, ends_piece


class WordEncoder:
    """Encodes with the lower-casing tokenizer that drops white space and never merges across it,
    word by word.

    Ids of a text are the ids of its words in order, and each distinct word of a batch of texts is
    encoded once.  Ids of a plain word are those of its pieces by the tokenizer's merges alone; any
    other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces, self.ends_piece = _merges_to_a_space(path)

    def _plain_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words in a row, and how many each has."""
        spaced = pc.replace_substring_regex(
            pc.utf8_lower(words), pattern=PIECE, replacement=r"\0 "
        )
        pieces = pc.count_substring(spaced, " ").to_numpy(zero_copy_only=False)
        ids = self.pieces.encode_to_numpy("".join(spaced.to_pylist())).astype("<u4")
        ends = np.concatenate([[0], np.flatnonzero(self.ends_piece[ids]) + 1])
        word_ends = ends[np.cumsum(pieces)]
        return ids, np.diff(word_ends, prepend=0)

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words in any order, where those of each word begin, and how many it has."""
        plain = pc.and_(
            pc.and_not(
                pc.match_substring_regex(words, PLAIN), pc.match_substring(words, SPECIAL)
            ),
            pc.less_equal(pc.binary_length(words), PLAIN_BYTES),
        )
        first, first_counts = self._plain_ids(words.filter(plain))
        others = words.filter(pc.invert(plain)).to_pylist()
        rest = [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        ids = np.concatenate([first, *(np.array(own, "<u4") for own in rest)])
        plain = plain.to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        counts = np.concatenate([first_counts, np.array([len(own) for own in rest], np.int64)])
        starts_by_word, counts_by_word = np.empty((2, len(words)), np.int64)
        starts_by_word[order] = np.cumsum(counts) - counts
        counts_by_word[order] = counts
        return ids, starts_by_word, counts_by_word

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, and the place before the first text and after each; words are
        split at ASCII white space only, the rest is left to the tokenizer."""
        folds = pc.and_not(pc.string_is_ascii(texts), pc.match_substring(texts, SPECIAL))
        words = pc.ascii_split_whitespace(pc.if_else(folds, pc.ascii_lower(texts), texts))
        coded = words.values.dictionary_encode()
        ids, starts, counts = self._word_ids(coded.dictionary)
        places = coded.indices.to_numpy(zero_copy_only=False)
        counts = counts[places]
        ends = np.concatenate([[0], np.cumsum(counts)])
        shifts = np.repeat(starts[places] - ends[:-1], counts)
        return ids[shifts + np.arange(ends[-1])], ends[words.offsets.to_numpy()]

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return self.batch(pa.array([text], pa.string()))[0]

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether its token closes a sentence."""
        vocabulary = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            if token.endswith("</w>") and token[:-4].rstrip("\"')]").endswith((".", "!", "?")):
                ends[number] = True
        return ends


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)


@functools.cache
def byte_pair_encoding(path: str, pattern: str):
    """A byte-level encoding from a file of ranks; no string is special."""
    import base64

    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(
        os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
