"""Token ids of whole texts at the cost of their distinct words.

The vocabulary files meant here drop white space and never join words, so a text has the ids of its
words, one after the other. Plain texts are first cut at the borders of letter runs, by Arrow; each
distinct word of a slice is then looked up in a bounded cache, and only words that the cache lacks
are encoded.
"""

from __future__ import annotations

import gc
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shoplens.llm.words import split_words

CALL, ROW, STEP = 2_000, 8, 1 << 16
#: Bytes that a worker's cache of words may take, and what an entry takes besides its word and ids.
CACHE, ENTRY = 96 << 20, 180
#: Characters whose case and normal form do not depend on their neighbours; the letters in lower case.
PLAIN, LETTERS = "\\t-\\r -~À-ÖØ-öø-ÿ", "a-zß-öø-ÿ"
ODD = f"[^{PLAIN}]|<\\|"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
ODD_WORD = re.compile(ODD)
WORD_END = "</w>"


class TextEncoder:
    """ids of texts, by ``fresh``: the ids (little-endian uint32 bytes) of words not seen before;
    ``plain`` says that all of them are plain and in lower case."""

    by_word = True

    def __init__(self, cache: int | None = None):
        self.known: dict[str, bytes] = {}
        self.held, self.cache = 0, CACHE if cache is None else cache

    def fresh(self, words: list[str], plain: bool) -> list[bytes]:
        raise NotImplementedError

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (uint32), and where each text's begin. Null: empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            found = self.fresh(texts.to_pylist(), False)
            starts = np.cumsum([0, *map(len, found)])
            return np.frombuffer(b"".join(found), dtype="<u4"), starts // 4
        odd = pc.match_substring_regex(texts, ODD)
        all_plain = not pc.any(odd).as_py()
        words = split_words(spaced(texts) if all_plain else pc.if_else(odd, texts, spaced(texts)))
        each = self.ids_of(words.strings(), all_plain)
        return joined(each, words.codes, words.starts)

    def forget(self) -> None:
        """Empties the cache: a worker may serve other stages next."""
        self.known.clear()
        self.held = 0

    def ids_of(self, words: list[str], plain: bool) -> list[bytes]:
        if self.held > self.cache:
            self.forget()
        known, held = self.known, self.held
        each = list(map(known.get, words))
        missing = [i for i, ids in enumerate(each) if ids is None]
        gc.disable()  # many small objects, none of them in a cycle
        try:
            new = [words[i] for i in missing]
            for i, word, ids in zip(missing, new, self.fresh(new, plain)):
                each[i] = ids
                if held <= self.cache:  # a slice with very many words must not outgrow it either
                    known[word] = ids
                    held += len(word) + len(ids) + ENTRY
        finally:
            self.held = held
            gc.enable()
        return each


def joined(
    each: list[bytes], codes: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words ``codes`` one after the other, and where the ids of each text begin.

    Words lie in rows of ``ROW`` ids, so that a word is copied in one piece; longer ones take
    several rows.
    """
    if not len(codes):
        return np.empty(0, dtype="<u4"), np.zeros(len(starts), dtype=np.int64)
    sizes = np.fromiter(map(len, each), dtype=np.int64, count=len(each)) // 4
    rows = np.maximum(-(-sizes // ROW), 1)
    first = np.cumsum(rows) - rows
    table = np.zeros((int(rows.sum()), ROW), dtype="<u4")
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table.reshape(-1)[np.repeat(first * ROW, sizes) + inside] = np.frombuffer(
        b"".join(each), dtype="<u4"
    )
    left = np.repeat(sizes, rows) - ROW * (np.arange(len(table)) - np.repeat(first, rows))
    filled = np.minimum(left, ROW).astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(sizes[codes])])
    if len(table) > len(each):  # some words take several rows
        many = rows[codes]
        codes = np.arange(int(many.sum())) + np.repeat(first[codes] - np.cumsum(many) + many, many)
    out = np.empty(int(ends[-1]), dtype="<u4")
    column, done = np.arange(ROW, dtype=np.int32), 0
    for at in range(0, len(codes), STEP):
        some = codes[at : at + STEP]
        ids = table[some][column < filled[some][:, None]]
        out[done : done + len(ids)] = ids
        done += len(ids)
    return out, ends[starts]


def spaced(texts: pa.Array) -> pa.Array:
    """Plain texts in lower case with a space at both ends of each letter run.

    An apostrophe keeps its neighbours, since it may begin a contraction.
    """
    low = pc.utf8_lower(texts)
    low = pc.replace_substring_regex(low, rf"([{LETTERS}])([^{LETTERS}\s'])", r"\1 \2")
    return pc.replace_substring_regex(low, rf"([^{LETTERS}\s'])([{LETTERS}])", r"\1 \2")


def pieces_of(word: str) -> list[str]:
    """The pieces of a plain word in lower case."""
    return [word] if word.isalpha() else PIECES.findall(word)


class LibraryEncoder(TextEncoder):
    """``encode(text, add_special_tokens=False)`` of the tokenizers library, unused truncation and
    padding. A vocabulary file of another kind gets whole texts."""

    def __init__(self, path: str, cache: int | None = None):
        super().__init__(cache)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        first = (described.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_word = (
            described["model"].get("end_of_word_suffix") == WORD_END
            and first.get("type") == "Split"
            and first.get("behavior") == "Removed"
            and first.get("invert") is True
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        for token, place in vocabulary.items():
            self.ends[place] = token.endswith(WORD_END)
        self.size = len(self.ends)

    def fresh(self, words: list[str], plain: bool) -> list[bytes]:
        if not self.by_word:
            return self.library(words)
        odd = [] if plain else [w for w in words if ODD_WORD.search(w)]
        found = dict(zip(odd, self.library(odd)))
        mixed = {w: PIECES.findall(w.lower()) for w in words if not w.isalpha() and w not in found}
        whole = [w for w in words if w.isalpha() and w not in found]
        if not plain:
            mixed |= {w: [w.lower()] for w in whole}
            whole = []
        unseen = dict.fromkeys([*whole, *(p for own in mixed.values() for p in own)])
        ids = self.pieces(list(unseen))
        for word, own in mixed.items():
            found[word] = b"".join([ids[p] for p in own])
        return [found[w] if w in found else ids[w] for w in words]

    def pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces, many in one call; a token that ends a word ends its piece."""
        out: dict[str, bytes] = {}
        for at in range(0, len(pieces), CALL):
            some = pieces[at : at + CALL]
            ids = np.frombuffer(self.library([" ".join(some)])[0], dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):  # a piece without an end token
                out.update(zip(some, self.library(some)))
                continue
            raw, begin = ids.tobytes(), 0
            for piece, end in zip(some, (cuts * 4).tolist()):
                out[piece] = raw[begin:end]
                begin = end
        return out

    def library(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]


def with_end(ids: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with id ``end`` after each text."""
    joined = np.insert(ids, starts[1:], np.uint32(end)) if len(starts) > 1 else ids
    return joined.astype("<u4", copy=False), starts + np.arange(len(starts))


@lru_cache(maxsize=2)
def encoder(path: str, cache: int | None = None) -> LibraryEncoder:
    """One encoder for each Python worker."""
    return LibraryEncoder(path, cache)


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
