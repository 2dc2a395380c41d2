"""Byte-pair encoding and decoding of whole texts.

Encoding: the symbols of a piece form a doubly linked list; a priority queue holds the merge rank
of each neighbouring pair, lowest rank first and then leftmost. A popped pair that no longer stands
in the list is stale and skipped; a merge links the new symbol to its neighbours and queues the two
pairs it makes. Decoding joins the vocabulary strings of the ids.

Null text: empty. An empty text has no ids and decodes to the empty text. Extra columns stay out of
the result; repeated rows give repeated results; a null doc_id stays null.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shoplens.llm.tokens import ODD_WORD, TextEncoder, pieces_of
from shoplens.llm.words import slices

#: White space and the piece pattern of the vocabulary file.
WHITE = "\t-\r \x85\xa0  -     　"
PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"
)

def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Bpe(TextEncoder):
    """Merges of a byte-level vocabulary with word ends, from its JSON file."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        characters = byte_characters()
        self.inside = [vocab[c] for c in characters]
        self.last = [vocab[c + suffix] for c in characters]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            key = vocab[left] << 32 | vocab[right]
            self.merges.setdefault(key, rank << 32 | vocab[left + right])
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        names = {**vocab, **self.special}
        self.strings = [""] * (max(names.values()) + 1)
        for token, place in names.items():
            self.strings[place] = token
        found = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.cut = re.compile(f"({found})" if found else r"(?!)")

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        symbols = [self.inside[b] for b in data]
        size = len(symbols)
        symbols[-1] = self.last[data[-1]]
        rank_of = self.merges.get
        queue = []
        for i in range(size - 1):
            pair = symbols[i] << 32 | symbols[i + 1]
            if (merged := rank_of(pair)) is not None:
                queue.append((merged >> 32, i, merged & 0xFFFFFFFF, pair))
        heapq.heapify(queue)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        while queue:
            _, i, made, pair = heapq.heappop(queue)
            j = after[i]
            if symbols[i] < 0 or j >= size or symbols[i] << 32 | symbols[j] != pair:
                continue  # stale: one of the two has been merged meanwhile
            symbols[i], symbols[j] = made, -1
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                if (merged := rank_of(new := made << 32 | symbols[k])) is not None:
                    heapq.heappush(queue, (merged >> 32, i, merged & 0xFFFFFFFF, new))
            if (h := before[i]) >= 0 and (
                merged := rank_of(new := symbols[h] << 32 | made)
            ) is not None:
                heapq.heappush(queue, (merged >> 32, h, merged & 0xFFFFFFFF, new))
        return [s for s in symbols if s >= 0]

    def fresh(self, words: list[str], plain: bool) -> list[bytes]:
        return [np.array(self.word(w), dtype="<u4").tobytes() for w in words]

    def word(self, word: str) -> list[int]:
        """Ids of a run without ASCII white space."""
        if not ODD_WORD.search(word):
            word = word.lower()
            if word.isalpha():
                return self.merge(word.encode())
            return [i for piece in pieces_of(word) for i in self.merge(piece.encode())]
        ids = []
        for part in self.cut.split(word):
            if part in self.special:
                ids.append(self.special[part])
            else:
                # Capital sigma by itself: str.lower() would look at its neighbours.
                low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                ids += [i for piece in PIECES.findall(low) for i in self.merge(piece.encode())]
        return ids

    def encode(self, text: str) -> list[int]:
        return self.texts(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings, a space between two; ids outside the vocabulary are left out."""
        strings = self.strings
        return " ".join([strings[i] for i in ids if i < len(strings)])


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    return Bpe(path)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and its ids (array<int>) for every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for part in slices(batches):
            ids, starts = model.texts(part.column("text"))
            column = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids.astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, ids array<int>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: every text encoded, its ids decoded."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for part in slices(batches):
            ids, starts = model.texts(part.column("text"))
            coded, decoded = [], []
            for start, end in zip(starts.tolist(), starts[1:].tolist()):
                own = ids[start:end]
                coded.append(hashlib.sha256(own.tobytes()).hexdigest())
                text = model.decode(own.tolist())
                decoded.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(starts), pa.int64()),
                 pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
